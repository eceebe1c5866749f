"""Data-quality queries.

The stage tables are sound, so most checks would list nothing.  Each check runs
on whole tables that carry planted faults (the same expressions on both sides);
the suite as a whole also runs on the sound tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract.expected import NON_NEGATIVE, PART_OF
from contract.oracle_tables import over_stages
from contract.queries import register, sql_rounded
from contract.stage_queries import FEATURE_DOUBLES
from contract.stages import Stages
from tidemark.operators import normalize, quality
from tidemark.operators.quality import CHECKS, Tables, quality_rates, run_suite
from tidemark.policy import QualityThresholds

_DAY = "day(cutoff_date)"

# Table -> (column replacements, rows that occur twice), in SQL both engines read.
FAULTS: dict[str, tuple[dict[str, str], str]] = {
    "population": (
        {
            "target_inspection_date": f"CASE WHEN {_DAY} = 13 THEN cutoff_date ELSE target_inspection_date END",
            "target_inspection_id": f"CASE WHEN {_DAY} = 21 THEN cutoff_inspection_id ELSE target_inspection_id END",
            "cutoff_inspection_id": f"CASE WHEN {_DAY} = 22 THEN 'lost' ELSE cutoff_inspection_id END",
        },
        f"{_DAY} = 17",
    ),
    "labels": (
        {
            "target_inspection_date": f"CASE WHEN {_DAY} = 13 THEN cutoff_date ELSE target_inspection_date END",
            "target_inspection_id": f"CASE WHEN {_DAY} = 21 THEN cutoff_inspection_id ELSE target_inspection_id END",
            "target_high_severity": f"CASE WHEN {_DAY} = 23 THEN NULL WHEN {_DAY} = 24 THEN 2 ELSE target_high_severity END",
            "days_to_target": f"CASE WHEN {_DAY} = 25 THEN 0 WHEN {_DAY} = 26 THEN NULL ELSE days_to_target END",
        },
        f"{_DAY} = 18",
    ),
    "features": (
        {
            "last_cycle_inspection_date": f"CASE WHEN {_DAY} = 13 THEN CAST(cutoff_date + INTERVAL 1 DAY AS DATE) ELSE last_cycle_inspection_date END",
            "prior_cycle_inspection_count": f"CASE WHEN {_DAY} = 14 THEN -1 ELSE prior_cycle_inspection_count END",
            "prior_critical_inspection_rate": f"CASE WHEN {_DAY} = 15 THEN 1.5 WHEN {_DAY} = 16 THEN NULL ELSE prior_critical_inspection_rate END",
            "history_depth_bucket": f"CASE WHEN {_DAY} = 19 THEN '9' ELSE history_depth_bucket END",
            "cutoff_inspection_id": f"CASE WHEN {_DAY} = 22 THEN 'stray' ELSE cutoff_inspection_id END",
        },
        f"{_DAY} = 17",
    ),
    "events": (
        {
            "inspection_id": "CASE WHEN day(inspection_date) = 11 THEN 'lost' ELSE inspection_id END",
            "inspection_date": "CASE WHEN day(inspection_date) = 13 THEN DATE '1900-01-01' ELSE inspection_date END",
        },
        "day(inspection_date) = 17",
    ),
    "entities": ({}, "borough = 'ASIA'"),
    "scoring": (
        {"cutoff_date": "CASE WHEN borough = 'ASIA' THEN CAST(cutoff_date - INTERVAL 1 DAY AS DATE) ELSE cutoff_date END"},
        "borough = 'AFRICA'",
    ),
}

_SQL_NAME = {"population": "pop", "labels": "lab", "features": "feat", "events": "ev", "entities": "entities", "scoring": "scoring"}


def plant(df: DataFrame, table: str) -> DataFrame:
    changes, twice = FAULTS[table]
    doubled = df.unionByName(df.where(twice))
    kinds = dict(df.dtypes)
    return doubled.select(
        *[F.expr(changes[c]).cast(kinds[c]).alias(c) if c in changes else F.col(c) for c in df.columns]
    )


def _planted_sql() -> list[str]:
    parts = []
    for table, (changes, twice) in FAULTS.items():
        name = _SQL_NAME[table]
        replaced = ", ".join(f"{sql} AS {c}" for c, sql in changes.items())
        star = f"* REPLACE ({replaced})" if changes else "*"
        parts.append(f"bad_{table} AS (SELECT {star} FROM (FROM {name} UNION ALL FROM {name} WHERE {twice}))")
    return parts


class PlantedTables:
    """What the checks read, built on demand: sound stages with the planted faults."""

    thresholds = QualityThresholds()
    previous_rows = 50000

    def __init__(self, stages: Stages):
        self._stages = stages

    def __getattr__(self, table: str) -> DataFrame:
        if table == "audit":
            return normalize.dedup_audit(self._stages.rows)
        sound = getattr(self._stages, table)
        return plant(sound, table) if table in FAULTS else sound


_FEATURES = sql_rounded("SELECT * FROM bad_features", FEATURE_DOUBLES)


def _status(name: str, ok: str, rest: str, source: str) -> str:
    return f"SELECT '{name}' AS check_name, CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status, {rest} FROM {source}"


def _rows(name: str, source: str, broken: str) -> str:
    return f"SELECT '{name}' AS check_name, t.* FROM ({source}) t WHERE {broken}"


def _twice(name: str, table: str, key: str, counted: str) -> str:
    return f"SELECT '{name}' AS check_name, {key}, count(*) AS {counted} FROM {table} GROUP BY {key} HAVING {counted} > 1"


def _unique(name: str, table: str, total: str, distinct: str, extra: str) -> str:
    inner = f"(SELECT count(*) AS {total}, count(DISTINCT camis) AS {distinct}, {total} - {distinct} AS {extra} FROM {table})"
    return _status(name, f"{extra} = 0", "*", inner)


def _pair(name: str, a_table: str, b_table: str, a: str, b: str, gap: str, order: str) -> str:
    inner = f"(SELECT {a}, {b}, {order} AS {gap} FROM (SELECT count(*) AS {a} FROM {a_table}), (SELECT count(*) AS {b} FROM {b_table}))"
    return _status(name, f"{gap} = 0", "*", inner)


_ORACLES: dict[str, str] = {
    "normalization_row_count": _pair(
        "normalization_row_count", "raw", "norm", "raw_row_count", "normalized_row_count", "row_count_difference",
        "normalized_row_count - raw_row_count",
    ),
    "unexpected_critical_flag": _status(
        "unexpected_critical_flag", "n = 0", "n AS unexpected_row_count",
        "(SELECT count(*) AS n FROM norm WHERE critical_flag = 'Unexpected')",
    ),
    "deduplication_audit": (
        "SELECT 'deduplication_audit' AS check_name, 'INFO' AS status, a AS input_row_count, b AS output_row_count,"
        " a - b AS exact_duplicates_removed FROM (SELECT count(*) AS a FROM norm), (SELECT count(*) AS b FROM dedup)"
    ),
    "restaurant_camis_uniqueness": _unique(
        "restaurant_camis_uniqueness", "bad_entities", "restaurant_rows", "unique_camis", "duplicate_camis"
    ),
    "sentinel_dates_excluded_from_events": _status(
        "sentinel_dates_excluded_from_events", "n = 0", "n AS sentinel_event_count",
        "(SELECT count(*) AS n FROM bad_events WHERE year(inspection_date) = 1900)",
    ),
    "duplicate_inspection_id": _twice("duplicate_inspection_id", "bad_events", "inspection_id", "duplicate_count"),
    "violations_map_to_inspections": _status(
        "violations_map_to_inspections", "n = 0", "n AS violations_without_matching_inspection",
        "(SELECT count(*) AS n FROM viol ANTI JOIN bad_events USING (inspection_id))",
    ),
    "inspection_type_policy_audit": (
        "SELECT 'inspection_type_policy_audit' AS check_name, 'INFO' AS status, inspection_type, count(*) AS event_count,"
        " count(*) FILTER (is_eligible_target_event) AS target_eligible_events,"
        " count(*) FILTER (is_eligible_historical_event) AS historical_eligible_events,"
        " count(*) FILTER (has_critical_violation) AS any_critical_events,"
        " count(*) FILTER (critical_violation_count > 2) AS high_severity_events,"
        " round(CAST(100 AS DOUBLE) * avg((critical_violation_count > 2)::INT), 2) AS high_severity_event_rate_pct"
        " FROM bad_events GROUP BY inspection_type"
    ),
    "event_attribute_conflicts": (
        "SELECT 'event_attribute_conflicts' AS check_name, 'INFO' AS status, n AS conflicting_event_count,"
        " round(CAST(100 AS DOUBLE) * n / nullif(total, 0), 4) AS conflict_rate_pct FROM (SELECT count(*) AS total,"
        " count(*) FILTER (greatest(distinct_score_count, distinct_grade_count, distinct_action_count) > 1) AS n"
        " FROM bad_events)"
    ),
    "duplicate_prediction_cutoff": _twice(
        "duplicate_prediction_cutoff", "bad_population", "cutoff_inspection_id", "row_count"
    ),
    "target_not_after_cutoff": _rows(
        "target_not_after_cutoff", "FROM bad_population", "NOT t.target_inspection_date > t.cutoff_date"
    ),
    "invalid_target_event_type": (
        "SELECT 'invalid_target_event_type' AS check_name, p.* FROM bad_population p WHERE NOT EXISTS"
        " (FROM bad_events e WHERE e.inspection_id = p.target_inspection_id AND e.is_eligible_target_event)"
    ),
    "invalid_cutoff_event_type": (
        "SELECT 'invalid_cutoff_event_type' AS check_name, p.* FROM bad_population p WHERE NOT EXISTS"
        " (FROM bad_events e WHERE e.inspection_id = p.cutoff_inspection_id AND e.is_eligible_historical_event)"
    ),
    "prediction_label_count_match": _pair(
        "prediction_label_count_match", "bad_population", "bad_labels", "prediction_rows", "label_rows", "difference",
        "prediction_rows - label_rows",
    ),
    "duplicate_label": _twice("duplicate_label", "bad_labels", "cutoff_inspection_id", "label_count"),
    "label_target_not_after_cutoff": _rows(
        "label_target_not_after_cutoff", "FROM bad_labels", "NOT t.target_inspection_date > t.cutoff_date"
    ),
    "target_equals_cutoff": _rows(
        "target_equals_cutoff", "FROM bad_labels", "t.target_inspection_id = t.cutoff_inspection_id"
    ),
    "invalid_target_label": _rows(
        "invalid_target_label", "FROM bad_labels", "coalesce(t.target_high_severity, 7) NOT IN (0, 1)"
    ),
    "non_positive_days_to_target": _rows(
        "non_positive_days_to_target", "FROM bad_labels", "coalesce(t.days_to_target, 0) <= 0"
    ),
    "target_summary": (
        "SELECT 'target_summary' AS check_name, count(*) AS labeled_rows, CAST(sum(target_high_severity) AS BIGINT) AS critical_targets,"
        " round(CAST(100 AS DOUBLE) * avg(target_high_severity), 2) AS critical_target_rate_pct,"
        " min(days_to_target) AS min_days_to_target, round(avg(days_to_target), 1) AS avg_days_to_target,"
        " quantile_cont(days_to_target, 0.5) AS median_days_to_target, max(days_to_target) AS max_days_to_target FROM bad_labels"
    ),
    "cutoff_event_composition": (
        "SELECT 'cutoff_event_composition' AS check_name, cutoff_inspection_type, count(*) AS prediction_rows,"
        " round(CAST(100 AS DOUBLE) * count(*) / (SELECT count(*) FROM bad_population), 2) AS pct_prediction_rows,"
        " round(avg(days_to_target), 1) AS avg_days_to_target FROM bad_population GROUP BY ALL"
    ),
    "duplicate_feature_rows": _twice("duplicate_feature_rows", "bad_features", "cutoff_inspection_id", "row_count"),
    "feature_label_count_match": _pair(
        "feature_label_count_match", "bad_features", "bad_labels", "feature_rows", "label_rows", "difference",
        "feature_rows - label_rows",
    ),
    "features_map_to_prediction_population": _status(
        "features_map_to_prediction_population", "n = 0", "n AS features_without_prediction_population",
        "(SELECT count(*) AS n FROM bad_features ANTI JOIN bad_population USING (cutoff_inspection_id))",
    ),
    "future_event_in_feature_history": _rows(
        "future_event_in_feature_history", _FEATURES, "t.last_cycle_inspection_date > t.cutoff_date"
    ),
    "negative_feature_counts": _rows(
        "negative_feature_counts", _FEATURES,
        f"least({', '.join('t.' + c for c in NON_NEGATIVE)}) < 0",
    ),
    "inconsistent_feature_counts": _rows(
        "inconsistent_feature_counts", _FEATURES,
        "t.prior_cycle_inspection_count <> t.prior_cycle_initial_count + t.prior_cycle_reinspection_count"
        + "".join(f" OR t.{whole} < t.{part}" for part, whole in PART_OF),
    ),
    "invalid_critical_inspection_rate": _rows(
        "invalid_critical_inspection_rate", _FEATURES, "NOT coalesce(t.prior_critical_inspection_rate, -1) BETWEEN 0 AND 1"
    ),
    "invalid_history_depth_bucket": _rows(
        "invalid_history_depth_bucket", _FEATURES,
        "t.history_depth_bucket <> CASE WHEN t.prior_cycle_initial_count > 3 THEN '4+' WHEN t.prior_cycle_initial_count > 1"
        " THEN '2-3' ELSE CAST(t.prior_cycle_initial_count AS VARCHAR) END",
    ),
    "scoring_population_uniqueness": _unique(
        "scoring_population_uniqueness", "bad_scoring", "scoring_rows", "unique_restaurants", "duplicate_restaurants"
    ),
    "scoring_date_consistency": _status(
        "scoring_date_consistency", "distinct_scoring_dates = 1", "*",
        "(SELECT min(cutoff_date) AS min_scoring_date, max(cutoff_date) AS max_scoring_date,"
        " count(DISTINCT cutoff_date) AS distinct_scoring_dates FROM bad_scoring)",
    ),
    "history_depth_distribution": (
        "SELECT 'history_depth_distribution' AS check_name, history_depth_bucket, count(*) AS feature_rows,"
        " round(CAST(100 AS DOUBLE) * count(*) / (SELECT count(*) FROM bad_features), 2) AS pct_feature_rows"
        " FROM bad_features GROUP BY ALL"
    ),
}

assert set(_ORACLES) == set(CHECKS)


def _add(name: str) -> None:
    @register(f"dq_{name}", over_stages(_ORACLES[name], *_planted_sql()))
    def _(s):
        return CHECKS[name](PlantedTables(s))


for _name in CHECKS:
    _add(_name)


def sound_tables(s: Stages) -> Tables:
    return Tables(
        raw=s.raw,
        rows=s.rows,
        audit=normalize.dedup_audit(s.rows),
        entities=s.entities,
        events=s.events,
        violations=s.violations,
        population=s.population,
        labels=s.labels,
        features=s.features,
        scoring=s.scoring,
    )


_CLEAN_LISTS = [n for n in CHECKS if "status" not in _ORACLES[n] and n not in (
    "target_summary", "cutoff_event_composition", "history_depth_distribution")]


@register(
    "dq_suite",
    over_stages(
        "SELECT check_name, status, CAST(n AS BIGINT) AS result_rows FROM (VALUES "
        + ", ".join(f"('{n}', 'PASS', 0)" for n in _CLEAN_LISTS)
        + ", "
        + ", ".join(
            f"('{n}', 'PASS', 1)"
            for n in (
                "normalization_row_count", "restaurant_camis_uniqueness", "sentinel_dates_excluded_from_events",
                "violations_map_to_inspections", "prediction_label_count_match", "feature_label_count_match",
                "features_map_to_prediction_population", "scoring_population_uniqueness", "scoring_date_consistency",
            )
        )
        + ", ('deduplication_audit', 'INFO', 1), ('event_attribute_conflicts', 'INFO', 1), ('target_summary', 'INFO', 1)"
        ") v(check_name, status, n)"
        " UNION ALL SELECT 'unexpected_critical_flag', if(count(*) = 0, 'PASS', 'FAIL'), 1 FROM norm WHERE critical_flag = 'Unexpected'"
        " UNION ALL SELECT 'inspection_type_policy_audit', 'INFO', count(DISTINCT inspection_type) FROM ev"
        " UNION ALL SELECT 'cutoff_event_composition', 'INFO', count(DISTINCT cutoff_inspection_type) FROM pop"
        " UNION ALL SELECT 'history_depth_distribution', 'INFO', count(DISTINCT history_depth_bucket) FROM feat"
    ),
)
def _(s):
    return run_suite(sound_tables(s))


def _rate_sql(name: str, severity: str, limit: float, rate: str) -> str:
    return (
        f"SELECT '{name}' AS rate_name, '{severity}' AS severity, coalesce(CAST(({rate}) AS DOUBLE), 0) AS rate,"
        f" CAST({limit} AS DOUBLE) AS \"limit\""
    )


def _share(table: str, broken: str) -> str:
    return f"SELECT count(*) FILTER ({broken}) / CAST(count(*) AS DOUBLE) FROM {table}"


_RATES = [
    ("unexpected_critical_flag_rate", "hard", 0.0, _share("norm", "critical_flag = 'Unexpected'")),
    ("duplicate_restaurant_rate", "hard", 0.0, "SELECT 1 - count(DISTINCT camis) / CAST(count(*) AS DOUBLE) FROM bad_entities"),
    ("duplicate_inspection_event_rate", "hard", 0.0, "SELECT 1 - count(DISTINCT inspection_id) / CAST(count(*) AS DOUBLE) FROM bad_events"),
    ("orphan_violation_rate", "hard", 0.0, "SELECT (SELECT count(*) FROM viol ANTI JOIN bad_events USING (inspection_id)) / CAST(count(*) AS DOUBLE) FROM viol"),
    ("invalid_target_date_rate", "hard", 0.0, _share("bad_population", "target_inspection_date <= cutoff_date")),
    ("feature_future_date_rate", "hard", 0.0, _share("bad_features", "last_cycle_inspection_date > cutoff_date")),
    ("invalid_label_rate", "hard", 0.0, _share("bad_labels", "coalesce(target_high_severity, 7) NOT IN (0, 1)")),
    ("unparseable_inspection_date_rate", "soft", 0.01, _share("typed", "inspection_date IS NULL")),
    ("missing_borough_rate", "soft", 0.01, _share("norm", "borough IS NULL")),
    ("missing_cuisine_rate", "soft", 0.05, _share("norm", "cuisine_description IS NULL")),
    ("missing_location_rate", "soft", 0.25, _share("norm", "location IS NULL")),
    ("event_attribute_conflict_rate", "soft", 0.01, _share("bad_events", "greatest(distinct_score_count, distinct_grade_count, distinct_action_count) > 1")),
    ("source_row_count_change_rate", "soft", 0.30, "SELECT abs(count(*) - 50000) / CAST(50000 AS DOUBLE) FROM raw"),
]


@register(
    "dq_thresholds",
    over_stages(
        'SELECT rate_name, severity, round(rate, 6) AS rate, "limit", rate > "limit" AS breached FROM ('
        + " UNION ALL ".join(_rate_sql(*r) for r in _RATES)
        + ")",
        *_planted_sql(),
    ),
)
def _(s):
    return quality_rates(PlantedTables(s))
