"""Data-quality checks as queries, and the optional gate over them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import to_date_safe
from tidemark.functions.rates import DEPTH_BUCKETS
from tidemark.operators.events import violation_counts
from tidemark.operators.splits import TARGET
from tidemark.policy import SENTINEL_DATE, QualityThresholds

HALF_UP_2 = 2


@dataclass
class Tables:
    """The stage tables a check may read."""

    raw: DataFrame
    rows: DataFrame
    audit: DataFrame
    entities: DataFrame
    events: DataFrame
    violations: DataFrame
    population: DataFrame
    labels: DataFrame
    features: DataFrame
    scoring: DataFrame
    previous_rows: int | None = None
    thresholds: QualityThresholds = field(default_factory=QualityThresholds)
    violation_counts: DataFrame | None = None
    #: Counts known from the writes, by table and name of `FACTS`; those not here are counted.
    facts: Mapping[str, Mapping[str, int]] = field(default_factory=dict)


# --- check shapes -----------------------------------------------------------


def _named(name: str, df: DataFrame) -> DataFrame:
    return df.select(F.lit(name).alias("check_name"), *df.columns)


def _passed(condition: Column) -> Column:
    return F.when(condition, "PASS").otherwise("FAIL").alias("status")


def failing_rows(name: str, df: DataFrame, broken: Column) -> DataFrame:
    """Every column of the rows that break the rule."""
    return _named(name, df.where(broken))


def duplicates(name: str, df: DataFrame, key: str, counted: str) -> DataFrame:
    """Keys that occur more than once."""
    return _named(name, df.groupBy(key).agg(F.count(F.lit(1)).alias(counted)).where(F.col(counted) > 1))


def unique_key(name: str, df: DataFrame, key: str, total: str, distinct: str, extra: str) -> DataFrame:
    one = df.agg(F.count(F.lit(1)).alias(total), F.count_distinct(key).alias(distinct))
    return one.withColumn(extra, F.col(total) - F.col(distinct)).select(
        F.lit(name).alias("check_name"), _passed(F.col(extra) == 0), total, distinct, extra
    )


def counted(t: Tables, table: str, *names: str) -> DataFrame:
    """One row with counts of `FACTS`: those the write of the table has noted, else from one pass over it."""
    known = (getattr(t, "facts", None) or {}).get(table, {})
    if set(names) <= set(known):
        return t.events.sparkSession.range(1).select(*[F.lit(known[n]).cast("bigint").alias(n) for n in names])
    return getattr(t, table).agg(*[FACTS[table][n]().alias(n) for n in names])


def counts_match(name: str, t: Tables, left: str, right: str, a: str, b: str, difference: str, swap: bool = False) -> DataFrame:
    """Row counts of two tables side by side."""
    one = counted(t, left, "rows").withColumnRenamed("rows", a).withColumn(b, counted(t, right, "rows").scalar())
    gap = F.col(b) - F.col(a) if swap else F.col(a) - F.col(b)
    return one.select(F.lit(name).alias("check_name"), _passed(gap == 0), a, b, gap.alias(difference))


def orphans(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows whose key the other table lacks.

    Keys are event ids.  Most rows find theirs with their entity, by which stored tables lie;
    the few left are looked up by the key alone.
    """
    known = other.select("camis", F.col(other_key or key).alias(key))
    left = df.join(known, ["camis", key], "left_anti")
    return left.join(known.select(key), key, "left_anti").select(*df.columns)


def lost_violations(t: Tables) -> DataFrame:
    """One row with the number of detail rows whose event is missing."""
    per_event = getattr(t, "violation_counts", None)
    per_event = violation_counts(t.violations) if per_event is None else per_event
    lost = orphans(per_event, t.events, "inspection_id")
    return lost.agg(F.coalesce(F.sum("violation_rows"), F.lit(0)).alias("n"))


def none_lost(name: str, number: DataFrame, column: str) -> DataFrame:
    """PASS when the number of a one-row table is 0."""
    return number.toDF(column).select(F.lit(name).alias("check_name"), _passed(F.col(column) == 0), column)


def share_by(name: str, df: DataFrame, group: str, counted: str, share: str, *extra: Column) -> DataFrame:
    """Rows and percentage per group."""
    whole = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    grouped = df.groupBy(group).agg(F.count(F.lit(1)).alias(counted), *extra)
    pct = F.round(F.try_divide(100.0 * F.col(counted), whole), HALF_UP_2)
    others = [c for c in grouped.columns if c not in (group, counted)]
    return grouped.select(F.lit(name).alias("check_name"), group, counted, pct.alias(share), *others)


# --- foundation -------------------------------------------------------------


def policy_audit(events: DataFrame, threshold: int = 3) -> DataFrame:
    """Events per type with eligible, critical and severe counts."""
    severe = F.col("critical_violation_count") >= threshold
    return (
        events.groupBy("inspection_type")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.count_if("is_eligible_target_event").alias("target_eligible_events"),
            F.count_if("is_eligible_historical_event").alias("historical_eligible_events"),
            F.count_if("has_critical_violation").alias("any_critical_events"),
            F.count_if(severe).alias("high_severity_events"),
            F.round(100.0 * F.avg(severe.cast("double")), HALF_UP_2).alias("high_severity_event_rate_pct"),
        )
        .select(F.lit("inspection_type_policy_audit").alias("check_name"), F.lit("INFO").alias("status"), "*")
        .orderBy(F.desc("event_count"), "inspection_type")
    )


def _conflicting() -> Column:
    return (
        (F.col("distinct_score_count") > 1)
        | (F.col("distinct_grade_count") > 1)
        | (F.col("distinct_action_count") > 1)
    )


def attribute_conflicts(events: DataFrame) -> DataFrame:
    n = F.count_if(_conflicting())
    return events.agg(
        n.alias("conflicting_event_count"),
        F.round(F.try_divide(100.0 * n, F.count(F.lit(1))), 4).alias("conflict_rate_pct"),
    ).select(F.lit("event_attribute_conflicts").alias("check_name"), F.lit("INFO").alias("status"), "*")


# --- temporal integrity -----------------------------------------------------


def _wrong_type(name: str, population: DataFrame, events: DataFrame, id_column: str, flag: str) -> DataFrame:
    return _named(name, orphans(population, events.where(flag), id_column, "inspection_id"))


def target_summary(labels: DataFrame) -> DataFrame:
    """Size, prevalence and horizon.  Days are whole numbers, so the exact median
    keeps one counter per distinct day count."""
    return labels.agg(
        F.count(F.lit(1)).alias("labeled_rows"),
        F.sum(TARGET).alias("critical_targets"),
        F.round(100.0 * F.avg(TARGET), HALF_UP_2).alias("critical_target_rate_pct"),
        F.min("days_to_target").alias("min_days_to_target"),
        F.round(F.avg("days_to_target"), 1).alias("avg_days_to_target"),
        F.median("days_to_target").alias("median_days_to_target"),
        F.max("days_to_target").alias("max_days_to_target"),
    ).select(F.lit("target_summary").alias("check_name"), "*")


# --- features and scoring ---------------------------------------------------

_NON_NEGATIVE = (
    "prior_cycle_inspection_count", "prior_cycle_initial_count", "prior_cycle_reinspection_count",
    "prior_critical_inspection_count", "prior_critical_violation_count",
    "cycle_inspections_last_365d", "critical_cycle_inspections_last_365d",
)

# (part, whole): the part may not exceed the whole.
_PART_OF = (
    ("prior_critical_inspection_count", "prior_cycle_inspection_count"),
    ("prior_cycle_initial_critical_count", "prior_cycle_initial_count"),
    ("prior_cycle_reinspection_critical_count", "prior_cycle_reinspection_count"),
    ("critical_cycle_inspections_last_365d", "cycle_inspections_last_365d"),
)


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _inconsistent() -> Column:
    parts = F.col("prior_cycle_initial_count") + F.col("prior_cycle_reinspection_count")
    return any_of(
        [parts != F.col("prior_cycle_inspection_count")] + [F.col(part) > F.col(whole) for part, whole in _PART_OF]
    )


def _wrong_bucket() -> Column:
    n, bucket = F.col("prior_cycle_initial_count"), F.col("history_depth_bucket")
    spans = ((0, 0), (1, 1), (2, 3), (4, None))
    return any_of(
        [
            ((n >= lo) if hi is None else n.between(lo, hi)) & (bucket != name)
            for name, (lo, hi) in zip(DEPTH_BUCKETS, spans)
        ]
    )


def scoring_date_consistency(scoring: DataFrame) -> DataFrame:
    one = scoring.agg(
        F.min("cutoff_date").alias("min_scoring_date"),
        F.max("cutoff_date").alias("max_scoring_date"),
        F.count_distinct("cutoff_date").alias("distinct_scoring_dates"),
    )
    return one.select(
        F.lit("scoring_date_consistency").alias("check_name"), _passed(F.col("distinct_scoring_dates") == 1), "*"
    )


def depth_distribution(features: DataFrame) -> DataFrame:
    shares = share_by("history_depth_distribution", features, "history_depth_bucket", "feature_rows", "pct_feature_rows")
    place = F.array_position(F.array(*[F.lit(b) for b in DEPTH_BUCKETS]), F.col("history_depth_bucket"))
    return shares.orderBy(place)


_Check = Callable[[Tables], DataFrame]


def _outside_unit(c: str) -> Column:
    return F.col(c).isNull() | ~F.col(c).between(0.0, 1.0)


#: Checks that list failing rows: (table, condition of a failing row).
ROW_RULES: dict[str, tuple[str, Callable[[], Column]]] = {
    "target_not_after_cutoff": ("population", lambda: F.col("target_inspection_date") <= F.col("cutoff_date")),
    "label_target_not_after_cutoff": ("labels", lambda: F.col("target_inspection_date") <= F.col("cutoff_date")),
    "target_equals_cutoff": ("labels", lambda: F.col("target_inspection_id") == F.col("cutoff_inspection_id")),
    "invalid_target_label": ("labels", lambda: F.col(TARGET).isNull() | ~F.col(TARGET).isin(0, 1)),
    "non_positive_days_to_target": ("labels", lambda: F.col("days_to_target").isNull() | (F.col("days_to_target") <= 0)),
    "future_event_in_feature_history": ("features", lambda: F.col("last_cycle_inspection_date") > F.col("cutoff_date")),
    "negative_feature_counts": ("features", lambda: any_of([F.col(c) < 0 for c in _NON_NEGATIVE])),
    "inconsistent_feature_counts": ("features", lambda: _inconsistent()),
    "invalid_critical_inspection_rate": ("features", lambda: _outside_unit("prior_critical_inspection_rate")),
    "invalid_history_depth_bucket": ("features", lambda: _wrong_bucket()),
}


def _row_check(name: str) -> _Check:
    table, failing = ROW_RULES[name]
    return lambda t: failing_rows(name, getattr(t, table), failing())


CHECKS: dict[str, _Check] = {
    "normalization_row_count": lambda t: counts_match(
        "normalization_row_count", t, "raw", "rows", "raw_row_count", "normalized_row_count", "row_count_difference", swap=True
    ),
    "unexpected_critical_flag": lambda t: none_lost(
        "unexpected_critical_flag", counted(t, "rows", "unexpected_flags"), "unexpected_row_count"
    ),
    "deduplication_audit": lambda t: t.audit.select(
        F.lit("deduplication_audit").alias("check_name"), F.lit("INFO").alias("status"), "*"
    ),
    "restaurant_camis_uniqueness": lambda t: unique_key(
        "restaurant_camis_uniqueness", t.entities, "camis", "restaurant_rows", "unique_camis", "duplicate_camis"
    ),
    "sentinel_dates_excluded_from_events": lambda t: none_lost(
        "sentinel_dates_excluded_from_events", counted(t, "events", "sentinel_dates"), "sentinel_event_count"
    ),
    "duplicate_inspection_id": lambda t: duplicates(
        "duplicate_inspection_id", t.events, "inspection_id", "duplicate_count"
    ),
    "violations_map_to_inspections": lambda t: none_lost(
        "violations_map_to_inspections", lost_violations(t), "violations_without_matching_inspection"
    ),
    "inspection_type_policy_audit": lambda t: policy_audit(t.events),
    "event_attribute_conflicts": lambda t: attribute_conflicts(t.events),
    "duplicate_prediction_cutoff": lambda t: duplicates(
        "duplicate_prediction_cutoff", t.population, "cutoff_inspection_id", "row_count"
    ),
    "target_not_after_cutoff": _row_check("target_not_after_cutoff"),
    "invalid_target_event_type": lambda t: _wrong_type(
        "invalid_target_event_type", t.population, t.events, "target_inspection_id", "is_eligible_target_event"
    ),
    "invalid_cutoff_event_type": lambda t: _wrong_type(
        "invalid_cutoff_event_type", t.population, t.events, "cutoff_inspection_id", "is_eligible_historical_event"
    ),
    "prediction_label_count_match": lambda t: counts_match(
        "prediction_label_count_match", t, "population", "labels", "prediction_rows", "label_rows", "difference"
    ),
    "duplicate_label": lambda t: duplicates("duplicate_label", t.labels, "cutoff_inspection_id", "label_count"),
    "label_target_not_after_cutoff": _row_check("label_target_not_after_cutoff"),
    "target_equals_cutoff": _row_check("target_equals_cutoff"),
    "invalid_target_label": _row_check("invalid_target_label"),
    "non_positive_days_to_target": _row_check("non_positive_days_to_target"),
    "target_summary": lambda t: target_summary(t.labels),
    "cutoff_event_composition": lambda t: share_by(
        "cutoff_event_composition", t.population, "cutoff_inspection_type", "prediction_rows", "pct_prediction_rows",
        F.round(F.avg("days_to_target"), 1).alias("avg_days_to_target"),
    ).orderBy(F.desc("prediction_rows"), "cutoff_inspection_type"),
    "duplicate_feature_rows": lambda t: duplicates(
        "duplicate_feature_rows", t.features, "cutoff_inspection_id", "row_count"
    ),
    "feature_label_count_match": lambda t: counts_match(
        "feature_label_count_match", t, "features", "labels", "feature_rows", "label_rows", "difference"
    ),
    "features_map_to_prediction_population": lambda t: none_lost(
        "features_map_to_prediction_population",
        orphans(t.features, t.population, "cutoff_inspection_id").agg(F.count(F.lit(1))),
        "features_without_prediction_population",
    ),
    "future_event_in_feature_history": _row_check("future_event_in_feature_history"),
    "negative_feature_counts": _row_check("negative_feature_counts"),
    "inconsistent_feature_counts": _row_check("inconsistent_feature_counts"),
    "invalid_critical_inspection_rate": _row_check("invalid_critical_inspection_rate"),
    "invalid_history_depth_bucket": _row_check("invalid_history_depth_bucket"),
    "scoring_population_uniqueness": lambda t: unique_key(
        "scoring_population_uniqueness", t.scoring, "camis", "scoring_rows", "unique_restaurants", "duplicate_restaurants"
    ),
    "scoring_date_consistency": lambda t: scoring_date_consistency(t.scoring),
    "history_depth_distribution": lambda t: depth_distribution(t.features),
}


def run_suite(tables: Tables, names: Sequence[str] | None = None) -> DataFrame:
    """All checks as rows (check_name, status, result_rows).

    Checks that report a status keep it; row-listing checks pass when they list
    nothing; reports are INFO.
    """
    reports = {"target_summary", "cutoff_event_composition", "history_depth_distribution"}
    names = list(names or CHECKS)
    parts = []
    # Row rules over one table are counted in one pass over it.
    for table in dict.fromkeys(ROW_RULES[n][0] for n in names if n in ROW_RULES):
        own = [n for n in names if n in ROW_RULES and ROW_RULES[n][0] == table]
        counted = getattr(tables, table).agg(*[F.count_if(ROW_RULES[n][1]()).alias(n) for n in own])
        rows = [
            F.struct(F.lit(n).alias("check_name"), F.when(F.col(n) == 0, "PASS").otherwise("FAIL").alias("status"), F.col(n).alias("result_rows"))
            for n in own
        ]
        parts.append(counted.select(F.inline(F.array(*rows))))
    for name in [n for n in names if n not in ROW_RULES]:
        found = CHECKS[name](tables)
        if "status" in found.columns:
            status = F.max("status")
        elif name in reports:
            status = F.lit("INFO")
        else:
            status = F.when(F.count(F.lit(1)) == 0, "PASS").otherwise("FAIL")
        parts.append(
            found.agg(
                F.lit(name).alias("check_name"), status.alias("status"), F.count(F.lit(1)).alias("result_rows")
            )
        )
    return reduce(DataFrame.unionByName, parts)


# --- thresholds ---------------------------------------------------------------


def _repeats(key: str) -> Column:
    n = F.count(F.lit(1))
    return F.coalesce(F.try_divide((n - F.count_distinct(key)).cast("double"), n), F.lit(0.0))


def _unreadable_date() -> Column:
    text = F.nullif(F.trim(F.col("`INSPECTION DATE`")), F.lit(""))
    return text.isNotNull() & to_date_safe(text).isNull()


def _when(condition: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: F.count_if(condition())


#: Counts per table, for checks and rates; the job's writes count them as they go.
FACTS: dict[str, dict[str, Callable[[], Column]]] = {
    table: {"rows": lambda: F.count(F.lit(1))} | {name: _when(condition) for name, condition in faults.items()}
    for table, faults in {
        "raw": {"unreadable_dates": lambda: _unreadable_date()},
        "rows": {
            "unexpected_flags": lambda: F.col("critical_flag") == "Unexpected",
            "missing_boroughs": lambda: F.col("borough").isNull(),
            "missing_cuisines": lambda: F.col("cuisine_description").isNull(),
            "missing_locations": lambda: F.col("location").isNull(),
        },
        "unique": {},
        "events": {
            "sentinel_dates": lambda: F.col("inspection_date") == F.lit(SENTINEL_DATE),
            "conflicts": lambda: _conflicting(),
        },
        "violations": {},
        "population": {"targets_not_after": lambda: F.col("target_inspection_date") <= F.col("cutoff_date")},
        "labels": {"invalid_labels": lambda: F.col(TARGET).isNull() | ~F.col(TARGET).isin(0, 1)},
        "features": {"future_history": lambda: F.col("last_cycle_inspection_date") > F.col("cutoff_date")},
    }.items()
}

#: Rate -> (table, count among its rows).
_SHARES = {
    "unparseable_inspection_date_rate": ("raw", "unreadable_dates"),
    "unexpected_critical_flag_rate": ("rows", "unexpected_flags"),
    "missing_borough_rate": ("rows", "missing_boroughs"),
    "missing_cuisine_rate": ("rows", "missing_cuisines"),
    "missing_location_rate": ("rows", "missing_locations"),
    "event_attribute_conflict_rate": ("events", "conflicts"),
    "invalid_target_date_rate": ("population", "targets_not_after"),
    "invalid_label_rate": ("labels", "invalid_labels"),
    "feature_future_date_rate": ("features", "future_history"),
}
#: Rate -> (table, key that should be unique).
_UNIQUE_KEYS = {"duplicate_restaurant_rate": ("entities", "camis"), "duplicate_inspection_event_rate": ("events", "inspection_id")}


def _rate(part: Column, whole: Column) -> Column:
    """A share of rows; 0 for an empty table."""
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def quality_rates(tables: Tables) -> DataFrame:
    """Observed rate, limit and breach per configured threshold; a table is read once for all its counts, if at all."""
    t = tables
    one, observed = t.events.sparkSession.range(1), {}
    for table in dict.fromkeys([*(table for table, _ in _SHARES.values()), "violations"]):
        cell = counted(t, table, *FACTS[table]).select(F.struct(*FACTS[table]).alias("c")).scalar()
        one = one.withColumn(f"_{table}", cell)
    for rate, (table, fault) in _SHARES.items():
        observed[rate] = _rate(F.col(f"_{table}.{fault}"), F.col(f"_{table}.rows"))
    for rate, (table, key) in _UNIQUE_KEYS.items():
        observed[rate] = getattr(t, table).agg(_repeats(key).alias("c")).scalar()
    observed["orphan_violation_rate"] = _rate(lost_violations(t).scalar(), F.col("_violations.rows"))
    if t.previous_rows is not None:
        observed["source_row_count_change_rate"] = _rate(F.abs(F.col("_raw.rows") - F.lit(t.previous_rows)), F.lit(t.previous_rows))
    entries = [
        F.struct(
            F.lit(name).alias("rate_name"), F.lit(kind).alias("severity"), observed[name].alias("rate"),
            F.lit(float(limit)).alias("limit"),
        )
        for kind, limits in (("hard", t.thresholds.hard), ("soft", t.thresholds.soft))
        for name, limit in limits.items()
        if name in observed
    ]
    return one.select(F.inline(F.array(*entries))).withColumn("breached", F.col("rate") > F.col("limit"))


class ThresholdBreached(Exception):
    """A hard threshold is breached."""


def enforce(rates: DataFrame) -> None:
    """Raise if any hard threshold is breached; reads one row per threshold."""
    broken = rates.where((F.col("severity") == "hard") & F.col("breached")).collect()
    if broken:
        raise ThresholdBreached(
            "; ".join(f"{r['rate_name']} is {r['rate']:.6f}, limit {r['limit']}" for r in sorted(broken))
        )
