"""Source profiles and modelling-set summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.oracle_tables import over_stages
from contract.queries import register
from tidemark.operators import profile
from tidemark.policy import SENTINEL_DATE

# The columns each profile covers.
NUMERIC = (
    "prior_cycle_inspection_count", "prior_cycle_initial_count", "prior_cycle_reinspection_count",
    "prior_critical_inspection_count", "prior_critical_inspection_rate", "prior_critical_violation_count",
    "days_since_last_cycle_inspection", "days_since_last_critical_inspection", "max_historical_score",
    "average_historical_score", "average_score_last_365d", "cycle_inspections_last_365d",
    "critical_cycle_inspections_last_365d", "prior_total_violations", "prior_critical_violation_rows",
    "violations_last_365d", "critical_violations_last_365d",
)
CATEGORICAL = ("borough", "cuisine_description", "zipcode", "nta", "community_board", "history_depth_bucket")
TARGETS = (
    "target_any_critical", "target_two_or_more_critical", "target_three_or_more_critical",
    "target_four_or_more_critical", "target_high_severity",
)
RAW_NULLS = (
    "CAMIS", "DBA", "BORO", "INSPECTION DATE", "ACTION", "VIOLATION CODE", "VIOLATION DESCRIPTION",
    "CRITICAL FLAG", "SCORE", "GRADE", "GRADE DATE", "INSPECTION TYPE",
)
GRAIN = ("CAMIS", "INSPECTION DATE", "INSPECTION TYPE")


@register("raw_row_count", over_stages("SELECT count(*) AS raw_row_count FROM raw"))
def _(s):
    from tidemark.sources.raw_log import landing_count

    return landing_count(s.raw)


@register("profile_size", over_stages("SELECT count(*) AS total_rows, count(DISTINCT camis) AS unique_restaurants FROM norm"))
def _(s):
    return profile.source_size(s.rows)


@register(
    "profile_span",
    over_stages(
        "SELECT min(inspection_date) AS earliest_inspection, max(inspection_date) AS latest_inspection,"
        " min(record_date) AS earliest_record, max(record_date) AS latest_record FROM norm"
    ),
)
def _(s):
    return profile.source_span(s.rows)


@register(
    "profile_not_yet_inspected",
    over_stages("SELECT count(*) AS not_yet_inspected_rows FROM norm WHERE inspection_date = DATE '1900-01-01'"),
)
def _(s):
    return profile.not_yet_inspected(s.rows, SENTINEL_DATE)


@register(
    "profile_nulls",
    over_stages(
        "SELECT count(*) AS total_rows, "
        + ", ".join(f"count(*) - count(\"{c}\") AS null_{c.lower().replace(' ', '_')}" for c in RAW_NULLS)
        + " FROM raw"
    ),
)
def _(s):
    return profile.null_counts(s.raw, RAW_NULLS)


@register(
    "profile_duplicates",
    over_stages(
        "SELECT a AS total_rows, b AS unique_rows, a - b AS duplicate_rows FROM (SELECT count(*) AS a FROM raw),"
        " (SELECT count(*) AS b FROM (SELECT DISTINCT * FROM raw))"
    ),
)
def _(s):
    return profile.duplicate_rows(s.raw)


@register(
    "profile_row_grain",
    over_stages('SELECT count(*) AS inspection_groups FROM (SELECT DISTINCT "CAMIS", "INSPECTION DATE", "INSPECTION TYPE" FROM raw)'),
)
def _(s):
    return profile.distinct_tuples(s.raw, GRAIN, "inspection_groups")


@register(
    "profile_group_sizes",
    over_stages(
        'SELECT "CAMIS", "INSPECTION DATE", "INSPECTION TYPE", count(*) AS raw_rows FROM raw GROUP BY ALL'
        ' ORDER BY raw_rows DESC, "CAMIS" NULLS LAST, "INSPECTION DATE" NULLS LAST, "INSPECTION TYPE" NULLS LAST LIMIT 20'
    ),
)
def _(s):
    return profile.largest_groups(s.raw, GRAIN, "raw_rows")


@register(
    "dataset_card",
    over_stages(
        "UNPIVOT (SELECT CAST(count(*) AS VARCHAR) AS prediction_examples,"
        " CAST(count(DISTINCT camis) AS VARCHAR) AS unique_restaurants,"
        " CAST(count(DISTINCT cutoff_inspection_id) AS VARCHAR) AS unique_cutoff_inspections,"
        " CAST(count(DISTINCT target_inspection_id) AS VARCHAR) AS unique_target_inspections,"
        " CAST(min(cutoff_date) AS VARCHAR) AS earliest_cutoff_date, CAST(max(cutoff_date) AS VARCHAR) AS latest_cutoff_date,"
        " CAST(min(target_inspection_date) AS VARCHAR) AS earliest_target_date,"
        " CAST(max(target_inspection_date) AS VARCHAR) AS latest_target_date,"
        " CAST(sum(target_high_severity) AS VARCHAR) AS high_severity_positives,"
        " printf('%.2f', 100 * avg(target_high_severity)) || '%' AS high_severity_prevalence,"
        " CAST(CAST(floor(median(days_to_target)) AS BIGINT) AS VARCHAR) AS median_days_to_target FROM model)"
        " ON COLUMNS(*) INTO NAME metric VALUE value"
    ),
)
def _(s):
    return profile.dataset_card(s.modeling)


@register(
    "validity_counts",
    over_stages(
        "SELECT count(*) AS row_count, count(DISTINCT cutoff_inspection_id) AS unique_cutoffs,"
        " count(*) - count(DISTINCT cutoff_inspection_id) AS duplicate_cutoffs,"
        " count(*) - count(target_high_severity) AS null_targets,"
        " count(*) FILTER (target_inspection_date <= cutoff_date) AS targets_not_after_cutoff,"
        " count(*) FILTER (days_to_target <= 0) AS non_positive_horizons,"
        " count(*) FILTER (coalesce(target_high_severity, 7) NOT IN (0, 1)) AS non_binary_targets FROM model"
    ),
)
def _(s):
    return profile.validity_counts(s.modeling)


@register(
    "severity_audit",
    over_stages(
        " UNION ALL ".join(
            f"SELECT '{c}' AS target, CAST(sum({c}) AS BIGINT) AS positive_examples, round(avg({c}), 6) AS positive_rate FROM model"
            for c in TARGETS
        )
    ),
)
def _(s):
    return profile.severity_audit(s.modeling, TARGETS)


def _rates_sql(name: str, group: str, extra: str = "", where: str = "") -> str:
    return (
        f"SELECT {group} AS {name}, count(*) AS examples, CAST(sum(target_high_severity) AS BIGINT) AS positive_targets,"
        f" round(avg(target_high_severity), 6) AS target_rate{extra} FROM model {where} GROUP BY 1"
    )


def _binned_sql(name: str, value: str, edges, labels) -> str:
    """Bins from a label table, so empty ones are reported."""
    cells = []
    for lo, hi, label in zip(edges, edges[1:], labels):
        top = "CAST('inf' AS DOUBLE)" if hi == float("inf") else f"CAST({hi} AS DOUBLE)"
        cells.append(f"(CAST({lo} AS DOUBLE), {top}, '{label}')")
    return (
        f"SELECT b.label AS {name}, count(m.camis) AS examples,"
        " coalesce(CAST(sum(m.target_high_severity) AS BIGINT), 0) AS positive_targets,"
        " round(avg(m.target_high_severity), 6) AS target_rate"
        f" FROM (VALUES {', '.join(cells)}) b(lo, hi, label)"
        f" LEFT JOIN model m ON m.{value} > b.lo AND m.{value} <= b.hi GROUP BY ALL"
    )


@register("target_rate_by_target_type", over_stages(_rates_sql("target_inspection_type", "target_inspection_type")))
def _(s):
    return profile.target_rate_by(s.modeling, "target_inspection_type", "target_inspection_type")


@register(
    "target_rate_by_cutoff_type",
    over_stages(
        _rates_sql(
            "cutoff_inspection_type", "cutoff_inspection_type",
            ", round(count(*) / CAST((SELECT count(*) FROM model) AS DOUBLE), 6) AS population_share",
        )
    ),
)
def _(s):
    return profile.target_rate_by(s.modeling, "cutoff_inspection_type", "cutoff_inspection_type", share=True)


@register("target_rate_by_borough", over_stages(_rates_sql("borough", "borough")))
def _(s):
    return profile.target_rate_by(s.modeling, "borough", "borough")


@register(
    "target_rate_by_borough_known", over_stages(_rates_sql("borough", "borough", where="WHERE borough IS NOT NULL"))
)
def _(s):
    return profile.target_rate_by(s.modeling, "borough", "borough", keep_null=False)


@register(
    "target_rate_by_horizon",
    over_stages(_binned_sql("horizon_bucket", "days_to_target", profile.HORIZON_EDGES, profile.HORIZON_LABELS)),
)
def _(s):
    return profile.target_rate_by_horizon(s.modeling)


@register(
    "target_rate_by_quarter",
    over_stages(_rates_sql("cutoff_quarter", "year(cutoff_date) || 'Q' || quarter(cutoff_date)")),
)
def _(s):
    return profile.target_rate_by_quarter(s.modeling)


@register(
    "target_rate_by_prior_critical_rate",
    over_stages(_binned_sql("prior_critical_rate_bucket", "prior_critical_inspection_rate", profile.RATE_EDGES, profile.RATE_LABELS)),
)
def _(s):
    return profile.target_rate_by_rate(s.modeling, "prior_critical_inspection_rate", "prior_critical_rate_bucket")


@register(
    "target_rate_by_prior_severe_rate",
    over_stages(
        _binned_sql("prior_high_severity_rate_bucket", "prior_high_severity_inspection_rate", profile.RATE_EDGES, profile.RATE_LABELS)
    ),
)
def _(s):
    return profile.target_rate_by_rate(
        s.modeling, "prior_high_severity_inspection_rate", "prior_high_severity_rate_bucket"
    )


@register(
    "target_rate_by_recency",
    over_stages(
        _binned_sql(
            "high_severity_recency_bucket", "days_since_last_high_severity_inspection", profile.RECENCY_EDGES, profile.RECENCY_LABELS
        )
    ),
)
def _(s):
    return profile.target_rate_by_recency(s.modeling)


INDICATORS = {
    "has_prior_critical_outcome": (
        "prior_critical_inspection_count > 0", "At least one prior critical outcome", "No prior critical outcome",
    ),
    "has_prior_high_severity_outcome": (
        "prior_high_severity_inspection_count > 0", "At least one prior high-severity outcome",
        "No prior high-severity outcome",
    ),
    "high_severity_recency_available": (
        "days_since_last_high_severity_inspection IS NOT NULL", "Observed prior high-severity event",
        "No observed prior high-severity event",
    ),
}


def _indicator(name: str, condition: str, yes: str, no: str) -> None:
    @register(f"target_rate_by_{name}", over_stages(_rates_sql(name, f"if({condition}, '{yes}', '{no}')")))
    def _(s):
        return profile.target_rate_by_indicator(s.modeling, F.expr(condition), yes, no, name)


for _name, (_condition, _yes, _no) in INDICATORS.items():
    _indicator(_name, _condition, _yes, _no)


@register(
    "history_depth_summary",
    over_stages(
        "SELECT history_depth_bucket, count(*) AS examples, count(DISTINCT camis) AS unique_restaurants,"
        " CAST(sum(target_high_severity) AS BIGINT) AS positive_targets, round(avg(target_high_severity), 6) AS target_rate,"
        " round(median(days_to_target), 6) AS median_days_to_target,"
        " round(median(prior_critical_inspection_rate), 6) AS median_prior_critical_rate FROM model GROUP BY ALL"
    ),
)
def _(s):
    return profile.depth_summary(s.modeling)


def _describe_sql(columns, probabilities, table: str = "model") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS \"count\", round(avg({c}), 6) AS mean,"
        f" round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(max({c}) AS DOUBLE), 6) AS max, "
        + ", ".join(
            f"round(quantile_cont(CAST({c} AS DOUBLE), {p}), 6) AS p{round(p * 100):02d}" for p in probabilities
        )
        + f" FROM {table}"
        for c in columns
    )


HORIZON_POINTS = (0.05, 0.25, 0.50, 0.75, 0.90, 0.95)
FEATURE_POINTS = (0.01, 0.05, 0.25, 0.50, 0.75, 0.95, 0.99)
SEVERE_COLUMNS = (
    "prior_high_severity_inspection_count", "prior_high_severity_inspection_rate",
    "high_severity_cycle_inspections_last_365d", "days_since_last_high_severity_inspection", "target_high_severity",
)
SEVERE_POINTS = (0.05, 0.25, 0.50, 0.75, 0.95)


@register("describe_horizon", over_stages(_describe_sql(["days_to_target"], HORIZON_POINTS)))
def _(s):
    return profile.describe(s.modeling, ["days_to_target"], HORIZON_POINTS)


@register("describe_features", over_stages(_describe_sql(NUMERIC, FEATURE_POINTS)))
def _(s):
    return profile.describe(s.modeling, NUMERIC, FEATURE_POINTS)


@register("describe_severity", over_stages(_describe_sql(SEVERE_COLUMNS, SEVERE_POINTS)))
def _(s):
    return profile.describe(s.modeling, SEVERE_COLUMNS, SEVERE_POINTS)


@register(
    "missingness",
    over_stages(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, round(CAST(100 AS DOUBLE) * (count(*) - count({c})) / count(*), 6) AS missing_pct FROM model"
            for c in NUMERIC + CATEGORICAL
        )
    ),
)
def _(s):
    return profile.missingness(s.modeling, NUMERIC + CATEGORICAL)


def _counts(column: str) -> None:
    @register(
        f"value_counts_{column}",
        over_stages(
            f"SELECT '{column}' AS column_name, {column} AS value, count(*) AS n FROM model GROUP BY ALL"
            " ORDER BY n DESC, value NULLS LAST LIMIT 15"
        ),
    )
    def _(s):
        return profile.value_counts(s.modeling, column)


for _column in CATEGORICAL:
    _counts(_column)


@register(
    "cardinality",
    over_stages(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS unique_values FROM (SELECT DISTINCT {c} FROM model)" for c in CATEGORICAL
        )
    ),
)
def _(s):
    return profile.cardinality(s.modeling, CATEGORICAL)


@register(
    "split_summary",
    over_stages(
        "SELECT split, count(*) AS examples, count(DISTINCT camis) AS unique_restaurants,"
        " CAST(sum(target_high_severity) AS BIGINT) AS positive_targets, round(avg(target_high_severity), 6) AS target_prevalence,"
        " min(cutoff_date) AS first_cutoff, max(cutoff_date) AS last_cutoff FROM parted GROUP BY split"
    ),
)
def _(s):
    from tidemark.operators.splits import split_summary

    return split_summary(s.parted)


@register(
    "split_violations",
    over_stages(
        # The validation rows are also called test here, so two rules break.
        "SELECT * FROM (SELECT 'validation' AS split, 'empty' AS problem UNION ALL SELECT 'validation', 'no positive examples'"
        " UNION ALL SELECT 'train', 'invalid target values' WHERE (SELECT count(*) FROM parted WHERE split = 'train'"
        " AND day(cutoff_date) = 9) > 0)"
    ),
)
def _(s):
    from tidemark.operators.splits import split_violations

    merged = F.when(F.col("split") == "train", "train").otherwise("test")
    spoiled = F.when((F.col("split") == "train") & (F.day("cutoff_date") == 9), 2).otherwise(F.col("target_high_severity"))
    return split_violations(s.parted.withColumns({"target_high_severity": spoiled, "split": merged}))
