"""Queries for the stage tables themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.oracle_tables import over_stages
from contract.queries import register, sql_rounded
from tidemark.operators import events, normalize, snapshots

FEATURE_DOUBLES = [
    "prior_critical_inspection_rate", "prior_high_severity_inspection_rate",
    "average_historical_score", "average_score_last_365d",
]


@register("raw_log", over_stages("SELECT * FROM raw"), from_raw=True)
def _(s):
    return s.raw


@register("normalize_rows", over_stages(sql_rounded("SELECT * FROM norm", ["latitude", "longitude"])), from_raw=True)
def _(s):
    return s.rows


@register("dedup_rows", over_stages(sql_rounded("SELECT * FROM dedup", ["latitude", "longitude"])), from_raw=True)
def _(s):
    return s.unique


@register(
    "dedup_audit",
    over_stages(
        "SELECT a AS input_row_count, b AS output_row_count, a - b AS exact_duplicates_removed FROM"
        " (SELECT count(*) AS a FROM norm), (SELECT count(*) AS b FROM dedup)"
    ),
    from_raw=True,
)
def _(s):
    return normalize.dedup_audit(s.rows)


@register("latest_entity", over_stages(sql_rounded("SELECT * FROM entities", ["latitude", "longitude"])), from_raw=True)
def _(s):
    return s.entities


@register("event_rollup", over_stages(f"SELECT {', '.join(events.EVENT_COLUMNS)} FROM ev"), from_raw=True)
def _(s):
    return s.events


@register("violation_rows", over_stages("SELECT * FROM viol"), from_raw=True)
def _(s):
    return s.violations


@register("next_event_asof", over_stages("SELECT * FROM pop"), from_raw=True)
def _(s):
    return s.population


@register("labels", over_stages("SELECT * FROM lab"), from_raw=True)
def _(s):
    return s.labels


@register("labels_by_join", over_stages("SELECT * FROM lab"), from_raw=True)
def _(s):
    return snapshots.attach_labels(s.population, s.wide_events)


@register("pit_features", over_stages(sql_rounded("SELECT * FROM feat", FEATURE_DOUBLES)), from_raw=True)
def _(s):
    return s.features


VIOLATION_FEATURES = [
    "cutoff_inspection_id", "violation_feature_source_max_date", "prior_total_violations",
    "prior_critical_violation_rows", "violations_last_365d", "critical_violations_last_365d",
]


@register("pit_violation_features", over_stages(f"SELECT {', '.join(VIOLATION_FEATURES)} FROM snap_features"), from_raw=True)
def _(s):
    """Detail counts joined per event from the violation table, then the same windows."""
    joined = snapshots.with_detail_counts(s.events, s.violations)
    return snapshots.decision_snapshots(joined).select(*VIOLATION_FEATURES)


@register("modeling_set", over_stages(sql_rounded("SELECT * FROM model", FEATURE_DOUBLES)), from_raw=True)
def _(s):
    return snapshots.modeling_set(s.features, s.labels)


@register("scoring_population", over_stages(sql_rounded("SELECT * FROM scoring", FEATURE_DOUBLES)), from_raw=True)
def _(s):
    return s.scoring


@register("scoring_date", over_stages("SELECT max(inspection_date) AS scoring_date FROM ev"), from_raw=True)
def _(s):
    return s.events.agg(F.max("inspection_date").alias("scoring_date"))


@register(
    "eligible_entities",
    over_stages("SELECT DISTINCT camis FROM ev WHERE is_eligible_historical_event"),
)
def _(s):
    return s.events.where("is_eligible_historical_event").select("camis").distinct()
