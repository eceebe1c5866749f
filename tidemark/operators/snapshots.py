"""Decision snapshots: for each eligible event, what was known and what came next.

The literal form is a range self-join (`later.date > cutoff.date`, `past.date <=
cutoff.date`), quadratic per entity.  Here one shuffle on the entity serves every
window: RANGE frames over the day number give the same rows, same-day peers
included.

Skew: windows run over events, not rows.  An entity has at most one event per
(date, history type), so its window group is bounded by the calendar however
large its share of the raw rows is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import days_between, depth_bucket, safe_rate
from tidemark.policy import EventPolicy

# Output columns of the snapshot tables.
POPULATION_COLUMNS = (
    "cutoff_inspection_id", "camis", "cutoff_date", "cutoff_inspection_type",
    "cutoff_is_cycle_initial", "cutoff_is_cycle_reinspection",
    "target_inspection_id", "target_inspection_date", "target_inspection_type",
    "days_to_target",
)

# Outcome columns of the target event carried into the labels.
_OUTCOMES = (
    "total_violations", "critical_violation_count", "noncritical_violation_count",
    "score", "grade", "action",
)

_LADDER = {1: "target_any_critical", 2: "target_two_or_more_critical",
           3: "target_three_or_more_critical", 4: "target_four_or_more_critical"}

DIMENSIONS = ("borough", "cuisine_description", "zipcode", "nta", "community_board")

# Columns of a finished feature block, shared by snapshots and current scoring.
HISTORY_FEATURES = (
    "feature_source_max_date", "violation_feature_source_max_date",
    "prior_cycle_inspection_count", "prior_cycle_initial_count",
    "prior_cycle_reinspection_count", "prior_critical_inspection_count",
    "prior_cycle_initial_critical_count", "prior_cycle_reinspection_critical_count",
    "prior_critical_violation_count", "prior_high_severity_inspection_count",
    "prior_cycle_initial_high_severity_count", "prior_cycle_reinspection_high_severity_count",
    "prior_critical_inspection_rate", "prior_high_severity_inspection_rate",
    "last_cycle_inspection_date", "days_since_last_cycle_inspection",
    "last_critical_inspection_date", "days_since_last_critical_inspection",
    "last_high_severity_inspection_date", "days_since_last_high_severity_inspection",
    "max_historical_score", "average_historical_score", "average_score_last_365d",
    "cycle_inspections_last_365d", "critical_cycle_inspections_last_365d",
    "high_severity_cycle_inspections_last_365d",
    "prior_total_violations", "prior_critical_violation_rows",
    "violations_last_365d", "critical_violations_last_365d",
    "history_depth_bucket", "has_no_cycle_initial_history",
)

_ZERO_DEFAULT = (
    "prior_total_violations", "prior_critical_violation_rows",
    "violations_last_365d", "critical_violations_last_365d",
)

FEATURE_COLUMNS = ("camis", "cutoff_inspection_id", "cutoff_date", *HISTORY_FEATURES, *DIMENSIONS)


def history_aggregates(policy: EventPolicy) -> dict[str, Column]:
    """Aggregates over all events up to the cutoff, by feature name."""
    first, again = F.col("is_cycle_initial"), F.col("is_cycle_reinspection")
    critical = F.col("has_critical_violation")
    severe = F.col("critical_violation_count") >= policy.severity_threshold
    day = F.col("inspection_date")
    counted = {
        "prior_cycle_inspection_count": F.lit(True),
        "prior_cycle_initial_count": first,
        "prior_cycle_reinspection_count": again,
        "prior_critical_inspection_count": critical,
        "prior_cycle_initial_critical_count": first & critical,
        "prior_cycle_reinspection_critical_count": again & critical,
        "prior_high_severity_inspection_count": severe,
        "prior_cycle_initial_high_severity_count": first & severe,
        "prior_cycle_reinspection_high_severity_count": again & severe,
    }
    return {
        "feature_source_max_date": F.max(day),
        "violation_feature_source_max_date": F.max(F.when(F.col("total_violations") > 0, day)),
        **{name: F.count_if(met) for name, met in counted.items()},
        "prior_critical_violation_count": F.sum(F.coalesce(F.col("critical_violation_count"), F.lit(0))),
        "last_cycle_inspection_date": F.max(day),
        "last_critical_inspection_date": F.max(F.when(critical, day)),
        "last_high_severity_inspection_date": F.max(F.when(severe, day)),
        "max_historical_score": F.max("score"),
        "average_historical_score": F.avg("score"),
        "prior_total_violations": F.sum("total_violations"),
        "prior_critical_violation_rows": F.sum("coded_critical_count"),
    }


def trailing_aggregates(policy: EventPolicy, recent: Column | None = None) -> dict[str, Column]:
    """Aggregates over the trailing days; `recent` restricts rows where no frame does."""
    recent = F.lit(True) if recent is None else recent
    severe = F.col("critical_violation_count") >= policy.severity_threshold
    return {
        "cycle_inspections_last_365d": F.count_if(recent),
        "critical_cycle_inspections_last_365d": F.count_if(recent & F.col("has_critical_violation")),
        "high_severity_cycle_inspections_last_365d": F.count_if(recent & severe),
        "average_score_last_365d": F.avg(F.when(recent, F.col("score"))),
        "violations_last_365d": F.sum(F.when(recent, F.col("total_violations"))),
        "critical_violations_last_365d": F.sum(F.when(recent, F.col("coded_critical_count"))),
    }


def finish_features(df: DataFrame) -> DataFrame:
    """Zero defaults, rates, recencies and the depth bucket from the aggregated history."""
    n = F.col("prior_cycle_inspection_count")
    depth = F.col("prior_cycle_initial_count")
    derived = {
        f"prior_{kind}_inspection_rate": safe_rate(F.col(f"prior_{kind}_inspection_count"), n)
        for kind in ("critical", "high_severity")
    }
    for kind in ("cycle", "critical", "high_severity"):
        last = F.col(f"last_{kind}_inspection_date")
        derived[f"days_since_last_{kind}_inspection"] = days_between(last, F.col("cutoff_date"))
    derived |= {c: F.coalesce(c, F.lit(0)) for c in _ZERO_DEFAULT}
    derived["history_depth_bucket"] = depth_bucket(depth)
    derived["has_no_cycle_initial_history"] = depth == 0
    return df.withColumns(derived)


def _day_windows(policy: EventPolicy):
    entity = Window.partitionBy("camis")
    so_far = entity.orderBy("_day").rangeBetween(Window.unboundedPreceding, 0)
    trailing = entity.orderBy("_day").rangeBetween(-policy.trailing_days, 0)
    later = entity.orderBy(F.desc("_day")).rangeBetween(Window.unboundedPreceding, -1)
    return so_far, trailing, later


def _eligible(events: DataFrame) -> DataFrame:
    return events.where("is_eligible_historical_event OR is_eligible_target_event").withColumn(
        "_day", F.unix_date("inspection_date")
    )


def _with_target(events: DataFrame, later, outcomes: tuple[str, ...] = ()) -> DataFrame:
    """Earliest eligible event strictly after the row, as struct `_target` (NULL if none)."""
    candidate = F.struct(
        F.col("inspection_date"), F.col("inspection_id"), F.col("inspection_type"), *[F.col(c) for c in outcomes]
    )
    nearest = F.min(F.when(F.col("is_eligible_target_event"), candidate))
    return events.withColumn("_target", nearest.over(later))


def _cutoff_columns() -> dict[str, Column]:
    return {
        "cutoff_inspection_id": F.col("inspection_id"),
        "cutoff_date": F.col("inspection_date"),
        "cutoff_inspection_type": F.col("inspection_type"),
        "cutoff_is_cycle_initial": F.col("is_cycle_initial"),
        "cutoff_is_cycle_reinspection": F.col("is_cycle_reinspection"),
        "target_inspection_id": F.col("_target.inspection_id"),
        "target_inspection_date": F.col("_target.inspection_date"),
        "target_inspection_type": F.col("_target.inspection_type"),
        "days_to_target": days_between(F.col("inspection_date"), F.col("_target.inspection_date")),
    }


def prediction_population(events: DataFrame, policy: EventPolicy = EventPolicy()) -> DataFrame:
    """Each eligible event with the next target strictly after it; none, no row."""
    *_, later = _day_windows(policy)
    return (
        _with_target(_eligible(events), later)
        .where(F.col("is_eligible_historical_event") & F.col("_target").isNotNull())
        .withColumns(_cutoff_columns())
        .select(*POPULATION_COLUMNS)
    )


def outcome_columns(policy: EventPolicy = EventPolicy()) -> dict[str, Column]:
    """Binary labels by threshold, the canonical one and its text form."""
    n = F.col("target_critical_violation_count")
    severe = n >= policy.severity_threshold
    return {
        **{name: (n >= t).cast("int") for t, name in _LADDER.items()},
        "target_high_severity": severe.cast("int"),
        "target_label": F.when(severe, "high_severity_critical_outcome").otherwise("below_high_severity_threshold"),
    }


LABEL_COLUMNS = (
    "camis",
    *[c for c in POPULATION_COLUMNS if c != "camis"],
    *[f"target_{c}" for c in _OUTCOMES],
    *_LADDER.values(),
    "target_high_severity",
    "target_label",
)


def attach_labels(population: DataFrame, events: DataFrame, policy: EventPolicy = EventPolicy()) -> DataFrame:
    """Outcome of the target event, joined by its id."""
    targets = events.where("is_eligible_target_event").select(
        F.col("inspection_id").alias("target_inspection_id"), *[F.col(c).alias(f"target_{c}") for c in _OUTCOMES]
    )
    return (
        population.where(F.col("target_inspection_date") > F.col("cutoff_date"))
        .join(targets, "target_inspection_id")
        .withColumns(outcome_columns(policy))
        .select(*LABEL_COLUMNS)
    )


def decision_snapshots(events: DataFrame, policy: EventPolicy = EventPolicy()) -> DataFrame:
    """Population, labels and history features side by side, from one shuffle.

    History spans every eligible event; cutoffs without a target leave only after
    the windows have seen them.  The target's outcomes travel inside the `min`
    struct, so no join attaches the labels.
    """
    so_far, trailing, later = _day_windows(policy)
    seen = F.col("is_eligible_historical_event")
    base = _with_target(_eligible(events), later, _OUTCOMES)
    if set(policy.target_types) - set(policy.history_types):
        # Target-only events take part in the look-ahead, never in the history.
        base = base.where(seen)
    windowed = base.withColumns(
        {name: agg.over(so_far) for name, agg in history_aggregates(policy).items()}
        | {name: agg.over(trailing) for name, agg in trailing_aggregates(policy).items()}
    )
    kept = windowed.where(seen & F.col("_target").isNotNull()).withColumns(
        _cutoff_columns() | {f"target_{c}": F.col(f"_target.{c}") for c in _OUTCOMES}
    )
    return finish_features(kept).withColumns(outcome_columns(policy)).select(
        *LABEL_COLUMNS, *HISTORY_FEATURES
    )


def labels_of(snapshots: DataFrame) -> DataFrame:
    return snapshots.select(*LABEL_COLUMNS)


def population_of(snapshots: DataFrame) -> DataFrame:
    return snapshots.select(*POPULATION_COLUMNS)


def with_dimensions(df: DataFrame, entities: DataFrame, columns: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    return df.join(entities.select("camis", *columns), "camis", "left")


def features_of(snapshots: DataFrame, entities: DataFrame) -> DataFrame:
    """Feature table with the entity's current dimensions."""
    block = snapshots.select("camis", "cutoff_inspection_id", "cutoff_date", *HISTORY_FEATURES)
    return with_dimensions(block, entities).select(*FEATURE_COLUMNS)


def with_detail_counts(events: DataFrame, violations: DataFrame) -> DataFrame:
    """Events with detail counts taken from a violation table.

    For callers whose event table lacks `coded_critical_count`: detail rows are
    reduced to one row per event first, so the join is 1:1 and same-day events are
    never counted twice.
    """
    detail = violations.groupBy("inspection_id").agg(
        F.count("violation_code").alias("_rows"), F.count_if("is_critical_violation").alias("_critical")
    )
    return (
        events.drop("coded_critical_count")
        .join(detail, "inspection_id", "left")
        .withColumns(
            {
                "total_violations": F.coalesce("_rows", F.lit(0)),
                "coded_critical_count": F.coalesce("_critical", F.lit(0)),
            }
        )
        .drop("_rows", "_critical")
    )


def modeling_set(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features with the label columns that modelling reads."""
    keep = [c for c in LABEL_COLUMNS if c != "cutoff_date"]
    # An event's id holds its entity, and the stored tables lie by the entity.
    return features.join(labels.select(*keep), ["camis", "cutoff_inspection_id"])


def current_population(
    events: DataFrame,
    entities: DataFrame,
    policy: EventPolicy = EventPolicy(),
    as_of: DataFrame | None = None,
) -> DataFrame:
    """Features of every eligible entity at the latest date of the whole log.

    `as_of` is a one-row, one-column DataFrame with that date; by default the
    maximum over all events, eligible or not.  It enters as a scalar subquery, so
    one partial aggregation per entity does the rest.
    """
    as_of = events.agg(F.max("inspection_date")) if as_of is None else as_of
    past = events.where("is_eligible_historical_event").withColumn("cutoff_date", as_of.scalar())
    recent = F.col("inspection_date") >= F.date_sub(F.col("cutoff_date"), policy.trailing_days)
    aggregates = (
        {"cutoff_date": F.max("cutoff_date")} | history_aggregates(policy) | trailing_aggregates(policy, recent)
    )
    grouped = past.where(F.col("inspection_date") <= F.col("cutoff_date")).groupBy("camis").agg(
        *[agg.alias(name) for name, agg in aggregates.items()]
    )
    limited = F.col("has_no_cycle_initial_history")
    named = with_dimensions(finish_features(grouped), entities, ("restaurant_name", *DIMENSIONS))
    return named.select(
        "camis",
        "cutoff_date",
        *HISTORY_FEATURES,
        "restaurant_name",
        *DIMENSIONS,
        F.lit(True).alias("is_eligible_for_scoring"),
        F.when(limited, "limited_cycle_initial_history").otherwise("eligible").alias("scoring_eligibility_reason"),
    )
