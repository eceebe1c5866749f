"""Event, violation and entity tables from deduplicated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import event_key
from tidemark.operators.normalize import row_digest
from tidemark.policy import UNKNOWN_TYPE, EventPolicy

EVENT_COLUMNS = (
    "inspection_id", "camis", "inspection_date", "inspection_type",
    "is_cycle_inspection", "is_cycle_initial", "is_cycle_reinspection",
    "is_eligible_target_event", "is_eligible_historical_event",
    "score", "grade", "grade_date", "action",
    "source_row_count", "total_violations", "critical_violation_count",
    "noncritical_violation_count", "has_any_violation", "has_critical_violation",
    "distinct_score_count", "distinct_grade_count", "distinct_action_count",
)

ENTITY_ATTRIBUTES = (
    "restaurant_name", "borough", "building", "street", "zipcode", "phone",
    "cuisine_description", "latitude", "longitude", "community_board",
    "council_district", "census_tract", "bin", "bbl", "nta", "location",
)


def usable_rows(rows: DataFrame, policy: EventPolicy = EventPolicy()) -> DataFrame:
    """Rows that belong to a dated event; the sentinel date means "not yet inspected"."""
    day = F.col("inspection_date")
    dated = day.isNotNull() & (day != F.lit(policy.sentinel_date))
    return rows.where(F.col("camis").isNotNull() & dated)


def _typed_usable(rows: DataFrame, policy: EventPolicy) -> DataFrame:
    """Usable rows with a digest of each, of rows that are typed in the same pass.

    Spark would put the filter before the typing and so read every date again for it, in one method too long to
    compile; it leaves a filter above a column that is not deterministic.
    """
    typed = rows.withColumns(row_digest(rows) | {"_at": F.monotonically_increasing_id()})
    return usable_rows(typed, policy).where("_at >= 0")


def _kind() -> Column:
    return F.coalesce(F.col("inspection_type"), F.lit(UNKNOWN_TYPE))


def roll_up_events(rows: DataFrame, policy: EventPolicy = EventPolicy()) -> DataFrame:
    """One row per (entity, date, type).

    Two hash levels instead of multi-distinct aggregation, which would sort four
    copies of every row.  The first counts rows per (event, attribute, value) for
    the three attributes that may conflict and combines map-side, so a hot event
    costs one small buffer per value and map task.  The second sees one row per
    distinct value.  Row counts ride on the score entries: every row has one.
    `coded_critical_count` (critical rows that carry a code) is kept next to the
    public columns: it lets the snapshot windows run without a second pass over
    the violations.
    """
    event = ("camis", "inspection_date", "inspection_type")
    flag, coded = F.col("critical_flag"), F.col("violation_code").isNotNull()
    counts = {
        "source_row_count": F.lit(True),
        "total_violations": coded,
        "critical_violation_count": flag == "Critical",
        "noncritical_violation_count": flag == "Not Critical",
        "coded_critical_count": (flag == "Critical") & coded,
    }
    attribute, value = F.col("_attribute"), F.col("_value")
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("_attribute"), F.col(c).cast("string").alias("_value"))
            for c in ("score", "grade", "action")
        ]
    )
    once = attribute == "score"
    per_value = (
        usable_rows(rows, policy)
        .withColumn("inspection_type", _kind())
        .select(*event, "grade_date", *[met.alias(name) for name, met in counts.items()], F.inline(entries))
        .groupBy(*event, "_attribute", "_value")
        .agg(
            F.max("grade_date").alias("grade_date"),
            *[F.count_if(once & F.col(name)).alias(name) for name in counts],
        )
    )

    def best(name: str) -> Column:
        return F.max(F.when(attribute == name, value))

    def distinct(name: str) -> Column:
        return F.count_if((attribute == name) & value.isNotNull())

    grouped = per_value.groupBy(*event).agg(
        F.max(F.when(attribute == "score", value.cast("int"))).alias("score"),
        *[best(c).alias(c) for c in ("grade", "action")],
        F.max("grade_date").alias("grade_date"),
        *[F.sum(name).alias(name) for name in counts],
        *[distinct(c).alias(f"distinct_{c}_count") for c in ("score", "grade", "action")],
    )
    kind = F.col("inspection_type")
    flags = {
        "is_cycle_inspection": policy.history_types,
        "is_cycle_initial": policy.initial_types,
        "is_cycle_reinspection": policy.reinspection_types,
        "is_eligible_target_event": policy.target_types,
        "is_eligible_historical_event": policy.history_types,
    }
    return grouped.withColumns(
        {
            "inspection_id": event_key(F.col("camis"), F.col("inspection_date"), kind),
            **{name: kind.isin(*types) for name, types in flags.items()},
            "has_any_violation": F.col("total_violations") > 0,
            "has_critical_violation": F.col("critical_violation_count") > 0,
        }
    ).select(*EVENT_COLUMNS, "coded_critical_count")


def roll_up_feed(rows: DataFrame, policy: EventPolicy = EventPolicy()) -> DataFrame:
    """`roll_up_events` of typed rows that may hold exact copies; each distinct row counts once.

    Copies share their event, so the rows are dealt by event once, with the few columns that
    events need and a digest in place of the others; copies are dropped and both levels of the
    roll-up run where the rows then lie.  All rows of one event meet in one task.
    """
    narrow = _typed_usable(rows, policy).select(
        "camis", "inspection_date", _kind().alias("inspection_type"), "score", "grade", "action", "grade_date", "critical_flag",
        F.when(F.col("violation_code").isNotNull(), "").alias("violation_code"), "_row1", "_row2",
    )
    dealt = narrow.repartition("camis", "inspection_date", "inspection_type")
    return roll_up_events(dealt.dropDuplicates().drop("_row1", "_row2"), policy)


def distinct_violations(rows: DataFrame, policy: EventPolicy = EventPolicy()) -> DataFrame:
    """What `violation_rows` reads of typed rows that may hold exact copies, each distinct row once.

    Only these columns and a digest of the row move, dealt by event as in `roll_up_feed`.
    """
    coded = _typed_usable(rows, policy).where(F.col("violation_code").isNotNull())
    narrow = coded.select("camis", "inspection_date", "inspection_type", "violation_code", "violation_description", "critical_flag", "_row1", "_row2")
    dealt = narrow.repartition("camis", "inspection_date", "inspection_type")
    return dealt.dropDuplicates().drop("_row1", "_row2")


def violation_rows(rows: DataFrame, policy: EventPolicy = EventPolicy()) -> DataFrame:
    """Coded detail rows with the id of their event."""
    return (
        usable_rows(rows, policy)
        .where(F.col("violation_code").isNotNull())
        .select(
            event_key(F.col("camis"), F.col("inspection_date"), F.col("inspection_type")).alias("inspection_id"),
            "camis",
            "inspection_date",
            _kind().alias("inspection_type"),
            "violation_code",
            "violation_description",
            "critical_flag",
            F.coalesce(F.col("critical_flag") == "Critical", F.lit(False)).alias("is_critical_violation"),
        )
    )


def violation_counts(violations: DataFrame) -> DataFrame:
    """Detail rows and critical ones per event: what joins need of them, one row however hot the event."""
    return violations.groupBy("camis", "inspection_id").agg(
        F.count(F.lit(1)).alias("violation_rows"), F.count_if("is_critical_violation").alias("critical_rows")
    )


def latest_entities(rows: DataFrame) -> DataFrame:
    """Attributes of each entity's latest row.

    Latest by event date, then record date, then fingerprint; the fingerprint
    covers only part of a row, so every attribute follows as a tie-break.  Spark
    keeps the first row per entity on the map side too (WindowGroupLimit), so one
    hot entity sends one row per map task.
    """
    newest_first = Window.partitionBy("camis").orderBy(
        F.desc_nulls_last("inspection_date"),
        F.desc_nulls_last("record_date"),
        F.asc_nulls_last("raw_row_hash"),
        *[F.asc_nulls_last(c) for c in ENTITY_ATTRIBUTES],
    )
    needed = ("camis", *ENTITY_ATTRIBUTES, "inspection_date", "record_date", "raw_row_hash")
    return (
        rows.where(F.col("camis").isNotNull())
        .select(*needed)
        .withColumn("_place", F.row_number().over(newest_first))
        .where(F.col("_place") == 1)
        .select(
            "camis",
            *ENTITY_ATTRIBUTES,
            F.col("inspection_date").alias("latest_observed_inspection_date"),
            F.col("record_date").alias("latest_observed_record_date"),
        )
    )
