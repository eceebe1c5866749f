"""Source profiles, dataset summaries and target-rate breakdowns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import bin_label, year_quarter
from tidemark.operators.selection import exact_quantiles
from tidemark.operators.splits import TARGET

INF = float("inf")

# Bin edges and labels of the reported breakdowns.
HORIZON_EDGES = (0, 90, 180, 365, 730, INF)
HORIZON_LABELS = ("0–90 days", "91–180 days", "181–365 days", "366–730 days", "731+ days")
RATE_EDGES = (-0.01, 0, 0.25, 0.50, 0.75, 1.0)
RATE_LABELS = ("0%", "0–25%", "25–50%", "50–75%", "75–100%")
RECENCY_EDGES = (-1, 30, 90, 180, 365, INF)
RECENCY_LABELS = ("0–30 days", "31–90 days", "91–180 days", "181–365 days", "366+ days")


def count_rows() -> Column:
    return F.count(F.lit(1))


# --- source profile ----------------------------------------------------------


def source_size(rows: DataFrame) -> DataFrame:
    return rows.agg(count_rows().alias("total_rows"), F.count_distinct("camis").alias("unique_restaurants"))


def source_span(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.min("inspection_date").alias("earliest_inspection"),
        F.max("inspection_date").alias("latest_inspection"),
        F.min("record_date").alias("earliest_record"),
        F.max("record_date").alias("latest_record"),
    )


def not_yet_inspected(rows: DataFrame, sentinel) -> DataFrame:
    return rows.agg(F.count_if(F.col("inspection_date") == F.lit(sentinel)).alias("not_yet_inspected_rows"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and NULLs per column in one pass."""
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c.lower().replace(' ', '_')}") for c in columns]
    return df.agg(count_rows().alias("total_rows"), *nulls)


def duplicate_rows(df: DataFrame) -> DataFrame:
    copies = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(count_rows().alias("_n"))
    return copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        count_rows().alias("unique_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def distinct_tuples(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Distinct combinations; combinations with NULL members count."""
    return df.agg(F.count_distinct(F.struct(*[F.col(f"`{c}`") for c in columns])).alias(name))


def largest_groups(df: DataFrame, columns: Sequence[str], name: str, limit: int = 20) -> DataFrame:
    keys = [F.col(f"`{c}`") for c in columns]
    return (
        df.groupBy(*keys)
        .agg(count_rows().alias(name))
        .orderBy(F.desc(name), *[F.asc_nulls_last(F.col(f"`{c}`")) for c in columns])
        .limit(limit)
    )


# --- modelling set summaries --------------------------------------------------


def unpivot_row(one: DataFrame, name: str = "metric", value: str = "value") -> DataFrame:
    """A one-row frame as (metric, value) text rows."""
    cells = [F.struct(F.lit(c).alias(name), F.col(c).cast("string").alias(value)) for c in one.columns]
    return one.select(F.inline(F.array(*cells)))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column_name, n, nulls): distinct values, and 1 where NULL occurs.

    Several distinct counts in one aggregate, or in scalar subqueries (which Spark merges into
    one), copy every row once per column.  As branches of a union each column is read alone,
    combined map-side and spread by value.
    """
    absent = lambda c: F.coalesce(F.max(F.col(c).isNull().cast("bigint")), F.lit(0)).alias("nulls")
    alone = [df.agg(F.count_distinct(c).alias("n"), absent(c)).select(F.lit(c).alias("column_name"), "n", "nulls") for c in columns]
    return reduce(DataFrame.unionAll, alone)


def dataset_card(df: DataFrame) -> DataFrame:
    distinct = {
        "unique_restaurants": "camis",
        "unique_cutoff_inspections": "cutoff_inspection_id",
        "unique_target_inspections": "target_inspection_id",
    }
    one = df.agg(
        count_rows().alias("prediction_examples"),
        F.min("cutoff_date").alias("earliest_cutoff_date"),
        F.max("cutoff_date").alias("latest_cutoff_date"),
        F.min("target_inspection_date").alias("earliest_target_date"),
        F.max("target_inspection_date").alias("latest_target_date"),
        F.sum(TARGET).alias("high_severity_positives"),
        F.concat(F.format_string("%.2f", 100 * F.avg(TARGET)), F.lit("%")).alias("high_severity_prevalence"),
        F.median("days_to_target").cast("bigint").alias("median_days_to_target"),
    )
    label = F.create_map(*[F.lit(x) for name, c in distinct.items() for x in (c, name)])
    ids = distinct_counts(df, list(distinct.values())).select(label[F.col("column_name")].alias("metric"), F.col("n").cast("string").alias("value"))
    return unpivot_row(one).unionAll(ids)


def validity_counts(df: DataFrame) -> DataFrame:
    """Rule breaks of the modelling set in one row; all but the first two should be 0."""
    days, target = F.col("days_to_target"), F.col(TARGET)
    n, ids = count_rows(), F.count_distinct("cutoff_inspection_id")
    return df.agg(
        n.alias("row_count"),
        ids.alias("unique_cutoffs"),
        (n - ids).alias("duplicate_cutoffs"),
        F.count_if(target.isNull()).alias("null_targets"),
        F.count_if(F.col("target_inspection_date") <= F.col("cutoff_date")).alias("targets_not_after_cutoff"),
        F.count_if(days <= 0).alias("non_positive_horizons"),
        F.count_if(target.isNull() | ~target.isin(0, 1)).alias("non_binary_targets"),
    )


def severity_audit(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    one = df.agg(*[F.sum(c).alias(f"s_{c}") for c in targets], *[F.avg(c).alias(f"m_{c}") for c in targets])
    cells = [
        F.struct(
            F.lit(c).alias("target"),
            F.col(f"s_{c}").alias("positive_examples"),
            F.col(f"m_{c}").alias("positive_rate"),
        )
        for c in targets
    ]
    return one.select(F.inline(F.array(*cells)))


def target_rate_by(
    df: DataFrame,
    group: Column | str,
    name: str,
    keep_null: bool = True,
    labels: Sequence[str] | None = None,
    share: bool = False,
) -> DataFrame:
    """Examples, positives and rate per group.

    `labels` lists the groups to report even when empty; `share` adds each group's
    part of the population.
    """
    key = F.col(group) if isinstance(group, str) else group
    grouped = df.groupBy(key.alias(name)).agg(
        count_rows().alias("examples"),
        F.sum(TARGET).alias("positive_targets"),
        F.avg(TARGET).alias("target_rate"),
    )
    if not keep_null:
        grouped = grouped.where(F.col(name).isNotNull())
    if labels is not None:
        every = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(v) for v in labels])).alias(name))
        grouped = F.broadcast(every).join(grouped, name, "left").withColumns(
            {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("examples", "positive_targets")}
        )
    if share:
        whole = grouped.agg(F.sum("examples").alias("n")).scalar()
        grouped = grouped.withColumn("population_share", F.try_divide(F.col("examples").cast("double"), whole))
    return grouped


def target_rate_by_horizon(df: DataFrame) -> DataFrame:
    label = bin_label(F.col("days_to_target"), HORIZON_EDGES, HORIZON_LABELS)
    return target_rate_by(df, label, "horizon_bucket", keep_null=False, labels=HORIZON_LABELS)


def target_rate_by_rate(df: DataFrame, rate: str, name: str) -> DataFrame:
    return target_rate_by(df, bin_label(F.col(rate), RATE_EDGES, RATE_LABELS), name, keep_null=False, labels=RATE_LABELS)


def target_rate_by_recency(df: DataFrame) -> DataFrame:
    label = bin_label(F.col("days_since_last_high_severity_inspection"), RECENCY_EDGES, RECENCY_LABELS)
    return target_rate_by(df, label, "high_severity_recency_bucket", keep_null=False, labels=RECENCY_LABELS)


def target_rate_by_quarter(df: DataFrame) -> DataFrame:
    return target_rate_by(df, year_quarter(F.col("cutoff_date")), "cutoff_quarter", keep_null=False)


def target_rate_by_indicator(df: DataFrame, condition: Column, yes: str, no: str, name: str) -> DataFrame:
    return target_rate_by(df, F.when(condition, yes).otherwise(no), name)


def depth_summary(df: DataFrame) -> DataFrame:
    """Size, entities, positives, rate and two exact medians per depth bucket."""
    sizes = df.groupBy("history_depth_bucket").agg(
        count_rows().alias("examples"),
        F.count_distinct("camis").alias("unique_restaurants"),
        F.sum(TARGET).alias("positive_targets"),
        F.avg(TARGET).alias("target_rate"),
    )
    names = {"days_to_target": "median_days_to_target", "prior_critical_inspection_rate": "median_prior_critical_rate"}
    middles = exact_quantiles(df, list(names), [0.5], ["history_depth_bucket"]).groupBy("history_depth_bucket").agg(
        *[F.max(F.when(F.col("column_name") == c, F.col("value"))).alias(n) for c, n in names.items()]
    )
    return sizes.join(middles, "history_depth_bucket", "left")


def describe(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, max and exact percentiles per column.

    Percentile columns are named by their rank: p05, p50, ...
    """
    moments = []
    for c in columns:
        v = F.col(c).cast("double")
        moments.append(
            F.struct(
                F.lit(c).alias("column_name"), F.count(v).alias("count"), F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
            ).alias(c)
        )
    long = df.agg(*moments).select(F.inline(F.array(*columns)))
    points = exact_quantiles(df, columns, probabilities).groupBy("column_name").agg(
        *[
            F.max(F.when(F.col("probability") == p, F.col("value"))).alias(f"p{round(p * 100):02d}")
            for p in probabilities
        ]
    )
    return long.join(points, "column_name", "left")


def missingness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    one = df.agg(*[(100 * F.avg(F.col(c).isNull().cast("double"))).alias(c) for c in columns])
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing_pct")) for c in columns]
    return one.select(F.inline(F.array(*cells))).orderBy(F.desc("missing_pct"), "column_name")


def value_counts(df: DataFrame, column: str, limit: int = 15) -> DataFrame:
    """The most frequent values, NULL included."""
    return (
        df.groupBy(F.col(column).cast("string").alias("value"))
        .agg(count_rows().alias("n"))
        .orderBy(F.desc("n"), F.asc_nulls_last("value"))
        .limit(limit)
        .select(F.lit(column).alias("column_name"), "value", "n")
    )


def cardinality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values per column, NULL counted as one."""
    return distinct_counts(df, columns).select("column_name", (F.col("n") + F.col("nulls")).alias("unique_values"))


# --- batch monitoring ----------------------------------------------------------


def monitoring_metrics(scored: DataFrame, p: str = "calibrated_high_severity_probability") -> DataFrame:
    """Prediction distribution of one scored batch as one row.

    Probabilities that are NULL do not count; `top_rank_probability` is that of
    the best rank.
    """
    score = F.col(p)
    median = exact_quantiles(scored, [p], [0.5]).select("value").scalar()
    return scored.agg(
        count_rows().alias("prediction_count"),
        F.avg(score).alias("prediction_mean"),
        F.min(score).alias("prediction_min"),
        F.max(score).alias("prediction_max"),
        F.avg((score >= 0.50).cast("double")).alias("high_risk_rate_0_50"),
        F.avg((score >= 0.75).cast("double")).alias("high_risk_rate_0_75"),
        F.count_distinct("camis").alias("unique_restaurants"),
        F.min_by(score, "priority_rank").alias("top_rank_probability"),
    ).withColumn("prediction_median", median)


def category_shares(df: DataFrame, column: str = "history_depth_bucket") -> DataFrame:
    """Share per category, NULL as `missing`."""
    counted = df.groupBy(F.coalesce(F.col(column), F.lit("missing")).alias("category")).agg(count_rows().alias("_n"))
    whole = df.agg(count_rows().alias("n")).scalar()
    return counted.select("category", F.try_divide(F.col("_n").cast("double"), whole).alias("share"))


def category_share_map(df: DataFrame, column: str = "history_depth_bucket") -> DataFrame:
    """The shares as one map column; one entry per category."""
    entries = F.collect_list(F.struct("category", "share"))
    return category_shares(df, column).agg(F.map_from_entries(entries).alias(f"{column}_distribution"))
