"""Split by time, never at random."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.policy import SplitBounds

TARGET = "target_high_severity"


def assign_split(df: DataFrame, bounds: SplitBounds = SplitBounds()) -> DataFrame:
    """Column `split`: train, validation or test by cutoff date; NULL outside the cohort."""
    day = F.col("cutoff_date")
    return df.withColumn(
        "split",
        F.when((day >= F.lit(bounds.start)) & (day < F.lit(bounds.validation)), "train")
        .when((day >= F.lit(bounds.validation)) & (day < F.lit(bounds.test)), "validation")
        .when((day >= F.lit(bounds.test)) & (day < F.lit(bounds.end)), "test"),
    )


def take_split(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("split") == name).drop("split")


def split_summary(df: DataFrame) -> DataFrame:
    """Rows, entities, positives, prevalence and date span per split."""
    return (
        df.where(F.col("split").isNotNull())
        .groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("examples"),
            F.count_distinct("camis").alias("unique_restaurants"),
            F.sum(TARGET).alias("positive_targets"),
            F.avg(TARGET).alias("target_prevalence"),
            F.min("cutoff_date").alias("first_cutoff"),
            F.max("cutoff_date").alias("last_cutoff"),
        )
    )


def split_violations(df: DataFrame) -> DataFrame:
    """Broken split rules as rows (split, problem); empty when the splits are sound."""
    observed = (
        df.where(F.col("split").isNotNull())
        .groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col(TARGET).isNull() | ~F.col(TARGET).isin(0, 1)).alias("invalid"),
            F.sum(TARGET).alias("positives"),
            F.min("cutoff_date").alias("first"),
            F.max("cutoff_date").alias("last"),
        )
    )
    per_split = []
    for name in ("train", "validation", "test"):
        here = F.col("split") == name
        per_split += [F.max(F.when(here, F.col(c))).alias(f"{name}_{c}") for c in ("n", "invalid", "positives", "first", "last")]
    one = observed.agg(*per_split)
    problems = []
    for name in ("train", "validation", "test"):
        problems += [
            (name, "empty", F.col(f"{name}_n").isNull()),
            (name, "invalid target values", F.col(f"{name}_invalid") > 0),
            (name, "no positive examples", F.coalesce(f"{name}_positives", F.lit(0)) == 0),
        ]
    problems += [
        ("validation", "overlaps train", F.col("train_last") >= F.col("validation_first")),
        ("test", "overlaps validation", F.col("validation_last") >= F.col("test_first")),
    ]
    entries = [
        F.when(F.coalesce(broken, F.lit(False)), F.struct(F.lit(s).alias("split"), F.lit(p).alias("problem")))
        for s, p, broken in problems
    ]
    return one.select(F.inline(F.array_compact(F.array(*entries))))


def validate_splits(df: DataFrame) -> None:
    """Raise on the first broken rule; reads at most a handful of rows."""
    broken = split_violations(df).collect()
    if broken:
        raise ValueError("; ".join(f"{r['split']} split: {r['problem']}" for r in broken))
