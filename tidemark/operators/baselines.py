"""Base rate and smoothed per-entity risk, learned from training rows only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.splits import TARGET

SMOOTHED = "smoothed_historical_high_severity_risk"


def base_rate(train: DataFrame) -> DataFrame:
    return train.agg(F.avg(TARGET).alias("base_rate"))


def entity_counts(train: DataFrame, key: str = "camis") -> DataFrame:
    return train.groupBy(key).agg(F.sum(TARGET).alias("_positives"), F.count(TARGET).alias("_seen"))


def _smoothed(alpha: Column) -> Column:
    rate = F.col("_rate")
    return F.coalesce((F.col("_positives") + alpha * rate) / (F.col("_seen") + alpha), rate)


def _with_counts(train: DataFrame, data: DataFrame, key: str) -> DataFrame:
    return data.join(entity_counts(train, key), key, "left").withColumn("_rate", base_rate(train).scalar())


def smoothed_risk(
    train: DataFrame, data: DataFrame, alpha: float, score: str = SMOOTHED, key: str = "camis"
) -> DataFrame:
    """(positives + alpha * rate) / (seen + alpha); entities unseen in training get the rate."""
    if alpha <= 0:
        raise ValueError("alpha must be positive.")
    return (
        _with_counts(train, data, key)
        .withColumn(score, _smoothed(F.lit(float(alpha))))
        .drop("_positives", "_seen", "_rate")
    )


def smoothed_risk_grid(
    train: DataFrame, data: DataFrame, alphas: Sequence[float], score: str = SMOOTHED, key: str = "camis"
) -> DataFrame:
    """The same for several alphas, one row per (row, alpha)."""
    return (
        _with_counts(train, data, key)
        .withColumn("alpha", F.explode(F.array(*[F.lit(float(a)) for a in alphas])))
        .withColumn(score, _smoothed(F.col("alpha")))
        .drop("_positives", "_seen", "_rate")
    )
