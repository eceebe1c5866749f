"""Exact quantiles by selection: histograms that are refined only where a wanted position lies.

A round counts values per bucket of a monotone scale, finds the buckets that hold the
wanted positions and, with the buckets' own least and greatest values as the new ends of the
scale, looks into those alone.  A round shuffles one partial count per task and
bucket, so what moves is bounded by the number of buckets, not by the number of distinct
values; no value is sorted, and none but the ends of buckets is stored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.tables import pin

#: Buckets per e-fold of magnitude in the first round; the magnitudes of doubles span less than _FOLDS e-folds on either side of 1.
_PER_FOLD = 1024
_FOLDS = 750
#: Equal parts into which each later round cuts a bucket.
_PARTS = 4096
#: Buckets looked into that are broadcast; more of them (groups by the thousand) meet the values in a shuffled join.
BROADCAST_BUCKETS = 50_000


def _by_magnitude(value: Column) -> Column:
    """Bucket on a logarithmic scale of both signs; zero and either infinity have one of their own."""
    size = F.floor(F.least(F.ln(F.abs(value)) + _FOLDS, F.lit(2.0 * _FOLDS)) * _PER_FOLD)
    return F.when(value > 0, size).when(value < 0, -size).otherwise(0)


def _between(value: Column, low: Column, high: Column) -> Column:
    """Bucket among equal parts of [low, high]: the ends fall into different ones, so each round makes a bucket smaller."""
    return F.least(F.lit(_PARTS - 1), F.floor((value - low) / (high - low) * _PARTS))


def _same(keys: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def _counted(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Buckets with their ends, their counts and the values before them among those of `keys`."""
    ends = (F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    earlier = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return cells.groupBy(*keys, "bucket").agg(*ends).withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def _first_targets(counted: DataFrame, keys: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """The bucket of each wanted position: two neighbours per probability, with the share of the way between them."""
    whole = counted.withColumn("_total", F.sum("n").over(Window.partitionBy(*keys)))
    wanted = []
    for p in probabilities:
        position = (F.col("_total") - 1) * F.lit(float(p))
        for side, at in enumerate((F.floor(position), F.ceil(position))):
            here = (at >= F.col("before")) & (at < F.col("before") + F.col("n"))
            cell = F.struct(F.lit(float(p)).alias("probability"), F.lit(side).alias("side"), (position - F.floor(position)).alias("part"), at.cast("bigint").alias("at"))
            wanted.append(F.when(here, cell))
    found = whole.select(*keys, "low", "high", "before", F.array_compact(F.array(*wanted)).alias("found")).where(F.size("found") > 0)
    return found.select(*keys, F.inline("found"), "low", "high", "before")


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Exact, linearly interpolated quantiles: rows (by, column_name, probability, value).

    NULL and NaN are left out; a column or group without a value gives no row; an empty
    frame gives none.  `df` is read once per round: once where the first buckets hold
    one value each (whole numbers up to a thousand), two or three times for most others.
    """
    keys = [*by, "column_name"]
    values = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns]
    cells = df.select(*by, F.inline(F.array(*values))).where(F.col("value").isNotNull() & ~F.isnan("value"))
    first = _counted(cells.withColumn("bucket", _by_magnitude(F.col("value"))), keys)
    targets = pin(_first_targets(first, keys, probabilities))
    while True:
        unsettled = targets.where(F.col("low") < F.col("high"))
        looked_into = unsettled.count()
        if not looked_into:
            break
        wide = unsettled.select(*[F.col(k).alias(f"_t_{k}") for k in keys], F.col("low").alias("from"), F.col("high").alias("to")).distinct()
        if looked_into <= BROADCAST_BUCKETS:
            wide = F.broadcast(wide)
        inside = cells.join(wide, _same(keys, "_t_") & F.col("value").between(F.col("from"), F.col("to")))
        parts = _counted(inside.withColumn("bucket", _between(F.col("value"), F.col("from"), F.col("to"))), [*keys, "from"])
        parts = parts.select(*[F.col(k).alias(f"_p_{k}") for k in keys], "from", "n", F.col("low").alias("_low"), F.col("high").alias("_high"), F.col("before").alias("_inside"))
        open_ = unsettled.join(parts, _same(keys, "_p_") & (F.col("low") == F.col("from")))
        start = F.col("before") + F.col("_inside")
        narrowed = open_.where((F.col("at") >= start) & (F.col("at") < start + F.col("n"))).select(
            *keys, "probability", "side", "part", "at", F.col("_low").alias("low"), F.col("_high").alias("high"), start.alias("before")
        )
        targets = pin(targets.where(F.col("low") >= F.col("high")).unionByName(narrowed))
    lower, upper = (F.max(F.when(F.col("side") == k, F.col("low"))) for k in (0, 1))
    # Neighbours that are the same infinity have no way between them.
    value = F.when(lower == upper, lower).otherwise(lower + (upper - lower) * F.max("part"))
    return targets.groupBy(*keys, "probability").agg(value.alias("value"))
