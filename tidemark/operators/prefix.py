"""Running totals and global ranks without a one-task window.

A window ordered over the whole table would pull every row into one task.  Here
rows are range-partitioned along the ordered axis, each partition is summed on its
own task, and the totals of earlier partitions are added as offsets.  The plan has
the same size for any number of partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.tables import pin


def slice_count(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def running_totals(
    df: DataFrame,
    order: str,
    totals: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = True,
) -> DataFrame:
    """Inclusive running sums of `totals` along `order` within `by`, as `cum_<name>`.

    `df` has one row per (by, order).  Adds `_slice`, the range partition of a row; the
    placement is pinned once, because sums and offsets must see the same one.  The
    offsets have one row per (by, slice).
    """
    direction = F.desc if descending else F.asc
    axis = [*[F.asc(b) for b in by], direction(order)]
    placed = pin(df.repartitionByRange(slice_count(df), *axis).withColumn("_slice", F.spark_partition_id()))
    inner = Window.partitionBy(*by, "_slice").orderBy(direction(order))
    outer = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    per_slice = placed.groupBy(*by, "_slice").agg(*[F.sum(t).alias(t) for t in totals])
    offsets = per_slice.select(
        *[F.col(b).alias(f"_by_{b}") for b in by],
        F.col("_slice").alias("_offset_slice"),
        *[F.coalesce(F.sum(t).over(outer), F.lit(0)).alias(f"_before_{t}") for t in totals],
    )
    match = F.col("_slice") == F.col("_offset_slice")
    for b in by:
        match = match & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    summed = placed.withColumns({f"cum_{t}": F.sum(t).over(inner) for t in totals})
    joined = summed.join(offsets, match).withColumns(
        {f"cum_{t}": F.col(f"cum_{t}") + F.col(f"_before_{t}") for t in totals}
    )
    return joined.drop("_offset_slice", *[f"_before_{t}" for t in totals], *[f"_by_{b}" for b in by])


def global_rank(df: DataFrame, *order: Column, rank: str = "priority_rank") -> DataFrame:
    """1..n along a total order of the whole table.

    Rows are range-partitioned and sorted, so ties and hot scores split by the
    trailing keys.  The placement is pinned once: positions and slice sizes must
    come from the same evaluation.  The offsets have one row per partition.
    """
    placed = pin(
        df.repartitionByRange(slice_count(df), *order)
        .sortWithinPartitions(*order)
        .withColumn("_position", F.monotonically_increasing_id())
    )
    part = F.shiftright("_position", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.col("_position").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(rank, F.col("_before") + inside + 1)
        .drop("_part", "_position", "_before")
    )
