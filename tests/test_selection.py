"""Exact quantiles by refined histograms."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import selection

POINTS = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]


def columns(seed, n=3000):
    draw = random.Random(seed)
    hot = [0.1] * (n // 3)
    return {
        "narrow": [0.5 + draw.random() * 1e-12 for _ in range(n)],
        "wide": [draw.choice((-1, 1)) * 10 ** draw.uniform(-300, 300) for _ in range(n)],
        "whole": [float(draw.randrange(-40, 40)) for _ in range(n)],
        "hot": hot + [draw.random() for _ in range(n - len(hot))],
        "neighbours": [math.nextafter(1.0, 2.0) if draw.random() < 0.5 else 1.0 for _ in range(n)],
        "absent": [draw.choice((None, float("nan"), draw.gauss(0, 1))) for _ in range(n)],
        "zeros": [draw.choice((-0.0, 0.0, 5e-324)) for _ in range(n)],
    }


@pytest.mark.parametrize("broadcast", [50_000, 0])
def test_equal_to_sorting(spark, monkeypatch, broadcast):
    monkeypatch.setattr(selection, "BROADCAST_BUCKETS", broadcast)
    data = columns(1)
    rows = list(zip(*data.values()))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).repartition(5)
    got = {(r.column_name, r.probability): r.value for r in selection.exact_quantiles(df, list(data), POINTS).collect()}
    for c, values in data.items():
        kept = sorted(v for v in values if v is not None and not math.isnan(v))
        for p in POINTS:
            at = (len(kept) - 1) * p
            low, high = kept[math.floor(at)], kept[math.ceil(at)]
            assert got[c, p] == low + (high - low) * (at - math.floor(at)), (c, p)
    assert len(got) == len(data) * len(POINTS)


def test_infinities_null_groups_and_nothing(spark):
    inf = math.inf
    rows = [("a", -inf), ("a", 1.0), ("a", inf), ("a", inf), (None, 2.0), (None, 4.0), ("b", None), ("c", float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {(r.g, r.probability): r.value for r in selection.exact_quantiles(df, ["x"], [0.0, 0.5], ["g"]).collect()}
    assert got[("a", 0.0)] == -inf and got[(None, 0.0)] == 2.0 and got[(None, 0.5)] == 3.0
    assert {g for g, _ in got} == {"a", None}
    assert selection.exact_quantiles(df.limit(0), ["x"], [0.5]).count() == 0
    assert selection.exact_quantiles(df.where("g = 'b'"), ["x"], [0.5]).count() == 0


def test_the_first_round_moves_buckets_not_values(spark):
    """A million distinct values in one octave give at most 1,024 buckets a task."""
    cells = spark.range(1_000_000).select(F.lit("x").alias("column_name"), (1 + F.col("id") / 1e6).alias("value"))
    counted = selection._counted(cells.withColumn("bucket", selection._by_magnitude(F.col("value"))), ["column_name"])
    assert counted.count() <= selection._PER_FOLD
    assert selection.exact_quantiles(cells, ["value"], [0.5]).first()["value"] == pytest.approx(1.4999995)
