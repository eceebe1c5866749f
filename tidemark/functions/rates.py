"""Rates, bins and display forms."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ordinal history-depth labels, in order.
DEPTH_BUCKETS = ("0", "1", "2-3", "4+")


def safe_rate(part: Column, whole: Column) -> Column:
    """part / whole as double, 0.0 where the whole is zero."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.try_divide(part.cast("double"), whole.cast("double")))


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def depth_bucket(n: Column) -> Column:
    return (
        F.when(n == 0, DEPTH_BUCKETS[0])
        .when(n == 1, DEPTH_BUCKETS[1])
        .when(n.between(2, 3), DEPTH_BUCKETS[2])
        .otherwise(DEPTH_BUCKETS[3])
    )


def bin_label(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins (lo, hi]; NULL and out-of-range values stay NULL."""
    value = c.cast("double")
    label = F.lit(None).cast("string")
    for lo, hi, name in reversed(list(zip(edges, edges[1:], labels))):
        inside = value > lo
        if not math.isinf(hi):
            inside = inside & (value <= hi)
        label = F.when(inside, name).otherwise(label)
    return label


def year_quarter(day: Column) -> Column:
    """2024-05-01 -> 2024Q2."""
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def risk_tier(p: Column) -> Column:
    return F.when(p >= 0.70, "risk-high").when(p >= 0.40, "risk-medium").otherwise("risk-low")


def percent_text(p: Column) -> Column:
    return F.when(p.isNull(), "—").otherwise(F.format_string("%.1f%%", p.cast("double") * 100))


def sigmoid(margin: Column, slope: float = 1.0, intercept: float = 0.0) -> Column:
    """1 / (1 + exp(-(slope * margin + intercept)))."""
    return 1.0 / (1.0 + F.exp(-(margin * F.lit(slope) + F.lit(intercept))))
