"""Exact ranking and calibration metrics.

Scores collapse to distinct values before anything is ordered, so a score shared
by a third of the rows is one row, and cumulative counts come from running totals
over range partitions.  A row whose score is NULL or NaN takes no part in any of the
ranking metrics: not in the counts, not in the sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.prefix import running_totals
from tidemark.operators.splits import TARGET


def with_scores(df: DataFrame, score: str) -> DataFrame:
    """The rows that have a score."""
    return df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))


def threshold_counts(df: DataFrame, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and rows per distinct score, with running counts from the top."""
    collapsed = with_scores(df, score).groupBy(*by, F.col(score).cast("double").alias("_score")).agg(
        F.sum(TARGET).alias("pos"), F.count(F.lit(1)).alias("n")
    )
    return running_totals(collapsed, "_score", ["pos", "n"], by)


def brier_scores(df: DataFrame, score: str, by: Sequence[str] = ()) -> DataFrame:
    """n, positives, prevalence and Brier score; one aggregate."""
    return with_scores(df, score).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(TARGET).alias("positives"),
        F.avg(TARGET).alias("prevalence"),
        F.avg(F.pow(F.col(score) - F.col(TARGET), F.lit(2.0))).alias("brier_score"),
    )


def ranking_metrics(df: DataFrame, score: str, by: Sequence[str] = ()) -> DataFrame:
    """n, positives, prevalence, average precision, ROC-AUC and Brier score.

    Average precision is the step-wise sum over distinct thresholds, ROC-AUC
    counts ties as half and is NULL where only one class is present.
    """
    counts = threshold_counts(df, score, by)
    whole = brier_scores(df, score, by)
    # Totals divide after the sums, so no group's thresholds are joined to anything.
    above = (F.col("cum_n") - F.col("cum_pos")) - (F.col("n") - F.col("pos")) / 2
    summed = counts.groupBy(*by).agg(
        F.sum(F.col("pos") * (F.col("cum_pos") / F.col("cum_n"))).alias("_gain"),
        F.sum(F.col("pos") * above.cast("double")).alias("_negatives_above"),
    )
    p, negatives = F.col("positives"), F.col("n") - F.col("positives")
    return _attach(whole, summed, by).select(
        *by,
        "n",
        "positives",
        "prevalence",
        F.try_divide("_gain", p).alias("average_precision"),
        (1 - F.try_divide(F.col("_negatives_above"), p.cast("double") * negatives)).alias("roc_auc"),
        "brier_score",
    )


def _attach(df: DataFrame, per_group: DataFrame, by: Sequence[str]) -> DataFrame:
    """Group-level columns of `per_group`; without groups they come as a scalar subquery."""
    if not by:
        cell = per_group.select(F.struct(*per_group.columns).alias("c")).scalar()
        return df.withColumn("_c", cell).select("*", "_c.*").drop("_c")
    renamed = per_group.withColumnsRenamed({b: f"_by_{b}" for b in by})
    match = F.lit(True)
    for b in by:
        match = match & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    return df.join(renamed, match).drop(*[f"_by_{b}" for b in by])


def metric_deltas(df: DataFrame, baseline: str, model: str, by: Sequence[str]) -> DataFrame:
    """Model minus baseline per segment; a lower Brier score is an improvement.

    Both scores go through one metric plan as rows; n, positives and prevalence are those
    of the rows the baseline scores.
    """
    side = lambda name, c: F.struct(F.lit(name).alias("_side"), F.col(c).cast("double").alias("_value"))
    long = df.select(*by, TARGET, F.inline(F.array(side("baseline", baseline), side("model", model))))
    found = ranking_metrics(long, "_value", [*by, "_side"])
    metrics = ("average_precision", "roc_auc", "brier_score")
    of = lambda name, c: F.max(F.when(F.col("_side") == name, F.col(c)))
    return (
        found.groupBy(*by)
        .agg(
            *[of("baseline", c).alias(c) for c in ("n", "positives", "prevalence")],
            *[of(name, c).alias(f"{name}_{c}") for name in ("baseline", "model") for c in metrics],
        )
        .withColumns(
            {
                "average_precision_improvement": F.col("model_average_precision") - F.col("baseline_average_precision"),
                "roc_auc_improvement": F.col("model_roc_auc") - F.col("baseline_roc_auc"),
                "brier_improvement": F.col("baseline_brier_score") - F.col("model_brier_score"),
            }
        )
    )


def calibration_curve(df: DataFrame, score: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Mean prediction and observed rate per non-empty uniform bin (lo, hi]."""
    p = F.col(score)
    bin_number = sum(((p > F.lit(i * (1.0 / bins))).cast("int") for i in range(1, bins)), F.lit(0))
    return (
        with_scores(df, score)
        .groupBy(*by, bin_number.cast("bigint").alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(p).alias("predicted_risk_bin_mean"),
            F.avg(TARGET).alias("observed_high_severity_rate"),
        )
    )


def error_types(df: DataFrame, score: str, threshold: float = 0.50) -> DataFrame:
    """Confusion cell of each row as `error_type`; a row without a score or outcome is Unknown."""
    hit, truth = F.when(~F.isnan(F.col(score).cast("double")), F.col(score) >= threshold), F.col(TARGET)
    kind = (
        F.when(hit & (truth == 1), "True Positive")
        .when(hit & (truth == 0), "False Positive")
        .when(~hit & (truth == 1), "False Negative")
        .when(~hit & (truth == 0), "True Negative")
        .otherwise("Unknown")
    )
    return df.withColumn("predicted_positive", hit.cast("int")).withColumn("error_type", kind)


def confusion_counts(df: DataFrame, score: str, threshold: float = 0.50) -> DataFrame:
    return error_types(with_scores(df, score), score, threshold).groupBy("error_type").agg(F.count(F.lit(1)).alias("n"))


def worst_errors(
    df: DataFrame, score: str, kind: str, limit: int = 20, threshold: float | None = None, *ties: str
) -> DataFrame:
    """The most confident errors: `false_positive` by high score, `false_negative` by low.

    Without a threshold the cut is 0.50; with one, only scores beyond it count
    (>= for positives, <= for negatives).
    """
    p, truth = F.col(score), F.col(TARGET)
    ids = [F.asc_nulls_last(t) for t in (ties or ("camis",))]
    if kind == "false_positive":
        wrong = (p >= (0.50 if threshold is None else threshold)) & (truth == 0)
        order = F.desc(score)
    elif kind == "false_negative":
        wrong = (p < 0.50 if threshold is None else p <= threshold) & (truth == 1)
        order = F.asc(score)
    else:
        raise ValueError(f"Unknown error kind: {kind}")
    return with_scores(df, score).where(wrong).orderBy(order, *ids).limit(limit)


def high_confidence_errors(df: DataFrame, score: str, high: float = 0.80, low: float = 0.20) -> DataFrame:
    p, truth = F.col(score), F.col(TARGET)
    return with_scores(df, score).agg(
        F.count_if((p >= high) & (truth == 0)).alias("high_confidence_false_positives"),
        F.count_if((p <= low) & (truth == 1)).alias("high_confidence_false_negatives"),
    )


def score_sanity(df: DataFrame, score: str) -> DataFrame:
    """Rows, and scores that are missing, not finite or outside [0, 1]."""
    p = F.col(score)
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(score).alias("score_count"),
        F.count_if(p.isNull() | F.isnan(p) | ~p.between(0.0, 1.0)).alias("bad_score_count"),
    )
