"""Capacity-limited selection and the evaluation of ranking policies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.prefix import global_rank
from tidemark.operators.splits import TARGET
from tidemark.policy import CAPACITIES


def check_capacity(capacity: int) -> None:
    if capacity <= 0:
        raise ValueError(f"A capacity is at least 1, not {capacity}.")


def check_columns(df: DataFrame, *columns: str) -> None:
    for c in columns:
        if c not in df.columns:
            raise ValueError(f"The table has no column {c}.")


def best_first(score: str, *ties: str, ascending: bool = False) -> list[Column]:
    """Score order with ties broken, so the result does not depend on the scan."""
    first = F.asc_nulls_last(score) if ascending else F.desc_nulls_last(score)
    return [first, *[F.asc_nulls_last(t) for t in ties]]


#: Relative rank error of the sketch that places a cut, as its inverse.
SKETCH_ACCURACY = 20_000
#: Shares of the rows, from all down to a millionth, above whose scores a cut may be placed.
_SHARES = [2.0 ** (-i / 2) for i in range(41)]


def _descending(score: str, ascending: bool) -> Column:
    """A number that falls from the best score to the worst; NaN counts as the largest score."""
    value = F.col(score).cast("double")
    value = F.when(F.isnan(value), F.lit(float("inf"))).otherwise(value)
    return -value if ascending else value


def _near_top(df: DataFrame, score: str, capacity: int, ascending: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """A superset of the k best rows (of every group of `by`), larger by a bounded share of the rows and the ties at its end.

    One aggregate sketches the scores, combined map-side.  A share is taken that holds k rows
    even if the sketch is off by its full error, so the cut needs no exact counts.  Where no
    share is large enough, all rows stay.  The sketches have one row per group; groups are
    the caller's policies or parameters.
    """
    key = _descending(score, ascending)
    at = F.percentile_approx(key, [1.0 - share for share in _SHARES], SKETCH_ACCURACY)
    needed = F.lit(float(capacity)) + F.count(key) * (2.0 / SKETCH_ACCURACY)
    large_enough = F.zip_with(at, F.array(*[F.lit(x) for x in _SHARES]), lambda cut, share: F.when(share * F.count(key) >= needed, cut))
    cut = F.array_max(large_enough).alias("_cut")
    if not by:
        limited = df.withColumn("_cut", df.agg(cut).scalar())
        return limited.where(F.col("_cut").isNull() | (key >= F.col("_cut"))).drop("_cut")
    cuts = df.groupBy(*[F.col(b).alias(f"_by_{b}") for b in by]).agg(cut)
    same = reduce(lambda x, y: x & y, [F.col(b).eqNullSafe(F.col(f"_by_{b}")) for b in by])
    below = F.col("_cut").isNotNull() & F.coalesce(key < F.col("_cut"), F.lit(True))
    return df.join(F.broadcast(cuts), same).where(~below).select(*df.columns)


def _pruned_by_spark(df: DataFrame, capacity: int) -> bool:
    """Whether Spark prunes a row_number window to the first k rows of a group in every task before the shuffle."""
    return capacity <= int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))


def ranked_top(df: DataFrame, score: str, capacity: int, *ties: str, ascending: bool = False, rank: str = "rank") -> DataFrame:
    """The k best rows with their 1..k rank; ties at the boundary go to the lowest id.

    Rows that cannot be among the k best go first.  A few are then ranked in one window,
    which Spark prunes to k per task before its shuffle; for a larger k the rest is ranked
    over range partitions, so no task ever holds the k rows.
    """
    ties = ties or ("camis",)
    check_capacity(capacity)
    check_columns(df, score, *ties)
    rows, order = _near_top(df, score, capacity, ascending), best_first(score, *ties, ascending=ascending)
    if _pruned_by_spark(df, capacity):
        ranked = rows.withColumn(rank, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    else:
        ranked = global_rank(rows, *order, rank=rank)
    return ranked.where(F.col(rank) <= capacity)


def top_k(df: DataFrame, score: str, capacity: int, *ties: str, ascending: bool = False) -> DataFrame:
    """`ranked_top` in rank order, without the rank."""
    return ranked_top(df, score, capacity, *ties, ascending=ascending, rank="_rank").orderBy("_rank").drop("_rank")


def ranked_top_by(df: DataFrame, by: str, score: str, capacity: int, *ties: str, rank: str = "rank") -> DataFrame:
    """The k best rows of each group, for few groups of any size.

    As `ranked_top`: beyond what Spark prunes, the rows left of all groups are put in one order over range
    partitions, in which a group's ranks count from its first place.
    """
    check_capacity(capacity)
    ties = ties or ("camis",)
    rows, order = _near_top(df, score, capacity, by=[by]), best_first(score, *ties)
    if _pruned_by_spark(df, capacity):
        window = Window.partitionBy(by).orderBy(*order)
        return rows.withColumn(rank, F.row_number().over(window).cast("bigint")).where(F.col(rank) <= capacity)
    placed = global_rank(rows, F.asc_nulls_first(by), *order, rank="_place")
    first = placed.groupBy(F.col(by).alias("_group")).agg(F.min("_place").alias("_first"))
    ranked = placed.join(F.broadcast(first), F.col(by).eqNullSafe(F.col("_group")))
    ranked = ranked.withColumn(rank, F.col("_place") - F.col("_first") + 1).where(F.col(rank) <= capacity)
    return ranked.drop("_place", "_first", "_group")


def _capacity_rows(capacities: Sequence[int]) -> Column:
    return F.explode(F.array(*[F.lit(int(k)).cast("bigint") for k in capacities]))


def _totals(df: DataFrame) -> DataFrame:
    """One struct: rows, positives and prevalence of the population."""
    return df.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"), F.sum(TARGET).alias("positives"), F.avg(TARGET).alias("prevalence")
        ).alias("t")
    )


def random_policy(df: DataFrame, capacities: Sequence[int] = CAPACITIES) -> DataFrame:
    """Expected yield of a uniform random choice."""
    for k in capacities:
        check_capacity(k)
    return (
        df.agg(F.avg(TARGET).alias("expected_precision_at_k"))
        .withColumn("capacity", _capacity_rows(capacities))
        .select(
            "capacity",
            (F.col("capacity") * F.col("expected_precision_at_k")).alias("expected_high_severity_outcomes"),
            "expected_precision_at_k",
            F.lit(1.0).alias("lift_vs_random"),
        )
    )


def _by_policy(df: DataFrame, scores: dict[str, str], capacity: int, *ties: str, ascending: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """(policy, rank, keep...) of the best rows of every policy of `scores` (name -> column), from one pass over df."""
    check_capacity(capacity)
    ties = ties or ("camis",)
    check_columns(df, *scores.values(), *ties)
    signed = lambda name, c: -F.col(c).cast("double") if name in ascending else F.col(c).cast("double")
    cells = [F.struct(F.lit(name).alias("policy"), signed(name, c).alias("_score")) for name, c in scores.items()]
    long = df.select(*dict.fromkeys([*keep, *ties]), F.inline(F.array(*cells)))
    return ranked_top_by(long, "policy", "_score", capacity, *ties).select("policy", "rank", *keep)


def policies_at_k(df: DataFrame, scores: dict[str, str], capacities: Sequence[int], *ties: str, ascending: Sequence[str] = ()) -> DataFrame:
    """Yield, precision, recall and lift of every policy at every capacity.

    The best max(k) rows of each policy are taken once; each capacity counts within them.
    Precision is over the rows actually selected, which may be fewer than k.
    """
    for k in capacities:
        check_capacity(k)
    found = (
        _by_policy(df, scores, max(capacities), *ties, ascending=ascending, keep=[TARGET])
        .withColumn("capacity", _capacity_rows(capacities))
        .where(F.col("rank") <= F.col("capacity"))
        .groupBy("policy", "capacity")
        .agg(F.count(F.lit(1)).alias("selected_examples"), F.sum(TARGET).alias("high_severity_outcomes_found"))
    )
    return _policy_columns(found.withColumn("_t", _totals(df).scalar()), F.col("policy"))


def policy_at_k(
    df: DataFrame,
    score: str,
    policy: str,
    capacities: Sequence[int] = CAPACITIES,
    *ties: str,
    ascending: bool = False,
) -> DataFrame:
    """`policies_at_k` of one policy."""
    return policies_at_k(df, {policy: score}, capacities, *ties, ascending=[policy] * ascending)


def _policy_columns(found: DataFrame, policy: str | Column) -> DataFrame:
    hits, prevalence = F.col("high_severity_outcomes_found"), F.col("_t.prevalence")
    precision = F.try_divide(hits, F.col("selected_examples"))
    return found.select(
        (F.lit(policy) if isinstance(policy, str) else policy).alias("policy"),
        "capacity",
        "selected_examples",
        "high_severity_outcomes_found",
        precision.alias("precision_at_k"),
        F.try_divide(hits, F.col("_t.positives")).alias("recall_at_k"),
        F.when(prevalence > 0, precision / prevalence).alias("lift_vs_random"),
        (hits - F.col("capacity") * prevalence).alias("incremental_outcomes_vs_random"),
    )


def capacity_sweep(
    df: DataFrame,
    scores: dict[str, str],
    capacities: Sequence[int] = CAPACITIES,
    *ties: str,
    ascending: Sequence[str] = (),
) -> DataFrame:
    """Random expectation and every policy of `scores` (name -> column), stacked."""
    chance = random_policy(df, capacities).select(
        F.lit("random_expected").alias("policy"),
        "capacity",
        F.col("capacity").alias("selected_examples"),
        F.col("expected_high_severity_outcomes").alias("high_severity_outcomes_found"),
        F.col("expected_precision_at_k").alias("precision_at_k"),
        F.lit(None).cast("double").alias("recall_at_k"),
        "lift_vs_random",
        F.lit(0.0).alias("incremental_outcomes_vs_random"),
    )
    found = policies_at_k(df, scores, capacities, *ties, ascending=ascending)
    return chance.unionByName(found.withColumn("high_severity_outcomes_found", F.col("high_severity_outcomes_found").cast("double")))


def alpha_grid(scored: DataFrame, score: str, capacities: Sequence[int] = CAPACITIES, *ties: str) -> DataFrame:
    """Policy yield per (alpha, capacity) next to the random expectation.

    `scored` is the output of `smoothed_risk_grid`: one row per (row, alpha).
    """
    best = ranked_top_by(scored, "alpha", score, max(capacities), *ties).select("alpha", "rank", TARGET)
    found = (
        best.withColumn("capacity", _capacity_rows(capacities))
        .where(F.col("rank") <= F.col("capacity"))
        .groupBy("alpha", "capacity")
        .agg(F.count(F.lit(1)).alias("_selected"), F.sum(TARGET).alias("policy_outcomes_found"))
    )
    whole = scored.groupBy("alpha").agg(F.sum(TARGET).alias("_positives"), F.avg(TARGET).alias("_prevalence"))
    hits = F.col("policy_outcomes_found")
    expected = F.col("capacity") * F.col("_prevalence")
    precision = F.try_divide(hits, F.col("_selected"))
    return found.join(whole, "alpha").select(
        "alpha",
        "capacity",
        "policy_outcomes_found",
        precision.alias("policy_precision_at_k"),
        F.try_divide(hits, F.col("_positives")).alias("policy_recall_at_k"),
        F.try_divide(precision, F.col("_prevalence")).alias("policy_lift_vs_random"),
        expected.alias("random_expected_outcomes"),
        F.col("_prevalence").alias("random_expected_precision"),
        (hits - expected).alias("incremental_outcomes_vs_random"),
    )


def score_spread(scored: DataFrame, score: str, by: str = "alpha") -> DataFrame:
    return scored.groupBy(by).agg(
        F.min(score).alias("min_score"), F.avg(score).alias("mean_score"), F.max(score).alias("max_score")
    )


def queue_overlap(
    df: DataFrame, score_a: str, score_b: str, capacities: Sequence[int] = CAPACITIES, *ties: str, key: str = "camis"
) -> DataFrame:
    """How two policies' queues agree, as sets of entities, per capacity."""
    ranks = _by_policy(df, {"a": score_a, "b": score_b}, max(capacities), *ties, keep=[key])
    best = lambda name: F.min(F.when(F.col("policy") == name, F.col("rank"))).alias(f"_{name}")
    both = ranks.groupBy(key).agg(best("a"), best("b"))
    k = F.col("capacity")
    in_a = F.coalesce(F.col("_a") <= k, F.lit(False))
    in_b = F.coalesce(F.col("_b") <= k, F.lit(False))
    return (
        both.withColumn("capacity", _capacity_rows(capacities))
        .groupBy("capacity")
        .agg(
            F.count_if(in_a).alias("a_queue_size"),
            F.count_if(in_b).alias("b_queue_size"),
            F.count_if(in_a & in_b).alias("overlap"),
            (F.count_if(in_a & in_b) / k).alias("overlap_rate"),
            F.count_if(in_b & ~in_a).alias("b_only"),
            F.count_if(in_a & ~in_b).alias("a_only"),
        )
    )


def only_in_b(df: DataFrame, score_a: str, score_b: str, capacity: int, *ties: str, key: str = "camis") -> DataFrame:
    """All rows of the entities that B's queue holds and A's does not."""
    queues = _by_policy(df, {"a": score_a, "b": score_b}, capacity, *ties, keep=[key])
    chosen = queues.groupBy(key).agg(F.min("policy").alias("_first"))
    only = chosen.where("_first = 'b'").select(key)
    return df.join(only, key, "left_semi").orderBy(*best_first(score_b, *(ties or (key,))))


def policy_comparison(
    df: DataFrame, score_a: str, score_b: str, capacities: Sequence[int] = CAPACITIES, *ties: str
) -> DataFrame:
    """Yields of two policies side by side with lifts and relative improvement."""
    hits = lambda name: F.max(F.when(F.col("policy") == name, F.col("high_severity_outcomes_found"))).alias(f"{name}_yield")
    yields = policies_at_k(df, {"a": score_a, "b": score_b}, capacities, *ties).groupBy("capacity").agg(hits("a"), hits("b"))
    k, a, b = F.col("capacity"), F.col("a_yield"), F.col("b_yield")
    expected = k * F.col("_t.positives") / F.col("_t.n")
    return (
        yields.withColumn("_t", _totals(df).scalar())
        .select(
            "capacity",
            expected.alias("random_expected_yield"),
            "a_yield",
            "b_yield",
            (a / k).alias("a_precision"),
            (b / k).alias("b_precision"),
            (b - a).alias("b_incremental_yield"),
            F.try_divide(a, expected).alias("a_lift_vs_random"),
            F.try_divide(b, expected).alias("b_lift_vs_random"),
            (F.try_divide(b, a) - 1).alias("b_relative_improvement"),
        )
    )


def priority_queue(scored: DataFrame, capacity: int, score: str = "calibrated_high_severity_probability") -> DataFrame:
    """Top-k queue with ranks; refused if there are fewer than k entities."""
    queue = ranked_top(scored, score, capacity, rank="priority_rank")
    size = scored.limit(capacity).count()
    if size < capacity:
        raise ValueError(f"A queue of {capacity} needs more entities than the {size} there are.")
    return queue


def filter_population(df: DataFrame, boroughs: Sequence[str] = (), cuisines: Sequence[str] = ()) -> DataFrame:
    """Both lists must match; an empty list does not restrict."""
    if boroughs:
        df = df.where(F.col("borough").isin(*boroughs))
    if cuisines:
        df = df.where(F.col("cuisine_description").isin(*cuisines))
    return df


def filtered_queue(scored: DataFrame, capacity: int, boroughs: Sequence[str] = (), cuisines: Sequence[str] = ()) -> DataFrame:
    """The best-ranked rows of a filtered population; the ranks stay global."""
    check_capacity(capacity)
    return filter_population(scored, boroughs, cuisines).orderBy("priority_rank").limit(capacity)


def search_entities(scored: DataFrame, query: str, results: int | None = None) -> DataFrame:
    """Case-insensitive literal match on name or id, best ranks first; all of them unless `results` is given."""
    needle = query.strip().lower()
    if not needle:
        raise ValueError("The search text is blank.")

    def has(c: str) -> Column:
        return F.contains(F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit(needle))

    found = scored.where(has("restaurant_name") | has("camis")).orderBy("priority_rank")
    return found if results is None else found.limit(results)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).dropna().distinct().orderBy(column)
