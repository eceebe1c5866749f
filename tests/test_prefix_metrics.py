import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics, ranking
from tidemark.operators.baselines import smoothed_risk
from tidemark.operators.prefix import global_rank
from tidemark.operators.selection import exact_quantiles


def frame(spark, n=400, seed=1, hot=0.4):
    """Scores in which one value holds a large share of the rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        p = 0.25 if rng.random() < hot else round(rng.random(), 3)
        rows.append((f"{i:05d}", p, int(rng.random() < p), rng.choice(["0", "1", None])))
    return rows, spark.createDataFrame(rows, "camis string, p double, target_high_severity int, seg string")


def auc(pairs):
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def average_precision(pairs):
    total, found, seen, ap = sum(y for _, y in pairs), 0, 0, 0.0
    for t in sorted({s for s, _ in pairs}, reverse=True):
        here = [y for s, y in pairs if s == t]
        found, seen = found + sum(here), seen + len(here)
        ap += sum(here) / total * found / seen
    return ap


def test_ranking_metrics_equal_definitions(spark):
    rows, df = frame(spark)
    got = metrics.ranking_metrics(df, "p").first()
    pairs = [(p, y) for _, p, y, _ in rows]
    assert got["average_precision"] == pytest.approx(average_precision(pairs))
    assert got["roc_auc"] == pytest.approx(auc(pairs))
    assert got["brier_score"] == pytest.approx(np.mean([(p - y) ** 2 for p, y in pairs]))


def test_segment_metrics_with_null_segment(spark):
    rows, df = frame(spark, 300, 2)
    got = {r["seg"]: r for r in metrics.ranking_metrics(df, "p", ["seg"]).collect()}
    for seg in ("0", "1", None):
        pairs = [(p, y) for _, p, y, s in rows if s == seg]
        assert got[seg]["n"] == len(pairs)
        assert got[seg]["roc_auc"] == pytest.approx(auc(pairs))


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([("1", 0.2, 1), ("2", 0.3, 1)], "camis string, p double, target_high_severity int")
    assert metrics.ranking_metrics(df, "p").first()["roc_auc"] is None


def test_exact_quantiles_equal_numpy(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.choice([None, 1.0, 1.0, rng.random(), 7.5]), float(rng.randrange(4))) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    points = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = {
        (r["g"], r["column_name"], r["probability"]): r["value"]
        for r in exact_quantiles(df, ["x", "y"], points, ["g"]).collect()
    }
    for g in "ab":
        for name, at in (("x", 1), ("y", 2)):
            values = [r[at] for r in rows if r[0] == g and r[at] is not None]
            for p in points:
                assert got[(g, name, p)] == pytest.approx(np.quantile(values, p))


def test_global_rank_is_total_under_ties(spark):
    rows, df = frame(spark, 500, 3, hot=0.7)
    got = [r["camis"] for r in global_rank(df, F.desc("p"), F.asc("camis")).orderBy("priority_rank").collect()]
    ranks = sorted(r["priority_rank"] for r in global_rank(df, F.desc("p"), F.asc("camis")).collect())
    assert got == [r[0] for r in sorted(rows, key=lambda r: (-r[1], r[0]))]
    assert ranks == list(range(1, 501))


@pytest.mark.parametrize("capacity", [1, 50, 150, 250])
@pytest.mark.parametrize("ascending", [False, True])
def test_one_plan_ranks_any_capacity(spark, capacity, ascending):
    rows, df = frame(spark, 200, 4)
    df = df.unionByName(spark.createDataFrame([("99999", None, 0, "0")], df.schema))
    best = [r[0] for r in sorted(rows, key=lambda r: (r[1] if ascending else -r[1], r[0]))] + ["99999"]
    ranked = ranking.ranked_top(df, "p", capacity, ascending=ascending)
    got = ranked.orderBy("rank").collect()
    assert [r["camis"] for r in got] == best[:capacity]
    assert [r["rank"] for r in got] == list(range(1, min(capacity, 201) + 1))


@pytest.mark.parametrize("capacity", [1, 90, 1001, 1500, 2200, 5000])
def test_groups_are_ranked_at_any_capacity(spark, capacity):
    """Two policies over 2,000 rows: beyond Spark's own pruning, above half the table, above all of it."""
    rows, df = frame(spark, 2000, 7)
    extra = [("zz1", None, 0, "1"), ("zz2", None, 1, None), ("aa0", float("nan"), 1, "1")]
    df = df.unionByName(spark.createDataFrame(extra, df.schema)).withColumn("n", -F.col("p"))
    scores = {"up": "p", "down": "n"}
    got = ranking._by_policy(df, scores, capacity, keep=["camis"]).collect()
    everything = rows + extra
    nan_first = lambda p: (p is None, not (p != p) if p is not None else True, -p if p == p and p is not None else 0)
    for policy, sign in (("up", 1), ("down", -1)):
        best = sorted(everything, key=lambda r: (*nan_first(None if r[1] is None else sign * r[1]), r[0]))
        mine = sorted((r for r in got if r["policy"] == policy), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, min(capacity, len(everything)) + 1))
        assert [r["camis"] for r in mine] == [r[0] for r in best[:capacity]]


def test_the_cut_leaves_little_and_no_window_over_a_policy(spark):
    df = spark.range(300_000).selectExpr("cast(id AS string) AS camis", "pmod(id * 7919, 300007) / 300007D AS p", "1 AS target_high_severity")
    assert 1001 <= ranking._near_top(df, "p", 1001).count() < 3000
    plan = ranking._by_policy(df, {"a": "p", "b": "p"}, 1001)._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan
    small = ranking._by_policy(df, {"a": "p", "b": "p"}, 100)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in small


def test_nan_scores_take_no_part_in_bins_and_cells(spark):
    rows, df = frame(spark, 50, 3)
    more = df.unionByName(spark.createDataFrame([("a", None, 1, "0"), ("b", float("nan"), 1, "0")], df.schema))
    for report in (metrics.calibration_curve, metrics.confusion_counts, metrics.high_confidence_errors):
        assert sorted(map(tuple, report(more, "p").collect()), key=str) == sorted(map(tuple, report(df, "p").collect()), key=str)
    assert metrics.worst_errors(more, "p", "false_positive", 100).count() == metrics.worst_errors(df, "p", "false_positive", 100).count()
    kinds = {r["camis"]: r["error_type"] for r in metrics.error_types(more, "p").collect()}
    assert kinds["a"] == kinds["b"] == "Unknown"


def test_rows_without_a_score_take_no_part(spark):
    rows, df = frame(spark, 200, 8)
    more = spark.createDataFrame([("a", None, 1, "0"), ("b", float("nan"), 1, "0")], df.schema)
    with_them, without = (metrics.ranking_metrics(d, "p").first().asDict() for d in (df.unionByName(more), df))
    # Two more rows change the order in which doubles are added.
    assert with_them == pytest.approx(without, rel=1e-12)
    assert all(with_them[c] == without[c] for c, x in without.items() if isinstance(x, int))


def test_plan_size_does_not_grow_with_partitions(spark):
    _, df = frame(spark, 50, 2)
    before, sizes = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("4", "300"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            sizes.append(len(exact_quantiles(df, ["p"], [0.5])._jdf.queryExecution().optimizedPlan().toString()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert abs(sizes[0] - sizes[1]) < 200


def test_policy_at_k(spark):
    rows, df = frame(spark, 120, 6)
    got = {r["capacity"]: r for r in ranking.policy_at_k(df, "p", "x", [10, 500]).collect()}
    best = sorted(rows, key=lambda r: (-r[1], r[0]))
    total = sum(r[2] for r in rows)
    assert got[10]["high_severity_outcomes_found"] == sum(r[2] for r in best[:10])
    assert got[10]["recall_at_k"] == pytest.approx(sum(r[2] for r in best[:10]) / total)
    assert got[500]["selected_examples"] == 120
    assert got[500]["lift_vs_random"] == pytest.approx(1.0)


def test_no_positives_has_no_lift(spark):
    df = spark.createDataFrame([("1", 0.2, 0), ("2", 0.3, 0)], "camis string, p double, target_high_severity int")
    row = ranking.policy_at_k(df, "p", "x", [1]).first()
    assert row["lift_vs_random"] is None and row["recall_at_k"] is None


def test_bad_arguments(spark):
    _, df = frame(spark, 5)
    with pytest.raises(ValueError):
        ranking.top_k(df, "p", 0)
    with pytest.raises(ValueError):
        ranking.top_k(df, "nope", 3)
    with pytest.raises(ValueError):
        ranking.priority_queue(df, 6, "p")
    with pytest.raises(ValueError):
        ranking.search_entities(df, "  ")
    with pytest.raises(ValueError):
        smoothed_risk(df, df, 0.0)


def test_smoothed_risk(spark):
    train = spark.createDataFrame(
        [("1", 1), ("1", 1), ("2", 0), ("3", 1)], "camis string, target_high_severity int"
    )
    data = spark.createDataFrame([("1",), ("2",), ("9",)], "camis string")
    got = {r["camis"]: r["s"] for r in smoothed_risk(train, data, 5.0, "s").collect()}
    assert got == pytest.approx({"1": (2 + 5 * 0.75) / 7, "2": (0 + 5 * 0.75) / 6, "9": 0.75})


def test_calibration_bins_are_right_closed(spark):
    rows = [(str(i), p, 1) for i, p in enumerate([0.0, 0.1, 0.10001, 0.3, 0.30000000000000004, 0.31, 1.0])]
    df = spark.createDataFrame(rows, "camis string, p double, target_high_severity int")
    got = {r["bin"]: r["n"] for r in metrics.calibration_curve(df, "p").collect()}
    edges = np.linspace(0.0, 1.0, 11)[1:-1]
    expected = {}
    for _, p, _ in rows:
        b = int(np.searchsorted(edges, p))
        expected[b] = expected.get(b, 0) + 1
    assert got == expected
