import pytest
from pyspark.sql import functions as F

from tidemark.functions import bin_label, percent_text, risk_tier
from tidemark.operators.profile import category_share_map, monitoring_metrics, target_rate_by_horizon
from tidemark.operators.ranking import filtered_queue, search_entities
from tidemark.sources.tables import read_scores, usable_scores

P = "calibrated_high_severity_probability"


@pytest.fixture
def batch(spark):
    return spark.createDataFrame(
        [(1, 0.10, 4, "0"), (2, 0.60, 3, "1"), (3, 0.80, 2, "2-3"), (4, 0.90, 1, "4+")],
        f"camis bigint, {P} double, priority_rank bigint, history_depth_bucket string",
    )


def test_batch_distribution(batch):
    row = monitoring_metrics(batch).first()
    assert (row["prediction_count"], row["unique_restaurants"]) == (4, 4)
    assert row["prediction_mean"] == pytest.approx(0.60)
    assert row["prediction_median"] == pytest.approx(0.70)
    assert (row["prediction_min"], row["prediction_max"]) == (0.10, 0.90)
    assert (row["high_risk_rate_0_50"], row["high_risk_rate_0_75"]) == (0.75, 0.50)
    assert row["top_rank_probability"] == 0.90
    assert category_share_map(batch).first()[0] == {"0": 0.25, "1": 0.25, "2-3": 0.25, "4+": 0.25}


def test_empty_batch(batch):
    row = monitoring_metrics(batch.where("camis < 0")).first()
    assert row["prediction_count"] == 0
    assert all(row[c] is None for c in ("prediction_mean", "prediction_median", "top_rank_probability"))


def test_missing_probability_is_refused(spark, batch, tmp_path):
    path = str(tmp_path / "scores")
    batch.drop(P).write.option("header", True).csv(path)
    with pytest.raises(ValueError, match=P):
        read_scores(spark, path)


def test_unusable_scores_are_dropped(spark):
    df = spark.createDataFrame(
        [("1", "2", "0.5"), ("2", "x", "0.4"), ("3", "1", None), ("4", "1", "0.9")],
        f"camis string, priority_rank string, {P} string",
    )
    assert [(r["camis"], r["priority_rank"]) for r in usable_scores(df).collect()] == [("4", 1), ("1", 2)]


def test_search_and_filter(spark):
    df = spark.createDataFrame(
        [("30", "Joe's 50% Grill", "Queens", "Pizza", 2), ("77", None, "Bronx", "Thai", 1), ("5", "JOE'S", "Bronx", "Pizza", 3)],
        "camis string, restaurant_name string, borough string, cuisine_description string, priority_rank int",
    )
    assert [r["camis"] for r in search_entities(df, "joe'S").collect()] == ["30", "5"]
    assert [r["camis"] for r in search_entities(df, "50%").collect()] == ["30"]
    assert [r["camis"] for r in search_entities(df, "7").collect()] == ["77"]
    assert [r["camis"] for r in filtered_queue(df, 5, ["Bronx"]).collect()] == ["77", "5"]
    assert [r["camis"] for r in filtered_queue(df, 5, ["Bronx"], ["Pizza"]).collect()] == ["5"]


def test_display_forms(spark):
    df = spark.createDataFrame([(0.7,), (0.4,), (0.39,), (None,)], "p double")
    got = [tuple(r) for r in df.select(risk_tier(F.col("p")), percent_text(F.col("p"))).collect()]
    assert got == [("risk-high", "70.0%"), ("risk-medium", "40.0%"), ("risk-low", "39.0%"), ("risk-low", "—")]


def test_bins(spark):
    df = spark.createDataFrame([(0,), (1,), (90,), (91,), (10_000,), (None,)], "d int")
    label = bin_label(F.col("d"), (0, 90, float("inf")), ("low", "high"))
    assert [r[0] for r in df.select(label).collect()] == [None, "low", "low", "high", "high", None]


def test_empty_bins_are_reported(spark):
    df = spark.createDataFrame([(10, 1), (20, 0)], "days_to_target bigint, target_high_severity int")
    got = {r["horizon_bucket"]: r["examples"] for r in target_rate_by_horizon(df).collect()}
    assert len(got) == 5 and sum(got.values()) == 2
