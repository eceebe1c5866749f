import datetime as dt
import json
import os
import random

import numpy as np
import pytest
from helpers import AGAIN, INITIAL, raw_rows
from pyspark.sql import functions as F

from tidemark.model.calibration import PlattCurve, fit_sigmoid
from tidemark.model.features import (
    CATEGORICAL_FEATURES,
    MODEL_FEATURES,
    NUMERIC_FEATURES,
    check_target,
    check_training_schema,
    feature_matrix,
    fit_preprocessor,
    training_matrix,
)
from tidemark.model.logistic import add_scores, fit_logistic
from tidemark.model.store import UnusableModel, StoredModel, load_artifacts, save_artifacts
from tidemark.operators.quality import ThresholdBreached
from tidemark.operators.splits import assign_split, split_violations, validate_splits
from tidemark.plans import jobs
from tidemark.policy import SplitBounds

P = "calibrated_high_severity_probability"


def training_rows(n=240, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        numbers = [float(rng.randrange(6)) for _ in NUMERIC_FEATURES]
        if i % 7 == 0:
            numbers[-1] = None
        cats = [rng.choice(["Bronx", "Queens", None]), rng.choice(["Thai", "Pizza"]), rng.choice(["0", "1", "2-3"])]
        y = int(rng.random() < 1 / (1 + np.exp(-(numbers[0] - 2.5))))
        rows.append((*numbers, *cats, y))
    return rows


def as_frame(spark, rows):
    kinds = [f"{c} double" for c in NUMERIC_FEATURES] + [f"{c} string" for c in CATEGORICAL_FEATURES]
    return spark.createDataFrame(rows, ", ".join([*kinds, "target_high_severity int"]))


@pytest.fixture(scope="module")
def train(spark):
    return as_frame(spark, training_rows())


@pytest.fixture(scope="module")
def model(train):
    return fit_logistic(train, c=1.0)


def newton(x, y, c, steps=50):
    """Minimise c * log-loss sum + |w|^2 / 2 with a free intercept."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.diag([1.0] * x.shape[1] + [0.0])
    w = np.zeros(x1.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x1 @ w))
        w -= np.linalg.solve(c * (x1 * (p * (1 - p))[:, None]).T @ x1 + ridge, c * x1.T @ (p - y) + ridge @ w)
    return w


def test_fit_equals_independent_solution(train, model):
    ready = model.transform(train).select("features", "target_high_severity").collect()
    x = np.array([r["features"].toArray() for r in ready])
    y = np.array([r["target_high_severity"] for r in ready])
    w = newton(x, y, 1.0)
    fitted = model.stages[-1]
    assert np.allclose([*fitted.coefficients.toArray(), fitted.intercept], w, atol=1e-4)


def test_numeric_columns_are_imputed_flagged_and_scaled(train):
    ready = fit_preprocessor(train).transform(train)
    values = np.array([r[0] for r in ready.select(f"num_{NUMERIC_FEATURES[-1]}").collect()])
    flags = np.array([r[0] for r in ready.select(f"null_{NUMERIC_FEATURES[-1]}").collect()])
    raw = [r[0] for r in train.select(NUMERIC_FEATURES[-1]).collect()]
    filled = np.array([np.median([v for v in raw if v is not None]) if v is None else v for v in raw])
    assert np.allclose(values, (filled - filled.mean()) / filled.std())
    absent = np.array([float(v is None) for v in raw])
    assert np.allclose(flags, (absent - absent.mean()) / absent.std())
    assert f"null_{NUMERIC_FEATURES[0]}" not in ready.columns


def test_unseen_category_is_all_zero(spark, train):
    prepare = fit_preprocessor(train)
    row = training_rows(1)[0]
    odd = as_frame(spark, [(*row[: len(NUMERIC_FEATURES)], "Mars", None, "1", 0)])
    hot = prepare.transform(odd).first()
    assert hot["hot_borough"].numNonzeros() == 0 and hot["hot_history_depth_bucket"].numNonzeros() == 1


def test_contracts(spark, train):
    with pytest.raises(ValueError, match="absent"):
        check_training_schema(train.drop(NUMERIC_FEATURES[0]))
    with pytest.raises(ValueError, match="outcomes among"):
        check_training_schema(train.withColumn("target_score", F.lit(1)))
    with pytest.raises(ValueError, match="target_high_severity"):
        check_training_schema(train.drop("target_high_severity"))
    with pytest.raises(ValueError, match="other than 0 and 1"):
        check_target(train.withColumn("target_high_severity", F.lit(None).cast("int")))
    with pytest.raises(ValueError, match="other than 0 and 1"):
        check_target(train.withColumn("target_high_severity", F.lit(2)))
    with pytest.raises(ValueError, match="positive"):
        fit_logistic(train, c=0.0)
    assert feature_matrix(train).columns == list(MODEL_FEATURES)


def test_calibration_keeps_the_order(train, model):
    scored = add_scores(model, train, "p", "m")
    fitted = fit_sigmoid(scored.select("m", "target_high_severity"), "m")
    assert fitted.slope > 0
    rows = scored.withColumn("q", fitted.column(F.col("m"))).orderBy("p").collect()
    assert all(0 <= r["q"] <= 1 for r in rows)
    assert [r["q"] for r in rows] == sorted(r["q"] for r in rows)
    with pytest.raises(TypeError):
        PlattCurve()


def test_store_round_trip(spark, train, model, tmp_path):
    path = str(tmp_path / "model")
    save_artifacts(spark, StoredModel(model, PlattCurve(0.9, -0.1)), path)
    back = load_artifacts(spark, path)
    assert back.feature_names == MODEL_FEATURES and back.calibrator == PlattCurve(0.9, -0.1)
    a = [r[0] for r in add_scores(model, train, "p").select("p").collect()]
    b = [r[0] for r in add_scores(back.model, train, "p").select("p").collect()]
    assert a == b
    with pytest.raises(UnusableModel):
        load_artifacts(spark, str(tmp_path / "absent"))


def population(spark, train, n):
    return train.drop("target_high_severity").limit(n).withColumn(
        "camis", F.row_number().over(__import__("pyspark.sql", fromlist=["Window"]).Window.orderBy(F.lit(1))).cast("string")
    )


def test_scoring_ranks_and_errors(spark, train, model):
    artifacts = StoredModel(model, PlattCurve(1.0, 0.0))
    people = population(spark, train, 5)
    scored, queue = jobs.score_population(people, artifacts, 3)
    rows = scored.orderBy("priority_rank").collect()
    assert [r["priority_rank"] for r in rows] == [1, 2, 3, 4, 5]
    assert [r[P] for r in rows] == sorted((r[P] for r in rows), reverse=True)
    assert queue.count() == 3 and "restaurant_name" not in scored.columns
    for capacity in (0, 6):
        with pytest.raises(ValueError, match="[Cc]apacity"):
            jobs.score_population(people, artifacts, capacity)
    with pytest.raises(ValueError, match="other features"):
        jobs.score_population(people, StoredModel(model, PlattCurve(1.0, 0.0), ("other",)), 3)


def test_split_rules(spark):
    rows = [("2022-05-01", 1), ("2024-05-01", 1), ("2025-05-01", 0), ("2030-01-01", 1)]
    df = spark.createDataFrame([(dt.date.fromisoformat(d), y) for d, y in rows], "cutoff_date date, target_high_severity int")
    parted = assign_split(df)
    assert [r["split"] for r in parted.orderBy("cutoff_date").collect()] == ["train", "validation", "test", None]
    assert [tuple(r) for r in split_violations(parted).collect()] == [("test", "no positive examples")]
    with pytest.raises(ValueError, match="no positive"):
        validate_splits(parted)


def feed(entities=40, seed=9):
    rng = random.Random(seed)
    rows = []
    for e in range(entities):
        day = dt.date(2021, 6, 1)
        bad = e % 3 == 0
        while day < dt.date(2026, 6, 1):
            kind = INITIAL if rng.random() < 0.7 else AGAIN
            for v in range(rng.randrange(3, 6) if bad and rng.random() < 0.8 else rng.randrange(1, 4)):
                rows.append(
                    {
                        "CAMIS": str(1000 + e), "DBA": f"Place {e}", "BORO": rng.choice(["Bronx", "Queens"]) if e % 5 else "Bronx",
                        "CUISINE DESCRIPTION": ["Thai", "Pizza", "Deli"][e % 3], "INSPECTION DATE": day.strftime("%m/%d/%Y"),
                        "VIOLATION CODE": f"0{v}", "CRITICAL FLAG": "Critical" if bad or rng.random() < 0.4 else "Not Critical",
                        "SCORE": str(rng.randrange(5, 40)), "RECORD DATE": "06/02/2026", "INSPECTION TYPE": kind,
                        "Location": "POINT (0 0)",
                    }
                )
            day += dt.timedelta(days=rng.randrange(60, 200))
    return rows


def test_train_then_batch_end_to_end(spark, tmp_path):
    root, landing, model_path = (str(tmp_path / n) for n in ("run", "landing", "model"))
    raw_rows(spark, feed()).write.option("header", True).csv(landing)
    tables = jobs.run_transformations(spark.read.schema(_raw_schema()).option("header", True).csv(landing), root + "/first")
    modeling = tables["features"].join(
        tables["labels"].select("cutoff_inspection_id", "target_inspection_date", "days_to_target", "target_high_severity"),
        "cutoff_inspection_id",
    )
    training = jobs.train(modeling, SplitBounds(), (0.1, 1.0), capacities=(5, 10))
    assert {r["c"] for r in training.selection.collect()} == {"0.1", "1.0"}
    assert {r["model"] for r in training.test_metrics.collect()} == {
        "smoothed_historical_risk", "logistic_regression", "calibrated_logistic",
    }
    jobs.save_training(spark, training, model_path)

    result = jobs.run_batch(spark, landing, root, model_path, 7, run_id="r1", gate=True)
    assert result.queue.count() == 7
    assert [r["priority_rank"] for r in result.queue.collect()] == list(range(1, 8))
    latest = spark.read.option("header", True).csv(f"{root}/latest/priority_queue")
    assert latest.count() == 7
    record = json.loads(open(_part(f"{root}/runs/r1")).read())
    assert record["status"] == "SUCCESS" and record["population_size"] == 40
    assert record["top_rank_probability"] == record["prediction_max"]
    assert abs(sum(record["history_depth_distribution"].values()) - 1) < 1e-9
    checks = {r["check_name"]: r["status"] for r in spark.read.parquet(f"{root}/checks").collect()}
    assert len(checks) == 32 and "FAIL" not in checks.values()

    queue, size = jobs.priority_queue_at(spark, root + "/stages", model_path, 3)
    assert size == 40 and queue.count() == 3

    # A second run replaces nothing of the first.
    jobs.run_batch(spark, landing, root, model_path, 2, run_id="r2")
    kept = spark.read.parquet(f"{root}/predictions").groupBy("run_id").count().collect()
    assert {r["run_id"]: r["count"] for r in kept} == {"r1": 40, "r2": 40}
    # The second run measures its row count against the first.
    rates = {r["rate_name"]: r["rate"] for r in spark.read.parquet(f"{root}/rates").where("run_id = 'r2'").collect()}
    assert rates["source_row_count_change_rate"] == 0.0


def test_pipeline_and_scoring_jobs_leave_records_of_one_shape(spark, tmp_path):
    root, landing = str(tmp_path / "run"), str(tmp_path / "landing")
    raw_rows(spark, feed(6)).write.option("header", True).csv(landing)
    tables = jobs.run_pipeline(spark, landing, root, run_id="p1")
    assert tables["scoring_population"].count() == 6
    with pytest.raises(UnusableModel):
        jobs.run_scoring(spark, root + "/stages", root, str(tmp_path / "no-model"), 2, run_id="s1")
    records = {r: json.loads(open(_part(f"{root}/runs/{r}")).read()) for r in ("p1", "s1")}
    assert records["p1"].keys() == records["s1"].keys()
    assert records["p1"]["status"] == "SUCCESS" and records["p1"]["kind"] == "pipeline" and records["p1"]["error"] is None
    assert records["p1"]["source_row_count"] == tables["raw_inspection"].count()
    assert records["s1"]["status"] == "FAILED" and "no-model" in records["s1"]["error"]
    assert jobs.previous_row_count(spark, root) == records["p1"]["source_row_count"]
    assert jobs.previous_row_count(spark, str(tmp_path / "none")) is None


def test_gate_and_failed_record(spark, tmp_path):
    root, landing = str(tmp_path / "run"), str(tmp_path / "landing")
    rows = feed(4)
    rows[0]["CRITICAL FLAG"] = "weird"
    raw_rows(spark, rows).write.option("header", True).csv(landing)
    with pytest.raises(ThresholdBreached, match="unexpected_critical_flag_rate"):
        jobs.run_batch(spark, landing, root, "unused", 1, gate=True, run_id="bad")
    assert json.loads(open(_part(f"{root}/runs/bad")).read())["status"] == "FAILED"
    with pytest.raises(ValueError):
        jobs.run_batch(spark, landing, root, "unused", 0)


def _raw_schema():
    from tidemark.sources.raw_log import RAW_SCHEMA

    return RAW_SCHEMA


def _part(folder):
    return next(os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".json"))


def test_training_matrix_drops_outcomes(spark, train):
    wide = train.withColumn("target_score", F.lit(1))
    assert training_matrix(wide).columns == ["target_high_severity", *MODEL_FEATURES]
