"""Preprocessing, fitting, calibration and batch scoring.

Fitted numbers have no SQL form; the preprocessing statistics and encodings do.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from contract.oracle_tables import over_stages
from contract.queries import register
from contract.ranking_queries import IDS, train_of
from contract.raw_view import BOUNDS
from contract.stages import Stages
from tidemark.model.calibration import add_calibrated, fit_calibrator
from tidemark.model.features import (
    CATEGORICAL_FEATURES,
    NUMERIC_FEATURES,
    fit_preprocessor,
    numeric_statistics,
    training_matrix,
)
from tidemark.model.logistic import add_scores, fit_logistic
from tidemark.model.store import StoredModel, load_artifacts, save_artifacts
from tidemark.operators.normalize import normalize_rows
from tidemark.operators.splits import take_split
from tidemark.plans import jobs
from tidemark.policy import INVERSE_REGULARISATIONS
from tidemark.sources.raw_log import landing_count, read_raw_csv
from tidemark.sources.tables import shared_folder


def _statistics_sql() -> str:
    parts = []
    for c in NUMERIC_FEATURES:
        parts.append(
            f"SELECT '{c}' AS column_name, round(any_value(m), 6) AS median, count(*) FILTER ({c} IS NULL) AS null_count,"
            f" round(avg(coalesce({c}, m)), 6) AS mean, round(stddev_pop(coalesce({c}, m)), 6) AS deviation,"
            f" round(avg(({c} IS NULL)::INT), 6) AS null_mean, round(stddev_pop(({c} IS NULL)::INT), 6) AS null_deviation"
            f" FROM (SELECT CAST({c} AS DOUBLE) AS {c} FROM parted WHERE split = 'train'),"
            f" (SELECT CAST(median({c}) AS DOUBLE) AS m FROM parted WHERE split = 'train')"
        )
    return " UNION ALL ".join(parts)


@register("numeric_statistics", over_stages(_statistics_sql()))
def _(s):
    return numeric_statistics(train_of(s))


@register(
    "one_hot_counts",
    over_stages(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, coalesce({c}, 'Missing') AS category, count(*) AS n FROM parted"
            f" WHERE split = 'test' AND coalesce({c}, 'Missing') IN (SELECT coalesce({c}, 'Missing') FROM parted WHERE split = 'train')"
            " GROUP BY 2"
            for c in CATEGORICAL_FEATURES
        )
    ),
)
def _(s):
    """Rows of the test period per encoded slot, after fitting on train."""
    prepare = fit_preprocessor(training_matrix(train_of(s)))
    ready = prepare.transform(take_split(s.parted, "test"))
    counted = None
    for c, labels in zip(CATEGORICAL_FEATURES, prepare.stages[1].labelsArray):
        slots = ready.select(F.posexplode(vector_to_array(f"hot_{c}")).alias("slot", "on")).where("on = 1")
        names = F.array(*[F.lit(v) for v in labels])
        part = (
            slots.groupBy("slot")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(c).alias("column_name"), F.element_at(names, F.col("slot") + 1).alias("category"), "n")
        )
        counted = part if counted is None else counted.unionByName(part)
    return counted


def _fitted(s: Stages) -> StoredModel:
    model = fit_logistic(training_matrix(train_of(s)))
    return StoredModel(model, fit_calibrator(model, take_split(s.parted, "validation")))


@register("logistic_scores")
def _(s):
    model = fit_logistic(training_matrix(train_of(s)))
    return add_scores(model, take_split(s.parted, "test")).select(*IDS, "raw_logistic_probability")


@register("calibrated_scores")
def _(s):
    found = _fitted(s)
    return add_calibrated(found.model, found.calibrator, take_split(s.parted, "test")).select(
        *IDS, "raw_logistic_probability", "calibrated_high_severity_probability"
    )


@register("regularisation_grid")
def _(s):
    return jobs.train(s.modeling, BOUNDS, INVERSE_REGULARISATIONS).selection


@register("training_report")
def _(s):
    return jobs.train(s.modeling, BOUNDS).test_metrics


@register("training_policies")
def _(s):
    return jobs.train(s.modeling, BOUNDS).test_policies


@register("batch_scoring")
def _(s):
    """Train, store, load back, score the current population, cut the queue."""
    path = f"{shared_folder(s.spark)}/tidemark-{s.spark.sparkContext.applicationId}-model"
    save_artifacts(s.spark, _fitted(s), path)
    _, queue = jobs.score_population(s.scoring, load_artifacts(s.spark, path), 100)
    return queue


#: Rows of a landed file at most; a compressed file is read by one task.
LANDED_ROWS = 100_000


def _landed(s: Stages):
    """The feed as compressed CSV files of bounded size."""
    path = f"{shared_folder(s.spark)}/tidemark-{s.spark.sparkContext.applicationId}-landing"
    (
        s.raw.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", LANDED_ROWS)
        .csv(path)
    )
    return read_raw_csv(s.spark, path)


@register("csv_landing_count", over_stages("SELECT count(*) AS raw_row_count FROM raw"))
def _(s):
    return landing_count(_landed(s))


@register(
    "csv_round_trip",
    over_stages("SELECT * REPLACE (round(latitude, 6) AS latitude, round(longitude, 6) AS longitude) FROM norm"),
)
def _(s):
    return normalize_rows(_landed(s))


@register(
    "population_status",
    over_stages("SELECT count(*) AS population_size, max(cutoff_date) AS scoring_date FROM scoring"),
)
def _(s):
    return jobs.population_status(s.scoring)


def _gradient(scored, weights: list[float], penalty: float, place: str):
    """Slope of the penalised loss per coefficient, over the rows; zero at the optimum."""
    error = F.col("_p") - F.col("target_high_severity")
    summed = scored.select(F.posexplode(F.transform(place, lambda x: x * error)).alias("slot", "part")).groupBy("slot").agg(
        F.sum("part").alias("slope"), F.count(F.lit(1)).alias("n")
    )
    own = F.array(*[F.lit(w) for w in weights])
    slope = (F.col("slope") + penalty * F.get(own, F.col("slot"))) / F.col("n")
    # Adding zero turns a negative zero into zero.
    return summed.select("slot", (F.round(slope, 4) + 0.0).alias("gradient"))


_SLOTS = " + ".join(
    [f"(SELECT 1 + (count(*) > count({c}))::INT FROM parted WHERE split = 'train')" for c in NUMERIC_FEATURES]
    + [f"(SELECT count(DISTINCT coalesce({c}, 'Missing')) FROM parted WHERE split = 'train')" for c in CATEGORICAL_FEATURES]
)


@register("logistic_gradient", over_stages(f"SELECT CAST(unnest(range(CAST({_SLOTS} AS BIGINT))) AS INT) AS slot, CAST(0 AS DOUBLE) AS gradient"))
def _(s):
    """The fitted coefficients are at the minimum of the penalised loss over the training rows."""
    rows = training_matrix(train_of(s))
    model = fit_logistic(rows)
    scored = model.transform(rows).select(
        "target_high_severity", vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("_p")
    )
    return _gradient(scored, [float(w) for w in model.stages[-1].coefficients], 1.0, "x")


@register("calibration_gradient", over_stages("SELECT CAST(unnest(range(2)) AS INT) AS slot, CAST(0 AS DOUBLE) AS gradient"))
def _(s):
    """Slope and intercept of the calibration are at the minimum over the validation rows; the intercept is free of penalty."""
    found = _fitted(s)
    margins = add_scores(found.model, take_split(s.parted, "validation"), probability=None, margin="_m")
    scored = margins.select("target_high_severity", F.array("_m", F.lit(1.0)).alias("x"), found.calibrator.column(F.col("_m")).alias("_p"))
    return _gradient(scored, [found.calibrator.slope, 0.0], 1.0, "x")
