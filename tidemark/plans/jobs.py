"""User-level jobs: build the stage tables, validate, train, score."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.model.calibration import add_calibrated, fit_calibrator
from tidemark.model.features import feature_matrix, training_matrix
from tidemark.model.logistic import fit_logistic_grid
from tidemark.model.store import StoredModel, check_contract, load_artifacts, save_artifacts
from tidemark.operators import events, normalize, snapshots
from tidemark.operators.baselines import smoothed_risk
from tidemark.operators.metrics import ranking_metrics
from tidemark.operators.prefix import global_rank
from tidemark.operators.profile import category_share_map, monitoring_metrics
from tidemark.operators.quality import FACTS, Tables, enforce, quality_rates, run_suite
from tidemark.operators.ranking import capacity_sweep, check_capacity, priority_queue
from tidemark.operators.splits import TARGET, assign_split, take_split, validate_splits
from tidemark.policy import CAPACITIES, EventPolicy, SplitBounds
from tidemark.sources.raw_log import MALFORMED, RAW_COLUMNS, check_unbroken, open_quotes, read_raw_csv
from tidemark.sources.stage_store import StageStore
from tidemark.sources.tables import pin, read_stage, write_csv, write_json, write_run_artifact

CONTEXT_COLUMNS = (
    "camis", "restaurant_name", "borough", "cuisine_description", "cutoff_date", "history_depth_bucket",
)
CALIBRATED = "calibrated_high_severity_probability"

Stage = tuple[str, Callable[[dict[str, DataFrame]], DataFrame]]


def stage_list(policy: EventPolicy) -> list[Stage]:
    """Stages in dependency order.

    `snapshots` holds the one window pass; population, labels and features are
    projections of it, so no event is shuffled for them again.
    """
    return [
        ("normalized_inspection_rows", lambda t: normalize.normalize_rows(t["raw_inspection"])),
        ("deduplicated_inspection_rows", lambda t: normalize.deduplicate(t["normalized_inspection_rows"])),
        ("restaurants", lambda t: events.latest_entities(t["deduplicated_inspection_rows"])),
        ("inspections", lambda t: events.roll_up_events(t["deduplicated_inspection_rows"], policy)),
        ("violations", lambda t: events.violation_rows(t["deduplicated_inspection_rows"], policy)),
        ("violation_counts", lambda t: events.violation_counts(t["violations"])),
        ("snapshots", lambda t: snapshots.decision_snapshots(t["inspections"], policy)),
        ("prediction_population", lambda t: snapshots.population_of(t["snapshots"])),
        ("labels", lambda t: snapshots.labels_of(t["snapshots"])),
        ("features", lambda t: snapshots.features_of(t["snapshots"], t["restaurants"])),
        (
            "scoring_population",
            lambda t: snapshots.current_population(t["inspections"], t["restaurants"], policy),
        ),
    ]


#: Stages bucketed by entity, and whether their rows already lie so when they are written.  Rows
#: of details are not: one entity may have any number of them.
_BY_ENTITY = {
    "restaurants": True, "inspections": False, "violation_counts": False, "snapshots": True, "prediction_population": True,
    "labels": True, "features": True, "scoring_population": True,
}
#: Stage -> table of the quality checks, whose facts its write counts.
_CHECKED = {
    "normalized_inspection_rows": "rows", "deduplicated_inspection_rows": "unique", "restaurants": "entities", "inspections": "events",
    "violations": "violations", "prediction_population": "population", "labels": "labels", "features": "features",
}


def write_stages(raw: DataFrame, store: StageStore, policy: EventPolicy = EventPolicy()) -> dict[str, DataFrame]:
    """Write every stage table of a run, not yet published; the feed is read once and counted on the way."""
    spark, seen = raw.sparkSession, Observation()
    counts = {name: fact() for name, fact in FACTS["raw"].items()} | ({"open_quotes": open_quotes()} if MALFORMED in raw.columns else {})
    tables = {"raw_inspection": raw.observe(seen, *[fact.alias(name) for name, fact in counts.items()])}
    for name, build in stage_list(policy):
        facts = {n: fact() for n, fact in FACTS.get(_CHECKED.get(name), {}).items() if n != "rows"}
        key = "camis" if name in _BY_ENTITY else None
        tables[name] = store.write(name, build(tables), key, _BY_ENTITY.get(name, False), facts)
        if name == "normalized_inspection_rows":
            check_unbroken(seen.get.get("open_quotes", 0))
            store.note("raw_inspection", seen.get)
        if name == "deduplicated_inspection_rows":
            before, after = (store.facts(n)["rows"] for n in ("normalized_inspection_rows", name))
            audit = spark.range(1).select(
                F.lit(before).cast("bigint").alias("input_row_count"),
                F.lit(after).cast("bigint").alias("output_row_count"),
                F.lit(before - after).cast("bigint").alias("exact_duplicates_removed"),
            )
            tables["deduplication_audit"] = store.write("deduplication_audit", audit)
    return tables | {"raw_inspection": raw.select(*RAW_COLUMNS)}


def run_transformations(raw: DataFrame, root: str, policy: EventPolicy = EventPolicy()) -> dict[str, DataFrame]:
    """Write every stage table under `root`, publish them together and return them as read back."""
    store = StageStore(raw.sparkSession, root)
    tables = write_stages(raw, store, policy)
    store.publish()
    return tables


def stage_tables(spark: SparkSession, root: str, raw: DataFrame, policy: EventPolicy = EventPolicy()) -> dict[str, DataFrame]:
    """The stored stage tables."""
    names = ["deduplication_audit", *(name for name, _ in stage_list(policy))]
    return {"raw_inspection": raw} | {name: read_stage(spark, root, name) for name in names}


def stage_facts(store: StageStore) -> dict[str, dict[str, int]]:
    """The counts of the stored tables by the names the checks use."""
    return {"raw": store.facts("raw_inspection")} | {table: store.facts(name) for name, table in _CHECKED.items()}


def as_check_tables(
    tables: dict[str, DataFrame], previous_rows: int | None = None, facts: dict[str, dict[str, int]] | None = None
) -> Tables:
    return Tables(
        raw=tables["raw_inspection"],
        rows=tables["normalized_inspection_rows"],
        audit=tables["deduplication_audit"],
        entities=tables["restaurants"],
        events=tables["inspections"],
        violations=tables["violations"],
        population=tables["prediction_population"],
        labels=tables["labels"],
        features=tables["features"],
        scoring=tables["scoring_population"],
        previous_rows=previous_rows,
        violation_counts=tables.get("violation_counts"),
        facts=facts or {},
    )


def run_validations(
    tables: dict[str, DataFrame], gate: bool = False, previous_rows: int | None = None, facts: dict[str, dict[str, int]] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Check results and threshold rates; with `gate` a breached hard limit raises.

    Counts that `facts` holds are not taken again.
    """
    checked = as_check_tables(tables, previous_rows, facts)
    rates = pin(quality_rates(checked))
    if gate:
        enforce(rates)
    return run_suite(checked), rates


def _scored(population: DataFrame, artifacts: StoredModel) -> DataFrame:
    """Context columns, raw and calibrated probability of every entity."""
    keep = [c for c in CONTEXT_COLUMNS if c in population.columns]
    twice = [c for c in keep if c in ("borough", "cuisine_description", "history_depth_bucket")]
    matrix = feature_matrix(population, *[c for c in keep if c not in twice])
    return add_calibrated(artifacts.model, artifacts.calibrator, matrix).select(
        *keep, "raw_logistic_probability", CALIBRATED
    )


def score_population(
    population: DataFrame, artifacts: StoredModel, capacity: int
) -> tuple[DataFrame, DataFrame]:
    """All entities scored and ranked, and the queue of the best `capacity`."""
    check_capacity(capacity)
    check_contract(artifacts)
    scored = _scored(population, artifacts)
    ranked = global_rank(scored, F.desc_nulls_last(CALIBRATED), F.asc_nulls_last("camis"))
    queue = ranked.where(F.col("priority_rank") <= capacity).orderBy("priority_rank")
    # The ranked rows are pinned, so this count reads what is already there.
    size = ranked.count()
    if size < capacity:
        raise ValueError(f"Capacity {capacity} is more than the {size} entities to score.")
    return ranked, queue


def priority_queue_at(
    spark: SparkSession, root: str, model_path: str, capacity: int
) -> tuple[DataFrame, int]:
    """Queue and population size from the stored scoring population and model.

    Only the rows from the k-th score up are ranked.
    """
    population = read_stage(spark, root, "scoring_population")
    stored = load_artifacts(spark, model_path)
    check_contract(stored)
    return priority_queue(_scored(population, stored), capacity, CALIBRATED), population.count()


def population_status(population: DataFrame) -> DataFrame:
    """Size and scoring date of the current population."""
    return population.agg(
        F.count(F.lit(1)).alias("population_size"), F.max("cutoff_date").alias("scoring_date")
    )


@dataclass
class Training:
    artifacts: StoredModel
    selection: DataFrame
    test_scores: DataFrame
    test_metrics: DataFrame
    test_policies: DataFrame


def train(
    modeling: DataFrame,
    bounds: SplitBounds = SplitBounds(),
    candidates: Sequence[float] = (1.0,),
    chosen: float = 1.0,
    alpha: float = 5.0,
    capacities: Sequence[int] = CAPACITIES,
) -> Training:
    """Fit on train, compare candidates and calibrate on validation, evaluate on test."""
    parted = pin(assign_split(modeling, bounds).where(F.col("split").isNotNull()))
    validate_splits(parted)
    fit_on, held_out, test = (take_split(parted, name) for name in ("train", "validation", "test"))
    models = fit_logistic_grid(training_matrix(fit_on), tuple(sorted({*candidates, chosen})))
    selection = _selection(models, held_out)
    calibrator = fit_calibrator(models[chosen], held_out)
    artifacts = StoredModel(models[chosen], calibrator)
    scored = add_calibrated(models[chosen], calibrator, smoothed_risk(fit_on, test, alpha, "historical_risk"))
    scored = pin(scored)
    metrics = _stack(scored, {"smoothed_historical_risk": "historical_risk",
                              "logistic_regression": "raw_logistic_probability", "calibrated_logistic": CALIBRATED})
    policies = capacity_sweep(
        scored, {"smoothed_historical_risk": "historical_risk", "logistic_regression": CALIBRATED}, capacities,
        "camis", "cutoff_inspection_id",
    )
    return Training(artifacts, selection, scored, metrics, policies)


def _stack(df: DataFrame, scores: dict[str, str]) -> DataFrame:
    """Metrics of several score columns in one pass: scores as rows, model as segment."""
    cells = [F.struct(F.lit(name).alias("model"), F.col(c).cast("double").alias("score")) for name, c in scores.items()]
    long = df.select(TARGET, F.inline(F.array(*cells)))
    return ranking_metrics(long, "score", ["model"])


def _selection(models: dict[float, PipelineModel], held_out: DataFrame) -> DataFrame:
    """Metrics per candidate; preprocessing is the same for all of them and runs once."""
    first = next(iter(models.values()))
    ready = pin(PipelineModel(first.stages[:-1]).transform(held_out).select(TARGET, "features"))
    scored, names = ready, {}
    for c, model in models.items():
        names[str(c)] = f"_score_{str(c).replace('.', '_')}"
        probability = vector_to_array("probability")[1].alias(names[str(c)])
        scored = model.stages[-1].transform(scored).select(*scored.columns, probability)
    return _stack(scored.drop("features"), names).withColumnRenamed("model", "c")


@dataclass
class BatchResult:
    run_id: str
    scored: DataFrame
    queue: DataFrame
    metrics: DataFrame


def _new_run_id() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%SZ")


def previous_row_count(spark: SparkSession, root: str) -> int | None:
    """Feed rows of the latest successful run under `root`; None before the first one."""
    try:
        runs = spark.read.json(f"{root}/runs/*")
    except AnalysisException:
        return None
    if not {"status", "source_row_count", "run_id"} <= set(runs.columns):
        return None
    good = runs.where("status = 'SUCCESS' AND source_row_count IS NOT NULL")
    last = good.orderBy(F.desc("run_id")).select("source_row_count").first()
    return last and last["source_row_count"]


def _ingest(spark, raw_path, root, run_id, policy, gate, previous_rows, multi_line) -> dict[str, DataFrame]:
    """Transformations and validations of one feed; checks and rates are kept per run.

    Readers see the new stage tables once all of that has passed, and the old ones until then.
    """
    store = StageStore(spark, f"{root}/stages")
    tables = write_stages(read_raw_csv(spark, raw_path, multi_line, keep_malformed=not multi_line), store, policy)
    checks, rates = run_validations(tables, gate, previous_rows, stage_facts(store))
    write_run_artifact(checks, root, "checks", run_id)
    write_run_artifact(rates, root, "rates", run_id)
    store.publish()
    return tables


def _publish(spark, population, model_path, root, run_id, capacity) -> tuple[DataFrame, DataFrame]:
    """Score, then write predictions and queue of the run and the latest exports."""
    scored, _ = score_population(population, load_artifacts(spark, model_path), capacity)
    path = write_run_artifact(scored, root, "predictions", run_id)
    stored = spark.read.parquet(path).where(F.col("run_id") == run_id).drop("run_id")
    queue = stored.where(F.col("priority_rank") <= capacity).orderBy("priority_rank")
    write_run_artifact(queue, root, "queues", run_id)
    # Ranked rows lie in ranges of ranks already.
    write_csv(scored, f"{root}/latest/scores")
    write_csv(queue, f"{root}/latest/priority_queue")
    return stored, queue


class _Run:
    """Writes the record of a run under `runs`: SUCCESS with its figures, or FAILED with the error.

    Both have the same columns; what a run did not get to is NULL or zero.
    """

    def __init__(self, spark: SparkSession, root: str, kind: str, run_id: str, capacity: int | None = None):
        self.spark, self.root, self.kind, self.run_id, self.capacity = spark, root, kind, run_id, capacity
        self.started, self.scored, self.rows, self.metrics = time.time(), None, None, None

    def __enter__(self) -> _Run:
        return self

    def __exit__(self, kind, error, trace) -> None:
        self.metrics = self._record("FAILED" if error else "SUCCESS", str(error) if error else None)
        write_json(self.metrics, f"{self.root}/runs/{self.run_id}")

    def _record(self, status: str, error: str | None) -> DataFrame:
        scored = self.scored
        if scored is None:
            scored = self.spark.createDataFrame([], f"camis string, {CALIBRATED} double, priority_rank bigint, history_depth_bucket string")
        figures = batch_metrics(scored, self.run_id, status, self.capacity or 0, time.time() - self.started)
        if "history_depth_distribution" not in figures.columns:
            figures = figures.withColumn("history_depth_distribution", F.lit(None).cast("map<string,double>"))
        return figures.withColumns(
            {
                "kind": F.lit(self.kind),
                "source_row_count": F.lit(self.rows).cast("bigint"),
                "error": F.lit(error).cast("string"),
            }
        )


def run_pipeline(
    spark: SparkSession,
    raw_path: str,
    root: str,
    policy: EventPolicy = EventPolicy(),
    gate: bool = False,
    run_id: str | None = None,
    previous_rows: int | None = None,
    multi_line: bool = False,
) -> dict[str, DataFrame]:
    """Ingest, transform and validate, with a run record of its own.

    `previous_rows` is what the row-count change is measured against; by default that of the
    latest successful run.  `multi_line` says that quoted fields of the feed hold line breaks;
    without it a feed with such a field fails.
    """
    run_id = run_id or _new_run_id()
    with _Run(spark, root, "pipeline", run_id) as run:
        before = previous_rows if previous_rows is not None else previous_row_count(spark, root)
        tables = _ingest(spark, raw_path, root, run_id, policy, gate, before, multi_line)
        run.rows = tables["deduplication_audit"].first()["input_row_count"]
    return tables


def run_scoring(
    spark: SparkSession, stages: str, root: str, model_path: str, capacity: int, run_id: str | None = None
) -> BatchResult:
    """Score the stored scoring population under `stages` with the stored model and write the results."""
    check_capacity(capacity)
    run_id = run_id or _new_run_id()
    with _Run(spark, root, "scoring", run_id, capacity) as run:
        population = read_stage(spark, stages, "scoring_population")
        stored, queue = _publish(spark, population, model_path, root, run_id, capacity)
        run.scored = stored
    return BatchResult(run_id, stored, queue, run.metrics)


def run_batch(
    spark: SparkSession,
    raw_path: str,
    root: str,
    model_path: str,
    capacity: int,
    policy: EventPolicy = EventPolicy(),
    gate: bool = False,
    run_id: str | None = None,
    previous_rows: int | None = None,
    multi_line: bool = False,
) -> BatchResult:
    """Ingest, transform, validate, score, write artifacts and metrics.

    A failed run leaves a FAILED record under `runs` and raises.  `multi_line` says that
    quoted fields of the feed hold line breaks; without it a feed with such a field fails.
    """
    check_capacity(capacity)
    run_id = run_id or _new_run_id()
    with _Run(spark, root, "batch", run_id, capacity) as run:
        before = previous_rows if previous_rows is not None else previous_row_count(spark, root)
        tables = _ingest(spark, raw_path, root, run_id, policy, gate, before, multi_line)
        run.rows = tables["deduplication_audit"].first()["input_row_count"]
        stored, queue = _publish(spark, tables["scoring_population"], model_path, root, run_id, capacity)
        run.scored = stored
    return BatchResult(run_id, stored, queue, run.metrics)


def batch_metrics(scored: DataFrame, run_id: str, status: str, capacity: int, seconds: float) -> DataFrame:
    """Run record, prediction distribution and history mix as one row."""
    distribution = monitoring_metrics(scored)
    if "history_depth_bucket" in scored.columns:
        distribution = distribution.withColumn("history_depth_distribution", category_share_map(scored).scalar())
    return distribution.select(
        F.lit(run_id).alias("run_id"),
        F.lit(status).alias("status"),
        F.lit(capacity).cast("bigint").alias("capacity"),
        F.col("prediction_count").alias("population_size"),
        F.least(F.col("prediction_count"), F.lit(capacity).cast("bigint")).alias("priority_queue_size"),
        F.lit(float(seconds)).alias("duration_seconds"),
        *distribution.columns,
    )


def save_training(spark: SparkSession, training: Training, path: str) -> None:
    save_artifacts(spark, training.artifacts, path)
