"""Sinks and jobs: written, read back and compared with the same rows in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from contract.model_queries import _landed
from contract.oracle_tables import over_stages
from contract.quality_queries import sound_tables  # noqa: F401  registers the suite first
from contract.queries import REGISTRY, register
from contract.ranking_queries import CAL_P, RAW_P, batch, over_batch
from contract.stages import Stages
from tidemark.operators.profile import monitoring_metrics
from tidemark.plans import jobs
from tidemark.sources.stage_store import StageStore
from tidemark.sources.tables import read_scores, read_stage, shared_folder, usable_scores, write_csv, write_json, write_run_artifact, write_stage


#: Verdict and rows of every check over the sound stages, as `dq_suite` states them.
_SUITE = REGISTRY["dq_suite"][1]


def _place(s: Stages, name: str) -> str:
    return f"{shared_folder(s.spark)}/tidemark-{s.spark.sparkContext.applicationId}-{name}-{uuid.uuid4().hex[:8]}"


@register(
    "score_csv_round_trip",
    over_batch(f"SELECT camis, priority_rank, round({CAL_P}, 6) AS {CAL_P}, round({RAW_P}, 6) AS {RAW_P} FROM batch"),
)
def _(s):
    path = _place(s, "scores")
    write_csv(batch(s), path)
    return usable_scores(read_scores(s.spark, path)).select("camis", "priority_rank", CAL_P, RAW_P)


@register(
    "metrics_json_round_trip",
    over_batch(f"SELECT count(*) AS prediction_count, round(max({CAL_P}), 6) AS prediction_max, round(min({CAL_P}), 6) AS prediction_min FROM batch"),
)
def _(s):
    path = _place(s, "metrics")
    write_json(monitoring_metrics(batch(s)), path)
    return s.spark.read.json(path).select("prediction_count", "prediction_max", "prediction_min")


@register(
    "run_artifact_round_trip",
    over_batch("SELECT run_id, count(*) AS n FROM batch, (VALUES ('r1', 40), ('r2', 25)) v(run_id, k) WHERE priority_rank <= k GROUP BY run_id"),
)
def _(s):
    """Two runs side by side; writing a run again replaces only that run."""
    root, ranked = _place(s, "runs"), batch(s)
    for run_id, k in (("r1", 10), ("r2", 25), ("r1", 40)):
        path = write_run_artifact(ranked.where(F.col("priority_rank") <= k), root, "predictions", run_id)
    return s.spark.read.parquet(path).groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))


@register("stage_round_trip", over_stages("SELECT camis, count(*) AS n FROM ev GROUP BY camis"))
def _(s):
    """A stage table written, replaced and read by its name."""
    root = _place(s, "stages")
    write_stage(s.events.limit(0), root, "inspections")
    write_stage(s.events, root, "inspections")
    return read_stage(s.spark, root, "inspections").groupBy("camis").agg(F.count(F.lit(1)).alias("n"))


@register(
    "pipeline_job",
    over_stages(
        "SELECT 'pipeline' AS kind, 'SUCCESS' AS status, (SELECT count(*) FROM raw) AS source_row_count,"
        " (SELECT count(*) FROM dedup) AS deduplicated_rows, (SELECT count(*) FROM ev) AS event_rows,"
        " (SELECT count(*) FROM pop) AS population_rows, CAST(32 AS BIGINT) AS checks"
    ),
)
def _(s):
    """Feed to stage tables with validations and the run's own record."""
    _landed(s)
    feed = f"{shared_folder(s.spark)}/tidemark-{s.spark.sparkContext.applicationId}-landing"
    root = _place(s, "pipeline")
    tables = jobs.run_pipeline(s.spark, feed, root, run_id="one")
    count = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return s.spark.read.json(f"{root}/runs/one").select(
        "kind", "status", "source_row_count",
        count(tables["deduplicated_inspection_rows"]).alias("deduplicated_rows"),
        count(tables["inspections"]).alias("event_rows"),
        count(tables["prediction_population"]).alias("population_rows"),
        count(s.spark.read.parquet(f"{root}/checks")).alias("checks"),
    )


@register("pipeline_checks", _SUITE)
def _(s):
    """Every check's verdict as a run of the job leaves it, from one read of the feed and the counts of its writes."""
    _landed(s)
    root = _place(s, "checked")
    jobs.run_pipeline(s.spark, f"{shared_folder(s.spark)}/tidemark-{s.spark.sparkContext.applicationId}-landing", root, run_id="one")
    return s.spark.read.parquet(f"{root}/checks").select("check_name", "status", "result_rows")


@register(
    "published_stage",
    over_stages("SELECT camis, count(*) AS events, CAST(sum(total_violations) AS BIGINT) AS violations FROM ev GROUP BY camis"),
)
def _(s):
    """A reader between two runs: it sees the published tables, not those of a run that is still writing."""
    root = _place(s, "published")
    write_stage(s.events, root, "inspections", "camis", placed=True)
    StageStore(s.spark, root).write("inspections", s.events.limit(10))
    return read_stage(s.spark, root, "inspections").groupBy("camis").agg(
        F.count(F.lit(1)).alias("events"), F.sum("total_violations").alias("violations")
    )


@register(
    "stage_facts",
    over_stages(
        "SELECT 'raw' AS stage, 'rows' AS fact, count(*) AS n FROM raw UNION ALL SELECT 'rows', 'rows', count(*) FROM norm"
        " UNION ALL SELECT 'rows', 'unexpected_flags', count(*) FILTER (critical_flag = 'Unexpected') FROM norm"
        " UNION ALL SELECT 'rows', 'missing_boroughs', count(*) FILTER (borough IS NULL) FROM norm"
        " UNION ALL SELECT 'unique', 'rows', count(*) FROM dedup UNION ALL SELECT 'events', 'rows', count(*) FROM ev"
        " UNION ALL SELECT 'events', 'sentinel_dates', count(*) FILTER (inspection_date = DATE '1900-01-01') FROM ev"
        " UNION ALL SELECT 'population', 'rows', count(*) FROM pop UNION ALL SELECT 'labels', 'rows', count(*) FROM lab"
        " UNION ALL SELECT 'features', 'rows', count(*) FROM feat"
    ),
)
def _(s):
    """Counts that the writes of a job note as they go, instead of reading the tables again."""
    store = StageStore(s.spark, _place(s, "facts"))
    jobs.write_stages(s.raw, store)
    facts = jobs.stage_facts(store)
    wanted = [
        ("raw", "rows"), ("rows", "rows"), ("rows", "unexpected_flags"), ("rows", "missing_boroughs"), ("unique", "rows"),
        ("events", "rows"), ("events", "sentinel_dates"), ("population", "rows"), ("labels", "rows"), ("features", "rows"),
    ]
    cells = [F.struct(F.lit(t).alias("stage"), F.lit(n).alias("fact"), F.lit(facts[t][n]).cast("bigint").alias("n")) for t, n in wanted]
    return s.spark.range(1).select(F.inline(F.array(*cells)))
