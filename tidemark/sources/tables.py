"""Stage tables, run-keyed artifacts and the scored-file contract.

Paths are Hadoop URIs throughout, so local folders and object stores look alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import replace_folder
from tidemark.sources.stage_store import StageStore

MONITORING_COLUMNS = ("camis", "calibrated_high_severity_probability", "priority_rank")
SCORED_COLUMNS = (
    "camis", "restaurant_name", "borough", "cuisine_description", "cutoff_date",
    "history_depth_bucket", "raw_logistic_probability",
    "calibrated_high_severity_probability", "priority_rank",
)


def require_columns(df: DataFrame, required: Iterable[str], what: str = "Table") -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing required columns: {', '.join(missing)}")
    return df


def write_stage(df: DataFrame, root: str, name: str, key: str | None = None, placed: bool = False) -> DataFrame:
    """Create or replace one stage table and read it back; readers see the old one until it is whole."""
    store = StageStore(df.sparkSession, root)
    stored = store.write(name, df, key, placed)
    store.publish()
    return stored


def read_stage(spark: SparkSession, root: str, name: str) -> DataFrame:
    return StageStore(spark, root).read(name)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`, else one in the warehouse.

    Both are places every executor reaches; nothing depends on the master.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints").rstrip("/")


def pin(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later reads see one evaluation, whatever executors are lost."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def write_csv(df: DataFrame, path: str) -> None:
    """Create or replace a CSV export; the old one stays until the new one is whole."""
    new = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    df.write.option("header", True).csv(new)
    replace_folder(df.sparkSession, new, path.rstrip("/"))


def write_json(df: DataFrame, path: str) -> None:
    """One object per row; map columns that are empty stay in the output."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_run_artifact(df: DataFrame, root: str, kind: str, run_id: str) -> str:
    """Append one run as a `run_id=` partition of `kind`, replacing only that run."""
    path = f"{root.rstrip('/')}/{kind}"
    (
        df.withColumn("run_id", F.lit(run_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )
    return path


def read_scores(spark: SparkSession, path: str, required: Iterable[str] = MONITORING_COLUMNS) -> DataFrame:
    """Scored rows from CSV or parquet, refused before any job if columns are missing."""
    if path.rstrip("/").endswith(".parquet"):
        scores = spark.read.parquet(path)
    else:
        scores = spark.read.option("header", True).option("escape", '"').csv(path)
    return require_columns(scores, required, "Score artifact")


def usable_scores(scores: DataFrame) -> DataFrame:
    """Numbers parsed leniently; rows without a rank or calibrated score are dropped."""
    numeric = ("priority_rank", "calibrated_high_severity_probability", "raw_logistic_probability")
    parsed = scores.withColumns(
        {c: F.col(c).cast("string").try_cast("double") for c in numeric if c in scores.columns}
    )
    return (
        parsed.dropna(subset=["priority_rank", "calibrated_high_severity_probability"])
        .withColumn("priority_rank", F.col("priority_rank").cast("bigint"))
        .orderBy("priority_rank")
    )
