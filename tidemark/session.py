"""A local session for tests and the bench; clusters bring their own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, memory: str = "8g", checkpoints: str = "/tmp/tidemark-checkpoints") -> SparkSession:
    session = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", checkpoints)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # Recommended for clusters too.  HotSpot interprets methods above 8000 bytes; such stages run faster split up.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Stages bucketed by entity then also meet without an exchange where a join adds the event's id.
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
