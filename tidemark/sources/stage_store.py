"""Stage tables that are published whole, placed by a key, with facts counted by their writes.

A run writes its tables into a version folder of its own.  Readers follow one small file
that names the folder, key and facts of every table; it is replaced last, by a rename, so a
run that fails changes nothing for them.  A table with a key is bucketed by it: joins,
windows and groups on that key read it without an exchange, in any later session too; joins
that add further columns to the key need spark.sql.requireAllClusterKeysForCoPartition=false.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import files


#: While a stage is written: the least exchange partitions before AQE puts small ones together, the most, and the stored bytes read for each.
INITIAL_PARTITIONS, MOST_PARTITIONS, BYTES_A_PARTITION = 512, 8192, 1 << 20
#: The size AQE aims at, that of a read split, and what a further file adds to one.
ADVISORY_BYTES, SPLIT_BYTES, OPEN_BYTES = "2m", "4m", "256k"

#: Stage files hold digests, which only a codec with entropy coding makes smaller.
CODEC = "zstd"


class StageStore:
    """The stage tables under one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.version = uuid.uuid4().hex
        #: Tables of this run, which readers do not see before `publish`.
        self.written: dict[str, dict] = {}

    # --- writing ---

    def write(self, name: str, df: DataFrame, key: str | None = None, placed: bool = False, facts: Mapping[str, Column] | None = None) -> DataFrame:
        """Write a table of this run and read it back, which cuts the lineage.

        With `key` it is bucketed into as many files as there are shuffle partitions; `placed` says that
        the rows already lie by the key, so that no exchange is needed.  `facts` are
        aggregates counted while the rows are written, next to their number as `rows`.
        """
        path = f"{self.root}/versions/{self.version}/{name}"
        entry = {"path": path, "schema": df.schema.json(), "key": key, "buckets": None, "facts": {}}
        if key is not None:
            entry["buckets"] = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            df = df if placed else df.repartition(entry["buckets"], key)
        partitions = self._partitions(df)
        counted = Observation()
        df = df.observe(counted, F.count(F.lit(1)).alias("rows"), *[fact.alias(n) for n, fact in (facts or {}).items()])
        if key is None:
            with self._small_tasks(partitions):
                df.write.option("compression", CODEC).parquet(path)
        else:
            with self._small_tasks(partitions), self._bucketed_scans():
                df.write.bucketBy(entry["buckets"], key).sortBy(key).option("path", path).option("compression", CODEC).saveAsTable(_table_name(path), format="parquet")
        entry["facts"] = counted.get
        self.written[name] = entry
        return self._open(entry)

    def note(self, name: str, facts: Mapping[str, int]) -> None:
        """Facts about something that is not stored, such as the feed."""
        self.written[name] = {"facts": dict(facts)}

    def publish(self) -> None:
        """Let readers see the tables of this run, all at once."""
        tables = self._published() | self.written
        files.replace_text(self.spark, f"{self.root}/current.json", json.dumps({"version": self.version, "tables": tables}))

    # --- reading ---

    def read(self, name: str) -> DataFrame:
        return self._open(self._entry(name))

    def facts(self, name: str) -> dict[str, int]:
        return self._entry(name)["facts"]

    def _entry(self, name: str) -> dict:
        tables = self._published() | self.written
        if name not in tables:
            raise FileNotFoundError(f"No stage table {name} is published under {self.root}.")
        return tables[name]

    def _published(self) -> dict[str, dict]:
        text = files.read_text(self.spark, f"{self.root}/current.json")
        return json.loads(text)["tables"] if text else {}

    def _open(self, entry: dict) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        if entry["key"] is None:
            return self.spark.read.schema(schema).parquet(entry["path"])
        name = _table_name(entry["path"])
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{entry['key']}`) SORTED BY (`{entry['key']}`)"
                f" INTO {entry['buckets']} BUCKETS LOCATION '{entry['path']}'"
            )
        return self.spark.table(name)

    @contextmanager
    def _settings(self, values: Mapping[str, str]) -> Iterator[None]:
        before = {name: self.spark.conf.get(name, None) for name in values}
        for name, value in values.items():
            self.spark.conf.set(name, value)
        try:
            yield
        finally:
            for name, value in before.items():
                self.spark.conf.unset(name) if value is None else self.spark.conf.set(name, value)

    def _bucketed_scans(self):
        """Sources are read bucket by bucket even where Spark sees no use for it, so each bucket is written by one task."""
        return self._settings({"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"})

    def _partitions(self, df: DataFrame) -> int:
        """Exchange partitions that grow with the files read, so that those of a task do not."""
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
        # A leaf that is no file, such as a checkpoint, may state the largest size there is for "unknown".
        read = sum(size for size in sizes if size < 1 << 60)
        least = max(INITIAL_PARTITIONS, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        return max(least, min(MOST_PARTITIONS, -(-read // BYTES_A_PARTITION)))

    def _small_tasks(self, partitions: int):
        """Many exchange partitions, put together up to a few megabytes, and small read splits.

        Rows grow some twentyfold between a narrow exchange and the hash tables and sorts behind it, and
        a task's rows are held by its exchange and sorts; tasks of the usual 64 MB would spill them.
        """
        return self._settings(
            {
                "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": ADVISORY_BYTES,
                "spark.sql.files.maxPartitionBytes": SPLIT_BYTES,
                "spark.sql.files.openCostInBytes": OPEN_BYTES,
            }
        )


def _table_name(path: str) -> str:
    return f"tidemark_{hashlib.md5(path.encode()).hexdigest()}"
