"""Stages are published whole, lie by their key and know their counts."""

import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import raw_rows
from test_model_jobs import feed
from tidemark.operators import quality, snapshots
from tidemark.plans import jobs
from tidemark.sources.raw_log import read_raw_csv
from tidemark.sources import stage_store
from tidemark.sources.stage_store import StageStore
from tidemark.sources.tables import read_stage, write_csv, write_stage


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("feed") / "landing")
    raw_rows(spark, feed(12)).write.option("header", True).csv(path)
    return path


@pytest.fixture
def no_broadcast(spark):
    switches = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in switches}
    for k, v in switches.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_an_unpublished_or_failed_run_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    write_stage(spark.range(5), root, "a")
    store = StageStore(spark, root)
    store.write("a", spark.range(9))
    store.write("b", spark.range(3))
    assert read_stage(spark, root, "a").count() == 5
    with pytest.raises(FileNotFoundError):
        read_stage(spark, root, "b")
    store.publish()
    assert read_stage(spark, root, "a").count() == 9 and read_stage(spark, root, "b").count() == 3
    broken = spark.range(4).select(F.when(F.col("id") < 9, F.raise_error(F.lit("lost"))).alias("id"))
    with pytest.raises(Exception, match="lost"):
        write_stage(broken, root, "a")
    assert read_stage(spark, root, "a").count() == 9
    assert write_stage(spark.range(7).limit(0), root, "a").count() == 0


def test_a_job_that_fails_between_stages_leaves_the_old_tables(spark, tmp_path, landing, monkeypatch):
    root = str(tmp_path)
    jobs.run_pipeline(spark, landing, root, run_id="one")
    before = open(f"{root}/stages/current.json").read()
    people = read_stage(spark, f"{root}/stages", "scoring_population").count()
    monkeypatch.setattr(jobs.snapshots, "features_of", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        jobs.run_pipeline(spark, landing, root, run_id="two")
    assert open(f"{root}/stages/current.json").read() == before
    assert read_stage(spark, f"{root}/stages", "scoring_population").count() == people == 12


def test_exports_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "latest" / "scores")
    write_csv(spark.range(3), path)
    write_csv(spark.range(8), path)
    assert spark.read.option("header", True).csv(path).count() == 8
    with pytest.raises(Exception, match="lost"):
        write_csv(spark.range(4).select(F.when(F.col("id") < 9, F.raise_error(F.lit("lost"))).cast("bigint").alias("id")), path)
    assert spark.read.option("header", True).csv(path).count() == 8


def test_stored_stages_meet_without_an_exchange(spark, tmp_path, landing, no_broadcast):
    tables = jobs.run_transformations(read_raw_csv(spark, landing), str(tmp_path))
    assert "Exchange" not in plan(snapshots.features_of(tables["snapshots"], tables["restaurants"]))
    assert "Exchange" not in plan(snapshots.modeling_set(tables["features"], tables["labels"]))
    assert "Exchange" not in plan(snapshots.decision_snapshots(tables["inspections"]))
    assert "Exchange" not in plan(snapshots.current_population(tables["inspections"], tables["restaurants"], as_of=spark.range(1).selectExpr("current_date()")))
    known = tables["inspections"].select("camis", "inspection_id")
    assert "Exchange" not in plan(tables["violation_counts"].join(known, ["camis", "inspection_id"], "left_anti"))
    # Each bucket was written by one task.
    for name in ("snapshots", "features", "labels", "inspections"):
        files = [f for f in tables[name].inputFiles()]
        assert 0 < len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_a_later_session_reads_the_buckets(spark, tmp_path, landing, no_broadcast):
    tables = jobs.run_transformations(read_raw_csv(spark, landing), str(tmp_path))
    rows = sorted(map(str, tables["labels"].collect()))
    entry = json.load(open(f"{tmp_path}/current.json"))["tables"]["labels"]
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("tidemark_")]:
        spark.sql(f"DROP TABLE {name}")
    assert os.path.isdir(entry["path"].removeprefix("file:"))
    again = {n: read_stage(spark, str(tmp_path), n) for n in ("labels", "features")}
    assert sorted(map(str, again["labels"].collect())) == rows
    assert "Exchange" not in plan(snapshots.modeling_set(again["features"], again["labels"]))


def test_the_feed_is_read_once_and_counted_on_the_way(spark, tmp_path, landing):
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    root = str(tmp_path)
    tables = jobs.run_pipeline(spark, landing, root, run_id="one", gate=True)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    after = store.executionsList(before, store.executionsCount() - before)
    plans = [after.apply(k).physicalPlanDescription() for k in range(after.size())]
    # The other read is of the header line alone.
    reads = [p for p in plans if "FileScan csv" in p or "Scan csv" in p]
    assert len([p for p in reads if "InsertInto" in p or "Write" in p]) == 1 and len(reads) == 1
    facts = jobs.stage_facts(StageStore(spark, f"{root}/stages"))
    checked = jobs.as_check_tables(tables, 100)
    for table, names in quality.FACTS.items():
        if table == "unique":
            continue
        counted = getattr(checked, table).agg(*[fact().alias(n) for n, fact in names.items()]).first().asDict()
        assert {n: facts[table][n] for n in names} == counted, table
    known = jobs.as_check_tables(tables, 100, facts)
    key = lambda r: str(r)
    assert sorted(quality.quality_rates(known).collect(), key=key) == sorted(quality.quality_rates(checked).collect(), key=key)
    assert sorted(quality.run_suite(known).collect(), key=key) == sorted(quality.run_suite(checked).collect(), key=key)


def test_orphans_are_found_by_their_key_alone(spark):
    df = spark.createDataFrame([("1", "a"), ("2", "b"), (None, "c"), ("4", None), ("5", "e"), ("5", "x")], "camis string, inspection_id string")
    other = spark.createDataFrame([("1", "a"), ("9", "b"), ("9", "c"), ("5", "e"), ("5", "e")], "camis string, inspection_id string")
    assert sorted(map(tuple, quality.orphans(df, other, "inspection_id").collect()), key=str) == [("4", None), ("5", "x")]


def test_exchange_partitions_of_a_write_grow_with_the_files_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stage_store, "INITIAL_PARTITIONS", 1)
    monkeypatch.setattr(stage_store, "BYTES_A_PARTITION", 1000)
    store, parts = StageStore(spark, str(tmp_path / "store")), []
    for n in (20_000, 200_000):
        spark.range(n).write.parquet(f"{tmp_path}/{n}")
        parts.append(store._partitions(spark.read.parquet(f"{tmp_path}/{n}").groupBy("id").count()))
    assert parts[0] > 8 and parts[1] > 5 * parts[0]
    # A leaf of unknown size asks for no more than the least.
    assert store._partitions(spark.createDataFrame([(1,)], "id int").localCheckpoint()) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_stage_files_are_compressed_with_entropy_coding(spark, tmp_path):
    import pyarrow.parquet as pq

    store = StageStore(spark, str(tmp_path))
    df = spark.range(1000).select(F.col("id"), F.md5(F.col("id").cast("string")).alias("digest"))
    store.write("plain", df)
    store.write("placed", df, "id")
    for name in ("plain", "placed"):
        for path in (tmp_path / "versions" / store.version / name).glob("*.parquet"):
            assert pq.ParquetFile(path).metadata.row_group(0).column(1).compression == "ZSTD"


def test_the_landed_feed_is_compressed_files_of_bounded_size(spark, tmp_path, monkeypatch):
    from contract import model_queries

    class Feed:
        raw = raw_rows(spark, feed(12))

    Feed.spark = spark
    monkeypatch.setattr(model_queries, "shared_folder", lambda _: str(tmp_path))
    monkeypatch.setattr(model_queries, "LANDED_ROWS", 5)
    landed = model_queries._landed(Feed)
    assert sorted(map(str, landed.collect())) == sorted(map(str, Feed.raw.collect()))
    files = list(tmp_path.glob("*-landing/*.csv.gz"))
    assert len(files) > 4
