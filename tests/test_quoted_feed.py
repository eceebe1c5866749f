"""Rows with quoted line breaks, read from files that are split among tasks."""

import random

import pytest

from tidemark.sources.raw_log import RAW_COLUMNS, read_raw_csv


def cell(draw):
    kind = draw.random()
    if kind < 0.45:
        return "plain" + str(draw.randrange(9))
    if kind < 0.55:
        return ""
    inner = "".join(draw.choices(["a", "é", ",", '""', "\n", "\r\n", " ", "#", "x,y"], k=draw.randrange(1, 8)))
    return f'"{inner}"'


def feed(seed, rows, end="\n"):
    draw = random.Random(seed)
    body = [",".join(str(k) if c == "CAMIS" else cell(draw) for c in RAW_COLUMNS) for k in range(rows)]
    return end.join([",".join(RAW_COLUMNS), *body]) + end


def spark_reader(spark, path):
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True).option("lineSep", "\n")
    return reader.csv(path).select(*[f"`{c}`" for c in RAW_COLUMNS])


def ordered(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (int(r[0]), str(r)))


@pytest.mark.parametrize("split", ["1000", "7", "200000"])
def test_breaks_across_the_edges_of_splits(spark, tmp_path, split):
    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "a.csv").write_bytes(feed(1, 60 if split == "7" else 300).encode())
    (folder / "b.csv").write_bytes(feed(2, 20).encode())
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        parts = spark.read.text(str(folder)).rdd.getNumPartitions()
        found = ordered(read_raw_csv(spark, str(folder), multi_line=True))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert parts > 10 or split == "200000"
    assert found == ordered(spark_reader(spark, str(folder)))


def test_one_row_over_many_splits_and_plain_files(spark, tmp_path):
    long = [",".join("k" if c == "CAMIS" else '"' + "line\n" * 500 + '"' if c == "DBA" else c.lower() for c in RAW_COLUMNS)]
    plain = [",".join(f"{c}{k}" for c in RAW_COLUMNS) for k in range(40)]
    (tmp_path / "x.csv").write_text("\n".join([",".join(RAW_COLUMNS), *plain, *long, *plain]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
        found = read_raw_csv(spark, str(tmp_path), multi_line=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(found) == 81 and [r["DBA"] for r in found if r["CAMIS"] == "k"] == ["line\n" * 500]


def test_faulty_feeds_fail(spark, tmp_path):
    open_, other, short = (tmp_path / n for n in ("open", "other", "short"))
    for folder in (open_, other, short):
        folder.mkdir()
    (open_ / "a.csv").write_text(",".join(RAW_COLUMNS) + '\n"never closed,\n')
    with pytest.raises(ValueError, match="never closed"):
        read_raw_csv(spark, str(open_), multi_line=True)
    (other / "a.csv").write_text(",".join(RAW_COLUMNS) + "\n")
    (other / "b.csv").write_text(",".join(RAW_COLUMNS[::-1]) + "\n")
    with pytest.raises(ValueError, match="header"):
        read_raw_csv(spark, str(other), multi_line=True)
    (short / "a.csv").write_text(",".join(RAW_COLUMNS[:-1]) + "\n")
    with pytest.raises(ValueError, match="lacks columns: Location"):
        read_raw_csv(spark, str(short), multi_line=True)


def test_compressed_files_and_splits_without_breaks(spark, tmp_path):
    """Compressed files are read whole; lines of splits without a broken row are not moved."""
    import gzip

    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "a.csv.gz").write_bytes(gzip.compress(feed(3, 200).encode()))
    (folder / "b.csv").write_bytes(feed(4, 50).encode())
    found = read_raw_csv(spark, str(folder), multi_line=True)
    assert ordered(found) == ordered(spark_reader(spark, str(folder)))
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in text
