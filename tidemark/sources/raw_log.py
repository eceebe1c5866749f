"""The violation-grain feed: one text row per cited violation."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.tables import pin

# The feed's header, in file order.
RAW_COLUMNS = (
    "CAMIS", "DBA", "BORO", "BUILDING", "STREET", "ZIPCODE", "PHONE",
    "CUISINE DESCRIPTION", "INSPECTION DATE", "ACTION", "VIOLATION CODE",
    "VIOLATION DESCRIPTION", "CRITICAL FLAG", "SCORE", "GRADE", "GRADE DATE",
    "RECORD DATE", "INSPECTION TYPE", "Latitude", "Longitude",
    "Community Board", "Council District", "Census Tract", "BIN", "BBL", "NTA",
    "Location",
)

RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])


def raw_col(name: str) -> Column:
    return F.col(f"`{name}`")


#: Column of `read_raw_csv` that holds the text of rows which do not fit the header.
MALFORMED = "_malformed"


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = False, keep_malformed: bool = False) -> DataFrame:
    """Scan the feed as text.

    No inference pass over the files: every column is a string and typing is the
    normaliser's job.  The header may hold more columns and in another order, but all files
    of a feed share it; a file with another header fails the scan.  Files are split
    among tasks, also where `multi_line` says that quoted fields hold line breaks (see
    `read_quoted_csv`).  `keep_malformed` adds the text of rows that do not fit the header as
    a column; with `multi_line` there is no such column.
    """
    if multi_line:
        return read_quoted_csv(spark, path)
    reader = spark.read.option("header", True).option("escape", '"')
    schema = _header_schema(reader.option("inferSchema", False).csv(path).columns)
    reader, kept = reader.option("enforceSchema", False), list(RAW_COLUMNS)
    if keep_malformed:
        # Rows are held against the whole header, whatever columns are read.
        schema = schema.add(MALFORMED, T.StringType())
        reader, kept = reader.option("columnPruning", False).option("columnNameOfCorruptRecord", MALFORMED), [*kept, MALFORMED]
    return reader.schema(schema).csv(path).select(*[raw_col(n) for n in kept])


def _header_schema(header: list[str]) -> T.StructType:
    missing = [name for name in RAW_COLUMNS if name not in header]
    if missing:
        raise ValueError(f"Raw feed lacks columns: {', '.join(missing)}")
    return T.StructType([T.StructField(name, T.StringType()) for name in header])


def read_quoted_csv(spark: SparkSession, path: str) -> DataFrame:
    """The feed where quoted fields hold line breaks, its files split among tasks like those without.

    A line whose number of quotes is odd opens or closes a quoted field, so the state at
    a split's first line is the parity of the quotes in the splits before it.  A first pass
    counts them per split, which gives one small row for each.  Splits without such a line pass as they
    are.  In the others, lines are numbered, and those of one row are put together again,
    also where a row reaches over the edge of a split.

    As the format has it, a quote within a field is doubled and its field quoted; a file with an odd
    number of quotes fails.  All files share one header line; lines that repeat it are no rows.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value",
        (quotes % 2).alias("odd"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
    )
    splits = lines.groupBy("file", "split").agg(F.sum("odd").alias("odds"), F.min_by("value", "at").alias("first"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = pin(splits.withColumn("open", F.coalesce(F.sum("odds").over(earlier), F.lit(0)) % 2))
    headers = splits.where("split = 0").select("first").distinct().limit(2).collect()
    if len(headers) > 1:
        raise ValueError("The files of the feed have different header lines.")
    unclosed = splits.groupBy("file").agg(F.sum("odds").alias("odds")).where("odds % 2 = 1").limit(1).collect()
    if unclosed:
        raise ValueError(f"A quoted field is never closed in {unclosed[0]['file']}.")
    header = headers[0]["first"].rstrip("\r") if headers else ""
    names = next(csv.reader([header]), [])
    schema = _header_schema(names)

    lines = lines.where(F.rtrim("value", F.lit("\r")) != header)
    # One small row per split; the lines of splits without such a line need not move.
    lines = lines.join(F.broadcast(splits.drop("first")), ["file", "split"], "left")
    # Splits are cut alike in both passes unless the cluster has grown or shrunk between them.
    lost = F.raise_error(F.lit("The feed was split in another way; run the job again.")).cast("bigint")
    lines = lines.withColumn("open", F.coalesce("open", lost))
    whole = lines.where("odds = 0 AND open = 0").select("value")

    in_split = Window.partitionBy("file", "split").orderBy("at")
    cut = lines.where("odds > 0 OR open = 1").select("*", F.row_number().over(in_split).alias("line"))
    before = F.coalesce(F.sum("odd").over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = cut.withColumn("starts", (F.col("open") + before) % 2 == 0)
    single = cut.where("starts AND odd = 0").select("value")
    parts = cut.where("NOT starts OR odd = 1")
    mine = F.last(F.when(F.col("starts"), F.col("line")), ignorenulls=True).over(in_split.rowsBetween(Window.unboundedPreceding, 0))
    parts = parts.withColumn("mine", mine)
    # A row that began in an earlier split is the last one that began there.
    begun = cut.where("starts AND odd = 1").groupBy("file", "split").agg(F.max("line").alias("line"))
    begun = begun.unionByName(splits.select("file", "split"), allowMissingColumns=True).groupBy("file", "split").agg(F.max("line").alias("line"))
    last = F.last(F.when(F.col("line").isNotNull(), F.struct("split", "line")), ignorenulls=True).over(earlier)
    begun = begun.select("file", "split", last.alias("before"))
    parts = parts.join(begun, ["file", "split"], "left")
    place = F.when(F.col("mine").isNull(), F.col("before")).otherwise(F.struct("split", F.col("mine").alias("line")))
    pieces = F.sort_array(F.collect_list(F.struct("split", "line", "value")))
    joined = parts.groupBy("file", place.alias("row")).agg(F.array_join(F.transform(pieces, lambda p: p["value"]), "\n").alias("value"))
    rows = whole.unionAll(single).unionAll(joined.select("value")).select(F.rtrim("value", F.lit("\r")).alias("value")).where("value <> ''")
    ddl = ", ".join(f"c{k} STRING" for k in range(len(schema)))
    parsed = rows.select(F.from_csv("value", ddl, {"escape": '"', "maxCharsPerColumn": "-1"}).alias("r"))
    return parsed.select(*[F.col(f"r.c{k}").alias(name) for k, name in enumerate(schema.names) if name in RAW_COLUMNS]).select(
        *[raw_col(name) for name in RAW_COLUMNS]
    )


def open_quotes() -> Column:
    """Number of malformed rows with an open quote: read line by line, fields with line breaks in them make such rows."""
    quotes = F.length(MALFORMED) - F.length(F.replace(F.col(MALFORMED), F.lit('"'), F.lit("")))
    return F.count(F.when(quotes % 2 == 1, 1))


def check_unbroken(broken: int) -> None:
    if broken:
        raise ValueError(f"{broken} malformed rows of the feed have an open quote; quoted line breaks need multi_line=True")


def landing_count(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count(F.lit(1)).alias("raw_row_count"))
