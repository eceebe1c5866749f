"""WARC archives: writing pages, and reading records back by boundary-chain verification.

Writing gives one record per page.  Among pages with one payload the smallest page_id
becomes the response, the others revisit it without repeating the payload.  Records
are rows of Spark's text writer, whose separator is the empty line that ends a
record, so a lost task is simply written again.

Reading cuts an archive at every occurrence of the magic line and takes each piece as a
candidate record.  A candidate states its own length and with it the offset of its
successor.  Magic inside a payload makes false candidates; pointer jumping from offset 0
of each file finds the candidates that the chain reaches, and the pieces of the others go
back to the record whose payload they are.  Jumps double in every round, so a file of
n records takes log2(n) rounds over small rows of offsets.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import pinned, scratch_path

#: What records begin with, and the versions that are read; 1.1 is written.
MAGIC, VERSIONS = "WARC/1.", "[01]"
GAP = "\r\n\r\n"
#: Payloads of fewer bytes are always written as responses.
LEAST_REVISITED = 0
#: Records in one file: bounds the offsets that one task orders when reading.
RECORDS_PER_FILE = 20_000
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DIGITS, _BASE32 = "0123456789abcdefghijklmnopqrstuv", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five hex digits are four digits of base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.lower(F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 32)), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), _DIGITS, _BASE32)


def _record_id(page: str, digest: str) -> Column:
    hexed = F.md5(F.concat_ws("/", F.coalesce(F.col(page).cast("string"), F.lit("")), digest))
    cuts = [F.substring(hexed, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def write_archives(pages: DataFrame, path: str, least: int = LEAST_REVISITED, compression: str = "gzip", date: str | None = None) -> None:
    """One record per row of pages (page_id, url, html) into files under `path`.

    Rows that share both payload and the smallest page_id are all responses.  A row without
    an id revisits a row that has one; without any id all are responses.
    """
    date = date or dt.datetime.now(dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = pages.select("page_id", "url", F.coalesce(pages["html"], F.lit("")).alias("html"))
    rows = rows.select("*", base32_sha1(F.col("html")).alias("digest"), F.octet_length("html").cast("bigint").alias("size"))
    first = rows.where(F.col("size") >= least).groupBy("digest").agg(F.min("page_id").alias("first"))
    rows = rows.join(first, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")) & (F.col("size") >= least)
    field = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))).otherwise("")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(GAP))
    rows = rows.select("page_id", "url", "digest", "first", revisit.alias("revisit"), http.alias("http"), "html")
    block = F.concat("http", F.when(F.col("revisit"), "").otherwise(F.col("html")))
    only = lambda value: F.when(F.col("revisit"), value)
    record = F.concat(
        F.lit(f"{MAGIC}1\r\n"),
        field("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        field("WARC-Record-ID", _record_id("page_id", "digest")),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", F.regexp_replace("url", "[\r\n]", "")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        field("WARC-Refers-To", only(_record_id("first", "digest"))),
        field("WARC-Profile", only(F.lit(_PROFILE))),
        field("X-Page-Id", F.col("page_id")),
        field("X-Refers-To-Page-Id", only(F.col("first"))),
        field("Content-Type", F.lit("application/http;msgtype=response")),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )
    (
        rows.select(record.alias("value")).write.option("lineSep", GAP).option("compression", compression)
        .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    )


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The text between magic lines, in file order by (block, number)."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("number"),
    )


def _parsed(pieces: DataFrame, *keys: str) -> DataFrame:
    """Header fields, payload size and digest of record texts (without their magic line)."""
    rows = pieces.select(*keys, "value", F.substring_index("value", GAP, 1).alias("header"))
    named = lambda name: F.nullif(F.regexp_extract("header", rf"(?im)^{name}: *([^\r\n]*)", 1), F.lit(""))
    rows = rows.select(
        *keys,
        F.octet_length("value").cast("bigint").alias("held"),
        F.octet_length("header").cast("bigint").alias("header_bytes"),
        # A piece without a version and the end of its line is no record.
        F.when(F.col("header").rlike(rf"^{VERSIONS}\r\n"), named("Content-Length").try_cast("bigint")).alias("content"),
        named("WARC-Type").alias("record_type"),
        named("X-Page-Id").try_cast("bigint").alias("page_id"),
        named("X-Refers-To-Page-Id").try_cast("bigint").alias("refers_to"),
        F.regexp_replace(named("WARC-Payload-Digest"), "^sha1:", "").alias("stated_digest"),
        F.expr(f"substring(value, length(header) + {len(GAP) + 1})").alias("body"),
    )
    rows = rows.withColumn("http", F.substring_index("body", GAP, 1))
    stated = F.regexp_extract("http", r"(?im)^Content-Length: *([0-9]+)", 1).try_cast("bigint")
    payload = F.expr(f"substring(body, length(http) + {len(GAP) + 1}, greatest(0, length(body) - length(http) - {2 * len(GAP)}))")
    rows = rows.select(*[c for c in rows.columns if c not in ("body", "http")], stated.alias("stated_bytes"), payload.alias("payload"))
    response = F.col("record_type") == "response"
    return rows.select(
        *[c for c in rows.columns if c not in ("payload", "stated_bytes", "stated_digest")],
        F.when(response, F.octet_length("payload").cast("bigint")).otherwise(F.col("stated_bytes")).alias("payload_bytes"),
        F.when(response, base32_sha1(F.col("payload"))).otherwise(F.col("stated_digest")).alias("payload_digest"),
    )


def reached(nodes: DataFrame) -> DataFrame:
    """(file, at) of the candidates that the chain from offset 0 passes; nodes are (file, at, to)."""
    jumps = pinned(nodes)
    found = pinned(jumps.where("at = 0").select("file", "at"))
    total, before = found.count(), 0
    while total > before:
        before = total
        next_ones = found.join(jumps, ["file", "at"]).select("file", F.col("to").alias("at"))
        there = nodes.select("file", "at")
        found = pinned(found.unionAll(next_ones.join(there, ["file", "at"], "left_semi")).distinct())
        second = jumps.select("file", F.col("at").alias("to"), F.col("to").alias("after"))
        jumps = pinned(jumps.join(second, ["file", "to"]).select("file", "at", F.col("after").alias("to")))
        total = found.count()
    return found


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per verified record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Size and digest of a response are measured on the payload that was read; a revisit has
    those it states.  Pieces the chain never reaches count as payload of the record before.
    """
    rows = _parsed(_pieces(spark, path), "file", "block", "number")
    in_file = Window.partitionBy("file").orderBy("block", "number")
    length = F.col("held") + len(MAGIC)
    before = F.coalesce(F.sum(length).over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # The piece before a file's first magic line stands at a negative offset.
    rows = pinned(rows.withColumn("at", before - len(MAGIC)).where("at >= 0"))
    step = F.lit(len(MAGIC) + 2 * len(GAP)) + F.col("header_bytes") + F.col("content")
    nodes = pinned(rows.select("file", "at", (F.col("at") + step).alias("to")))
    chain = reached(nodes).withColumn("real", F.lit(True))
    marked = rows.join(chain, ["file", "at"], "left")
    to_here = Window.partitionBy("file").orderBy("at")
    marked = marked.withColumn("record", F.last(F.when(F.col("real"), F.col("at")), ignorenulls=True).over(to_here))
    marked = pinned(marked.where("record IS NOT NULL"))
    cut = marked.where("real IS NULL").select("file", "record").distinct()
    result = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    whole = marked.where("real").join(cut.withColumnRenamed("record", "at"), ["file", "at"], "left_anti").select(*result)
    places = marked.join(cut, ["file", "record"]).select("file", "block", "number", "record", "at", "held")
    # Pieces of cut records are read again.  They are numbered as before unless the cluster has grown or shrunk meanwhile.
    texts = places.join(_pieces(spark, path), ["file", "block", "number"], "left")
    same = F.octet_length("value").cast("bigint").eqNullSafe(F.col("held"))
    changed = F.raise_error(F.lit("The archives were split in another way at the second reading; run the job again.")).cast("string")
    texts = texts.withColumn("value", F.when(same, F.col("value")).otherwise(changed))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda p: p["value"]), MAGIC)
    mended = _parsed(texts.groupBy("file", "record").agg(joined.alias("value"))).select(*result)
    return whole.unionAll(mended)


def archived(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write pages to archives (in the shared folder if no path is given) and read them back.

    One row per row of pages.  Null html is an empty payload; null urls and ids have no
    header field.  Other columns are ignored; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path)
