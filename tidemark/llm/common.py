"""Helpers that several operators of this package share."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

#: ASCII white space, as a character class: space, tab, line feed, vertical tab, form feed, return.
BLANKS = r"[\x20\x09-\x0D]+"
BLANK_CHARACTERS = " \t\n\v\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_text(docs: DataFrame, *more: str) -> DataFrame:
    """The columns an operator works on; any other column, whatever its name, is left out. Null text counts as empty."""
    return docs.select("doc_id", F.coalesce(docs["text"], F.lit("")).alias("text"), *more)


def words_of(text: Column) -> Column:
    """Array of the maximal runs without ASCII white space."""
    inner = F.btrim(text, F.lit(BLANK_CHARACTERS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, BLANKS, -1))


def running_sum(lengths: Column, block: int = 256) -> Column:
    """Exclusive prefix sums of an array of longs.

    Two levels of blocks, so an array of n costs about n ** 1.5 copies instead of n ** 2.
    """

    def scan(values: Column, start: Column) -> Column:
        first = F.struct(start.alias("at"), F.array().cast("array<bigint>").alias("out"))
        step = lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out"))
        return F.aggregate(values, first, step, lambda a: a["out"])

    zero = F.lit(0).cast("bigint")
    count = F.floor((F.size(lengths) + block - 1) / block).cast("int")
    numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    blocks = F.transform(numbers, lambda b: F.slice(lengths, b * block + 1, block))
    starts = scan(F.transform(blocks, lambda part: F.aggregate(part, zero, lambda a, x: a + x)), zero)
    return F.flatten(F.zip_with(blocks, starts, scan))


def pinned(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder of `spark.checkpoint.dir`, evaluated now."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder a cluster names; without one, a folder in the warehouse, which every executor reaches too."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def exact_id(name: str = "doc_id") -> list[Column]:
    """An id column as (id, known) for Python workers, which get a nullable bigint as floats."""
    return [F.coalesce(F.col(name), F.lit(0)).alias("id"), F.col(name).isNotNull().alias("known")]


def word_blocks(text: str, size: int = 4_000_000) -> Iterator[list[bytes]]:
    """Words of the text with A-Z lower-cased, in UTF-8, some megabytes of text at a time.

    The white space of bytes.split is exactly the ASCII white space of BLANKS, and
    bytes.lower touches A-Z alone.
    """
    at = 0
    while at < len(text):
        end = at + size
        while end < len(text) and text[end] not in " \t\n\v\f\r":
            end += 1
        yield text[at:end].encode().lower().split()
        at = end


def once(key: str, make: Callable[[], T]) -> T:
    """make(), kept for the life of the Python process.

    Functions sent by value get new module globals in every task; `sys` stays, so a reused
    worker loads a tokenizer once.
    """
    kept = sys.__dict__.setdefault("_tidemark_once", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once, however often body uses it, also within lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def where_late(df: DataFrame, condition: Column) -> DataFrame:
    """df.where(condition) that stays above df's expressions.

    The optimizer copies a filter's columns into what it moves below; for array work that
    would compute them twice, or once per element.  A row number in the condition
    keeps the filter in its place.
    """
    numbered = df.select("*", F.monotonically_increasing_id().alias("row_in_place"))
    return numbered.where(condition & (F.col("row_in_place") >= 0)).drop("row_in_place")
