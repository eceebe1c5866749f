"""Ranked lexical search with the roles reversed: the items are indexed, the documents stream past.

The inverted index is over the terms of the items, which are few beside the documents, and
is broadcast.  One pass over the texts turns each document into the counts of those of
its terms that any item has; these go to a table.  Document frequencies, the number of
documents and their length are sums over it.  A second pass streams the counts through
the index: a term's contribution is added to every item on its posting list, and a
document enters the bounded heap of each item whose worst entry it beats.  A task emits its
heaps, and heaps are merged in two steps, so that no task meets those of all tasks.

Items beyond `INDEX_POSTINGS` postings are searched in blocks, each with its own index.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterator
from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import exact_id, pinned, scratch_path

#: Distinct terms of all items together in one broadcast index; an item is never split.
INDEX_POSTINGS = 1_000_000
TOP = 10
#: Groups in which the heaps of the tasks are merged first.
MERGE_GROUPS = 64
#: Bytes of text split at a time, and pairs of term and item added up at a time.
_PART, _PAIRS = 4_000_000, 2_000_000

#: ASCII letters and digits and all bytes of other characters belong to terms; A-Z become a-z.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_lists(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, a bounded list at a time."""
    at = 0
    while at < len(text):
        end = at + _PART
        while end < len(text) and _TERM_BYTES[text[end]] != 32:
            end += 1
        yield text[at:end].translate(_TERM_BYTES).split()
        at = end


def _text(rows: DataFrame):
    return F.coalesce(rows["text"], F.lit("")).cast("binary").alias("text")


def _item_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        terms = [sorted({t for part in term_lists(text) for t in part}) for text in batch["text"]]
        yield pd.DataFrame({"item": batch["item"], "id": batch["id"], "known": batch["known"], "terms": terms, "size": [len(t) for t in terms]})


class Index:
    """Posting lists of one block of items; weights are set once the documents are counted."""

    def __init__(self, items: pd.DataFrame):
        self.item_ids = [int(i) if known else None for i, known in zip(items["id"], items["known"])]
        self.items = items["item"].to_numpy(np.int64)
        numbers: dict[bytes, int] = {}
        term = np.array([numbers.setdefault(bytes(t), len(numbers)) for terms in items["terms"] for t in terms], np.int64)
        owner = np.repeat(np.arange(len(items)), [len(t) for t in items["terms"]])
        self.numbers = numbers
        self.lengths = np.bincount(term, minlength=len(numbers))
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.postings = owner[np.argsort(term, kind="stable")]
        self.weights = np.zeros(len(numbers), np.int64)
        self.total = self.terms_total = 0

    def weigh(self, total: int, terms_total: int, frequency: dict[int, int]) -> None:
        self.total, self.terms_total = total, terms_total
        for number, df in frequency.items():
            self.weights[number] = math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1)))

    def parts(self, spark: SparkSession):
        """Broadcast of the plain parts, which workers read without this package."""
        return spark.sparkContext.broadcast(dict(vars(self)))


def damping(lengths: np.ndarray, total: int, terms_total: int) -> np.ndarray:
    """m of documents of so many terms; in whole numbers of any size."""
    distinct, place = np.unique(lengths, return_inverse=True)
    return np.array([100 - 90 + 90 * int(n) * total // terms_total for n in distinct], np.int64)[place]


def _counts_of(shared) -> Callable:
    """Counts of the index's terms per document, as packed term numbers and times."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = shared.value["numbers"].get
        for batch in batches:
            rows = []
            for text in batch["text"]:
                found, total = Counter(), 0
                for part in term_lists(text):
                    total += len(part)
                    found.update(map(number, part))
                found.pop(None, None)
                terms, times = np.fromiter(found, "<u4", len(found)), np.fromiter(found.values(), "<i8", len(found))
                rows.append((total, terms.tobytes(), times.tobytes()))
            out = pd.DataFrame(rows, columns=["n", "terms", "times"])
            yield pd.concat([batch[["id", "known"]].reset_index(drop=True), out], axis=1)

    return run


def _frequencies(size: int) -> Callable:
    """Documents holding each term, summed over a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            held += np.bincount(np.frombuffer(b"".join(batch["terms"]), "<u4"), minlength=size)
        terms = np.flatnonzero(held)
        yield pd.DataFrame({"term": terms, "df": held[terms]})

    return run


class Heaps:
    """The best documents of each item so far, the worst of them on top.

    An entry is (score, not null, ~doc_id), so that of equal scores the smaller id is better
    and a null id comes last.
    """

    def __init__(self, items: int, size: int):
        self.size = size
        self.heaps: list[list[tuple[int, int, int]]] = [[] for _ in range(items)]
        self.worst = np.zeros((3, items), np.int64)  # parts of the entry to beat; until a heap is full, a score of 0

    def add(self, scores: np.ndarray, known: np.ndarray, order: np.ndarray) -> None:
        """scores of (document, item); known and order are the other parts of the documents' entries."""
        worst = self.worst
        better = scores > worst[0]
        rows, items = np.nonzero((scores == worst[0]) & (scores > 0))
        later = (known[rows] > worst[1, items]) | (known[rows] == worst[1, items]) & (order[rows] > worst[2, items])
        better[rows[later], items[later]] = True
        rows, items = np.nonzero(better)
        best_first = np.lexsort((~order[rows], -known[rows], -scores[rows, items], items))
        rows, items = rows[best_first], items[best_first]
        place = np.arange(len(items)) - np.searchsorted(items, items)
        rows, items = rows[place < self.size], items[place < self.size]
        for row, item in zip(rows.tolist(), items.tolist()):
            entry, heap = (int(scores[row, item]), int(known[row]), int(order[row])), self.heaps[item]
            if len(heap) < self.size:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.size:
                self.worst[:, item] = heap[0]


def _heaps_of(shared, size: int) -> Callable:
    """Streams counted documents through the index; the heaps of the task at its end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = SimpleNamespace(**shared.value)
        count = len(index.items)
        heaps = Heaps(count, size)
        for batch in batches:
            lengths = batch["n"].to_numpy(np.int64)
            known, order = batch["known"].to_numpy(np.int64), ~batch["id"].to_numpy(np.int64)
            held = (batch["terms"].str.len() // 4).to_numpy(np.int64)
            document = np.repeat(np.arange(len(batch)), held)
            term = np.frombuffer(b"".join(batch["terms"]), "<u4").astype(np.int64)
            times = np.frombuffer(b"".join(batch["times"]), "<i8")
            m = damping(lengths, index.total, index.terms_total)[document]
            gain = index.weights[term] * (1_000_000_000 * times // (1000 * times + 8 * m))
            ends, pairs = np.cumsum(held), np.concatenate([[0], np.cumsum(index.lengths[term])])
            first = 0
            while first < len(batch):
                begin = ends[first] - held[first]
                last = first + 1
                while last < len(batch) and last - first < max(1, 4 * _PAIRS // count) and pairs[ends[last]] - pairs[begin] <= _PAIRS:
                    last += 1
                scores = np.zeros((last - first) * count, np.int64)
                here = slice(begin, ends[last - 1])
                listed = index.lengths[term[here]]
                inside = np.arange(listed.sum()) - np.repeat(np.cumsum(listed) - listed, listed)
                item = index.postings[np.repeat(index.starts[term[here]], listed) + inside]
                np.add.at(scores, np.repeat(document[here] - first, listed) * count + item, np.repeat(gain[here], listed))
                heaps.add(scores.reshape(last - first, count), known[first:last], order[first:last])
                first = last
        found = [(k, s, ~order if known else None) for k, heap in enumerate(heaps.heaps) for s, known, order in heap]
        item_ids = pd.array([index.item_ids[k] for k, *_ in found], "Int64")
        yield pd.DataFrame({
            "item": [int(index.items[k]) for k, *_ in found], "item_id": item_ids,
            "doc_id": pd.array([d for *_, d in found], "Int64"), "score": [s for _, s, _ in found],
        })

    return run


def _merged(heaps: DataFrame, size: int) -> DataFrame:
    """The best `size` of all heaps of an item: among the tasks of a group first, then among groups."""
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    heaps = heaps.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    for keys in (("item", "part"), ("item",)):
        heaps = heaps.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*best))).where(F.col("rank") <= size)
    return heaps.select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, size: int = TOP, postings: int = INDEX_POSTINGS) -> DataFrame:
    """The `size` best documents of every row of items: item_id, rank (from 1), doc_id, score.

    docs has doc_id and text, items item_id and text; other columns are ignored.  Terms are the
    maximal runs of ASCII letters, digits and non-ASCII characters, only A-Z lower-cased.
    Only documents with a score above 0 are ranked, equal scores by ascending doc_id, a null id
    last.  Null and empty texts have no terms: such a document is found by no item and such an
    item finds none.  Repeated rows each count as a document or an item of their own.  Empty
    tables give an empty result.  Texts of any length are taken whole.  Each block of items reads the texts again;
    scoring a block costs far more than that.
    """
    spark = docs.sparkSession
    rows = docs.select(*exact_id(), _text(docs))
    listed = items.select(F.monotonically_increasing_id().alias("item"), *exact_id("item_id"), _text(items))
    listed = pinned(listed.mapInPandas(_item_terms, "item bigint, id bigint, known boolean, terms array<binary>, size bigint").where("size > 0"))
    blocks = max(1, -(-(listed.agg(F.sum("size")).first()[0] or 0) // postings))
    folder, found = scratch_path(spark, "search"), []
    for block in range(blocks):
        index = Index(listed.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).drop("size").orderBy("item").toPandas())
        if not len(index.items):
            continue
        path = f"{folder}/counts-{block}"
        rows.mapInPandas(_counts_of(index.parts(spark)), "id bigint, known boolean, n bigint, terms binary, times binary").write.parquet(path)
        counts = spark.read.parquet(path)
        total, terms_total = counts.where("n > 0").agg(F.count("*"), F.sum("n")).first()
        held = counts.select("terms").mapInPandas(_frequencies(len(index.numbers)), "term bigint, df bigint")
        index.weigh(total, terms_total or 0, {r["term"]: r["df"] for r in held.groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator()})
        heaps = counts.where(F.octet_length("terms") > 0).mapInPandas(_heaps_of(index.parts(spark), size), "item bigint, item_id bigint, doc_id bigint, score bigint")
        best = _merged(heaps, size)
        if blocks > 1:
            best.write.parquet(f"{folder}/best-{block}")
            best = spark.read.parquet(f"{folder}/best-{block}")
        found.append(best)
    if not found:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    result = found[0]
    for more in found[1:]:
        result = result.unionAll(more)
    return result
