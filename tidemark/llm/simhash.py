"""SimHash near-duplicate groups by segment-popcount embedding.

A fingerprint's 64 bits are cut into 16 segments of four; the bit counts of the
segments are its place in a grid.  The Manhattan distance of two places never exceeds
the Hamming distance of the fingerprints, and two places at distance two or less have
a grid point within one step of both.  So each distinct fingerprint stands on its own
grid point and the points one step away, and fingerprints can only be linked if they
meet on a point: that is the range join.  Whoever meets is verified exactly: two
fingerprints differ in at most two bits if and only if some 64-bit value is within one
bit of both, and at most 65 fingerprints are within one bit of a value.  Each such
value links its fingerprints to the smallest of them, so a dense group gives a number
of links in proportion to its members, and no pair is missed.

Copies share one fingerprint and are a single node; the documents come back at the end
by a join on the fingerprint, which adaptive execution splits where it is skewed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.llm.common import keyed_text, pinned, word_blocks

SHINGLE_WORDS = 3
SEED = 42
SEGMENTS = 16
_WIDTH = 64 // SEGMENTS


def fingerprint(text: str, size: int = SHINGLE_WORDS) -> int:
    """SimHash over word shingles, repeats included, as a signed 64-bit integer; 0 without words."""
    counts, total, carried = np.zeros(64, np.int64), 0, []
    for block in word_blocks(text):
        words = carried + block
        shingles = map(b" ".join, zip(*(words[k:] for k in range(size))))
        hashes = np.fromiter((xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
        for at in range(0, len(hashes), 1 << 16):
            part = hashes[at : at + (1 << 16)]
            counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
        carried = words[-(size - 1) :] if size > 1 else []
    if not total and carried:
        hashes = np.array([xxh64_intdigest(b" ".join(carried), SEED)], np.uint64)
        counts, total = np.unpackbits(hashes.view(np.uint8), bitorder="little").astype(np.int64), 1
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, extra: str = "") -> DataFrame:
    """(doc_id, fp) of every row of docs; `extra` names a long column to carry along."""
    schema = "doc_id bigint, fp bigint" + (f", {extra} bigint" if extra else "")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = {"doc_id": batch["doc_id"].astype("Int64"), "fp": [fingerprint(t) for t in batch["text"]]}
            yield pd.DataFrame(out | ({extra: batch[extra]} if extra else {}))

    return keyed_text(docs, *[extra] * bool(extra)).mapInPandas(run, schema)


def _counts(fp: Column) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(fp, _WIDTH * k).bitwiseAND((1 << _WIDTH) - 1)).cast("bigint") for k in range(SEGMENTS)]


def _places(distinct: DataFrame) -> DataFrame:
    """(fp, cell, segment, step): the fingerprint's grid point and all points one step from it."""
    counts = _counts(F.col("fp"))
    place = sum((F.shiftleft(c, 4 * k) for k, c in enumerate(counts[1:], 1)), counts[0])
    entry = lambda cell, k, step: F.struct(cell.alias("cell"), F.lit(k).alias("segment"), F.lit(step).alias("step"))
    entries = [entry(F.col("place"), -1, 0)]
    for k in range(SEGMENTS):
        one = F.lit(1 << (4 * k)).cast("bigint")
        count = F.shiftrightunsigned("place", 4 * k).bitwiseAND(15)
        entries += [
            F.when(count < _WIDTH, entry(F.col("place") + one, k, 1)),
            F.when(count > 0, entry(F.col("place") - one, k, -1)),
        ]
    return (
        distinct.select("fp", place.alias("place"))
        .select("fp", F.explode(F.array_compact(F.array(*entries))).alias("e"))
        .select("fp", "e.cell", "e.segment", "e.step")
    )


def links(distinct: DataFrame) -> DataFrame:
    """(a, b), a > b: links that connect exactly the fingerprints connected by steps of two bits or fewer."""
    places = _places(distinct)
    met = places.groupBy("cell").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low < high")
    close = places.join(met.select("cell"), "cell", "left_semi")
    # A value on the point `cell` is the fingerprint itself, or one bit of that segment away.
    moved = [
        F.when((F.getbit("fp", F.col("segment") * _WIDTH + b) == 0) == (F.col("step") == 1), F.lit(b)) for b in range(_WIDTH)
    ]
    values = F.when(F.col("step") == 0, F.array(F.col("fp"))).otherwise(
        F.transform(
            F.array_compact(F.array(*moved)),
            lambda b: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("segment") * _WIDTH + b)),
        )
    )
    shared = (
        close.where("step = 0").select("fp", F.col("fp").alias("value"))
        .unionAll(close.where("step <> 0").select("fp", F.explode(values).alias("value")))
    )
    hubs = shared.groupBy("value").agg(F.collect_set("fp").alias("members")).where(F.size("members") > 1)
    pairs = hubs.select(F.explode("members").alias("a"), F.array_min("members").alias("b"))
    return pairs.where((F.col("a") > F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node of the component, for every node that has a link.

    Alternating large-star and small-star rounds; each halves the distance to the root,
    and each is checkpointed.  Minima are aggregated before the shuffle and joined back,
    so a node with very many links is never gathered into one group.
    """
    state = lambda df: df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    edges = pinned(edges)
    before = None
    while (now := state(edges)) != before:
        before = now
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
            .unionAll(low.select("a", F.col("low").alias("b")))
            .distinct()
        )
        edges = pinned(small)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def group_labels(marked: DataFrame, first: Column) -> DataFrame:
    """(fp, label): `first` is an aggregate of `marked` per fingerprint, label its minimum over the component."""
    classes = pinned(marked.groupBy("fp").agg(first.alias("first")))
    roots = pinned(components(links(classes.select("fp"))))
    labels = (
        roots.join(classes, roots["node"] == classes["fp"]).groupBy("root").agg(F.min("first").alias("label"))
    )
    linked = roots.join(labels, "root").select(F.col("node").alias("fp"), "label")
    return classes.join(linked, "fp", "left").select("fp", F.coalesce("label", "first").alias("label"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 hex digits), component_id.

    Null text counts as empty; texts without words have fingerprint zero.  Repeated rows
    each get a row.  A null doc_id is never a component's id unless all its ids are null.
    An empty table gives an empty result.
    """
    marked = pinned(fingerprints(docs))
    found = marked.join(group_labels(marked, F.min("doc_id")), "fp")
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("label").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of docs without near-duplicates: of each component the row with the smallest doc_id stays.

    Null ids come last.  Rows of one id are told apart by a digest of their text; rows
    equal in both are copies, of which one stays.
    """
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), digest.alias("digest"))
    marked = pinned(fingerprints(docs.select("doc_id", "text", digest.alias("digest")), "digest"))
    place = F.struct(F.col("doc_id").isNull().alias("absent"), F.col("doc_id").alias("id"), F.col("digest").alias("digest"))
    kept = group_labels(marked, F.min(place)).groupBy("label").agg(F.lit(1)).select("label.id", "label.digest")
    kept = kept.select(F.col("id").alias("kept_id"), F.col("digest").alias("kept_digest"))
    stays = row.join(kept, row["id"].eqNullSafe(kept["kept_id"]) & (row["digest"] == kept["kept_digest"]), "left_semi")
    return stays.dropDuplicates(["id", "digest"]).select("row.*")
