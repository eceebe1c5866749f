"""Benchmark decontamination by spaced seeds.

A mask looks at five of eight neighbouring words and ignores the others, so a seed is
unchanged by a substituted word at an ignored place.  Where items are so short that the
allowed substitutions can touch every seed, shorter masks look besides; an item of fewer
words than a mask spans is looked up by the hash of all its words.  Every position of every document
is hashed under every mask and looked up among the seeds of the benchmark items.  A hit
fixes how the item lies on the document; the whole item is then compared word by word
along that line, and the pair is reported if enough words agree.

The lookup is a broadcast join.  The benchmark's words are counted first; a benchmark
with more than SEED_WORDS of them is looked up in blocks of items, one pass over the
documents per block, so what is broadcast stays bounded.  Seeds carry the key of their
item only; its words are broadcast once beside them.  Verification happens beside the
hit, before anything is shuffled.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import where_late

#: Places a mask looks at; all masks span as many words.
MASKS = ((0, 1, 2, 4, 7), (0, 1, 4, 6, 7), (0, 2, 3, 5, 7))
SPAN = 8
#: Item lengths at which a share of LEAST_SHARE can agree without any seed of MASKS, and the masks for them.
SHORT_LENGTHS = (8, 10, 11, 15, 16, 17)
SHORT_MASKS = ((0, 1, 2, 4), (0, 2, 3, 4))
SHORT_SPAN = 5
#: An item counts as contained if this share of its words agrees, or a stretch scores this much.
LEAST_SHARE = 0.8
LEAST_STRETCH = 13
_MISMATCH = 4
#: Words of benchmark items that are broadcast at once, each with three or five seeds of three numbers; a word of more
#: than _WORD_BYTES counts as so many words as it has such parts.  One item is never split.
SEED_WORDS = 500_000
_WORD_BYTES = 16


def tokens(text: Column) -> Column:
    """Lower-case words; ASCII other than letters and digits separates them."""
    return F.filter(F.split(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1), lambda w: w != "")


class _Masks(NamedTuple):
    """Masks of one span, numbered from `first`; of the items they take those for which `items` holds."""

    masks: tuple
    span: int
    first: int
    items: Column


def _mask_groups(sizes: list[int]) -> list[_Masks]:
    """The masks that items of these sizes call for; items below SPAN words have one mask, of all their words."""
    size = F.size("words")
    groups = [_Masks(MASKS, SPAN, 0, size >= SPAN)]
    if any(n in SHORT_LENGTHS for n in sizes):
        groups.append(_Masks(SHORT_MASKS, SHORT_SPAN, len(MASKS), size.isin(*SHORT_LENGTHS)))
    whole = len(MASKS) + len(SHORT_MASKS)
    return groups + [_Masks((tuple(range(n)),), n, whole + n, size == n) for n in sizes if n < SPAN]


def _seeds(hashes: Column, group: _Masks) -> Column:
    """Seeds under each mask, all positions of one after those of the other."""
    last = F.size(hashes) - group.span
    under = lambda number, mask: F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.lit(number), *[F.get(hashes, i + place) for place in mask])
    )
    return F.when(last >= 0, F.concat(*[under(group.first + number, mask) for number, mask in enumerate(group.masks)]))


def _seeded(rows: DataFrame, groups: list[_Masks], items: bool = False) -> DataFrame:
    """Rows with `words`, one per seed: adds `seed` and `at`, the position of its first word; of items by their own masks only."""
    hashed = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    none = F.array().cast("array<bigint>")
    lists, at, before = [], F.lit(None), F.lit(0)
    for group in groups:
        seeds = _seeds(F.col("hashes"), group)
        places = F.greatest(F.size("words") - group.span + 1, F.lit(0))
        if items:
            seeds, places = F.when(group.items, seeds), F.when(group.items, places).otherwise(0)
        lists.append(F.coalesce(seeds, none))
        number = F.col("number") - before
        # Of the groups a number lies beyond the beginning of, the last one with any place holds it.
        at = F.when((number >= 0) & (places > 0), number % F.greatest(places, F.lit(1))).otherwise(at)
        before = before + places * len(group.masks)
    seeds = F.concat(*lists) if len(lists) > 1 else lists[0]
    # The outer form: for the inner one the optimizer adds a filter on `seeds` and computes them twice.
    found = hashed.select(*rows.columns, seeds.alias("seeds")).select(*rows.columns, F.posexplode_outer("seeds").alias("number", "seed"))
    return found.select(*rows.columns, "seed", at.cast("int").alias("at"))


def _stretch(agrees: Column) -> Column:
    """Best sum over a stretch of neighbours: 1 for an agreeing word, -4 for another."""
    start = F.struct(F.lit(0).alias("here"), F.lit(0).alias("best"))

    def step(a: Column, ok: Column) -> Column:
        here = F.greatest(F.lit(0), a["here"] + F.when(ok, 1).otherwise(-_MISMATCH))
        return F.struct(here.alias("here"), F.greatest(a["best"], here).alias("best"))

    return F.aggregate(agrees, start, step, lambda a: a["best"])


def _in_block(docs: DataFrame, items: DataFrame, groups: list[_Masks]) -> DataFrame:
    """Verified pairs of docs (doc_id, digest, words) and items (item_id, key, words), with one row or more each."""
    seeds = _seeded(items.select("key", "words"), groups, items=True).select("seed", "key", F.col("at").alias("item_at"))
    whole = items.select("key", "item_id", F.col("words").alias("item"))
    hits = _seeded(docs, groups).join(F.broadcast(seeds), "seed").join(F.broadcast(whole), "key")
    line = F.col("at") - F.col("item_at")
    # Only the words under the item go on; the lambda below names them twice, so the slice is not computed within it.
    cut = F.slice("words", F.greatest(line, F.lit(0)) + 1, F.size("item") + F.least(line, F.lit(0)))
    laid = hits.select("doc_id", "digest", "item_id", line.alias("start"), "item", cut.alias("under"))
    agrees = F.transform(
        "item",
        lambda w, i: (i + F.least(F.col("start"), F.lit(0)) < F.size("under")) & F.coalesce(F.get("under", i + F.least(F.col("start"), F.lit(0))) == w, F.lit(False)),
    )
    laid = laid.select("doc_id", "digest", "item_id", "start", agrees.alias("agrees"))
    scored = laid.select(
        "doc_id", "digest", "item_id", "start",
        F.size("agrees").alias("item_words"),
        F.size(F.filter("agrees", lambda ok: ok)).alias("matched_words"),
        _stretch(F.col("agrees")).alias("stretch"),
    )
    share = F.when(F.col("item_words") < SPAN, 1.0).otherwise(LEAST_SHARE)
    enough = (F.col("matched_words") >= share * F.col("item_words")) | (F.col("stretch") >= LEAST_STRETCH)
    return where_late(scored, enough)


def _overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, digest of the text, item_id, start, item_words, matched_words, stretch), best line of each pair."""
    rows = docs.select(
        "doc_id", F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("digest"), tokens(F.coalesce(docs["text"], F.lit(""))).alias("words")
    )
    items = benchmark.select("item_id", tokens(F.coalesce(benchmark["text"], F.lit(""))).alias("words")).where(F.size("words") > 0)
    items = items.distinct().withColumn("key", F.xxhash64("item_id", "words"))
    load = F.aggregate("words", F.lit(0).cast("bigint"), lambda a, w: a + F.ceil(F.octet_length(w) / _WORD_BYTES))
    # Sizes that call for masks of their own: there are only so many of them.
    listed = F.when(F.size("words").isin(*range(1, SPAN), *SHORT_LENGTHS), F.size("words"))
    total, sizes = items.agg(F.sum(load), F.array_sort(F.collect_set(listed))).first()
    blocks = -(-(total or 0) // SEED_WORDS) or 1
    block = F.pmod("key", F.lit(blocks))
    found = reduce(DataFrame.unionAll, [_in_block(rows, items.where(block == k) if blocks > 1 else items, _mask_groups(sizes)) for k in range(blocks)])
    best = F.max(F.struct("matched_words", "stretch", (-F.col("start")).alias("back"), "item_words")).alias("best")
    return (
        found.groupBy("doc_id", "digest", "item_id").agg(best)
        .select("doc_id", "digest", "item_id", "best.item_words", "best.matched_words", "best.stretch", (-F.col("best.back")).alias("start"))
    )


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item it contains: doc_id, item_id, item_words, matched_words, similarity, start.

    Words are compared in lower case without ASCII punctuation.  `start` is the word of the
    document under the item's first word (negative if the document begins within the
    item).  A pair counts if at least 0.8 of the item's words agree in place, or a
    stretch of the item scores 13 at 1 per agreeing word and -4 per other.  An item of
    fewer than 8 words counts only where all its words agree; null and empty texts match
    nothing; repeated rows of a document give one row; an empty table gives no rows.
    """
    best = F.max_by(F.struct("item_words", "matched_words", "start"), F.struct("matched_words", "digest")).alias("best")
    pairs = _overlaps(docs, benchmark).groupBy("doc_id", "item_id").agg(best)
    return pairs.select(
        "doc_id", "item_id", "best.item_words", "best.matched_words",
        (F.col("best.matched_words") / F.col("best.item_words")).alias("similarity"), "best.start",
    )


def uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that contain no item, with their columns as they were."""
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("id"),
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("row_digest"),
    )
    found = _overlaps(docs, benchmark).select("doc_id", "digest").distinct()
    same = row["id"].eqNullSafe(found["doc_id"]) & (row["row_digest"] == found["digest"])
    return row.join(found, same, "left_anti").select("row.*")
