"""Token counts without token ids.

A task turns its documents into an inverted index, a block of text at a time: for each
distinct pre-token of the block, the documents it is in and how often.  Pre-tokens are
dealt into buckets by their hash, and a block sends one packed row to each bucket.
There each distinct pre-token is counted once, its count meets its frequencies, and
a packed row of sums per block goes back to the block's documents.  Rows are
as many as blocks times buckets; the library makes ids of the distinct pre-tokens of a
bucket, of which only their number is kept, and none of any text.

A pre-token found in many documents of a block is dealt to one of a fixed number of
shares by a hash of the block, so the very common ones do not meet in one task; such a
pre-token is counted once in each share, up to `SHARES` times.
"""

from __future__ import annotations

import itertools
import os
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import keyed_text, once
from tidemark.llm.pretokens import Splitter, special_tokens

#: Characters and rows in one block of the index; a block has at least one document.
BLOCK_CHARACTERS = 12_000_000
BLOCK_ROWS = 60_000
#: A pre-token in more than 1 of so many documents of a block is dealt to so many shares.
HOT_FRACTION, SHARES = 16, 64
TOKEN_LIMIT = 512
_COUNTED = 400_000
_POSTING = np.dtype([("document", "<u2"), ("times", "u1")])
_INDEX = "block bigint, bucket int, pieces array<string>, lengths binary, postings binary, doc_ids array<bigint>, sizes array<bigint>, specials array<bigint>"
_REPLY = np.dtype([("document", "<u2"), ("tokens", "<u4")])


def mixed(block: int) -> int:
    """A hash of a block's number, which is a row number: its low bits are those of few partitions."""
    return zlib.crc32(block.to_bytes(8, "little"))


def _dealt(rows: list[Counter], block: int, buckets: int) -> Iterator[tuple[int, list[str], bytes, bytes]]:
    """(bucket, its pre-tokens, number of postings of each, packed postings) of a block's counted documents."""
    pieces = list(itertools.chain.from_iterable(rows))
    numbers = {piece: k for k, piece in enumerate(dict.fromkeys(pieces))}
    codes = np.fromiter(map(numbers.__getitem__, pieces), np.int64, len(pieces))
    distinct = np.array([*numbers, None], dtype=object)[:-1]
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    documents = np.repeat(np.arange(len(rows), dtype=np.uint16), sizes)
    times = np.fromiter(itertools.chain.from_iterable(c.values() for c in rows), np.int64, len(pieces))
    hashes = np.fromiter((zlib.crc32(p.encode()) for p in distinct), np.int64, len(distinct))
    hot = np.bincount(codes, minlength=len(distinct)) * HOT_FRACTION > max(len(rows), HOT_FRACTION)
    bucket = np.where(hot, hashes + mixed(block) % SHARES * 7919, hashes) % buckets
    # A posting holds at most 255 times; larger numbers take several postings.
    copies = np.maximum(1, -(-times // 255))
    by_bucket = np.lexsort((codes, bucket[codes]))
    codes, documents, times, copies = codes[by_bucket], documents[by_bucket], times[by_bucket], copies[by_bucket]
    packed = np.empty(copies.sum(), _POSTING)
    packed["document"] = np.repeat(documents, copies)
    packed["times"] = 255
    packed["times"][np.cumsum(copies) - 1] = times - 255 * (copies - 1)
    lengths = np.bincount(codes, copies, len(distinct)).astype("<u4")
    order = np.lexsort((np.arange(len(distinct)), bucket))
    used, starts = np.unique(bucket[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    at = 0
    for number, start, end in zip(used.tolist(), starts.tolist(), ends.tolist()):
        mine = order[start:end]
        stop = at + int(lengths[mine].sum())
        yield number, distinct[mine].tolist(), lengths[mine].tobytes(), packed[at:stop].tobytes()
        at = stop


def _index(tokenizer_path: str, buckets: int):
    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        splitter = once(f"splitter {tokenizer_path}", lambda: Splitter(special_tokens(tokenizer_path)))
        for batch in batches:
            total, start = 0, 0
            for k, size in enumerate(batch["text"].str.len()):
                if k > start and (total + size > BLOCK_CHARACTERS or k - start >= BLOCK_ROWS):
                    yield one(splitter, batch.iloc[start:k])
                    total, start = 0, k
                total += size
            if len(batch):
                yield one(splitter, batch.iloc[start:])

    def one(splitter: Splitter, rows: pd.DataFrame) -> pd.DataFrame:
        counted, specials = [], []
        for text in rows["text"]:
            pieces, special = Counter(), 0
            for words, mark in splitter.lists(text):
                pieces.update(words)
                special += mark is not None
            counted.append(pieces)
            specials.append(special)
        block = int(rows["row"].iloc[0])
        dealt = [(block, *d, None, None, None) for d in _dealt(counted, block, buckets)]
        # The documents themselves travel once, so that those without any pre-token have a row too.
        ids = [None if pd.isna(x) else int(x) for x in rows["doc_id"]]
        own = (block, mixed(block) % buckets, [], b"", b"", ids, rows["size"].tolist(), specials)
        return pd.DataFrame([*dealt, own], columns=["block", "bucket", "pieces", "lengths", "postings", "doc_ids", "sizes", "specials"])

    return blocks


def _counted(tokenizer_path: str):
    """Replies (block, sums) of the index rows; the documents' own rows pass through."""

    def load() -> tuple[Tokenizer, dict[str, int]]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        return Tokenizer.from_file(tokenizer_path), {}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer, counts = once(f"counts {tokenizer_path}", load)
        for batch in batches:
            sums = []
            for pieces, lengths, postings in zip(batch["pieces"], batch["lengths"], batch["postings"]):
                new = [p for p in pieces if p not in counts]
                if len(counts) + len(new) > _COUNTED:
                    counts.clear()
                    new = list(pieces)
                counts.update(zip(new, (len(e.ids) for e in tokenizer.encode_batch_fast(new, add_special_tokens=False))))
                each = np.fromiter(map(counts.__getitem__, pieces), np.int64, len(pieces))
                found = np.frombuffer(postings, _POSTING)
                tokens = np.bincount(found["document"], np.repeat(each, np.frombuffer(lengths, "<u4")) * found["times"])
                documents = np.flatnonzero(tokens)
                reply = np.empty(len(documents), _REPLY)
                reply["document"], reply["tokens"] = documents, tokens[documents]
                sums.append(reply.tobytes())
            yield pd.DataFrame({"block": batch["block"], "sums": sums, **{c: batch[c] for c in ("doc_ids", "sizes", "specials")}})

    return run


def _documents(rows: pd.DataFrame) -> pd.DataFrame:
    """The documents of one block, from its own row and the replies of the buckets."""
    own = rows[rows["doc_ids"].notna()].iloc[0]
    replies = np.frombuffer(b"".join(rows["sums"]), _REPLY)
    tokens = np.bincount(replies["document"], replies["tokens"], len(own["doc_ids"])).astype(np.int64)
    ids = pd.array([None if pd.isna(x) else int(x) for x in own["doc_ids"]], "Int64")
    return pd.DataFrame({"doc_id": ids, "n_bytes": own["sizes"], "n_tokens": tokens + np.asarray(own["specials"], np.int64)})


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_tokens, over_limit (more than `limit` tokens).

    Counts are those of the vocabulary file's library without added special tokens; a
    special string in a text is one token.  Null text counts as empty: 0 bytes, 0
    tokens.  Repeated rows and null ids each keep their row, because rows are told
    apart by their place in the input.  An empty table gives an empty result.
    """
    rows = keyed_text(docs).select(
        "doc_id", "text", F.monotonically_increasing_id().alias("row"), F.octet_length("text").cast("bigint").alias("size")
    )
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = rows.mapInPandas(_index(tokenizer_path, buckets), _INDEX).repartition("bucket")
    replies = index.mapInPandas(_counted(tokenizer_path), "block bigint, sums binary, doc_ids array<bigint>, sizes array<bigint>, specials array<bigint>")
    found = replies.groupBy("block").applyInPandas(_documents, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
