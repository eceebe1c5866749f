"""Token ids in binary files of patched frame-of-reference blocks.

A file holds the ids of whole documents, one after the other, in blocks of `BLOCK` ids.
A block subtracts its minimum and packs the differences at the width that `PERCENT` of
them fit; of the others the low bits are packed too, and their places and high bits stand in
an exception list behind.  The starts of the blocks are indexed, so any stretch of ids is
read by unpacking the blocks it touches.  All numbers are little-endian:

    magic                     8 bytes
    blocks                    u4 minimum, u1 width, u1 exceptions, packed differences,
                              u1 place of each exception, u4 high bits of each
    block starts              u4 each
    documents                 i8 id, u1 id is known, u4 ids: three arrays
    footer (64 bytes)         u8 documents, u8 ids, u8 blocks, u8 offset of the starts,
                              u8 offset of the documents, u4 part, u4 number within it,
                              u4 CRC-32 of all before, 4 zero bytes, magic

Files are written by Spark's text writer, one row a file, so a lost task is simply written
again; the line break it adds after the footer is not part of the format.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import exact_id, once, scratch_path

MAGIC = b"PFORIDS1"
BLOCK = 128
PERCENT = 90
#: A file is closed once it has so many ids; a document is never split.
FILE_IDS = 2_000_000
#: Id of the mark that ends a document.
END = 1
#: Encoded words remembered per Python process, and the longest of them in bytes.
REMEMBERED_WORDS, _LONGEST = 1_000_000, 64
_HEAD, _PART, _ROWS = 6, 4_000_000, 1_000
_FOOTER, _FOOTER_BYTES = "<5Q3I4x8s", 64
#: Files whose ids are summed by one task for the starts of the documents.
_FILES_TOGETHER = 1000


# ---- blocks ---------------------------------------------------------------------------


_DIGITS = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def _some(chosen: np.ndarray) -> list[np.ndarray]:
    """The places that are chosen, a bounded number at a time."""
    places = np.flatnonzero(chosen)
    return np.array_split(places, len(places) // 4096 + 1)


def pack(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Blocks of the ids (unsigned 32-bit), one after the other, and the start of each.

    The last block is filled up with copies of the last id.
    """
    if not len(ids):
        return b"", np.zeros(0, "<u4")
    count = -(-len(ids) // BLOCK)
    rows = np.concatenate([ids, np.full(count * BLOCK - len(ids), ids[-1])]).astype(np.uint32).reshape(count, BLOCK)
    least = rows.min(1)
    rest = rows - least[:, None]
    # Binary digits of each difference; those of up to sixteen are looked up.
    bits = _DIGITS[rest] if rest.max() < len(_DIGITS) else np.frexp(rest.astype(np.float64))[1].astype(np.uint8)
    fits = -(-PERCENT * BLOCK // 100) - 1
    width = np.partition(bits, fits, 1)[:, fits].astype(np.int64)
    beyond = bits > width[:, None]
    exceptions = beyond.sum(1)
    packed = width * (BLOCK // 8)
    sizes = _HEAD + packed + 5 * exceptions
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    out[starts[:, None] + np.arange(4)] = least.astype("<u4").view(np.uint8).reshape(count, 4)
    out[starts + 4], out[starts + 5] = width, exceptions
    for w in np.unique(width[width > 0]).tolist():
        for some in _some(width == w):
            bits = np.unpackbits(rest[some].astype("<u4").view(np.uint8).reshape(-1, BLOCK, 4), axis=2, bitorder="little")
            each = np.packbits(bits[:, :, :w].reshape(len(some), -1), axis=1, bitorder="little")
            out[(starts[some] + _HEAD)[:, None] + np.arange(w * BLOCK // 8)] = each
    block, place = np.nonzero(beyond)
    nth = np.arange(len(block)) - (np.cumsum(exceptions) - exceptions)[block]
    lists = (starts + _HEAD + packed)[block]
    out[lists + nth] = place
    high = (rest[block, place] >> width[block].astype(np.uint32)).astype("<u4").view(np.uint8).reshape(-1, 4)
    out[(lists + exceptions[block] + 4 * nth)[:, None] + np.arange(4)] = high
    return out.tobytes(), starts.astype("<u4")


def unpack(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at `starts` of data (bytes), in that order."""
    starts = starts.astype(np.int64)
    least = np.ascontiguousarray(data[starts[:, None] + np.arange(4)]).view("<u4")[:, 0]
    width, exceptions = data[starts + 4].astype(np.int64), data[starts + 5].astype(np.int64)
    rows = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        for some in _some(width == w):
            each = np.unpackbits(data[(starts[some] + _HEAD)[:, None] + np.arange(w * BLOCK // 8)], axis=1, bitorder="little")
            bits = np.zeros((len(some), BLOCK, 32), np.uint8)
            bits[:, :, :w] = each.reshape(len(some), BLOCK, w)
            rows[some] = np.packbits(bits, axis=2, bitorder="little").view("<u4")[:, :, 0]
    block = np.repeat(np.arange(len(starts)), exceptions)
    nth = np.arange(len(block)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
    lists = (starts + _HEAD + width * (BLOCK // 8))[block]
    high = np.ascontiguousarray(data[(lists + exceptions[block] + 4 * nth)[:, None] + np.arange(4)]).view("<u4")[:, 0]
    # A width of 32 leaves no high bits, so there are no exceptions then.
    rows[block, data[lists + nth]] |= high << width[block].astype(np.uint32)
    return (rows + least[:, None]).reshape(-1)


# ---- files ----------------------------------------------------------------------------


def file_of(doc_ids: list[int | None], ids: list[np.ndarray], part: int = 0, number: int = 0) -> bytes:
    """One file with the given documents in order."""
    whole = np.concatenate(ids).astype(np.uint32) if ids else np.zeros(0, np.uint32)
    blocks, starts = pack(whole)
    head = MAGIC + blocks
    lengths = np.array([len(x) for x in ids], "<u4").tobytes()
    known = bytes(d is not None for d in doc_ids)
    documents = np.array([d or 0 for d in doc_ids], "<i8").tobytes() + known + lengths
    body = head + starts.tobytes() + documents
    return body + struct.pack(_FOOTER, len(ids), len(whole), len(starts), len(head), len(head) + 4 * len(starts), part, number, zlib.crc32(body), MAGIC)


class TokenFile:
    """Reads one file; raises ValueError if it is cut, changed or of another format."""

    def __init__(self, content: bytes, check: bool = True):
        content = content[:-1] if content[-1:] == b"\n" and content[-1 - len(MAGIC) : -1] == MAGIC else content
        if len(content) < _FOOTER_BYTES + len(MAGIC) or content[: len(MAGIC)] != MAGIC or content[-len(MAGIC) :] != MAGIC:
            raise ValueError("not a file of token ids, or a part of one")
        self.documents, self.total, blocks, at, to, self.part, self.number, crc, _ = struct.unpack(_FOOTER, content[-_FOOTER_BYTES :])
        if check and zlib.crc32(memoryview(content)[: -_FOOTER_BYTES]) != crc:
            raise ValueError("the file's check sum does not fit its bytes")
        self.data = np.frombuffer(content, np.uint8, at - len(MAGIC), len(MAGIC))
        self.starts = np.frombuffer(content, "<u4", blocks, at)
        known = np.frombuffer(content, np.uint8, self.documents, to + 8 * self.documents)
        self.doc_ids = [int(d) if k else None for d, k in zip(np.frombuffer(content, "<i8", self.documents, to), known)]
        self.lengths = np.frombuffer(content, "<u4", self.documents, to + 9 * self.documents).astype(np.int64)
        self.first = np.cumsum(self.lengths) - self.lengths

    def between(self, start: int, end: int) -> np.ndarray:
        """Ids start to end (exclusive) of the file; only the blocks they are in are unpacked."""
        end = min(end, self.total)
        if start >= end:
            return np.zeros(0, np.uint32)
        block = start // BLOCK
        found = unpack(self.data, self.starts[block : -(-end // BLOCK)])
        return found[start - block * BLOCK : end - block * BLOCK]

    def document(self, k: int) -> np.ndarray:
        return self.between(int(self.first[k]), int(self.first[k] + self.lengths[k]))


# ---- encoding -------------------------------------------------------------------------


#: Lower-casing in Latin-1, and the pre-tokens of lower-cased text of ASCII and Latin-1 letters.
_LOWER = bytes(b + 32 if 65 <= b <= 90 or 0xC0 <= b <= 0xDE and b != 0xD7 else b for b in range(256))
_PLAIN = bytes([*range(0x80), *range(0xC0, 0x100)])
_UNITS = rb"[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-z0-9\xdf-\xf6\xf8-\xff]+"


class WordEncoder:
    """Whole texts by the vocabulary file's library, with a memory of encoded pieces.

    For the vocabulary with word ends, whose normaliser composes characters (NFC) and lower-cases,
    and whose pre-tokeniser takes contractions, runs of letters, single digits and runs of
    other characters and drops white space.  So the ids of a text are those of its words between ASCII
    white space; and where a line has only ASCII and Latin-1 letters, which NFC leaves alone, and
    no mark of a special token, those of its pre-tokens, of which far fewer differ.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        size = 1 + max(vocabulary.values())
        suffix = self.tokenizer.model.end_of_word_suffix
        self.ends_word = np.zeros(size, bool)
        self.ends_word[[n for token, n in vocabulary.items() if token.endswith(suffix)]] = True
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.units = re.compile(_UNITS).findall
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[bytes, bytes] = {}

    def encode(self, text: bytes) -> np.ndarray:
        """The ids, of the type `kind`."""
        at, parts = 0, []
        while at < len(text):
            end = at + _PART
            while end < len(text) and text[end] not in b" \t\n\v\f\r":
                end += 1
            part = text[at:end]
            parts += [self._part(part)] if (plain := self._plain(part)) is None else [plain]
            at = end
        return np.frombuffer(b"".join(parts), self.kind)

    def _part(self, text: bytes) -> bytes:
        lines = text.split(b"\n")
        if len(lines) == 1:
            return self._coded(text.split(), self.words, self._word_ids)
        return b"".join([self._coded(line.split(), self.words, self._word_ids) if (plain := self._plain(line)) is None else plain for line in lines])

    def _plain(self, text: bytes) -> bytes | None:
        if b"<|" in text:
            return None
        try:
            single = text.decode("utf-8").encode("latin-1")
        except UnicodeError:
            return None
        if single.translate(None, _PLAIN):
            return None
        return self._coded(self.units(single.translate(_LOWER)), self.pieces, self._piece_ids)

    def _coded(self, words: list[bytes], memory: dict[bytes, bytes], fresh_ids: Callable) -> bytes:
        """Joined ids of words; fresh_ids gives those of the ones not remembered."""
        found = list(map(memory.get, words))
        missing = [k for k, ids in enumerate(found) if ids is None]
        if missing:
            fresh = list({words[k] for k in missing})
            new = dict(zip(fresh, fresh_ids(fresh)))
            for k in missing:
                found[k] = new[words[k]]
            if len(memory) > REMEMBERED_WORDS:
                memory.clear()
            memory.update((w, ids) for w, ids in new.items() if len(w) <= _LONGEST)
        return b"".join(found)

    def _word_ids(self, words: list[bytes]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        return [np.array(c.ids, self.kind).tobytes() for c in coded]

    def _piece_ids(self, pieces: list[bytes]) -> list[bytes]:
        """Of pre-tokens, encoded as one text; the last id of each ends a word."""
        ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(pieces).decode("latin-1")], add_special_tokens=False)[0].ids, self.kind)
        ends = ((np.flatnonzero(self.ends_word[ids]) + 1) * self.kind.itemsize).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]


def _encoded(tokenizer_path: str, end: int, bounds: np.ndarray, unknown: int) -> Callable:
    """Ids of each text, and the part its row goes to: one of those between whose bounds its id lies."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = once(f"words {tokenizer_path}", lambda: WordEncoder(tokenizer_path))
        mark = np.array([end], encoder.kind).tobytes()
        for batch in batches:
            ids, known, row = batch["id"].to_numpy(np.int64), batch["known"].to_numpy(bool), batch["row"].to_numpy(np.int64)
            low, high = np.searchsorted(bounds, ids, "left"), np.searchsorted(bounds, ids, "right")
            dealt = np.array([zlib.crc32(r.tobytes()) for r in row], np.int64)
            part = np.where(known, unknown + low + dealt % (high - low + 1), dealt % max(1, unknown))
            rows = batch[["id", "known", "row"]].assign(part=part.astype(np.int32), width=encoder.kind.itemsize)
            for at in range(0, len(rows), _ROWS):
                coded = [encoder.encode(text).tobytes() + mark for text in batch["text"].iloc[at : at + _ROWS]]
                yield rows.iloc[at : at + _ROWS].assign(ids=coded)

    return run


def _files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    part, number, held = TaskContext.get().partitionId(), 0, 0
    doc_ids: list[int | None] = []
    ids: list[np.ndarray] = []
    for batch in batches:
        for doc_id, known, width, packed in zip(batch["id"], batch["known"], batch["width"], batch["ids"]):
            if held >= FILE_IDS:
                yield pd.DataFrame({"content": [file_of(doc_ids, ids, part, number)]})
                number, held, doc_ids, ids = number + 1, 0, [], []
            doc_ids.append(int(doc_id) if known else None)
            ids.append(np.frombuffer(packed, f"<u{width}"))
            held += len(ids[-1])
    if ids:
        yield pd.DataFrame({"content": [file_of(doc_ids, ids, part, number)]})


def write_files(docs: DataFrame, path: str, tokenizer_path: str, end: int = END) -> None:
    """The ids of every row of docs (doc_id, text), each followed by `end`, into new files under `path`.

    Files stand in ascending doc_id order, null ids first; rows of one id stand together, in no
    particular order.  A null text is empty and has the end mark alone.  Rows are dealt to ranges
    of ids whose bounds come from a sketch of all ids; an id on which several bounds fall,
    as null ids, is spread over the ranges between them.  Texts stay where they are
    read: their ids move.
    """
    spark = docs.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [k / parts for k in range(1, parts)]
    total, known, bounds = docs.agg(F.count("*"), F.count("doc_id"), F.percentile_approx("doc_id", shares, 20 * parts)).first()
    unknown = -(-parts * (total - known) // max(1, total))
    text = F.coalesce(docs["text"], F.lit("")).cast("binary").alias("text")
    rows = docs.select(*exact_id(), text, F.monotonically_increasing_id().alias("row"))
    encode = _encoded(tokenizer_path, end, np.array(bounds or [], np.int64), unknown)
    coded = rows.mapInPandas(encode, "id bigint, known boolean, row bigint, part int, width int, ids binary")
    placed = coded.repartitionById(unknown + parts, F.col("part")).sortWithinPartitions("known", "id", "row")
    files = placed.select("id", "known", "width", "ids").mapInPandas(_files, "content binary")
    files.select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for content in batch["content"]:
            file = TokenFile(content)
            ids = np.ascontiguousarray(file.between(0, file.total).astype("<u4"))
            view = memoryview(ids.view(np.uint8)) if len(ids) else memoryview(b"")
            ends = file.first + file.lengths
            crcs = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(file.first.tolist(), ends.tolist())]
            yield pd.DataFrame({
                "part": file.part, "number": file.number, "doc_id": pd.array(file.doc_ids, "Int64"),
                "at": file.first, "n_tokens": file.lengths, "ids_crc32": crcs,
            })


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [struct.unpack(_FOOTER, footer) for footer in batch["footer"]]
        yield pd.DataFrame([(f[5], f[6], f[1]) for f in found], columns=["part", "number", "held"])


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files under `path`: doc_id, start, n_tokens, ids_crc32.

    start counts the ids of all documents before it, over all files; ids_crc32 is the unsigned
    CRC-32 of the document's ids as little-endian 32-bit integers.
    """
    files = spark.read.format("binaryFile").load(path).where("length > 0")
    # Of each file the footer says how many ids it has; sums run within groups of files, then over groups.
    footer = F.expr(f"substring(content, length(content) - {_FOOTER_BYTES}, {_FOOTER_BYTES})").alias("footer")
    held = files.select(footer).mapInPandas(_footers, "part bigint, number bigint, held bigint")
    held = held.withColumn("group", F.floor(F.col("part") / _FILES_TOGETHER))
    sums = held.groupBy("group").agg(F.sum("held").alias("sum"))
    earlier = (Window.unboundedPreceding, -1)
    sums = sums.select("group", F.coalesce(F.sum("sum").over(Window.orderBy("group").rowsBetween(*earlier)), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("held").over(Window.partitionBy("group").orderBy("part", "number").rowsBetween(*earlier)), F.lit(0))
    before = held.withColumn("inside", inside).join(sums, "group").select("part", "number", (F.col("base") + F.col("inside")).alias("before"))
    rows = files.select("content").mapInPandas(_read, "part bigint, number bigint, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.join(before, ["part", "number"]).select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def stored(docs: DataFrame, tokenizer_path: str, path: str | None = None, end: int = END) -> DataFrame:
    """Write the ids of docs to files (in the shared folder if no path is given) and read them back.

    One row per row of docs.  Empty tables give an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    write_files(docs, path, tokenizer_path, end)
    return read_files(spark, path)
