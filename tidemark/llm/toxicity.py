"""Toxicity by a small convolutional text classifier, trained in numpy.

A word is three rows of hashed embeddings: two by the halves of its 32-bit hash, so two
words share both only if they share the hash, and one by the hash of its first bytes, for
inflected forms.  Filters of width one to three slide over the whole text, each keeps
its three largest outputs (k-max pooling, so that one chance word weighs less than
several), and a logistic layer reads them.  The first
entry of each embedding row starts at the z-score by which its bucket leans to toxic
training texts, the others near zero.

A threshold is calibrated for each language on training rows held back from the
gradient steps, and shifts the score so that the threshold is 0.5.  The language is
guessed from the function words of the text; the table's own language column, ids,
sources and labels are never inputs of a score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby, tee

import numpy as np
import pandas as pd
from pyspark import RDD
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidemark.llm.common import keyed_text, once

#: Labelled rows are dealt into shards of about twice so many, by the hash of their id; every row is in one.
FIT_ROWS = 2_000
#: A single shard is trained on the driver if its word hashes have at most so many bytes.
DRIVER_BYTES = 64_000_000
#: Shards that one task trains, one after the other; it sends what they change together.
SHARDS_A_TASK = 4
#: Embedding rows that are summed up at a time.
_PIECE = 16_384
FOLDS = 5
#: Of the training rows, this fold calibrates the thresholds.
CALIBRATION_FOLD = 1

_BITS, _DIM, _FILTERS, _WIDTHS, _TOP, _STEM = 17, 8, 16, (1, 2, 3), 3, 6
_ROWS = 1 << _BITS
_EPOCHS, _BATCH, _RATE, _DECAY = 6, 32, 0.01, 1e-5
#: Passes over the rows where several shards train side by side.
_ROUNDS = 3
#: Logits of held-back rows are counted to this part of one.
_LOGIT_PART = 1024
_SEGMENT = 16_384
#: Words are runs of digits, a-z and bytes from 0x80 on; every other byte becomes a space.
_APART = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
#: Words of up to so many bytes are hashed side by side, those of about so many bytes of text at a time.
_SHORT, _STRETCH = 64, 1 << 17

#: Function words by which the language of a text is guessed.
FUNCTION_WORDS = {
    "en": "the of and to is that with for was on are by this be as it at from or".split(),
    "de": "der die und das nicht von mit dem den im für auf ein eine zu ist sich auch".split(),
    "fr": "le les et des une que qui dans pour sur est pas du au avec par".split(),
    "es": "el los las una y del por con para se su es como lo más".split(),
}
LANGUAGES = ("other", *FUNCTION_WORDS)


def _crc_parts() -> tuple[np.ndarray, np.ndarray]:
    """What a byte adds to the CRC-32 of its word, by its distance from the word's end (from 1), and that of so many zero bytes.

    But for a constant of its length, the CRC-32 of a word is the sum without carry of what its bytes add.
    """
    zeros = np.array([zlib.crc32(bytes(n)) for n in range(_SHORT + 1)], np.uint32)
    parts = np.zeros((_SHORT + 1, 256), np.uint32)
    for n in range(1, _SHORT + 1):
        parts[n] = [zlib.crc32(bytes([b]) + bytes(n - 1)) for b in range(256)]
        parts[n] ^= zeros[n]
    # A blank, which ends a word, adds nothing.
    parts[:, 0x20] = 0
    return parts.reshape(-1), zeros


def _hashed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Both hashes of the words between the blanks of `data`, and where the words end."""
    parts, zeros = once("parts of CRC-32 for toxicity", _crc_parts)
    # Each stretch up to a blank, the blank included, is a word, if only of no bytes.
    letters = np.frombuffer(data + b" ", np.uint8)
    ends = np.flatnonzero(letters == 0x20).astype(np.int32)
    starts = np.empty_like(ends)
    starts[0], starts[1:] = 0, ends[:-1] + 1
    lengths = ends - starts
    to_end = np.repeat(ends, lengths + 1) - np.arange(len(letters), dtype=np.int32)
    whole = np.bitwise_xor.reduceat(parts.take(np.minimum(to_end, _SHORT) * 256 + letters), starts)
    words = np.flatnonzero(lengths)
    starts, ends, lengths = starts[words], ends[words], lengths[words]
    found = np.empty((len(words), 2), "<u4")
    found[:, 0] = whole[words] ^ zeros[np.minimum(lengths, _SHORT)]
    for i in np.flatnonzero(lengths > _SHORT):
        found[i, 0] = zlib.crc32(data[starts[i] : ends[i]])
    found[:, 1] = found[:, 0]
    cut = np.flatnonzero(lengths > _STEM)
    stem = np.full(len(cut), zeros[_STEM])
    for n in range(_STEM):
        stem ^= parts[(_STEM - n) * 256 :].take(letters.take(starts[cut] + n))
    found[cut, 1] = stem
    return found, ends


def word_hashes(text: str) -> np.ndarray:
    """CRC-32 of each lower-case word, and of its first bytes."""
    return next(hashes_by_text([text]))


def hashes_by_text(texts: Iterable[str]) -> Iterator[np.ndarray]:
    """`word_hashes` of each text; short texts are hashed together, long ones in parts."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        held.append(text.lower().encode().translate(_APART))
        size += len(held[-1]) + 1
        if size >= _STRETCH:
            yield from _hashed_together(held)
            held, size = [], 0
    yield from _hashed_together(held)


def _hashed_together(held: list[bytes]) -> Iterator[np.ndarray]:
    if len(held) > 1 and len(held[-1]) >= _STRETCH:
        # Only the last can be long.
        yield from _hashed_together(held[:-1])
        held = held[-1:]
    if len(held) == 1:
        found, start, data = [], 0, held[0]
        while not found or start < len(data):
            end = data.find(b" ", start + _STRETCH)
            end = len(data) if end < 0 else end
            found.append(_hashed(data[start:end])[0])
            start = end + 1
        yield found[0] if len(found) == 1 else np.concatenate(found)
    elif held:
        found, ends = _hashed(b" ".join(held))
        yield from np.split(found, np.searchsorted(ends, np.cumsum([len(data) + 1 for data in held[:-1]])))


#: Embedding bucket of a word's hashes, by table.
_BUCKETS = (
    lambda hashes: hashes[:, 0] & (_ROWS - 1),
    lambda hashes: hashes[:, 0] >> (32 - _BITS),
    lambda hashes: hashes[:, 1] & (_ROWS - 1),
)


def _language_table() -> np.ndarray:
    table = np.zeros(_ROWS, np.int8)
    for number, words in enumerate(FUNCTION_WORDS.values(), 1):
        for word in words:
            table[zlib.crc32(word.encode()) & (_ROWS - 1)] = number
    return table


def language_of(hashes: np.ndarray, table: np.ndarray) -> int:
    """Number of the language with the most function words; 0 without any."""
    counts = np.bincount(table[hashes[:, 0] & (_ROWS - 1)], minlength=len(LANGUAGES))[1:]
    return int(counts.argmax()) + 1 if counts.any() else 0


@dataclass
class Model:
    tables: np.ndarray  # per bucket function: (_ROWS, _DIM)
    filters: list[np.ndarray]  # per width: (width, len(tables) * _DIM, _FILTERS)
    biases: list[np.ndarray]
    weights: np.ndarray  # per width, place among the largest, filter
    bias: float
    thresholds: np.ndarray  # logits, per language

    def embedded(self, hashes: np.ndarray) -> np.ndarray:
        # Of all tables at once, as if they were one.
        rows = np.empty((len(hashes), len(_BUCKETS)), np.intp)
        for number, bucket in enumerate(_BUCKETS):
            rows[:, number] = bucket(hashes)
            rows[:, number] += number * _ROWS
        return self.tables.reshape(-1, _DIM).take(rows.reshape(-1), axis=0).reshape(len(hashes), -1)

    def pooled(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The _TOP largest outputs of each filter over a text, at least 0, and their positions (-1: none)."""
        shape = (len(_WIDTHS), _TOP, _FILTERS)
        best, places = np.zeros(shape, np.float32), np.full(shape, -1)
        overlap, every = max(_WIDTHS) - 1, np.arange(len(_WIDTHS) * _FILTERS)
        stacked = np.concatenate([part.T for filters in self.filters for part in filters])
        for start in range(0, len(hashes), _SEGMENT):
            size = min(_SEGMENT, len(hashes) - start)
            part = self.embedded(hashes[start : start + size + overlap])
            found = np.zeros((len(stacked), size + overlap), np.float32)
            np.matmul(stacked, part.T, out=found[:, : len(part)])
            # A row per width and filter; a word of a window adds its own filter's output.
            rows, at = np.empty((len(every), size), np.float32), 0
            for k, width in enumerate(_WIDTHS):
                out = rows[k * _FILTERS : (k + 1) * _FILTERS]
                out[:] = self.biases[k][:, None]
                for d in range(width):
                    out += found[at : at + _FILTERS, d : d + size]
                    at += _FILTERS
            for top in range(min(_TOP, size)):
                spots = rows.argmax(axis=1)
                values = rows[every, spots]
                rows[every, spots] = -np.inf
                values, spots = values.reshape(-1, _FILTERS), spots.reshape(-1, _FILTERS) + start
                if start == 0:
                    # Nothing was found before, and the largest come first.
                    best[:, top], places[:, top] = np.where(values > 0, values, 0), np.where(values > 0, spots, -1)
                else:
                    self._place(best, places, values, spots)
        return best, places

    @staticmethod
    def _place(best: np.ndarray, places: np.ndarray, values: np.ndarray, spots: np.ndarray) -> None:
        """Put one output per filter among the largest; it comes after equal ones."""
        for top in range(_TOP):
            larger = values > best[:, top]
            if not larger.any():
                continue
            old, place = best[:, top].copy(), places[:, top].copy()
            best[:, top], places[:, top] = np.where(larger, values, old), np.where(larger, spots, place)
            values, spots = np.where(larger, old, values), np.where(larger, place, spots)

    def logit(self, hashes: np.ndarray) -> float:
        return float((self.pooled(hashes)[0] * self.weights).sum() + self.bias)


class _Adam:
    def __init__(self, shapes: list[tuple[int, ...]]):
        self.first = [np.zeros(s, np.float32) for s in shapes]
        self.second = [np.zeros(s, np.float32) for s in shapes]
        self.steps = 0

    def step(self, values: list[np.ndarray], slopes: list[np.ndarray]) -> None:
        self.steps += 1
        scale = _RATE * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
        for value, slope, m, v in zip(values, slopes, self.first, self.second):
            m += 0.1 * (slope - m)
            v += 0.001 * (slope * slope - v)
            value -= scale * m / (np.sqrt(v) + 1e-8)


def _leaning(texts: list[np.ndarray], toxic: np.ndarray, bucket) -> np.ndarray:
    """Per bucket, how far its share of the toxic texts is from its share of the others: a z-score, scaled and bounded."""
    counts = np.zeros((2, _ROWS))
    for hashes, y in zip(texts, toxic):
        counts[int(y), np.unique(bucket(hashes))] += 1
    n = np.array([(toxic == 0).sum(), (toxic == 1).sum()])
    return _z_scores(counts, n)


def _z_scores(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    pooled = np.clip(counts.sum(axis=0) / n.sum(), 1e-9, 1 - 1e-9)
    z = (counts[1] / n[1] - counts[0] / n[0]) / np.sqrt(pooled * (1 - pooled) * (1 / n[0] + 1 / n[1]))
    return np.clip(z / 5, -1, 3)


def _start(rng: np.random.Generator) -> Model:
    depth = len(_BUCKETS) * _DIM
    return Model(
        np.stack([rng.normal(0, 0.02, (_ROWS, _DIM)).astype(np.float32) for _ in _BUCKETS]),
        [rng.normal(0, 0.2, (w, depth, _FILTERS)).astype(np.float32) for w in _WIDTHS],
        [np.zeros(_FILTERS, np.float32) for _ in _WIDTHS],
        rng.normal(0, 0.1, (len(_WIDTHS), _TOP, _FILTERS)).astype(np.float32), 0.0,
        np.zeros(len(LANGUAGES)),
    )


def _constant(model: Model, share: float) -> Model:
    model.weights[:] = 0
    model.bias = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    return model


def _descend(model: Model, adam: _Adam, texts: list[np.ndarray], toxic: np.ndarray, balance: np.ndarray) -> None:
    """One step down the slope of a batch."""
    dense = [*model.filters, *model.biases, model.weights]
    shape, reach = (len(texts), len(_WIDTHS), _TOP, _FILTERS), max(_WIDTHS)
    features, places = np.empty(shape, np.float32), np.empty(shape, np.intp)
    # The words from that on at which a largest output lies, one step further at a time; beyond the text they count for nothing.
    met, inside = np.zeros((*shape, reach, 2), np.uint32), np.empty((*shape, reach), bool)
    for i, hashes in enumerate(texts):
        features[i], places[i] = model.pooled(hashes)
        at = places[i][..., None] + np.arange(reach)
        inside[i] = (places[i][..., None] >= 0) & (at < len(hashes))
        if len(hashes):
            met[i] = hashes.take(np.minimum(at, len(hashes) - 1), axis=0)
    logits = (features * model.weights).reshape(len(texts), -1).sum(axis=1) + model.bias
    errors = (1 / (1 + np.exp(-logits.astype(float))) - toxic) * balance / len(texts)
    gains = errors[:, None, None, None] * model.weights
    of_biases = np.where(places >= 0, gains, 0).sum(axis=2)
    slopes = [np.zeros(v.shape, np.float32) for v in dense]
    bias_slope = 0.0
    for error, found, of_bias in zip(errors, features, of_biases):
        bias_slope += error
        slopes[-1] += error * found
        for k in range(len(_WIDTHS)):
            slopes[len(_WIDTHS) + k] += of_bias[k]
    moved: list[tuple[np.ndarray, np.ndarray]] = []
    for k, width in enumerate(_WIDTHS):
        for d in range(width):
            *_, of = at = np.nonzero(inside[:, k, ..., d])
            words = met[:, k, ..., d, :][at]
            shared = np.zeros((len(of), _FILTERS), np.float32)
            shared[np.arange(len(of)), of] = gains[:, k][at]
            slopes[k][d] += model.embedded(words).T @ shared
            moved.append((words, shared @ model.filters[k][d].T))
    adam.step(dense, [s + _DECAY * v for s, v in zip(slopes, dense)])
    model.bias -= _RATE * bias_slope
    words, slope = np.concatenate([w for w, _ in moved]), _RATE * np.concatenate([v for _, v in moved])
    for number, (values, bucket) in enumerate(zip(model.tables, _BUCKETS)):
        cells = bucket(words).astype(np.int64)[:, None] * _DIM + np.arange(_DIM)
        np.subtract.at(values.reshape(-1), cells.ravel(), slope[:, number * _DIM : (number + 1) * _DIM].astype(np.float32).ravel())


def train(texts: list[np.ndarray], toxic: np.ndarray, held: np.ndarray, seed: int = 7) -> Model:
    """Fit on the rows that are not `held`, calibrate on those that are.

    Without both classes the model knows nothing: its score is the share of label 1.
    """
    rng = np.random.default_rng(seed)
    model = _start(rng)
    # Some clean texts also give a short cut of themselves, so that a short text alone is no sign.
    cuts = []
    for i in np.flatnonzero(~held & (toxic == 0))[::10]:
        start = int(rng.integers(0, len(texts[i]) + 1))
        cuts.append(texts[i][start : start + int(rng.integers(0, 30))])
    texts = [*texts, *cuts]
    toxic = np.concatenate([toxic, np.zeros(len(cuts), int)])
    held = np.concatenate([held, np.zeros(len(cuts), bool)])
    fit = np.flatnonzero(~held)
    if len(set(toxic[fit].tolist())) < 2:
        return _constant(model, float(toxic.mean()) if len(toxic) else 0.0)
    for values, bucket in zip(model.tables, _BUCKETS):
        values[:, 0] = _leaning([texts[i] for i in fit], toxic[fit], bucket)
    adam = _Adam([v.shape for v in (*model.filters, *model.biases, model.weights)])
    balance = np.where(toxic == 1, 0.5 / max(1, (toxic[fit] == 1).sum()), 0.5 / max(1, (toxic[fit] == 0).sum())) * len(fit)
    for _ in range(_EPOCHS):
        for batch in np.array_split(rng.permutation(fit), max(1, len(fit) // _BATCH)):
            _descend(model, adam, [texts[i] for i in batch], toxic[batch], balance[batch])
    kept, table = [texts[i] for i in np.flatnonzero(held)], _language_table()
    logits, languages = np.array([model.logit(t) for t in kept]), np.array([language_of(t, table) for t in kept], int)
    _calibrate(model, logits, languages, toxic[held], np.ones(len(kept), int))
    return model


def _calibrate(model: Model, logits: np.ndarray, languages: np.ndarray, toxic: np.ndarray, counts: np.ndarray) -> None:
    """Per language the logit with the fewest errors on held-back rows, drawn towards that of all languages."""
    if len(set(toxic.tolist())) < 2:
        return

    def best(rows: np.ndarray) -> float:
        values, of = np.unique(logits[rows], return_inverse=True)
        n = np.array([np.bincount(of, counts[rows] * (toxic[rows] == y), len(values)) for y in (0, 1)])
        # An edge stands below its value: toxic rows under it and clean ones from it on are errors.
        wrong = np.concatenate([[0], n[1].cumsum()]) + np.concatenate([n[0][::-1].cumsum()[::-1], [0]])
        middle = (values[1:] + values[:-1]) / 2
        edges = np.concatenate([[values[0] - 1], middle, [values[-1] + 1]])
        shared = n.sum(axis=0) > 1
        edges, wrong = np.concatenate([edges, values[shared]]), np.concatenate([wrong, wrong[:-1][shared]])
        good = edges[wrong == wrong.min()]
        return float((good.min() + good.max()) / 2)

    overall = best(np.arange(len(logits)))
    model.thresholds[:] = overall
    for number in range(1, len(LANGUAGES)):
        rows = np.flatnonzero(languages == number)
        if len(rows) and len(set(toxic[rows].tolist())) == 2:
            n = counts[rows][toxic[rows] == 1].sum()
            model.thresholds[number] = (n * best(rows) + 20 * overall) / (n + 20)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by five; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Train on all labelled documents outside the held-out fold.

    Rows without id, text or label, and ids with contradicting labels, are left out; of the rows that share
    an id one counts, that whose text has the smallest hash.  Rows are dealt into shards of about
    2 * `rows`; one shard alone is trained on the driver, several side by side (`_train_shards`),
    each task with as many as the others, or one fewer.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).where("toxic = other")
        .where(~held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    )
    shards = max(1, -(-known.count() // (2 * rows)))
    tasks = -(-shards // SHARDS_A_TASK)
    place, none = F.xxhash64("doc_id"), F.lit(None)
    shard = F.pmod("place", F.lit(shards)).cast("int")
    task = F.expr(f"CAST(CAST(shard AS BIGINT) * {tasks} DIV {shards} AS INT)")
    # Texts move once, to the task that trains on them, and labels with them; every pass reads them where they then lie.
    texts = docs.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    both = texts.select("doc_id", "text", none.cast("int").alias("toxic")).unionByName(known.select("doc_id", none.cast("string").alias("text"), "toxic"))
    dealt = (
        both.withColumn("place", place).withColumn("shard", shard).withColumn("task", task)
        .repartitionById(tasks, "task").groupBy("task", "shard", "place", "doc_id")
        .agg(F.max("toxic").alias("toxic"), F.min_by("text", F.when(F.col("text").isNotNull(), F.struct(F.xxhash64("text"), "text"))).alias("text"))
        .where("toxic IS NOT NULL AND text IS NOT NULL")
        # The order in which the groups come, so texts are sorted once.
        .sortWithinPartitions("task", "shard", "place", "doc_id")
        .select("shard", "place", "toxic", ((F.crc32(F.col("doc_id").cast("string")) % FOLDS) == CALIBRATION_FOLD).alias("held"), "text").rdd
    )
    if shards > 1 or dealt.map(lambda r: word_hashes(r["text"]).nbytes).sum() > DRIVER_BYTES:
        return _train_shards(dealt)
    found = sorted(dealt.map(lambda r: (r["place"], word_hashes(r["text"]).tobytes(), r["toxic"], r["held"])).collect())
    return train(
        [_hashes_of(data) for _, data, _, _ in found], np.array([y for _, _, y, _ in found], int), np.array([held for *_, held in found], bool)
    )


def _with_hashes(rows: Iterable[Row]) -> Iterator[tuple[Row, np.ndarray]]:
    """Each row with the hashes of its text; some rows are read ahead."""
    rows, ahead = tee(rows)
    return zip(rows, hashes_by_text(row["text"] for row in ahead))


def _hashes_of(data: bytes) -> np.ndarray:
    return np.frombuffer(bytes(data), np.uint32).reshape(-1, 2)


def _train_shards(dealt: RDD, seed: int = 7) -> Model:
    """Every row of every shard trains the model.

    The leanings are counted over all rows.  In a round each shard goes on from the same model, and
    what it changes is averaged: weights over all shards, an embedding row over the shards that met
    it.  Thresholds come from the logits of all held-back rows.  What reaches the driver has the size
    of the model, whatever that of the tables.  Rows lie by shard and place.
    """
    context = dealt.context
    model = _start(np.random.default_rng(seed))

    def counted(rows: Iterator[Row]) -> Iterator[tuple]:
        # Texts by bucket and class; the last table holds the rows by class, those held back behind the others.
        counts = np.zeros((len(_BUCKETS) + 1, _ROWS, 2))
        def tallied() -> Iterator[Row]:
            for row in rows:
                counts[-1, int(row["held"]), row["toxic"]] += 1
                if not row["held"]:
                    yield row

        for row, hashes in _with_hashes(tallied()):
            for number, bucket in enumerate(_BUCKETS):
                counts[number, np.unique(bucket(hashes)), row["toxic"]] += 1
        for slot, values in enumerate(counts):
            yield from _pieces(slot, np.flatnonzero(values.any(axis=1)), values)

    counts = np.zeros((len(_BUCKETS) + 1, _ROWS, 2))
    for slot, at, sums in _added(dealt.mapPartitions(counted)):
        counts[slot, at] = sums
    fitted, every = counts[-1, 0], counts[-1, :2].sum(axis=0)
    if not fitted.all():
        return _constant(model, every[1] / max(1, every.sum()))
    balance = 0.5 * fitted.sum() / fitted
    for values, count in zip(model.tables, counts):
        values[:, 0] = _z_scores(count.T, fitted)

    for turn in range(_ROUNDS):
        sent = context.broadcast(vars(model))

        def shard_round(rows: Iterator[Row], sent=sent, turn=turn) -> Iterator[tuple]:
            before = Model(**sent.value)
            total = [np.zeros((len(old), _DIM + 1), np.float32) for old in (*before.tables, _dense(before))]
            fit = (r for r in rows if not r["held"])
            for _, shard in groupby(fit, key=lambda r: r["shard"]):
                after = _copied(before)
                adam = _Adam([v.shape for v in (*after.filters, *after.biases, after.weights)])
                _pass_over(after, adam, [(r["place"], r["toxic"], hashes) for r, hashes in _with_hashes(shard)], balance, turn)
                _add_change(total, before, after)
            for slot, values in enumerate(total):
                yield from _pieces(slot, np.flatnonzero(values[:, _DIM]), values)

        _apply(model, [(slot, at, sums[:, :_DIM] / sums[:, _DIM:]) for slot, at, sums in _added(dealt.mapPartitions(shard_round))])
        sent.unpersist()

    sent = context.broadcast(vars(model))

    def logits(rows: Iterator[Row]) -> Iterator[tuple]:
        known, table = Model(**sent.value), _language_table()
        for row, hashes in _with_hashes(row for row in rows if row["held"]):
            part = int(np.rint(np.clip(known.logit(hashes), -30, 30) * _LOGIT_PART))
            yield (language_of(hashes, table), row["toxic"], part), 1

    tally = sorted(dealt.mapPartitions(logits).reduceByKey(lambda a, b: a + b).collect())
    language, toxic, part = np.array([key for key, _ in tally], int).reshape(-1, 3).T
    _calibrate(model, part / _LOGIT_PART, language, toxic, np.array([n for _, n in tally], int))
    return model


def _pieces(slot: int, at: np.ndarray, values: np.ndarray) -> Iterator[tuple]:
    """The rows `at` of a table, by ranges of its rows."""
    for piece in np.unique(at // _PIECE):
        part = at[at // _PIECE == piece]
        yield (slot, int(piece)), (part.astype(np.int32), values[part])


def _added(pieces: RDD) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(slot, rows, sums of their values) over all tasks; a sum is held for one range of rows at a time in a task."""

    def add(found: Iterator[tuple]) -> Iterator[tuple]:
        sums: dict = {}
        for key, (at, values) in found:
            if key not in sums:
                sums[key] = np.zeros((_PIECE, values.shape[1])), np.zeros(_PIECE, bool)
            total, met = sums[key]
            total[at - key[1] * _PIECE] += values
            met[at - key[1] * _PIECE] = True
        for (slot, piece), (total, met) in sums.items():
            at = np.flatnonzero(met)
            yield slot, at + piece * _PIECE, total[at]

    ranges = _ROWS // _PIECE
    return pieces.partitionBy((len(_BUCKETS) + 1) * ranges, lambda key: key[0] * ranges + key[1]).mapPartitions(add).collect()


def _copied(model: Model) -> Model:
    return Model(model.tables.copy(), [f.copy() for f in model.filters], [b.copy() for b in model.biases], model.weights.copy(), model.bias, model.thresholds)


def _pass_over(model: Model, adam: _Adam, rows: list[tuple[int, int, np.ndarray]], balance: np.ndarray, turn: int) -> None:
    """The steps of one pass over (place, toxic, hashes) of a shard; as in `train`, some clean texts also give a short cut of themselves."""
    rng = np.random.default_rng([turn, rows[0][0] & 0xFFFFFFFF])
    texts, toxic = [hashes for *_, hashes in rows], np.array([y for _, y, _ in rows], int)
    for i in np.flatnonzero(toxic == 0)[::10]:
        start = int(rng.integers(0, len(texts[i]) + 1))
        texts.append(texts[i][start : start + int(rng.integers(0, 30))])
    toxic = np.concatenate([toxic, np.zeros(len(texts) - len(toxic), toxic.dtype)])
    for batch in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // _BATCH)):
        _descend(model, adam, [texts[i] for i in batch], toxic[batch], balance[toxic[batch]])


def _dense(model: Model) -> np.ndarray:
    """All values but the embeddings, in rows of _DIM."""
    flat = np.concatenate([v.ravel() for v in (*model.filters, *model.biases, model.weights)] + [[model.bias]])
    return np.concatenate([flat, np.zeros(-len(flat) % _DIM)]).reshape(-1, _DIM)


def _add_change(total: list[np.ndarray], before: Model, after: Model) -> None:
    """Add to `total` the rows that differ and how often: embedding rows by table, then the others, which every shard changes."""
    for slot, (old, new) in enumerate(zip([*before.tables, _dense(before)], [*after.tables, _dense(after)])):
        at = np.flatnonzero((old != new).any(axis=1)) if slot < len(_BUCKETS) else np.arange(len(old))
        total[slot][at, :_DIM] += new[at] - old[at]
        total[slot][at, _DIM] += 1


def _apply(model: Model, means: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
    dense = _dense(model)
    for slot, at, mean in means:
        [*model.tables, dense][slot][at] += mean.astype(model.weights.dtype)
    flat, at = dense.ravel(), 0
    for value in (*model.filters, *model.biases, model.weights):
        value[:] = flat[at : at + value.size].reshape(value.shape)
        at += value.size
    model.bias = float(flat[at])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted, language.

    Null text counts as empty; a text without words holds nothing toxic and scores 0.  Repeated rows and null ids each keep a row; other columns are
    ignored; an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, table = Model(**sent.value), _language_table()
        for batch in batches:
            rows = []
            for hashes in hashes_by_text(batch["text"]):
                language = language_of(hashes, table)
                logit = np.clip(known.logit(hashes) - known.thresholds[language], -30, 30)
                rows.append((float(1 / (1 + np.exp(-logit))) if len(hashes) else 0.0, LANGUAGES[language]))
            out = pd.DataFrame(rows, columns=["score", "language"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64"))
            yield out

    found = keyed_text(docs).mapInPandas(run, "doc_id bigint, score double, language string")
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "language"
    )
