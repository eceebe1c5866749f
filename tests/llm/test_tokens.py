import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_samples import EDGE
from tidemark.llm import bpe_automaton, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe_automaton.Codec(PATH)


def fuzz():
    draw = random.Random(4)
    parts = ["a", "aa", " ", "  ", "\n", "é", "日本", "😀", "'s", "1", "22", "<|endoftext|>", "####", "====", " ", "the", "ing", "xyxyxy", "\x00"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(draw.choices("ab", k=draw.randint(0, 80))) for _ in range(500)]
    texts += ["".join(draw.choices("-= *", k=draw.randint(0, 300))) for _ in range(300)]
    return [*EDGE, *texts]


def test_automaton_encodes_as_the_library_does(library, codec):
    for text in fuzz():
        ids = np.frombuffer(b"".join(codec.encode(text)), "<u4")
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text[:80])
        assert codec.decode(ids.tobytes()).decode() == text


def test_every_token_is_reached_by_its_own_bytes(codec):
    automaton = codec.automaton
    for label, number in list(automaton.numbers.items())[::97]:
        assert automaton.encode_word(label) == [number]


def test_a_word_that_greedy_matching_gets_wrong(library, codec):
    wrong = 0
    for label in list(codec.automaton.numbers)[::50]:
        word = label * 2
        if b" " in word[1:]:
            continue
        try:
            text = word.decode()
        except UnicodeDecodeError:
            continue
        got = np.frombuffer(b"".join(codec.encode(text)), "<u4").tolist()
        assert got == library.encode(text, add_special_tokens=False).ids
        wrong += len(got) != 2
    assert wrong > 20


def test_queries_agree_with_the_library(spark, documents, clashing, library):
    docs = dict(enumerate(fuzz()[:400]))
    frame = clashing(documents([*docs.items(), (1000, None), (None, "the end")]))
    ids = {k: library.encode(t, add_special_tokens=False).ids for k, t in docs.items()} | {1000: [], None: library.encode("the end").ids}
    texts = docs | {1000: "", None: "the end"}
    counts = {r.doc_id: r for r in token_counts.token_counts(frame, PATH).collect()}
    coded = {r.doc_id: r for r in bpe_automaton.encode_and_decode(frame, PATH, with_ids=True).collect()}
    assert counts.keys() == coded.keys() == ids.keys()
    for k, want in ids.items():
        assert (counts[k].n_tokens, counts[k].n_bytes) == (len(want), len(texts[k].encode()))
        assert counts[k].over_limit == (len(want) > 512)
        raw = np.array(want, "<u4").tobytes()
        assert coded[k].ids_sha256 == hashlib.sha256(raw).hexdigest() and bytes(coded[k].ids) == raw
        assert coded[k].decoded_sha256 == hashlib.sha256(texts[k].encode()).hexdigest() and coded[k].round_trip


def test_repeated_rows_and_blocks(spark, documents, library, monkeypatch):
    text = "the cat sat on the mat " * 400
    rows = [(1, text)] * 3 + [(k, f"word{k} the the") for k in range(2, 60)]
    for size in (50, 10_000_000):
        monkeypatch.setattr(token_counts, "BLOCK_CHARACTERS", size)
        found = token_counts.token_counts(documents(rows), PATH).collect()
        want = sorted((k, len(library.encode(t).ids)) for k, t in rows)
        assert sorted((r.doc_id, r.n_tokens) for r in found) == want
    assert token_counts.token_counts(documents([]), PATH).count() == 0
    assert bpe_automaton.encode_and_decode(documents([]), PATH).count() == 0


@pytest.mark.parametrize("buckets", [64, 128, 211])
def test_hot_pre_tokens_and_own_rows_spread_over_buckets(spark, documents, monkeypatch, buckets):
    """Blocks are numbered by their first row: a multiple of 2 ** 33 where a partition begins."""
    monkeypatch.setattr(spark.conf, "get", lambda key, *d, f=spark.conf.get: str(buckets) if key == "spark.sql.shuffle.partitions" else f(key, *d))
    rows = documents([(k, "the common" + " rare" * (k % 400 == 3)) for k in range(1600)]).repartition(16)
    indexed = token_counts.keyed_text(rows).select(
        "doc_id", "text", token_counts.F.monotonically_increasing_id().alias("row"), token_counts.F.lit(1).cast("bigint").alias("size")
    ).mapInPandas(token_counts._index(PATH, buckets), token_counts._INDEX).collect()
    blocks = {r.block for r in indexed}
    assert len(blocks) == 16
    assert len({r.bucket for r in indexed if r.doc_ids is not None}) >= 10
    assert len({r.bucket for r in indexed if "the" in r.pieces}) >= 10
    assert len({r.bucket for r in indexed if " rare" in r.pieces}) == 1
