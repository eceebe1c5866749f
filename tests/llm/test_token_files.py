import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_samples import EDGE
from tidemark.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def fuzz():
    draw = random.Random(11)
    parts = ["a", "The", " ", "  ", "\n", "é", "é", "́", "日本", "😀", "'s", "'S", "22", "<|endoftext|>", "<|startoftext|>", "İ", "Σ", "ΑΣ", "\x1c", "\x85", "\xa0", " ", "​", "ing", "É", "Ü", "ß", "×", "÷", "²", "µ", "ÿ", "'LL", "ª", "\x00", "\t", "\x0b", "#!"]
    return [*EDGE, *("".join(draw.choices(parts, k=draw.randint(0, 50))) for _ in range(2000))]


def arrays():
    draw = np.random.default_rng(2)
    yield np.zeros(0, np.uint32)
    yield np.array([7], np.uint32)
    yield np.full(128, 2**32 - 1, np.uint32)
    yield np.array([0, 2**32 - 1] * 200, np.uint32)
    for size in (127, 128, 129, 5000):
        yield draw.integers(0, 49408, size, dtype=np.uint32)
        few = draw.integers(1000, 1008, size, dtype=np.uint32)
        few[:: max(3, size // 9)] = draw.integers(0, 2**32, len(few[:: max(3, size // 9)]), dtype=np.uint32)
        yield few


def test_blocks_round_trip():
    for ids in arrays():
        packed, starts = token_files.pack(ids)
        assert len(starts) == -(-len(ids) // token_files.BLOCK)
        if len(ids):
            assert token_files.unpack(np.frombuffer(packed, np.uint8), starts)[: len(ids)].tolist() == ids.tolist()


def test_outliers_are_patched_not_paid_for():
    ids = np.full(128, 1000, np.uint32)
    ids[1::2] += 3
    narrow = len(token_files.pack(ids)[0])
    ids[5], ids[77] = 2**31, 2**20
    assert narrow == 6 + 2 * 16
    assert len(token_files.pack(ids)[0]) == narrow + 2 * 5


def test_files_read_documents_and_stretches():
    parts = list(arrays())
    ids = [None, -5, 2**63 - 1, *range(len(parts) - 3)]
    content = token_files.file_of(ids, parts, 3, 9)
    for written in (content, content + b"\n"):
        file = token_files.TokenFile(written)
        assert (file.doc_ids, file.part, file.number) == (ids, 3, 9)
        for k, want in enumerate(parts):
            assert file.document(k).tolist() == want.tolist()
    whole = np.concatenate(parts)
    for a, b in ((0, 1), (100, 130), (127, 129), (300, 300), (5, len(whole) + 10)):
        assert file.between(a, b).tolist() == whole[a:b].tolist()
    for broken in (content[:-1], content[:200], b"", b"x" + content[1:], content[:50] + b"\xff\x00\xff" + content[53:]):
        with pytest.raises(ValueError):
            token_files.TokenFile(broken)


def test_words_encode_as_the_whole_text(library, monkeypatch):
    encoder = token_files.WordEncoder(PATH)
    for text in fuzz():
        assert encoder.encode(text.encode()).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text[:60])
    draw = random.Random(3)
    plain = ["a", "É", "ß", "×", "÷", "Þ", "ÿ", " ", "\n", "'s", "'RE", "'", "7", "x1", ".", "\x1f", "\x7f", "-", "<", "|"]
    for _ in range(2000):
        text = "".join(draw.choices(plain, k=draw.randint(0, 40)))
        assert encoder.encode(text.encode()).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    monkeypatch.setattr(token_files, "_PART", 5)
    monkeypatch.setattr(token_files, "REMEMBERED_WORDS", 3)
    for text in fuzz()[::10]:
        assert encoder.encode(text.encode()).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("file_ids", [2_000_000, 300])
def test_stored_equals_the_library(spark, documents, clashing, library, monkeypatch, file_ids):
    monkeypatch.setattr(token_files, "FILE_IDS", file_ids)
    texts = fuzz()[:300]
    rows = [*((3 * k % 700 - 50, t) for k, t in enumerate(texts)), (None, "no id"), (2000, None), (2**63 - 1, "last"), (-(2**63), "first"), (7, "one"), (7, "one"), (7, "two three")]
    random.Random(1).shuffle(rows)
    found = token_files.stored(clashing(documents(rows).repartition(4)), PATH)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    got = sorted(found.collect(), key=lambda r: r.start)
    coded = [(d, [*library.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in rows]
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    order = lambda d: (d is not None, d or 0)
    assert sorted([(order(r.doc_id), r.n_tokens, r.ids_crc32) for r in got]) == sorted((order(d), len(ids), crc(ids)) for d, ids in coded)
    assert [order(r.doc_id) for r in got] == sorted(order(d) for d, _ in coded)
    ends = [0, *(r.start + r.n_tokens for r in got)]
    assert [r.start for r in got] == ends[:-1]


def test_empty_table_and_hot_id(spark, documents, tmp_path):
    assert token_files.stored(documents([]), PATH).count() == 0
    rows = [(1, f"copy {k % 3}") for k in range(300)] + [(k, "x") for k in range(2, 50)] + [(None, "none")] * 100
    path = str(tmp_path / "files")
    token_files.write_files(documents(rows).repartition(6), path, PATH)
    got = sorted(token_files.read_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None] * 100 + [1] * 300 + list(range(2, 50))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:])) and got[0].start == 0
    parts = {}
    for name in glob.glob(f"{path}/part-*"):
        file = token_files.TokenFile(open(name, "rb").read())
        for d in file.doc_ids:
            parts.setdefault(d, set()).add(file.part)
    assert len(parts[1]) > 1
