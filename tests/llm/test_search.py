import math
import random
import re
from collections import Counter

import pytest

from llm_samples import words
from tidemark.llm import lexical_search

ITEM = "item_id bigint, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size=10):
    counted = [(doc_id, Counter(terms_of(text))) for doc_id, text in docs]
    total = sum(bool(c) for _, c in counted)
    length = sum(sum(c.values()) for _, c in counted)
    rows = []
    for item_id, text in items:
        scores = []
        for doc_id, counts in counted:
            score = 0
            for term in set(terms_of(text)) & counts.keys():
                df = sum(term in c for _, c in counted)
                m = 100 - 90 + 90 * sum(counts.values()) * total // length
                weight = math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1)))
                score += weight * (1_000_000_000 * counts[term] // (1000 * counts[term] + 8 * m))
            scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        best = [s for s in sorted(scores, key=lambda s: s[:3]) if s[0] < 0][:size]
        rows += [(item_id, k + 1, s[3], -s[0]) for k, s in enumerate(best)]
    return sorted(rows, key=str)


def tables(seed, count=120):
    draw = random.Random(seed)
    common = ["the", "und", "é", "日本"]
    docs = [(k, " ".join(draw.choices(words(k % 9, 40, 60) + common, k=draw.randint(0, 60)))) for k in range(count)]
    docs += [(1000 + k, "The THE copy, of one-text: é") for k in range(30)]  # ties at every place
    docs += [(5, "the second row of one id"), (5, "the second row of one id"), (None, "the null id copy"), (900, None), (901, ""), (902, " .,-")]
    docs += [(-7, "É é ÉÉ _ a_b 0x1F"), (2**63 - 1, "zzz only here"), (-(2**63), "zzz only here")]
    items = [(k, " ".join(draw.choices(words(k % 9, 40, 60) + common, k=draw.randint(1, 30)))) for k in range(25)]
    items += [(90, "copy of one text"), (90, "copy of one text"), (91, None), (92, "..."), (None, "the"), (93, "ZZZ"), (94, "absent0 terms1")]
    return docs, items


@pytest.mark.parametrize("postings,pairs", [(1_000_000, 2_000_000), (40, 50)])
def test_equals_brute_force(spark, documents, clashing, monkeypatch, postings, pairs):
    monkeypatch.setattr(lexical_search, "_PAIRS", pairs)
    docs, items = tables(3)
    found = lexical_search.ranked(
        clashing(documents(docs).repartition(5)), clashing(spark.createDataFrame(items, ITEM)), postings=postings
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(docs, items)


def test_empty_tables_and_sizes(spark, documents):
    docs, items = tables(4, 30)
    none = spark.createDataFrame([], ITEM)
    assert lexical_search.ranked(documents([]), spark.createDataFrame(items, ITEM)).count() == 0
    assert lexical_search.ranked(documents(docs), none).count() == 0
    assert lexical_search.ranked(documents([(1, None)]), spark.createDataFrame([(1, "a")], ITEM)).count() == 0
    found = lexical_search.ranked(documents(docs), spark.createDataFrame(items, ITEM), size=3)
    assert sorted(map(tuple, found.collect()), key=str) == brute(docs, items, 3)


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = ("Word" * 3 + " é ") * 50
    whole = [t for part in lexical_search.term_lists(text.encode()) for t in part]
    monkeypatch.setattr(lexical_search, "_PART", 7)
    assert [t for part in lexical_search.term_lists(text.encode()) for t in part] == whole == [t.encode() for t in terms_of(text)]


def test_heaps_keep_the_best_of_many_batches():
    import numpy as np

    draw = np.random.default_rng(5)
    heaps, rows = lexical_search.Heaps(4, 10), []
    for batch in range(30):
        scores = draw.integers(0, 6, (50, 4))
        ids = draw.permutation(50) + 50 * (29 - batch)
        heaps.add(scores, np.ones(50, np.int64), ~ids)
        rows += [(int(s[k]), ~int(i), k) for s, i in zip(scores, ids) for k in range(4)]
    for k in range(4):
        want = sorted(((s, i) for s, i, item in rows if item == k and s > 0), reverse=True)[:10]
        assert sorted(((s, i) for s, _, i in heaps.heaps[k]), reverse=True) == want


def test_the_merge_is_pruned_before_each_shuffle(spark):
    heaps = spark.range(1000).selectExpr("id % 7 AS item", "id % 7 AS item_id", "id AS doc_id", "id * 31 % 97 AS score")
    plan = lexical_search._merged(heaps, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 3
