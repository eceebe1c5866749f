import re

import xxhash

from llm_samples import EDGE, words
from tidemark.llm import simhash


def brute_fingerprint(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    values, parent = sorted(set(prints.values())), {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for k, a in enumerate(values):
        for b in values[:k]:
            if (a ^ b).bit_count() <= 2:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for doc, value in prints.items():
        least[root(value)] = min(least.get(root(value), doc), doc)
    return {doc: least[root(value)] for doc, value in prints.items()}


def texts():
    base = words(1, 300)
    near = []
    for k in range(40):
        copy = list(base)
        copy[k * 7] = f"new{k}"
        near.append(" ".join(copy))
    return [*EDGE, " ".join(base), " ".join(base).upper(), *near, *(" ".join(words(s, 60)) for s in range(2, 30))]


def test_matches_brute_force(spark, documents, clashing):
    docs = dict(enumerate(texts()))
    prints = {k: brute_fingerprint(t) for k, t in docs.items()}
    found = simhash.near_duplicates(clashing(documents(docs.items()))).collect()
    assert {r.doc_id: r.fingerprint for r in found} == {k: f"{v:016x}" for k, v in prints.items()}
    assert {r.doc_id: r.component_id for r in found} == brute_components(prints)
    assert len(set(brute_components(prints).values())) < len(docs) - 10


def test_chain_of_links_is_one_component(spark):
    values = [(1 << (2 * k)) - 1 for k in range(20)] + [0b11 << 40 | 1 << 63]
    edges = simhash.links(spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp bigint"))
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    assert len(roots) == 20 and set(roots.values()) == {0}


def test_nulls_repeats_and_empty_tables(spark, documents):
    same = "a b c d e"
    rows = [(None, same), (7, same), (7, same), (9, None), (8, ""), (None, "only this one here")]
    found = sorted(simhash.near_duplicates(documents(rows)).collect(), key=str)
    assert len(found) == 6
    assert {r.component_id for r in found if r.fingerprint == "0" * 16} == {8}
    assert [r.component_id for r in found].count(7) == 3 and [r.component_id for r in found].count(None) == 1
    assert simhash.near_duplicates(documents([])).collect() == []


def test_one_row_of_each_group_stays(spark, documents, clashing):
    same = " ".join(words(5, 50))
    docs = clashing(documents([(3, same), (2, same), (2, same), (None, same), (4, " ".join(words(6, 50))), (5, None), (None, None)]))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5]
    assert simhash.keep_one(documents([])).count() == 0


def test_a_block_boundary_changes_nothing():
    text = " ".join(words(9, 4000))
    from tidemark.llm.common import word_blocks

    whole = [w for block in word_blocks(text) for w in block]
    assert [w for block in word_blocks(text, 100) for w in block] == whole
