import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie

TURN = "conv_id bigint, turn bigint, role string, text string"


def digest(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute(rows):
    """Nodes by their whole sequences."""
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own.setdefault(conv_id, []).append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[x] for x in below) if below else 1
        saved[node] = sum(saved[x] for x in below) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    result = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node))
        above = min(members[node[:-1]]) if node else None
        result.append((min(convs), len(node), above, len(convs), len(children.get(node, [])), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(result, key=str)


def talks(seed, convs=260, longest=12, vocabulary=3):
    draw = random.Random(seed)
    rows = []
    for c in [*range(convs), 1000, 1001, 2150, -3, -150, 2**62]:
        for turn in range(draw.choice([1, 2, 3, longest])):
            text = "hello é😀 "[: draw.randrange(1, 9)] if draw.random() < 0.2 else f"text {draw.randrange(vocabulary)}"
            rows.append((c, draw.choice([turn, turn, turn, None]) if c % 7 == 0 else turn, draw.choice(["user", "assistant"]) if c % 5 else "user", text))
    rows += [(3, 0, None, None), (3, 0, "", ""), (None, 1, "user", "nobody's"), (400, 0, "user", ""), (401, None, None, "x")]
    rows += [(4, 1, "user", "repeated")] * 3 + [(500 + k, t, "user", f"copy {t}") for k in range(60) for t in range(4)]
    draw.shuffle(rows)
    return rows


def found(frame):
    out = prefix_trie.trie(frame)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("strand,batches", [(128, (5, 25, 100)), (4, (30, 60, 100))])
def test_equals_brute_force(spark, clashing, monkeypatch, strand, batches):
    monkeypatch.setattr(prefix_trie, "STRAND", strand)
    monkeypatch.setattr(prefix_trie, "BATCHES", batches)
    rows = talks(strand)
    rows += [(600 + c, t, "user", f"{t if t < 40 - c else c}") for c in range(3) for t in range(45)]
    assert found(clashing(spark.createDataFrame(rows, TURN)).repartition(5)) == brute(rows)


def test_empty_and_turnless(spark):
    assert found(spark.createDataFrame([], TURN)) == []
    assert found(spark.createDataFrame([(None, 1, "a", "b")], TURN)) == []
    alone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(alone, 0, "user", "lost")]
    assert found(spark.createDataFrame(rows, TURN)) == brute(rows) and brute(rows)[0][1] == 0


def test_two_fattest(spark):
    def plain(low, high):
        return max(range(low + 1, high + 1), key=lambda n: n & -n)

    pairs = [(a, b) for b in range(1, 130) for a in range(0, b, 3)]
    frame = spark.createDataFrame(pairs, "a int, b int").select("a", "b", prefix_trie.two_fattest(F.col("a"), F.col("b")).alias("f"))
    assert all(r.f == plain(r.a, r.b) for r in frame.collect())


def test_search_finds_the_longest_shared_prefix(spark):
    """Against comparing a strand with every strand of the trie."""
    rows = talks(9, 200)
    turns, _ = prefix_trie.rebuilt(prefix_trie.ordered_turns(spark.createDataFrame(rows, TURN)))
    strands = prefix_trie.pinned(prefix_trie.strands_of(prefix_trie.with_fingerprints(turns)))
    half = F.pmod(F.xxhash64("fp"), F.lit(2)) == 0
    nodes = prefix_trie.inserted(prefix_trie.inserted(None, strands.where(half)), strands.where(half))
    there = {t["fp"] for r in strands.where(half).collect() for t in r["line"]}
    got = prefix_trie.located(strands.where(~half), nodes).collect()
    ends = {r["fp"] for r in nodes.collect()}
    assert len(got) > 40
    for r in got:
        want = sum(t["fp"] in there for t in r["line"])
        assert r["met"] == want
        at_node = want == 0 or r["line"][want - 1]["fp"] in ends
        assert (r["split"] is None) == at_node


def test_a_node_is_an_end_or_a_fork(spark):
    turns, _ = prefix_trie.rebuilt(prefix_trie.ordered_turns(spark.createDataFrame(talks(2), TURN)))
    strands = prefix_trie.pinned(prefix_trie.strands_of(prefix_trie.with_fingerprints(turns)))
    nodes = prefix_trie.built(strands).collect()
    above, ends = [r["above"] for r in nodes], {r["fp"] for r in strands.collect()}
    assert len({r["fp"] for r in nodes}) == len(nodes)
    assert all(r["fp"] in ends or above.count(r["fp"]) > 1 for r in nodes)
    assert all(r["depth"] - r["top"] == len(r["line"]) and r["line"][-1]["fp"] == r["fp"] for r in nodes)
    handles = prefix_trie._with_handle(spark.createDataFrame(nodes, prefix_trie.built(strands).schema))
    assert handles.select("handle").distinct().count() == len(nodes)
