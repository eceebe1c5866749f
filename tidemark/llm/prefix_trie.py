"""Prefix trie of conversations as a z-fast trie over distributed tables.

Every turn becomes a digest, so that texts never move.  The fingerprint of a prefix combines
the digests of its turns with their depths; equal prefixes, and for all practical purposes only
those, have equal fingerprints (128 bits).  A conversation is cut into strands of at most
`STRAND` turns, which bounds a row however long a conversation is; strands with the same
end are one.

The trie is a table of compacted nodes.  A node stands for the edge from its parent's
depth `top` (exclusive) to its own depth and holds the fingerprints along it.  Its handle
is the fingerprint at the two-fattest number of that interval, the one most divisible by two.
Strands are inserted in batches:

* a fat binary search finds the exit node of every strand of the batch: it looks up the
  fingerprint at the two-fattest number of the open interval among the handles; a hit
  moves the lower end to the depth of the node, a miss the upper end below the number;
* edges that strands leave in the middle are split there;
* the turns of the strands beyond their exits are grouped by fingerprint; where strands end
  or part is a new node, and the rest of the turns are the edges between.

Sums over subtrees double their reach in every round along pointers to ancestors.
Expanding the edges at the end gives a row for each prefix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import pinned

#: Turns in a strand; each multiple of it is the depth of a node.
STRAND = 128
#: Cumulative shares of the strands, in percent, that the batches insert.
BATCHES = (5, 25, 100)
#: Conversations that share a base, and the number of first turns taken from it.
GROUP, MOST_SHARED = 100, 6
#: Ids of one node that are joined in one row before they are hashed.
_IDS_TOGETHER = 65_536
_ROOT = "0" * 32
_NONE = hashlib.sha256(b"").hexdigest()


def two_fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] that is divisible by the largest power of two; low < high."""
    step = F.pow(F.lit(2), F.length(F.bin(low.bitwiseXOR(high))) - 1)
    return (F.floor(high / step) * step).cast("int")


# ---- turns and fingerprints -----------------------------------------------------------


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, digest, size): turns numbered from 1 in each conversation, without their texts.

    Ordered by turn, null first, equal turns by digest.  Positions come from ranges of
    the whole table, so a conversation with very many turns is spread over tasks.
    """
    text = lambda name: F.coalesce(F.col(name), F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        F.md5(F.concat_ws(":", F.octet_length(text("role")).cast("string"), F.concat(text("role"), text("text")))).alias("digest"),
        F.length(text("text")).cast("bigint").alias("size"),
    )
    order = ["conv_id", F.asc_nulls_first("turn"), "digest"]
    placed = pinned(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    here = Window.partitionBy("conv_id", "part").orderBy(F.asc_nulls_first("turn"), "digest")
    counts = placed.groupBy("conv_id", "part").agg(F.count("*").alias("held"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Only conversations that reach over a border of ranges have more than one row here.
    before = counts.select("conv_id", "part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))
    numbered = placed.withColumn("inside", F.row_number().over(here)).join(before, ["conv_id", "part"])
    return numbered.select("conv_id", (F.col("before") + F.col("inside")).alias("at"), "digest", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, digest, size) of the rebuilt conversations, and (conv_id) of all of them.

    The first h turns are those of the conversation conv_id - conv_id % 100, the others
    the conversation's own after its first h; h is crc32(conv_id) % 6.
    """
    turns = turns.withColumn("taken", F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(MOST_SHARED)))
    convs = turns.groupBy("conv_id").agg(F.first("taken").alias("taken"))
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
    heads = turns.where((F.col("conv_id") % GROUP == 0) & (F.col("at") < MOST_SHARED)).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("at", "digest", "size"))).alias("head")
    )
    shared = convs.where("taken > 0").join(heads, "base").select("conv_id", F.expr("slice(head, 1, cast(taken AS int))").alias("head"))
    first = shared.select("conv_id", F.posexplode("head").alias("k", "turn")).select(
        "conv_id", (F.col("k") + 1).cast("bigint").alias("depth"), "turn.digest", "turn.size"
    )
    own = turns.where("at > taken").join(shared.select("conv_id", F.size("head").alias("had")), "conv_id", "left")
    own = own.select("conv_id", (F.col("at") - F.col("taken") + F.coalesce("had", F.lit(0))).alias("depth"), "digest", "size")
    return first.unionAll(own), convs.select("conv_id")


def with_fingerprints(turns: DataFrame) -> DataFrame:
    """(conv_id, piece, depth, root, fp, path, size): fingerprints of the prefix that ends with the turn.

    `path` counts the code points of the prefix, `size` those of the turn; `root` is the
    fingerprint before the turn's piece.  The fingerprint is the exclusive or of two hashes of (depth, digest) per turn, so it is a
    running total: within a piece of `STRAND` turns, and over the pieces of a conversation.
    """
    high, low = F.xxhash64("depth", "digest"), F.xxhash64(F.lit("low"), "digest", "depth")
    turns = turns.select("*", high.alias("high"), low.alias("low"), F.floor((F.col("depth") - 1) / STRAND).alias("piece"))
    whole = {"high": F.bit_xor, "low": F.bit_xor, "size": F.sum}
    inside = Window.partitionBy("conv_id", "piece").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = turns.groupBy("conv_id", "piece").agg(*[f(c).alias(c) for c, f in whole.items()])
    pieces = pieces.select("conv_id", "piece", *[F.coalesce(f(c).over(before), F.lit(0)).alias(f"before_{c}") for c, f in whole.items()])
    sums = [f(c).over(inside).alias(f"sum_{c}") for c, f in whole.items()]
    turns = turns.select("conv_id", "piece", "depth", "size", *sums).join(pieces, ["conv_id", "piece"])
    joined = lambda value: F.concat(*[F.lpad(F.lower(F.hex(value(c))), 16, "0") for c in ("high", "low")])
    return turns.select(
        "conv_id",
        "piece",
        "depth",
        joined(lambda c: F.col(f"before_{c}")).alias("root"),
        joined(lambda c: F.col(f"before_{c}").bitwiseXOR(F.col(f"sum_{c}"))).alias("fp"),
        (F.col("before_size") + F.col("sum_size")).alias("path"),
        "size",
    )


def strands_of(turns: DataFrame) -> DataFrame:
    """(fp, root, start, line): distinct strands by their last fingerprint.

    `line` holds (fp, path, size) of the depths start + 1, start + 2, ...; `root` is the
    fingerprint at depth `start`.
    """
    turn = F.struct("depth", "fp", "path", "size")
    lines = turns.groupBy("conv_id", "piece").agg(F.first("root").alias("root"), F.sort_array(F.collect_list(turn)).alias("line"))
    lines = lines.select("root", (F.col("piece") * STRAND).cast("int").alias("start"), F.transform("line", lambda t: t.dropFields("depth")).alias("line"))
    return lines.select(F.element_at("line", -1)["fp"].alias("fp"), "*").dropDuplicates(["fp"])


# ---- the trie ---------------------------------------------------------------------------


# A node has fp and depth, the fp and depth of its parent as above and top, the start of its
# strands, and (fp, path, size) of the turns along its edge as line.


def _with_handle(nodes: DataFrame) -> DataFrame:
    """Adds handle, the fingerprint at the two-fattest number of the edge, counted from the strand's start."""
    fattest = two_fattest(F.col("top") - F.col("start"), F.col("depth") - F.col("start"))
    return nodes.withColumn("handle", F.element_at("line", fattest - (F.col("top") - F.col("start")))["fp"])


def located(strands: DataFrame, nodes: DataFrame) -> DataFrame:
    """Adds to strands `met`, the number of turns shared with the trie, and `split`, the fp of the edge left in its middle.

    One round of the fat binary search is one join of the strands' probes with the handles.
    """
    longest = strands.agg(F.max(F.size("line"))).first()[0] or 0
    handles = _with_handle(nodes).select(
        "handle", F.col("fp").alias("node"), (F.col("depth") - F.col("start")).alias("node_depth"), F.size("line").alias("span")
    )
    state = strands.select("*", F.lit(0).alias("low"), F.size("line").alias("high"))
    for _ in range(longest.bit_length()):
        probe = F.when(F.col("low") < F.col("high"), F.element_at("line", two_fattest(F.col("low"), F.col("high")))["fp"])
        looked = state.withColumn("probe", probe).join(handles, F.col("probe") == F.col("handle"), "left")
        open_, hit = F.col("low") < F.col("high"), F.col("node").isNotNull()
        # A hit whose node ends within the strand, on its path, is passed; any other hit is the exit.
        passed = hit & (F.col("node_depth") <= F.size("line")) & (F.get("line", F.col("node_depth") - 1)["fp"] == F.col("node"))
        state = looked.select(
            *strands.columns,
            F.when(open_ & passed, F.col("node_depth")).when(open_ & hit, F.col("node_depth") - F.col("span")).otherwise(F.col("low")).alias("low"),
            F.when(open_ & hit & ~passed, F.col("node_depth") - F.col("span"))
            .when(open_ & ~hit, two_fattest(F.col("low"), F.col("high")) - 1)
            .otherwise(F.col("high"))
            .alias("high"),
        )
    # All on the path up to `low` is in the trie; the edge that goes on from there is known by its first turn.
    edges = nodes.select(F.col("line")[0]["fp"].alias("next"), F.col("fp").alias("edge"), F.col("line").alias("edge_line"))
    state = state.withColumn("next", F.get("line", F.col("low"))["fp"]).join(edges, "next", "left")
    rest = F.slice("line", F.col("low") + 1, F.greatest(F.size("line") - F.col("low"), F.lit(0)))
    shared = F.size(F.filter(F.zip_with(rest, "edge_line", lambda a, b: a["fp"] == b["fp"]), lambda same: same))
    shared = F.when(F.col("edge").isNull(), 0).otherwise(shared)
    split = F.when((shared > 0) & (shared < F.size("edge_line")), F.col("edge"))
    return state.select(*strands.columns, (F.col("low") + shared).alias("met"), split.alias("split"))


def _pieces(line: Column, ends: Column) -> Column:
    """The line cut after each of the ascending positions `ends`, as structs (from, to)."""
    return F.transform(ends, lambda end, k: F.struct(F.when(k > 0, F.get(ends, k - 1)).otherwise(0).alias("from"), end.alias("to")))


def _cut(lines: DataFrame) -> DataFrame:
    """Nodes of lines (start, top, above, line, ends): one for each piece between ends."""
    cut = lines.select("start", "top", "above", "line", F.explode(_pieces(F.col("line"), F.col("ends"))).alias("piece"))
    return cut.select(
        F.element_at("line", F.col("piece.to"))["fp"].alias("fp"),
        F.when(F.col("piece.from") > 0, F.get("line", F.col("piece.from") - 1)["fp"]).otherwise(F.col("above")).alias("above"),
        "start",
        (F.col("top") + F.col("piece.from")).alias("top"),
        (F.col("top") + F.col("piece.to")).alias("depth"),
        F.slice("line", F.col("piece.from") + 1, F.col("piece.to") - F.col("piece.from")).alias("line"),
    )


def inserted(nodes: DataFrame | None, strands: DataFrame) -> DataFrame:
    """The trie with a batch of strands added."""
    if nodes is None:
        found = strands.select("*", F.lit(0).alias("met"), F.lit(None).cast("string").alias("split"))
    else:
        found = pinned(located(strands, nodes))
    # Turns beyond the exits: where strands end or part is a node.
    there = F.transform(
        F.sequence(F.col("met"), F.size("line") - 1),
        lambda k: F.struct(
            k.alias("at"), F.get("line", k).alias("turn"), F.get("line", k + 1)["fp"].alias("next"),
            F.when(k > 0, F.get("line", k - 1)["fp"]).otherwise(F.col("root")).alias("above"),
        ),
    )
    beyond = found.where(F.col("met") < F.size("line")).select(F.col("fp").alias("strand"), "start", F.explode(there).alias("t"))
    prefixes = beyond.groupBy(F.col("t.turn.fp").alias("fp")).agg(
        F.min("strand").alias("strand"), F.first("start").alias("start"), F.first("t.at").alias("at"), F.first("t.turn").alias("turn"),
        F.first("t.above").alias("above"), (F.max(F.col("t.next").isNull()) | (F.min("t.next") != F.max("t.next"))).alias("node"),
    )
    # Turns of one edge have the same strands below them, and so the same least one.
    lines = prefixes.groupBy("strand").agg(
        F.first("start").alias("start"), F.sort_array(F.collect_list(F.struct("at", "turn", "above", "node"))).alias("turns")
    )
    lines = lines.select(
        "start",
        (F.col("start") + F.col("turns")[0]["at"]).alias("top"),
        F.col("turns")[0]["above"].alias("above"),
        F.col("turns.turn").alias("line"),
        F.filter(F.transform("turns", lambda t, k: F.when(t["node"], k + 1)), lambda k: k.isNotNull()).alias("ends"),
    )
    new = _cut(lines)
    if nodes is None:
        return pinned(new)
    splits = found.where("split IS NOT NULL").groupBy("split").agg(F.collect_set(F.col("start") + F.col("met")).alias("depths"))
    old = nodes.join(splits, nodes["fp"] == F.col("split"), "left")
    ends = F.array_sort(F.array_append(F.transform("depths", lambda d: (d - F.col("top")).cast("int")), F.size("line")))
    whole = old.where("split IS NULL").select(*nodes.columns)
    halves = _cut(old.where("split IS NOT NULL").withColumn("ends", ends))
    return pinned(whole.unionByName(halves).unionByName(new))


def built(strands: DataFrame) -> DataFrame:
    """The compacted trie of all strands, inserted batch by batch."""
    nodes, done = None, 0
    place = F.pmod(F.xxhash64("fp"), F.lit(100))
    for share in BATCHES:
        nodes = inserted(nodes, strands.where((place >= done) & (place < share)))
        done = share
    return nodes


# ---- sums over subtrees and the expanded nodes ------------------------------------------


def summed(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """Nodes, the root among them, with sums over their subtrees.

    `ends` has the number of members that end at a fingerprint and the least of them.  Adds
    n_children, and of all members n_convs, the smallest conv_id and `ended`, the code points of
    their whole conversations; n_leaves; and `text`, the code points of all edges.
    """
    nothing = {c: F.lit(None).cast(kind) for c, kind in nodes.dtypes if c != "fp"}
    number = lambda n: F.lit(n).cast("bigint")
    parts = nodes.withColumns({"child": number(0), "members": number(0), "least": F.lit(None).cast("bigint")})
    children = nodes.select(F.col("above").alias("fp")).withColumns(nothing | {"child": number(1), "members": number(0), "least": F.lit(None).cast("bigint")})
    members = ends.withColumns(nothing | {"child": number(0)})
    one = parts.unionByName(children).unionByName(members).groupBy("fp").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in nothing],
        F.sum("child").alias("n_children"), F.sum("members").alias("n_convs"), F.min("least").alias("conv_id"),
    )
    end, begin = F.element_at("line", -1), F.get("line", F.lit(0))
    one = pinned(one.withColumns({
        "n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint"),
        "ended": F.col("n_convs") * F.coalesce(end["path"], number(0)),
        "text": F.coalesce(end["path"] - begin["path"] + begin["size"], number(0)),
    }))
    sums = ("n_convs", "n_leaves", "ended", "text")
    state = one.select("fp", F.col("above").alias("pointer"), "conv_id", *sums)
    while state.where("pointer IS NOT NULL").limit(1).count():
        added = state.where("pointer IS NOT NULL").groupBy(F.col("pointer").alias("fp")).agg(
            *[F.sum(c).alias(f"more_{c}") for c in sums], F.min("conv_id").alias("more_conv_id")
        )
        further = state.select(F.col("fp").alias("pointer"), F.col("pointer").alias("further"))
        state = pinned(
            state.join(added, "fp", "left").join(further, "pointer", "left").select(
                "fp", F.col("further").alias("pointer"), F.least("conv_id", "more_conv_id").alias("conv_id"),
                *[(F.col(c) + F.coalesce(F.col(f"more_{c}"), F.lit(0))).alias(c) for c in sums],
            )
        )
    return one.drop("conv_id", *sums).join(state.drop("pointer"), "fp")


def _ends_hash(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 per node over its joined ids, which come in order, a bounded piece at a time."""
    open_, digest = None, None
    for batch in batches:
        done = []
        for fp, ids in zip(batch["fp"], batch["ids"]):
            if fp != open_:
                if open_ is not None:
                    done.append((open_, digest.hexdigest()))
                open_, digest = fp, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield pd.DataFrame(done, columns=["fp", "ends_sha256"])
    if open_ is not None:
        yield pd.DataFrame([(open_, digest.hexdigest())], columns=["fp", "ends_sha256"])


def ends_of(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, fp) of the node at which each rebuilt conversation ends."""
    last = turns.groupBy("conv_id").agg(F.max_by("fp", "depth").alias("fp"))
    return convs.join(last, "conv_id", "left").select("conv_id", F.coalesce("fp", F.lit(_ROOT)).alias("fp"))


def end_hashes(ends: DataFrame) -> DataFrame:
    """(fp, ends_sha256): ids of a node meet in pieces of bounded ranges, and then stream in order through the hash."""
    pieces = ends.groupBy("fp", F.floor(F.col("conv_id") / _IDS_TOGETHER).alias("piece")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids")
    )
    return pieces.repartition("fp").sortWithinPartitions("fp", "piece").select("fp", "ids").mapInPandas(_ends_hash, "fp string, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    conversations has conv_id, turn, role and text; other columns are ignored.  Null roles and
    texts are empty, null turns come first, equal turns are ordered by the MD5 of role and
    text, and repeated rows are repeated turns.  Rows without a conv_id belong to no
    conversation and are left out.  An empty table gives an empty result.
    """
    turns, convs = rebuilt(ordered_turns(conversations))
    turns, convs = pinned(with_fingerprints(turns)), pinned(convs)
    ends = pinned(ends_of(turns, convs))
    counted = ends.groupBy("fp").agg(F.count("*").alias("members"), F.min("conv_id").alias("least"))
    nodes = summed(built(pinned(strands_of(turns))), counted)
    parents = nodes.select(F.col("fp").alias("above"), F.col("conv_id").alias("above_conv_id"))
    rows = pinned(nodes.join(parents, "above", "left").join(end_hashes(ends), "fp", "left"))
    # Within an edge all nodes have the members of its lower end, and one child each.
    cells = rows.select("*", F.posexplode("line").alias("k", "turn")).withColumn("above_path", F.col("turn.path") - F.col("turn.size"))
    cells = cells.withColumn("begin_path", F.get("line", F.lit(0))["path"] - F.get("line", F.lit(0))["size"])
    last = F.col("k") == F.size("line") - 1
    # Code points that members repeat: all they hold from this depth on, less every text once.
    once = F.col("text") - (F.col("above_path") - F.col("begin_path"))
    inner = cells.select(
        "conv_id",
        (F.col("top") + F.col("k") + 1).cast("bigint").alias("depth"),
        F.when(F.col("k") > 0, F.col("conv_id")).otherwise(F.col("above_conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(last, F.col("n_children")).otherwise(1).cast("bigint").alias("n_children"),
        "n_leaves",
        (F.col("ended") - F.col("n_convs") * F.col("above_path") - once).alias("saved_tokens"),
        F.when(last, F.coalesce("ends_sha256", F.lit(_NONE))).otherwise(_NONE).alias("ends_sha256"),
    )
    root = rows.where(F.col("fp") == _ROOT).select(
        "conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", (F.col("ended") - F.col("text")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_NONE)).alias("ends_sha256"),
    )
    return root.unionByName(inner)
