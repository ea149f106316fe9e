"""Prefix trie of conversations: subtree figures by an Euler tour whose arcs are ranked as a distributed list."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scans import neighbours, running
from .common import stash, table

#: Four sums of 32-bit hashes tell prefixes apart; as exact sums, they are made range by range.
_SUMS = ["s0", "s1", "s2", "s3"]
_KEY = ["depth", *_SUMS]


def positions(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, chars): places from 1 by (turn, role, text), nulls first, and 128 bits of (role, text)."""
    t = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = running(t, ["conv_id"], ["turn", "role", "text"], {"pos": F.lit(1)}, keep=stash)
    return stash(placed.select("conv_id", F.col("pos").cast("long").alias("pos"), F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(1), "role", "text").alias("b"), F.length("text").cast("long").alias("chars")))


def rebuilt(turns: DataFrame, heads: int = 6, group: int = 100) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: (conv_id, pos, a, b, chars), and (conv_id, depth) of all, turnless ones too.

    Each takes the first ``h = crc32(conv_id) % heads`` turns of conversation ``conv_id - conv_id % group``, and its own
    turns after its first h. A conversation that others start with is handed to at most 2 * group - 1 of them, and only
    with its first ``heads - 1`` turns.
    """
    rows = positions(turns)
    convs = rows.groupBy("conv_id").agg(F.max("pos").alias("own"))
    h = F.crc32(F.col("conv_id").cast("string")) % heads
    start = rows.where((F.col("conv_id") % group == 0) & (F.col("pos") < heads))
    convs = convs.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
    lengths = start.groupBy(F.col("conv_id").alias("base")).agg(F.max("pos").alias("_base_own"))
    convs = convs.join(lengths, "base", "left").withColumn("taken", F.least("h", F.coalesce("_base_own", F.lit(0))))
    convs = stash(convs.select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).cast("long").alias("depth")))
    shared = convs.select("conv_id", "base", "h").join(start.withColumnRenamed("conv_id", "base"), "base").where("pos <= h").select("conv_id", "pos", "a", "b", "chars")
    own = rows.where(F.col("pos") > h).join(convs.select("conv_id", "h", "taken"), "conv_id").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "a", "b", "chars")
    return shared.unionByName(own), convs.select("conv_id", "depth")


def trie(turns: DataFrame, heads: int = 6, group: int = 100) -> tuple[DataFrame, DataFrame]:
    """Nodes (depth, s0 ... s3, id, conv_id, n_convs, weight, p0 ... p3), and (depth, s0 ... s3, conv_id) of the ends.

    A node is a distinct sequence of first turns, told apart by its length and the sums of its turns' hashes, which mix
    in their places; p0 ... p3 are its parent's sums. ``weight`` is what it saves: (n_convs - 1) * code points of its text.
    """
    rows, convs = rebuilt(turns, heads, group)
    x, y = F.xxhash64("pos", "a", "b"), F.xxhash64(F.lit(7), "b", "pos", "a")
    half = {"s0": F.shiftrightunsigned(x, 32), "s1": x.bitwiseAND(0xFFFFFFFF), "s2": F.shiftrightunsigned(y, 32), "s3": y.bitwiseAND(0xFFFFFFFF)}
    rows = rows.select("conv_id", "pos", "chars", *[c.alias(f"w{i}") for i, c in enumerate(half.values())])
    rows = running(rows, ["conv_id"], ["pos"], {s: F.col(f"w{i}") for i, s in enumerate(_SUMS)}, keep=stash).withColumnRenamed("pos", "depth")
    rows = stash(rows.select("conv_id", "depth", "chars", *_SUMS, *[(F.col(s) - F.col(f"w{i}")).alias(f"p{i}") for i, s in enumerate(_SUMS)]))
    zero = [F.lit(0).cast("long").alias(s) for s in _SUMS]
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(F.lit(0).cast("long").alias("depth"), *zero, "conv_id", "n_convs", F.lit(0).cast("long").alias("weight"), *[F.lit(None).cast("long").alias(f"p{i}") for i in range(4)])
    nodes = rows.groupBy(*_KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("chars").alias("chars"), *[F.first(f"p{i}").alias(f"p{i}") for i in range(4)])
    nodes = nodes.select(*_KEY, "conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("chars")).alias("weight"), *[f"p{i}" for i in range(4)])
    nodes = stash(nodes.unionByName(root).withColumn("id", F.monotonically_increasing_id()))
    ends = rows.select("conv_id", *_KEY).join(convs, ["conv_id", "depth"])
    return nodes, ends.select(*_KEY, "conv_id").unionByName(convs.where("depth = 0").select("depth", *zero, "conv_id"))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix sums of what is left of the list, which has a bounded number of arcs."""
    arcs = {r["arc"]: r for b in batches for r in b.to_pylist()}
    at, leaves, saved, out = next((a for a, r in arcs.items() if r["prev"] is None), None), 0, 0, []
    while at is not None:
        leaves, saved = leaves + arcs[at]["leaves"], saved + arcs[at]["saved"]
        out.append({"arc": at, "leaves": leaves, "saved": saved})
        at = arcs[at]["next"]
    yield pa.RecordBatch.from_pylist(out, pa.schema([(c, pa.int64()) for c in ("arc", "leaves", "saved")]))


def list_ranks(arcs: DataFrame, remainder: int = 1000) -> DataFrame:
    """(arc, leaves, saved): sums along one list of (arc, prev, next, leaves, saved) up to each arc, its own included.

    Each round takes out the arcs whose hash is above both neighbours', about a third: no two of them are adjacent, each
    gives its sums to the arc after it, and each neighbour its other neighbour. When at most ``remainder`` arcs are left,
    one task walks them. Then the rounds are undone, last one first: what was taken out is the sum of the arc before it and
    its own. All tables together have about three times the arcs' rows, and no arc gets more than two messages.
    """
    rounds, alive = [], stash(arcs.select("arc", "prev", "next", "leaves", "saved"))
    none, sums = F.lit(None).cast("long"), ["leaves", "saved"]

    def said(arc: Column, prev: Column, next_: Column, new_prev: Column, new_next: Column, told: bool = True) -> Column:
        own = [F.col(c) if told else F.lit(0).cast("long") for c in sums]
        return F.struct(*[c.alias(n) for n, c in zip(["arc", "prev", "next", "new_prev", "new_next", *sums], [arc, prev, next_, new_prev, new_next, *own])])

    while alive.count() > remainder:
        here, before, after = (F.xxhash64(c, F.lit(len(rounds))) for c in ("arc", "prev", "next"))
        out = F.col("prev").isNotNull() & F.col("next").isNotNull() & (here > before) & (here > after)
        rounds.append(alive.where(out).select("arc", "prev", *sums))
        arc, prev, next_ = F.col("arc"), F.col("prev"), F.col("next")
        told = F.when(out, F.array(said(prev, none, none, none, next_, told=False), said(next_, none, none, prev, none))).otherwise(F.array(said(arc, prev, next_, none, none)))
        g = alive.select(F.inline(told)).groupBy("arc").agg(*[F.max(c).alias(c) for c in ("prev", "next", "new_prev", "new_next")], *[F.sum(c).alias(c) for c in sums])
        alive = stash(g.select("arc", F.coalesce("new_prev", "prev").alias("prev"), F.coalesce("new_next", "next").alias("next"), *sums))
    known = stash(alive.repartition(1).mapInArrow(_walk, "arc long, leaves long, saved long"))
    for taken in reversed(rounds):
        before = known.select(F.col("arc").alias("prev"), *[F.col(c).alias(f"_{c}") for c in sums])
        known = known.unionByName(stash(taken.join(before, "prev").select("arc", *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in sums])))
    return known


def tour(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The Euler tour: each node (id) has an enter arc, 2 * id, and an exit arc, 2 * id + 1. Returns the arcs with their
    neighbours and sums (a leaf counts 1 and a node's weight at its enter arc), and each node's parent_id,
    parent_conv_id, first child, last child and n_children.

    Children are in the order of their conv_id; a parent may have any number of them (see ``neighbours``).
    """
    above = nodes.select((F.col("depth") + 1).alias("depth"), *[F.col(s).alias(f"p{i}") for i, s in enumerate(_SUMS)], F.col("id").alias("parent_id"), F.col("conv_id").alias("parent_conv_id"))
    below = stash(nodes.select("id", "conv_id", "depth", *[f"p{i}" for i in range(4)]).join(above, ["depth", *[f"p{i}" for i in range(4)]]).select("id", "conv_id", "parent_id", "parent_conv_id"))
    children = below.groupBy(F.col("parent_id").alias("id")).agg(F.min_by("id", "conv_id").alias("first"), F.max_by("id", "conv_id").alias("last"), F.count("*").alias("n_children"))
    beside = neighbours(below, ["parent_id"], ["conv_id"], "id", keep=stash).select("id", "parent_id", "parent_conv_id", "before", "after")
    all_ = stash(nodes.select("id", "conv_id", "depth", "n_convs", "weight", *_SUMS).join(beside, "id", "left").join(children, "id", "left"))
    enter, leave = F.col("id") * 2, F.col("id") * 2 + 1
    zero = F.lit(0).cast("long")
    arc = lambda *cols: F.struct(*[c.alias(n) for n, c in zip(["arc", "prev", "next", "leaves", "saved"], cols)])
    entry = arc(enter, F.coalesce(F.col("before") * 2 + 1, F.col("parent_id") * 2), F.coalesce(F.col("first") * 2, leave), F.col("first").isNull().cast("long"), F.col("weight"))
    exit_ = arc(leave, F.coalesce(F.col("last") * 2 + 1, enter), F.coalesce(F.col("after") * 2, F.col("parent_id") * 2 + 1), zero, zero)
    return all_.select(F.inline(F.array(entry, exit_))), all_


def _sha256(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes rows (key, ids) that come ordered by key, one running hash a key: no key's ids are held together."""
    key, running_hash = None, None
    done = lambda: pa.RecordBatch.from_pydict({"key": [key], "ends_sha256": [running_hash.hexdigest()]}, pa.schema([("key", pa.int64()), ("ends_sha256", pa.string())]))
    for batch in batches:
        for k, ids in zip(batch["key"].to_pylist(), batch["ids"].to_pylist()):
            if running_hash is not None and k == key:
                running_hash.update(b"," + ids.encode())
                continue
            if running_hash is not None:
                yield done()
            key, running_hash = k, hashlib.sha256(ids.encode())
    if running_hash is not None:
        yield done()


def ends_digests(ends: DataFrame, chunk: int = 4096) -> DataFrame:
    """(key, ends_sha256) for ends (key, conv_id): ids in ascending order, joined by commas.

    Ids are joined in pieces of ``chunk`` consecutive ids first, each by one task; only the pieces of a key meet in a
    task, which passes them through its hash one by one, as SHA-256 needs them in a row.
    """
    pieces = ends.groupBy("key", F.floor(F.col("conv_id") / chunk).alias("chunk")).agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    return pieces.repartition("key").sortWithinPartitions("key", "chunk").select("key", "ids").mapInArrow(_sha256, "key long, ends_sha256 string")


def conversation_trie(turns: DataFrame, heads: int = 6, group: int = 100, remainder: int = 1000) -> DataFrame:
    """Figures of every node of the prefix trie of rebuilt conversations (see ``rebuilt``).

    Turns are (conv_id, turn, role, text). Returns conv_id (smallest member), depth, parent_conv_id (null at the root),
    n_convs, n_children, n_leaves and saved_tokens (of the subtree), ends_sha256.

    Rows without a conv_id belong to no conversation and are left out; null roles and texts are empty; turns of a null
    place come first, equal places go by role, then text, and repeated rows are turns of their own. A conversation, a
    node's members or its children may be any share of all rows. Long texts are hashed where they are. An empty table has
    no node; further columns are not looked at. Ids are truncated towards zero for their group, as % does.
    """
    nodes, ends = trie(turns, heads, group)
    arcs, all_ = tour(nodes)
    # The sum at the exit less what came before the enter arc: its sum without the node's own.
    odd = F.col("arc") % 2 == 1
    ranks = list_ranks(arcs, remainder).groupBy(F.floor(F.col("arc") / 2).alias("id")).agg(*[F.sum(F.when(odd, F.col(c)).otherwise(-F.col(c))).alias(c) for c in ("leaves", "saved")])
    last = ends.join(all_.select("id", *_KEY), _KEY).select(F.col("id").alias("key"), "conv_id")
    digests = ends_digests(last).withColumnRenamed("key", "id")
    out = all_.select("id", "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "weight").join(ranks, "id").join(digests, "id", "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        (F.col("leaves") + (F.col("n_children") == 0).cast("long")).alias("n_leaves"),
        (F.col("saved") + F.col("weight")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def op12_prefix_trie(spark, sf_dir):
    return conversation_trie(table(spark, sf_dir, "conversations"))


#: Rebuilt conversations as lists of (role, text); each prefix is a node, and subtrees are prefixes of their nodes.
ORACLE = r"""
WITH RECURSIVE crc(i, v) AS (SELECT range, range FROM range(256)),
tab AS (SELECT i, list_reduce([v] || range(8), lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM crc),
lut AS (SELECT list(v ORDER BY i) AS t FROM tab),
t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS j, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
g AS (SELECT c, list({'r': r, 'x': x} ORDER BY j) AS own FROM t GROUP BY c),
h AS (SELECT c, own, c - c % 100 AS b, xor(list_reduce([4294967295] || list_transform(string_split(CAST(c AS VARCHAR), ''), lambda z: CAST(ascii(z) AS BIGINT)), lambda a, z: xor(a >> 8, t[1 + (xor(a, z) & 255)])), 4294967295) % 6 AS h FROM g, lut),
f AS (SELECT h.c, list_concat(CASE WHEN b.own IS NULL THEN [] ELSE b.own[1:h.h] END, h.own[h.h + 1:]) AS s FROM h LEFT JOIN g b ON b.c = h.b),
p AS (SELECT c, len(s) AS n, d, md5(CAST(s[1:d] AS VARCHAR)) AS k, CASE WHEN d > 0 THEN md5(CAST(s[1:d - 1] AS VARCHAR)) END AS up, CASE WHEN d > 0 THEN length(s[d].x) ELSE 0 END AS chars FROM f, range(0, len(s) + 1) q(d)),
n AS (SELECT d, k, any_value(up) AS up, min(c) AS c, count(*) AS n, any_value(chars) AS chars, sha256(coalesce(string_agg(CASE WHEN n = d THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '')) AS ends FROM p GROUP BY d, k),
m AS (SELECT n.*, u.c AS parent, (SELECT count(*) FROM n z WHERE z.d = n.d + 1 AND z.up = n.k) AS children FROM n LEFT JOIN n u ON u.d = n.d - 1 AND u.k = n.up),
a(d, k, td, tk) AS (SELECT d, k, d, k FROM m UNION ALL SELECT a.d, a.k, m.d, m.k FROM a JOIN m ON m.d = a.td + 1 AND m.up = a.tk),
w AS (SELECT a.d, a.k, sum(CASE WHEN m.children = 0 THEN 1 ELSE 0 END) AS leaves, sum((m.n - 1) * m.chars) AS saved FROM a JOIN m ON m.d = a.td AND m.k = a.tk GROUP BY a.d, a.k)
SELECT m.c AS conv_id, CAST(m.d AS BIGINT) AS depth, m.parent AS parent_conv_id, m.n AS n_convs, m.children AS n_children, CAST(w.leaves AS BIGINT) AS n_leaves, CAST(w.saved AS BIGINT) AS saved_tokens, m.ends AS ends_sha256
FROM m JOIN w USING (d, k)
"""
