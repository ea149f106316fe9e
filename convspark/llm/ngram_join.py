"""Self-join of documents by the Jaccard similarity of word shingles, with grouped prefixes."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, drop_written, small_batches, stash, table, written
from .components import components
from .shingles import U64, mix, text_shingles

#: Nodes up to this count are broadcast (24 bytes each); more are joined by a shuffle.
BROADCAST_NODES = 500_000
#: Shingles that are held at once while frequent ones are looked for.
CHUNK = 1_000_000
#: Documents of an Arrow batch that are worked on at once.
ROWS = 250
#: Smallest hashes of a set, by which it meets the first candidates for a link.
LOW = 6
#: Bits of a set's parity map: at least twice its size, up to this many.
MOST_BITS = 1 << 15


def _pieces(batches):
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            yield batch.slice(a, ROWS)


def _prefix(n, percent: int):
    """Of a set of n shingles in any common order, two sets that link share one of the first so many."""
    return n - -(-n * percent // 100) + 1


def _least_shared(a, b, percent: int):
    """Shingles that two sets of sizes a and b share at least when 100 * intersection >= percent * union."""
    return F.ceil(F.lit(float(percent)) * (a + b) / (100 + percent))


def _fits(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def signatures(docs: DataFrame, words: int, share: float, id_col: str, text_col: str) -> DataFrame:
    """A row a document, and rows of shingles that are frequent in some chunk of documents (``times``).

    A document has its set's size n, how many of these are even (e), and 128 bits of signature. A shingle that a share
    of all documents holds has that share in some chunk at least, so only a chunk's own frequent ones are sent on;
    equal sets of a chunk count once.
    """
    names = ["doc_id", "text_key", "n", "e", "sig1", "sig2", "token", "times"]

    def sketch(batches):
        sets: list[np.ndarray] = []
        held, seen, n_docs = 0, set(), 0

        def often():
            tokens, n = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, U64), np.zeros(0, int))
            most = n >= max(3, math.ceil(share * n_docs))
            null = pa.nulls(int(most.sum()), pa.int64())
            return pa.RecordBatch.from_arrays([null] * 6 + [pa.array(tokens[most].view(np.int64)), pa.array(n[most].astype(np.int64))], names)

        for batch in _pieces(batches):
            rows = []
            for run in text_shingles(batch.column(2), words):
                own, n_docs = np.unique(run), n_docs + 1
                rows.append((len(own), int((own & U64(1) == 0).sum()), own.sum(dtype=U64), mix(own ^ U64(77)).sum(dtype=U64)))
                key = (len(own), int(rows[-1][2]))
                if len(own) and key not in seen:
                    seen.add(key)
                    sets.append(own)
                    held += len(own)
                if held >= CHUNK:
                    yield often()
                    sets, held, seen, n_docs = [], 0, set(), 0
            columns = [batch.column(0), batch.column(1), *(pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1))]
            columns += [pa.array(np.array([r[k] for r in rows], U64).view(np.int64)) for k in (2, 3)]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.nulls(len(rows), pa.int64())] * 2], names)
        yield often()

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(sketch, ", ".join(f"{c} long" for c in names))


def _texts(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns of nodes (with rep, rep_key) and the text of the row that stands for each; a repeated row comes again."""
    keyed = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(F.col(text_col)).alias("_text_key"), F.col(text_col).cast("string").alias("text"))
    same = F.col("_id").eqNullSafe(F.col("rep")) & (F.col("_text_key") == F.col("rep_key"))
    return keyed.join(F.broadcast(nodes) if nodes.count() <= BROADCAST_NODES else nodes, same).drop("_id", "_text_key", "rep", "rep_key")


def _held(own: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which of a set's shingles are in the sorted ones."""
    if not len(some):
        return np.zeros(len(own), bool)
    return some[np.minimum(np.searchsorted(some, own), len(some) - 1)] == own


def shared_shingles(texts: DataFrame, frequent, words: int, often: int) -> DataFrame:
    """(node, token, often, very) of even shingles that two or more nodes hold, from (node, text).

    ``often`` says that so many nodes hold it. Very frequent shingles are known already and only counted: a row without
    a token says how many a node has. Shingles are dealt out by hash and sorted, so that each one's nodes come together;
    none of them has more than the very frequent ones' share of all nodes.
    """

    def postings(batches):
        for batch in _pieces(batches):
            tokens, nodes, very = [], [], []
            for node, run in zip(batch.column(0).to_pylist(), text_shingles(batch.column(1), words), strict=True):
                own = np.unique(run)
                own = own[own & U64(1) == 0]
                known = _held(own, frequent.value)
                tokens.append(own[~known])
                nodes.append(np.full(len(tokens[-1]), node))
                very.append(np.zeros(len(tokens[-1]), np.int64))
                if known.any():
                    tokens.append(mix(np.array([node], U64)))
                    nodes.append(np.array([node]))
                    very.append(np.array([known.sum()]))
            yield pa.RecordBatch.from_pydict({"token": pa.array(np.concatenate(tokens or [np.zeros(0, U64)]).view(np.int64)), "node": pa.array(np.concatenate(nodes or [[]]).astype(np.int64)), "very": pa.array(np.concatenate(very or [[]]).astype(np.int64))})

    def shared(batches):
        kept: list[np.ndarray] = []

        def out(rows):
            counts = rows[rows[:, 2] > 0]
            yield pa.RecordBatch.from_arrays([pa.array(counts[:, 1]), pa.nulls(len(counts), pa.int64()), pa.array(np.zeros(len(counts), bool)), pa.array(counts[:, 2])], ["node", "token", "often", "very"])
            rows = rows[rows[:, 2] == 0]
            starts = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]]) if len(rows) else np.zeros(0, np.int64)
            n = np.diff(np.r_[starts, len(rows)])
            n = np.repeat(n, n)
            rows, n = rows[n > 1], n[n > 1]
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, 1]), pa.array(rows[:, 0]), pa.array(n >= often), pa.array(np.zeros(len(rows), np.int64))], ["node", "token", "often", "very"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([c.to_numpy() for c in batch.columns], 1)
            last = int(np.searchsorted(rows[:, 0], rows[-1, 0]))
            if last:
                yield from out(np.concatenate([*kept, rows[:last]]))
                kept = []
            kept.append(rows[last:])
            if not last and kept[0][0, 0] != rows[0, 0]:  # what is held has other shingles than this batch
                yield from out(np.concatenate(kept[:-1]))
                kept = kept[-1:]
        if kept:
            yield from out(np.concatenate(kept))

    found = texts.select("node", "text").mapInArrow(postings, "token long, node long, very long")
    return found.repartition("token").sortWithinPartitions("token").mapInArrow(shared, "node long, token long, often boolean, very long")


def _parity_map(own: np.ndarray) -> np.ndarray:
    """Parity of how many shingles fall on each bit: two sets' maps differ in no more bits than the sets in members."""
    bits = min(MOST_BITS, max(64, 1 << (2 * len(own) - 1).bit_length()))
    odd = np.bincount((mix(own ^ U64(99)) & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def prefixed(texts: DataFrame, frequent, words: int, percent: int) -> DataFrame:
    """A row a node, from (node, text, rare, often): size, signature of the prefix, spots, lowest hashes, parity map, set.

    The order of shingles: even ones that no other node holds; even ones that few hold; odd ones; even ones that many
    hold; very frequent ones; by hash in each class. Spots are the shingles of the prefix, and their places in it, but
    for those that no other node holds. ``share`` is the part of the set that many nodes hold.
    """

    def sketch(batches):
        for batch in _pieces(batches):
            columns: list[list] = [[] for _ in range(9)]
            lists = [[np.array(x or [], np.int64).view(U64) for x in batch.column(k).to_pylist()] for k in (2, 3)]
            for node, run, rare, often in zip(batch.column(0).to_pylist(), text_shingles(batch.column(1), words), *lists, strict=True):
                own = np.unique(run)
                n, even, very = len(own), own & U64(1) == 0, _held(own, frequent.value)
                rare, often = _held(own, np.sort(rare)) & ~very, _held(own, np.sort(often)) & ~very
                alone = even & ~very & ~rare & ~often
                order = [own[alone], own[rare], own[~even & ~very], own[often], own[very]]
                prefix = np.concatenate(order)[: _prefix(n, percent)]
                spots = prefix[len(order[0]) :]
                low = np.sort(mix(own ^ U64(55)))[:LOW]
                row = (node, n, int(mix(prefix).sum(dtype=U64).astype(np.int64)), min(len(order[0]), len(prefix)), spots.view(np.int64), low.view(np.int64), float((often.sum() + very.sum()) / n), _parity_map(own), own.view(np.int64))
                for c, x in zip(columns, row, strict=True):
                    c.append(x)
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2 + [pa.float64()] + [pa.list_(pa.int64())] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["node", "n", "prefix_sig", "ahead", "spots", "low", "share", "bits", "s"])

    return texts.select("node", "text", "rare", "often").mapInArrow(sketch, "node long, n long, prefix_sig long, ahead long, spots array<long>, low array<long>, share double, bits array<long>, s array<long>")


def _differ(x: Column, y: Column) -> Column:
    """Bits in which two parity maps differ; the larger is folded first (sets that fit are a factor of two apart at most)."""
    half = lambda b: F.zip_with(F.slice(b, 1, F.floor(F.size(b) / 2).cast("int")), F.slice(b, F.floor(F.size(b) / 2).cast("int") + 1, F.floor(F.size(b) / 2).cast("int")), lambda p, q: p.bitwiseXOR(q))
    a, b = F.when(F.size(x) > F.size(y), half(x)).otherwise(x), F.when(F.size(y) > F.size(x), half(y)).otherwise(y)
    return F.aggregate(F.zip_with(a, b, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, c: t + c)


def _near(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs of nodes (a, b), those that their sizes and parity maps don't keep from linking, with ``differ``."""
    of = lambda c: sets.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b").where(_fits(F.col("n_a"), F.col("n_b"), percent))
    both = both.withColumn("differ", _differ(F.col("bits_a"), F.col("bits_b"))).drop("bits_a", "bits_b")
    return both.where(F.col("n_a") + F.col("n_b") - F.col("differ") >= 2 * _least_shared(F.col("n_a"), F.col("n_b"), percent))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs of nodes (a, b), those whose whole sets link, as edges (u, v)."""
    both = pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("s").alias("s_a")), "a").join(sets.select(F.col("node").alias("b"), F.col("s").alias("s_b")), "b")
    linked = F.size(F.array_intersect("s_a", "s_b")) >= _least_shared(F.size("s_a"), F.size("s_b"), percent)
    return both.where(linked).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _first_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """For each node, up to two others to try: of those that stand for one of its lowest hashes, the most alike.

    For a hash and a class of sizes stand the node with the largest share of frequent shingles (the original of a family
    of copies) and an arbitrary one. Nodes of one group meet its first node too.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent)).cast("int")
    low = sets.select("node", "n", "share", F.explode("low").alias("token"), band.alias("band"))
    stands = low.groupBy("token", "band").agg(F.max_by("node", F.struct("share", -F.col("node"))).alias("x"), F.min_by("node", F.xxhash64("node")).alias("y"))
    stands = stands.select("token", "band", F.explode(F.array_distinct(F.array("x", "y"))).alias("other"))
    here = low.join(stands, ["token", "band"])
    below = low.withColumn("band", F.col("band") - 1).join(stands, ["token", "band"])
    met = here.unionByName(below).where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")).distinct()
    best = _near(met, sets, percent).groupBy("a").agg(F.slice(F.array_sort(F.collect_list(F.struct("differ", "b"))), 1, 2).alias("best"))
    return best.select("a", F.explode("best").alias("x")).select("a", F.col("x.b").alias("b"))


def _list_pairs(percent: int):
    """Pairs of entities of a long list (or of two blocks of one) that positions, sizes, roots and parity maps leave."""

    def folded(words: np.ndarray) -> np.ndarray:
        return words[:, : words.shape[1] // 2] ^ words[:, words.shape[1] // 2 :]

    def pairs(cell: pa.Table) -> pa.Table:
        n, pos, root, entity, wide, token, left, right, own = (cell.column(k).to_numpy() for k in ("n", "pos", "root", "entity", "wide", "token", "x", "y", "own"))
        lists = cell.column("bits").combine_chunks()
        lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
        size = np.diff(lists.offsets.to_numpy())
        flat, at = lists.values.to_numpy().view(U64), lists.offsets.to_numpy()[:-1]
        maps = {w: flat[at[size == w][:, None] + np.arange(w)] for w in np.unique(size).tolist()}
        place = np.zeros(len(n), np.int64)
        for w in maps:
            place[size == w] = np.arange((size == w).sum())
        found_a, found_b = [], []
        for i in range(len(n)):
            for w in (int(size[i]), int(size[i]) * 2, int(size[i]) // 2):
                if w not in maps:
                    continue
                j = np.flatnonzero(size == w)
                ok = (token[j] == token[i]) & (root[j] != root[i]) & (left[j] == left[i]) & (right[j] == right[i])
                ok &= (own[j] != own[i]) if left[i] != right[i] else True
                ok &= (entity[j] > entity[i]) & (100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i]))
                least = -(-percent * (n[j] + n[i]) // (100 + percent))
                ok &= (pos[j] <= n[j] - least) & (pos[i] <= n[i] - least)
                j = j[ok]
                if not len(j):
                    continue
                theirs, mine = maps[w][place[j]], maps[int(size[i])][place[i]][None]
                theirs, mine = (folded(theirs), mine) if w > size[i] else (theirs, folded(mine)) if w < size[i] else (theirs, mine)
                differ = np.bitwise_count(theirs ^ mine).sum(1).astype(np.int64) - wide[j] - wide[i]
                j = j[n[j] + n[i] - differ >= 2 * least[ok]]
                found_a.append(np.full(len(j), entity[i]))
                found_b.append(entity[j])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_a, found_b))
        return pa.table({"e_a": pa.array(a, pa.int64()), "e_b": pa.array(b, pa.int64())})

    return pairs


def ngram_components(docs: DataFrame, percent: int = 75, words: int = 5, hot_share: float = 0.001, bucket_rows: int = 4096, often: int = 32, long_list: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of documents that links join, each document with the smallest id of its group.

    Two documents link when 100 * intersection >= percent * union of their sets of ``words``-word shingles (words end
    at ASCII white space, A-Z in lower case; shorter texts are one shingle, texts without words have none and no links).

    Equal sets become one node. Shingles are ordered by how many nodes hold them, those of a single node first, and two
    sets that link share one of their prefixes: a node whose prefix nobody else can share is done. Of the others, nodes
    of equal prefix and size become one group. Each node first tries the most alike of a few that stand for its lowest
    hashes, which connects families of copies at a cost of their size. Then each group, once for each component that
    its nodes are in by now, meets all groups of other components with which it shares a prefix shingle; pairs that
    sizes, places in the prefixes and parity maps leave are expanded to their nodes, and whole sets decide. Shingles of
    more than ``long_list`` groups are compared in blocks of ``bucket_rows``, and only what the bounds leave is a row.

    ``hot_share`` of all documents makes a shingle very frequent (at most mean set size / share of them; they are
    broadcast), ``often`` nodes frequent. Both only order the shingles.

    Returns a row for each input row: id (an integer, or text of one), n_shingles, component_id, and text_key and kept
    (one row of each component: the smallest id, then the smallest key). Null ids count as larger than others; equal ids
    with different texts are different nodes. Shingles are 64-bit hashes, sets are told apart by 128 bits. An empty
    table gives an empty result.
    """
    small_batches(docs.sparkSession)
    mark = written()
    sketched = stash(signatures(docs, words, hot_share, id_col, text_col))
    rows = sketched.where("times IS NULL").select("doc_id", "text_key", "n", "e", "sig1", "sig2")
    least = max(often, hot_share * rows.count())
    very = sketched.where("times IS NOT NULL").groupBy("token").agg(F.sum("times").alias("times")).where(F.col("times") >= least).select("token")
    very = np.sort(np.array([r[0] for r in very.toLocalIterator()], np.int64).view(U64))  # mean set size / hot_share at most
    frequent = docs.sparkSession.sparkContext.broadcast(very)

    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    nodes = rows.where("n > 0").groupBy("sig1", "sig2", "n").agg(F.min(order).alias("o"), F.first("e").alias("e"))
    nodes = stash(nodes.select(F.monotonically_increasing_id().alias("node"), "sig1", "sig2", "n", "e", F.col("o.doc_id").alias("rep"), F.col("o.text_key").alias("rep_key")))
    shared = stash(shared_shingles(_texts(docs, nodes.select("node", "rep", "rep_key"), id_col, text_col), frequent, words, often))
    known = nodes.join(shared.groupBy("node").agg((F.count("token") + F.sum("very")).alias("k")), "node", "left")
    live = stash(known.where(F.col("e") - F.coalesce("k", F.lit(0)) < F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).select("node", "rep", "rep_key"))
    if not live.count():
        roots = None
    else:
        lists = shared.join(live, "node", "left_semi").groupBy("node").agg(F.collect_set(F.when(~F.col("often"), F.col("token"))).alias("rare"), F.collect_set(F.when(F.col("often"), F.col("token"))).alias("often"))
        texts = _texts(docs, live, id_col, text_col).join(lists.hint("merge"), "node", "left")
        sets = prefixed(texts, frequent, words, percent).where(F.size("spots") > 0)
        if rows.groupBy("doc_id", "text_key").count().where("count > 1").limit(1).count():
            sets = sets.dropDuplicates(["node"])
        roots = _roots(stash(sets), percent, bucket_rows, long_list)

    placed = nodes.select("sig1", "sig2", "n", "node", F.struct(F.col("rep").isNull(), "rep", "rep_key").alias("o"))
    placed = placed.withColumn("root", F.col("node")) if roots is None else placed.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("o").alias("least"))
    named = stash(placed.join(least, "root").select("sig1", "sig2", "n", F.col("least.rep").alias("_rep"), F.col("least.rep_key").alias("_rep_key")))
    drop_written(docs.sparkSession, mark, keep=(sketched, named))
    out = rows.join(named, ["sig1", "sig2", "n"], "left")
    is_rep = F.col("doc_id").eqNullSafe(F.col("_rep")) & (F.col("text_key") == F.col("_rep_key"))
    return out.select(
        F.col("doc_id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("_rep")).alias("component_id"),
        "text_key",
        ((F.col("n") == 0) | is_rep).alias("kept"),
    )


def _roots(sets: DataFrame, percent: int, block: int, long_list: int) -> DataFrame:
    """(node, root) of the nodes that links join, from ``prefixed``."""
    members = stash(sets.groupBy("prefix_sig", "n").agg(F.min("node").alias("gid")).join(sets.select("node", "prefix_sig", "n"), ["prefix_sig", "n"]).select("node", "gid"))
    inside = _near(members.where("node <> gid").select(F.col("gid").alias("a"), F.col("node").alias("b")), sets, percent).select("a", "b")
    first = stash(_first_pairs(sets, percent).unionByName(inside).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    edges = stash(_verified(first, sets, percent).distinct())
    roots = components(edges)

    # An entity: the nodes of a group that one component has; the least node stands for it.
    placed = members.join(roots, "node", "left").select("node", "gid", F.coalesce("root", "node").alias("root"))
    entities = placed.groupBy("gid", "root").agg(F.min("node").alias("entity"))
    placed = stash(placed.join(entities, ["gid", "root"]).select("node", "root", "entity"))
    heads = sets.join(placed.where("node = entity").drop("node"), sets["node"] == F.col("entity"))
    spots = stash(heads.select("entity", "root", "n", "ahead", F.posexplode("spots").alias("k", "token")).select("entity", "root", "n", (F.col("ahead") + F.col("k")).alias("pos"), "token"))
    mixed = stash(spots.groupBy("token").agg(F.count("*").alias("held"), F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("token", "held"))
    spots = spots.join(mixed, "token")

    short = spots.where(F.col("held") <= long_list)
    of = lambda c: short.select("token", *[F.col(x).alias(f"{x}_{c}") for x in ("entity", "root", "n", "pos")])
    need = _least_shared(F.col("n_a"), F.col("n_b"), percent)
    fits = _fits(F.col("n_a"), F.col("n_b"), percent) & (F.col("pos_a") <= F.col("n_a") - need) & (F.col("pos_b") <= F.col("n_b") - need)
    met = of("a").join(of("b"), "token").where((F.col("entity_a") < F.col("entity_b")) & (F.col("root_a") != F.col("root_b")) & fits).select(F.col("entity_a").alias("e_a"), F.col("entity_b").alias("e_b"))

    if mixed.where(F.col("held") > long_list).limit(1).count():
        # How far an entity's parity maps are from its head's.
        maps = sets.select("node", F.col("bits").alias("bits_b"))
        wide = placed.where("node <> entity").join(maps, "node").join(sets.select(F.col("node").alias("entity"), "bits"), "entity").groupBy("entity").agg(F.max(_differ(F.col("bits"), F.col("bits_b"))).alias("wide"))
        long = spots.where(F.col("held") > long_list).join(wide, "entity", "left").withColumn("wide", F.coalesce("wide", F.lit(0)).cast("long"))
        blocks = F.ceil(F.col("held") / block)
        long = long.withColumn("own", F.pmod(F.xxhash64("entity"), blocks))
        other = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda k: F.struct(F.least(k, F.col("own")).alias("x"), F.greatest(k, F.col("own")).alias("y"))))
        cells = long.select("token", "entity", "root", "n", "pos", "wide", "own", other.alias("z")).select("*", "z.*").drop("z")
        cells = cells.join(sets.select(F.col("node").alias("entity"), "bits"), "entity").withColumn("cell", F.xxhash64("token", "x", "y"))
        met = met.unionByName(cells.groupBy("cell").applyInArrow(_list_pairs(percent), "e_a long, e_b long"))

    met = stash(met.distinct())
    if not met.limit(1).count():
        return roots
    of = lambda c: placed.select(F.col("entity").alias(f"e_{c}"), F.col("node").alias(c))
    pairs = met.join(of("a"), "e_a").join(of("b"), "e_b").select("a", "b")
    more = stash(_verified(_near(pairs, sets, percent), sets, percent).distinct())
    return components(edges.unionByName(more)) if more.limit(1).count() else roots


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component does, with all their columns (``_ngram_*`` are reserved)."""
    mark = written()
    kept = ngram_components(docs, id_col=id_col, text_col=text_col, **options).where("kept").select(F.col(id_col).alias("_ngram_id"), F.col("text_key").alias("_ngram_key"), F.col("n_shingles").alias("_ngram_n"))
    keys = stash(kept.groupBy("_ngram_id", "_ngram_key").agg(F.count("*").alias("_ngram_copies"), F.max("_ngram_n").alias("_ngram_n")))
    drop_written(docs.sparkSession, mark, keep=(keys,))
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_ngram_id")) & (F.xxhash64(F.col(text_col)) == F.col("_ngram_key"))
    out = docs.join(F.broadcast(keys) if keys.count() <= BROADCAST_NODES else keys, same)
    names = docs.columns
    single = out.where("_ngram_copies = 1 OR _ngram_n = 0").select(*names)
    repeated = out.where("_ngram_copies > 1 AND _ngram_n > 0")
    if keys.where("_ngram_copies > 1 AND _ngram_n > 0").limit(1).count():
        single = single.unionByName(repeated.dropDuplicates(["_ngram_id", "_ngram_key"]).select(*names))
    return single


def op5_ngram_join(spark, sf_dir):
    return ngram_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


ORACLE = rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
o AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(d, m) AS (SELECT DISTINCT x, x FROM o UNION SELECT o.y, r.m FROM r JOIN o ON o.x = r.d WHERE r.m < o.y)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(m, doc_id) AS component_id FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT d AS doc_id, min(m) AS m FROM r GROUP BY d) USING (doc_id)
"""
