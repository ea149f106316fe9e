"""Language-model scores by a probabilistic suffix tree over words."""

from __future__ import annotations

import math
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_held_out, drop_written, free_shuffles, table, written
from .common import stash as written_rows
from .shingles import U64, mix, word_hashes

END = U64(0x5851F42D4C957F2D)
PAIR = U64(0x9E3779B97F4A7C15)
DISCOUNT = 0.5


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All rows' words, each row followed by the end token, and the rows' bounds among them."""
    parts, bounds, total = [], [np.zeros(1, np.int64)], 0
    for _, words, cut in word_hashes(texts):
        n = len(cut) - 1
        out = np.full(len(words) + n, END, U64)
        out[np.arange(len(words)) + np.repeat(np.arange(n), np.diff(cut))] = words
        parts.append(out)
        bounds.append(cut[1:] + np.arange(1, n + 1) + total)
        total += len(out)
    return (np.concatenate(parts) if parts else np.zeros(0, U64)), np.concatenate(bounds)


def _find(keys: pd.Index, wanted: np.ndarray) -> np.ndarray:
    """Places in the distinct keys, -1 where there is none. By hash, as a search of sorted keys takes four times as long."""
    return keys.get_indexer(wanted) if len(keys) else np.full(len(wanted), -1, np.int64)


def _longer(runs: np.ndarray) -> np.ndarray:
    """Hashes of the runs one word longer than those that end at each token; the first has none before it."""
    return mix(np.r_[U64(0), runs[:-1]] * PAIR + runs)


def stash(df: DataFrame) -> DataFrame:
    """Writes the rows and reads them back. What was shuffled for earlier ones goes before, and for these after it; the
    last job's plan may outlive the first collection."""
    free_shuffles(df.sparkSession)
    rows = written_rows(df)
    free_shuffles(df.sparkSession)
    return rows


#: Counts of a block, packed by ranges of the hash (buckets): runs without their last (a) and first (b) word, or, of kind
#: 1, contexts (a), and how often training rows have them (n).
COUNTS = "kind int, bucket long, block long, a binary, b binary, n binary"
#: Rows that are handed to blocks at once.
DEALT = 1 << 20


def _hashes(kind: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a if kind else mix(a * PAIR + b)


def _numbers(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype), *(np.frombuffer(x.as_buffer(), dtype) for x in column)])


def _packed(kind: int, a: np.ndarray, b: np.ndarray, learnt: np.ndarray, block: int, bits: int) -> pa.Table:
    """A block's distinct runs or contexts, from one row for each occurrence: a row for each of 2 ** bits buckets."""
    back, h = pd.factorize(_hashes(kind, a, b))
    first = np.zeros(len(h), np.int64)
    first[back[::-1]] = np.arange(len(back))[::-1]
    n = np.bincount(back, learnt, len(h)).astype(np.uint32)
    a, b, bucket = a[first], b[first], (h >> U64(64 - bits)).astype(np.int64)
    # Of one context in a row, so that what is shuffled is compressed better.
    at = U64(len(h).bit_length())
    # One number has the bucket, the first bits of the context and the place: numbers are sorted faster than places by them.
    order = np.sort(bucket.astype(U64) << U64(64 - bits) | a >> at >> U64(bits) << at | np.arange(len(h), dtype=U64)) & (U64(1) << at) - U64(1)
    a, b, n, bucket = a[order], b[order], n[order], bucket[order]
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(h) else np.zeros(0, np.int64)
    own = lambda of: pa.array([of[x:y].tobytes() for x, y in zip(starts, [*starts[1:], len(h)][: len(starts)], strict=True)], pa.binary())
    columns = {"a": own(a), "b": own(b), "n": own(n)}
    return pa.table({"kind": pa.array([kind] * len(starts), pa.int32()), "bucket": pa.array(bucket[starts]), "block": pa.array([block] * len(starts), pa.int64()), **columns})


def _whole(batches):
    """Blocks and their rows, from batches whose last column is the block."""
    last, held = None, []
    for batch in batches:
        block = batch.column(batch.num_columns - 1).to_numpy()
        cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True]) if len(block) else [0]
        for x, y in zip(cuts[:-1], cuts[1:], strict=True):
            if held and block[x] != last:
                yield last, pa.Table.from_batches(held)
                held = []
            last = block[x]
            held.append(batch.slice(x, y - x))
    if held:
        yield last, pa.Table.from_batches(held)


def _words(blocks: DataFrame, bits: int) -> DataFrame:
    """Counts of the words in each block, in training rows or not, as contexts."""

    def count(batches):
        for block, rows in _whole(batches):
            parts = [(np.zeros(0, U64), np.zeros(0, bool))]
            for batch in rows.to_batches():
                words, bounds = _tokens(batch.column(0))
                parts.append((words, np.repeat(batch.column(1).to_numpy(zero_copy_only=False), np.diff(bounds))))
            words, learnt = (np.concatenate(x) for x in zip(*parts, strict=True))
            yield from _packed(1, words, np.zeros(len(words), U64), learnt, block, bits).to_batches()

    return blocks.select("text", "train", "block").mapInArrow(count, COUNTS)


def _pairs(blocks: DataFrame, bits: int) -> DataFrame:
    """Counts of the runs of two words in each block, in training rows or not."""

    def count(batches):
        for block, rows in _whole(batches):
            parts = [(np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, bool))]
            for batch in rows.to_batches():
                words, bounds = _tokens(batch.column(0))
                learnt = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), np.diff(bounds))
                inside = np.ones(len(words), bool)
                inside[bounds[:-1]] = False  # the first word of a text ends no pair
                at = np.flatnonzero(inside)
                parts.append((words[at - 1], words[at], learnt[at]))
            yield from _packed(0, *(np.concatenate(x) for x in zip(*parts, strict=True)), block, bits).to_batches()

    return blocks.select("text", "train", "block").mapInArrow(count, COUNTS)


def _dealt(rows: DataFrame, *names: str) -> DataFrame:
    """Hands rows (blocks, kind and named numbers of 64 bits) to the blocks: (block, kind, numbers), packed."""

    def deal(batches):
        held, size = [], 0
        for batch in chain(batches, [None]):
            if batch is not None:
                sizes = pc.list_value_length(batch.column(0)).to_numpy(zero_copy_only=False).astype(np.int64)
                at = np.repeat(np.arange(len(sizes)), sizes)
                held.append([batch.column(0).flatten().to_numpy(), *(c.to_numpy(zero_copy_only=False)[at] for c in batch.columns[1:])])
                size += len(at)
            if size and (batch is None or size >= DEALT):
                block, kind, *own = (np.concatenate(x) for x in zip(*held, strict=True))
                order = np.lexsort((kind, block))
                block, kind, own = block[order], kind[order], [x[order] for x in own]
                cuts = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (kind[1:] != kind[:-1]), True])
                pairs = list(zip(cuts[:-1], cuts[1:], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(block[cuts[:-1]]), pa.array(kind[cuts[:-1]]), *(pa.array([x[i:j].tobytes() for i, j in pairs], pa.binary()) for x in own)], ["block", "kind", *names])
                held, size = [], 0

    return rows.select("blocks", "kind", *names).mapInArrow(deal, "block long, kind int, " + ", ".join(f"{x} binary" for x in names))


def _texts(blocks: DataFrame, *columns: str) -> DataFrame:
    """The columns, text last, as rows (block, rows) of up to 500 texts in Arrow's format, by zstd: what is shuffled to meet
    a block's counts is a good deal smaller than the texts by the shuffle's own compression."""

    def pack(batches):
        for batch in batches:
            block = batch.column(batch.num_columns - 1).to_numpy()
            cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True]) if len(block) else [0]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                for at in range(x, y, 500):
                    piece, out = pa.RecordBatch.from_arrays(batch.columns[:-1], list(columns)).slice(at, min(500, y - at)), pa.BufferOutputStream()
                    with pa.ipc.new_stream(out, piece.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as to:
                        to.write_batch(piece)
                    yield pa.RecordBatch.from_pydict({"block": pa.array([block[x]], pa.int64()), "rows": pa.array([out.getvalue().to_pybytes()], pa.binary())})

    return blocks.select(*columns, "block").mapInArrow(pack, "block long, rows binary")


def _unpacked(texts: pa.Table):
    """The batches of a block's packed rows."""
    for rows in texts.column("rows"):
        yield from pa.ipc.open_stream(rows.as_buffer())


def _grown(blocks: DataFrame, marks: DataFrame, length: int, counted: bool, bits: int, half: int | None = None) -> DataFrame:
    """Counts in each block of the runs of a context of ``length`` words and a word, and of such contexts.

    ``marks`` (blocks, kind, h) has contexts as kind 1: those whose words but the first the divergence test kept, if they
    are ``counted``, and nothing but runs is counted then; otherwise the kept ones, a word shorter. A repeated run's last
    ``length`` words are of kind 0: runs of which they aren't are left out. What is both is of kind 2, and handed once.
    With a ``half``, only the runs whose hash begins with that bit are counted.
    """

    def count(texts: pa.Table, known: pa.Table) -> pa.Table:
        kinds = known.column("kind").to_numpy()
        kept, runs = (pd.Index(_numbers(known.column("h").filter(pa.array((kinds == k) | (kinds == 2))), U64)) for k in (1, 0))
        none = np.zeros(0, U64)
        found = [(none, none, none, none.astype(bool), none.astype(bool))]
        for rows in _unpacked(texts) if len(kept) else ():
            ends, bounds = _tokens(rows.column("text"))
            sizes = np.diff(bounds)
            learnt, place = np.repeat(rows.column("train").to_numpy(zero_copy_only=False), sizes), np.arange(len(ends)) - np.repeat(bounds[:-1], sizes)
            for _ in range(length - 2):
                ends = _longer(ends)
            suffix, ends = ends, _longer(ends)
            at = np.flatnonzero((_find(kept, ends if counted else suffix) >= 0) & (place >= length - 1))
            then = at[_find(runs, ends[np.minimum(at + 1, len(ends) - 1)]) >= 0]
            at = at[:0] if counted else at
            found.append((ends[at], ends[then], ends[then + 1], learnt[at], learnt[then]))
            if half is not None:
                own = _hashes(0, *found[-1][1:3]) >> U64(63) == U64(half)
                found[-1] = (ends[at], *(x[own] for x in found[-1][1:3]), learnt[at], learnt[then][own])
        whole, a, b, n_whole, n = (np.concatenate(x) for x in zip(*found, strict=True))
        block = texts.column("block")[0].as_py() if texts.num_rows else 0
        return pa.concat_tables([_packed(1, whole, np.zeros(len(whole), U64), n_whole, block, bits), _packed(0, a, b, n, block, bits)])

    return _texts(blocks, "train", "text").groupBy("block").cogroup(_dealt(marks, "h").groupBy("block")).applyInArrow(count, COUNTS)


def _merged(found: DataFrame, least: int) -> DataFrame:
    """(kind, h, a, b, n, blocks) of the runs and contexts that training rows have ``least`` times or more, from their counts.

    h is the hash of the run or context; blocks are all that have it, in training rows or not. A bucket of all blocks'
    hashes is one group; there are as many buckets as keep it below the size of a block.
    """

    def merge(rows: pa.Table) -> pa.Table:
        kind, (a, b), n = rows.column("kind")[0].as_py(), (_numbers(rows.column(x), U64) for x in "ab"), _numbers(rows.column("n"), np.uint32)
        block = np.repeat(rows.column("block").to_numpy(), [len(x.as_buffer()) // 8 for x in rows.column("a")])
        h = _hashes(kind, a, b)
        order = np.argsort(h)
        h, block = h[order], block[order]
        starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        total, sizes = np.add.reduceat(n[order].astype(np.int64), starts), np.diff(np.r_[starts, len(h)])
        often = total >= least
        at = order[starts[often]]
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes[often])].astype(np.int32)), pa.array(block[np.repeat(often, sizes)]))
        return pa.table({"kind": pa.array(np.full(len(at), kind, np.int32)), "h": pa.array(h[starts[often]].view(np.int64)), "a": pa.array(a[at].view(np.int64)), "b": pa.array(b[at].view(np.int64)), "n": pa.array(total[often]), "blocks": lists})

    return found.groupBy("kind", "bucket").applyInArrow(merge, "kind int, h long, a long, b long, n long, blocks array<long>")


def _repeated(found: DataFrame) -> DataFrame:
    return stash(_merged(found, 2))


def _level(runs: DataFrame, shorter: DataFrame, contexts: DataFrame, n_tokens: int, *columns: str) -> DataFrame:
    """Runs with their contexts' back-off weights (``back``, where the context is kept) and the probability v by which
    they go on to longer runs, and the named columns, from runs (h, a, b, n), the level below (h, v) and the
    contexts' counts (h, n).

    Runs that were counted get (count - 1/2) / count of the context; what is left goes to all other words in
    proportion to the suffix's distribution. A context stays if its divergence from that distribution, times its
    count, is above half the log of all tokens for each of its runs: what naming those runs would cost.
    """
    context = Window.partitionBy("a")
    p, rest = (F.col("n") - DISCOUNT) / F.col("own"), lambda x: F.least(F.lit(1.0), F.greatest(F.lit(1e-12), 1 - F.sum(x).over(context)))
    x = runs.select("h", "a", "b", "n").join(shorter.select(F.col("h").alias("b"), F.col("v").alias("below")), "b").join(contexts.select(F.col("h").alias("a"), F.col("n").alias("own")), "a").withColumn("p", p)
    x = x.withColumn("rest", rest("p")).withColumn("rest_below", rest("below")).withColumn("cost", F.count("*").over(context) * math.log(max(2, n_tokens)) / 2).withColumn("sum", F.sum(F.col("p") * F.log(F.col("p") / F.col("below"))).over(context))
    kept = F.col("own") * (F.col("sum") + F.col("rest") * F.log(F.col("rest") / F.col("rest_below"))) > F.col("cost")
    return stash(x.select("h", "a", *columns, F.when(kept, F.col("p")).otherwise(F.col("below")).alias("v"), F.when(kept, F.log10(F.col("rest") / F.col("rest_below"))).alias("back")))


def score_texts(docs: DataFrame, train: Column, block_rows: int = 4096, id_col: str = "doc_id", text_col: str = "text", pinned: bool = False) -> DataFrame:
    """Scores every whole text by a tree learnt from the rows where ``train`` holds.

    Tokens are words (A-Z in lower case, ended by ASCII white space) and an end a text. All words are counted, and all
    runs of two words that occur twice or more in training rows; a divergence test says which words are kept as contexts.
    The tree then grows by a word at a time: a context one word longer is looked at if its suffix was kept, by counting
    the repeated runs behind it, until a test keeps nothing. A context may have any number of words. A token's probability
    comes from the longest context before it that was kept, or by back-off from that context's suffixes down to single
    words with add-one smoothing.

    Words, runs and contexts grow with the corpus and never meet in one place: documents are taken in blocks of
    ``block_rows``, a block's distinct words and runs are joined with the counts and contexts, and come back to the
    block, which they meet with its texts packed. The input is written to the shared folder first, so that blocks stay what they are; ``pinned`` says that its
    rows come in the same order each time (a scan of files) and leaves that out.

    Returns a row for each input row: id, n_tokens, n_known, train_tokens, base_score, score. Null texts are empty;
    without training rows every probability is 1, and an empty table gives an empty result. Rows with equal ids are scored
    each. A very long text is scored whole; its block is held in one task.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text_col).cast("string").alias("text"))
    spark, mark = docs.sparkSession, written()
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")  # a batch of texts is held whole on both sides
    if not pinned:
        rows = stash(rows)
    bits = max(1, math.ceil(math.log2(4 * rows.count() / block_rows + 1)))
    blocks = rows.withColumn("block", F.floor(F.monotonically_increasing_id() / block_rows))

    counted = stash(_merged(_words(blocks, bits), 1).select("h", "n", "blocks"))
    n_tokens, n_known = (int(x or 0) for x in counted.agg(F.sum("n"), F.count("*")).first())
    log_all = math.log10(n_tokens + n_known + 1)

    # Repeated runs (of one word first) behind kept contexts, and contexts.
    held = contexts = counted.withColumn("v", (F.col("n") + 1) / F.lit(n_tokens + n_known + 1))
    found, length, handed = _repeated(_pairs(blocks, bits)), 2, []
    while True:
        runs = found.where("kind = 0")
        longer = _level(runs, held, contexts, n_tokens, *(("b",) if counted is not None else ()))
        after = longer.where("back IS NOT NULL").groupBy(F.col("a").alias("h")).agg(F.first("back").alias("after"))
        kept = stash(contexts.select("h", "n", "blocks").join(after, "h"))
        # What blocks need of runs of this length: counts of those behind kept contexts, and the contexts among them.
        handed += [df.select("h", "n", x.alias("after"), F.lit(length - 1).alias("kind"), "blocks") for df, x in ((held, F.lit(None).cast("double")), (kept, F.col("after")))]
        if kept.isEmpty():
            break
        # Longer runs end in a run that is held, so that those have all the probabilities below that the next test needs.
        if counted is not None:
            # All repeated runs of two words are known, and so are the contexts among them; longer contexts are counted.
            whole = kept.select(F.col("h").alias("b"), F.lit(True).alias("whole"))
            both = longer.join(whole, "b", "left").where("back IS NOT NULL OR whole").select("h", F.when(F.col("back").isNotNull(), F.col("v")).alias("v"), "whole")
            both = stash(both.join(runs.select("h", "n", "blocks"), "h"))
            held, contexts = both.where("v IS NOT NULL"), both.where("whole")
            marks = both.select("blocks", F.when(F.col("v").isNull(), 1).when(F.col("whole"), 2).otherwise(0).alias("kind"), "h")
        else:
            held = stash(longer.where("back IS NOT NULL").select("h", "v").join(runs.select("h", "n", "blocks"), "h"))
            marks = kept.select("blocks", F.lit(1).alias("kind"), "h").unionByName(held.select("blocks", F.lit(0).alias("kind"), "h"))
        drop_written(spark, mark, keep=(rows, held, *handed))
        # Runs of three words are by far the most; their counts are merged by halves, so that only one half is on disk.
        found = reduce(DataFrame.unionByName, [_repeated(_grown(blocks, marks, length, counted is not None, bits, half)) for half in ((None,) if counted is None else (0, 1))])
        contexts, counted, length = contexts if counted is not None else found.where("kind = 1"), None, length + 1

    def score(texts: pa.Table, known: pa.Table) -> pa.Table:
        lengths, tables = known.column("kind").to_numpy(), []
        for k in range(1, length):
            own = known.filter(pa.array(lengths == k))
            keys, n, after = (_numbers(own.column(x), dtype) for x, dtype in (("h", U64), ("n", np.int64), ("after", np.float64)))
            order = np.lexsort((np.isnan(after), keys))
            # What is both behind a kept context and one itself came twice; it stays with its weight.
            order = order[np.r_[True, keys[order][1:] != keys[order][:-1]]] if len(order) else order
            # The last entry is for runs that aren't there: count 0, and no context.
            tables.append((pd.Index(keys[order]), np.r_[n[order], 0], np.r_[after[order], np.nan]))
        out, ids = [], [pa.array([], pa.int64())]
        for rows in _unpacked(texts):
            ends, bounds = _tokens(rows.column("text"))
            place = np.arange(len(ends)) - np.repeat(bounds[:-1], np.diff(bounds))
            at = _find(tables[0][0], ends)
            counts, after = tables[0][1][at], tables[0][2][at]
            base = np.log10(counts + 1.0) - log_all
            own, n = base, counts
            for keys, total, weights in tables[1:]:
                ends, place = _longer(ends), place - 1
                before, back = np.r_[0, n[:-1]], np.where(place >= 0, np.r_[np.nan, after[:-1]], np.nan)
                # Only a run behind a kept context has a probability here, and only one behind whose suffix is kept may be one.
                asked, at = np.flatnonzero((place >= 0) & ~(np.isnan(back) & np.isnan(after))), np.full(len(ends), -1)
                at[asked] = _find(keys, ends[asked])
                n, after = total[at], weights[at]
                own = np.where(np.isnan(back), own, np.where(n > 0, np.log10(np.maximum(n - DISCOUNT, DISCOUNT) / np.maximum(before, 1)), own + back))
            ids.append(rows.column("doc_id"))
            out.append([np.diff(bounds), *(np.add.reduceat(x, bounds[:-1]) for x in ((counts > 0).astype(np.int64), base, own))])
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0)] * 4
        return pa.table({"doc_id": pa.chunked_array(ids), "n_tokens": pa.array(columns[0], pa.int64()), "n_known": pa.array(columns[1], pa.int64()), "train_tokens": pa.array([n_tokens] * len(columns[0]), pa.int64()), "base_score": pa.array(columns[2], pa.float64()), "score": pa.array(columns[3], pa.float64())})

    back = _dealt(reduce(DataFrame.unionByName, handed), "h", "n", "after")
    scored = _texts(blocks, "doc_id", "text").groupBy("block").cogroup(back.groupBy("block")).applyInArrow(score, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return scored.withColumnRenamed("doc_id", id_col)


def op1_suffix_tree(spark, sf_dir):
    held_out = crc_held_out(F.col("doc_id"), 7, 2)
    scored = score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), ~held_out, pinned=True)
    return scored.withColumn("held_out", held_out).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
