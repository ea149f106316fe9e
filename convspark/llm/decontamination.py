"""Benchmark decontamination: MinHash containment search by size classes, verified by exact shingle containment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UPPER, small_batches, table
from .shingles import MARKS, U64, text_shingles

HASHES = 64
_FACTORS = np.random.default_rng(7).integers(1, 1 << 63, HASHES, dtype=np.int64).astype(U64) * U64(2) + U64(1)
SMALLEST = 8
#: Items of fewer distinct shingles are looked up exactly.
FEW = 16


def _minima(v: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.minimum.reduceat(v, starts)


class Items:
    """A block of test items: exact sets; MinHash values by size class, and single shingles of the items that are too
    small for them.

    An item of at least ``FEW`` distinct shingles that fill more than half of its size class is searched by MinHash. Of
    any other, a text that holds ``least`` of its shingles holds one of the first d - ceil(least * d) + 1 of its d, which
    are looked up as they are.
    """

    def __init__(self, ids: list, runs: list[np.ndarray], least: float):
        self.ids, self.least = ids, least
        self.sets = [np.unique(r) for r in runs]
        classes = np.array([max(SMALLEST, 1 << (len(r) - 1).bit_length()) for r in runs])
        sizes = np.array([len(s) for s in self.sets])
        large = (sizes >= FEW) & (2 * sizes > classes)
        single = [(x, k) for k in np.flatnonzero(~large).tolist() for x in self.sets[k][: sizes[k] - int(np.ceil(least * sizes[k])) + 1].tolist()]
        self.single = np.array(sorted(single), U64).reshape(-1, 2)
        self.classes = {}
        for size in np.unique(classes[large]).tolist():
            own = np.flatnonzero(large & (classes == size))
            lists = []
            for a in _FACTORS:
                values = np.array([((self.sets[k] * a) >> U64(32)).min() for k in own])
                order = np.argsort(values, kind="stable")
                lists.append((values[order], own[order]))
            self.classes[size] = lists

    def looked_up(self, runs: list[np.ndarray]) -> set[tuple[int, int]]:
        """Pairs (row, item) where the row holds one of the item's single shingles."""
        lengths = [len(r) for r in runs]
        if not len(self.single) or not sum(lengths):
            return set()
        flat, row = np.concatenate(runs), np.repeat(np.arange(len(runs)), lengths)
        keys = np.ascontiguousarray(self.single[:, 0])
        left, right = np.searchsorted(keys, flat, "left"), np.searchsorted(keys, flat, "right")
        return {(int(row[j]), int(x)) for j in np.flatnonzero(left < right).tolist() for x in self.single[left[j] : right[j], 1]}

    def candidates(self, runs: list[np.ndarray]) -> set[tuple[int, int]]:
        """Pairs (row, item) where a window of the row and the item agree in a MinHash value.

        A row's shingles are cut into blocks of 8, 16, 32 ... as the size class asks; a window is two neighbouring
        blocks, so that a passage no longer than the class lies in one. With at least 3/4 of the item in a window of
        twice its class, of which the item fills more than a quarter, their Jaccard similarity is 0.176 or more, and 64
        values miss it with probability under 5e-6.
        """
        if not self.classes:
            return set()
        lengths = np.array([len(r) for r in runs])
        rows = np.flatnonzero(lengths)
        if not len(rows):
            return set()
        flat, n_blocks = np.concatenate(runs), -(-lengths[rows] // SMALLEST)
        base = np.concatenate([[0], np.cumsum(lengths[rows])[:-1]])
        block_row = np.repeat(np.arange(len(rows)), n_blocks)
        within = np.arange(n_blocks.sum()) - np.repeat(np.concatenate([[0], np.cumsum(n_blocks)[:-1]]), n_blocks)
        starts = base[block_row] + within * SMALLEST
        found: set[tuple[int, int]] = set()
        top = max(self.classes)
        for k, a in enumerate(_FACTORS):
            low, row, size = _minima(((flat * a) >> U64(32)), starts), block_row, SMALLEST
            while True:
                if size in self.classes:
                    window = low.copy()
                    same = row[1:] == row[:-1]
                    window[:-1][same] = np.minimum(low[:-1], low[1:])[same]
                    values, own = self.classes[size][k]
                    left, right = np.searchsorted(values, window, "left"), np.searchsorted(values, window, "right")
                    for j in np.flatnonzero(left < right).tolist():
                        found.update((int(rows[row[j]]), int(x)) for x in own[left[j] : right[j]])
                if size >= top:
                    break
                firsts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                nth = np.arange(len(row)) - np.repeat(firsts, np.diff(np.r_[firsts, len(row)]))
                even = np.flatnonzero(nth % 2 == 0)
                low, row, size = np.minimum.reduceat(low, even), row[even], size * 2
        return found

    def matches(self, runs: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
        """(row, item, shared shingles) of rows that hold at least ``least`` of the item's shingles."""
        last, own = -1, None
        for row, item in sorted(self.candidates(runs) | self.looked_up(runs)):
            if row != last:
                last, own = row, np.unique(runs[row])
            shared = len(np.intersect1d(own, self.sets[item], assume_unique=True))
            if shared >= self.least * len(self.sets[item]):
                yield row, item, shared


def item_blocks(items: DataFrame, least: float, words: int, block_shingles: int, id_col: str, text_col: str) -> Iterator[Items]:
    """The stated query set in blocks of a bounded number of shingles, so that what is broadcast is bounded."""
    ids: list = []
    runs: list[np.ndarray] = []
    for r in items.select(id_col, text_col).toLocalIterator():
        (own,) = text_shingles(pa.array([r[1]], pa.large_string()), words, MARKS)
        if not len(own):
            continue
        if runs and sum(map(len, runs)) + len(own) > block_shingles:
            yield Items(ids, runs, least)
            ids, runs = [], []
        ids.append(r[0])
        runs.append(own)
    if runs:
        yield Items(ids, runs, least)


def find_items(docs: DataFrame, items: DataFrame, least: float = 0.75, words: int = 5, block_shingles: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Pairs of a document and a test item of which it holds at least ``least`` of the distinct ``words``-word shingles.

    Words are runs of letters and digits with A-Z in lower case. A text of fewer words is one shingle as a whole, so that
    an item of fewer words is found only in documents that consist of it; texts without words hold and match nothing.
    Ids are integers, or texts of integers. Returns, for every row of ``docs`` (also of equal ids): id, item id,
    item_shingles, shared, containment. No documents or no items: no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, item_id long, item_shingles long, shared long"
    out = None
    for block in item_blocks(items.withColumn(item_id, F.col(item_id).cast("long")), least, words, block_shingles, item_id, item_text):
        shared_block = spark.sparkContext.broadcast(block)

        def search(batches, shared_block=shared_block):
            block = shared_block.value
            for batch in batches:
                for piece in _pieces(batch):
                    runs = list(text_shingles(piece.column(1), words, MARKS))
                    rows = [(piece.column(0)[r].as_py(), block.ids[i], len(block.sets[i]), s) for r, i, s in block.matches(runs)]
                    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], pa.int64()) for k in range(4)], ["doc_id", "item_id", "item_shingles", "shared"])

        found = slim.mapInArrow(search, schema)
        out = found if out is None else out.unionByName(found)
    out = spark.createDataFrame([], schema) if out is None else out
    return out.select(F.col("doc_id").alias(id_col), F.col("item_id").alias(item_id), "item_shingles", "shared", (F.col("shared") / F.col("item_shingles")).alias("containment"))


def _pieces(batch: pa.RecordBatch, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    for a in range(0, batch.num_rows, rows):
        yield batch.slice(a, rows)


def decontaminate(docs: DataFrame, items: DataFrame, least: float = 0.75, words: int = 5, block_shingles: int = 1 << 20, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item (see ``find_items``), with all their columns."""
    small_batches(docs.sparkSession)
    at = docs.columns.index(text_col)
    for block in item_blocks(items, least, words, block_shingles, item_id, item_text):
        shared_block = docs.sparkSession.sparkContext.broadcast(block)

        def keep(batches, shared_block=shared_block):
            for batch in batches:
                for piece in _pieces(batch):
                    runs = list(text_shingles(piece.column(at), words, MARKS))
                    clean = np.ones(piece.num_rows, bool)
                    clean[[r for r, _, _ in shared_block.value.matches(runs)]] = False
                    yield piece.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def op3_decontamination(spark, sf_dir):
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = rf"list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
ORACLE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM d WHERE len(w) > 0),
bs AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM b WHERE len(w) > 0),
n AS (SELECT item_id, count(*) AS item_shingles FROM bs GROUP BY item_id)
SELECT doc_id, item_id, item_shingles, count(*) AS shared, count(*) / item_shingles AS containment
FROM ds JOIN bs USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id, item_shingles HAVING count(*) >= 0.75 * item_shingles
"""
