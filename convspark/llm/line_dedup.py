"""Line deduplication by a suffix array over line ids, built by distributed prefix doubling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import bound
from .common import SPACES, stash, table, whole_text

_KEY = ["h1", "h2"]


def _ranked(keys: DataFrame, by: list[str], name: str) -> DataFrame:
    """Ranks of distinct keys: sampled splitters, a sort of each range, and ids that grow along ranges and rows."""
    ordered = keys.repartitionByRange(*by).sortWithinPartitions(*by)
    return stash(ordered.withColumn(name, F.monotonically_increasing_id() + 1))


def _lines(text: Column) -> Column:
    """(index, line) of lines with white space made single and trimmed."""
    return F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("raw"), F.trim(F.regexp_replace(x, SPACES, " ")).alias("line")))


def _suffixes(live: DataFrame, depth: int) -> DataFrame:
    """Adds r0, r1 ... to live lines: ranks of the runs of 1, 2, 4 ... lines that start there, up to ``depth`` lines.

    A segment is a stretch of live lines; a run that its segment ends is padded by rank 0. Each step pairs the rank of a
    run with that of the run which follows it, ranks the distinct pairs, and hands the new rank back to the lines.
    """
    at = Window.partitionBy("uid", "segment").orderBy("ln")
    size, k = 1, 0
    while size < depth:
        paired = stash(live.withColumn("next", F.coalesce(F.lead(f"r{k}", size).over(at), F.lit(0))))
        ranks = _ranked(paired.select(f"r{k}", "next").distinct(), [f"r{k}", "next"], f"r{k + 1}")
        live = paired.join(ranks, [f"r{k}", "next"]).drop("next")
        size, k = size * 2, k + 1
    return live


def repeated_lines(docs: DataFrame, min_words: int = 10, whole_runs: bool = False) -> DataFrame:
    """Lines (uid, ln) of later copies of repeated runs, for ``docs`` (uid, id, text).

    Only lines that occur twice can be in a repeated run; the suffixes that start at them are ranked by their first
    1, 2, 4 ... lines. A run counts from ``min_words`` words, and as a line has one at least, that many lines tell
    suffixes apart for good. The suffixes whose longest common prefix has the lines that a run needs here are an
    interval of the suffix array; two ranks name it, so that nothing but an aggregation has to hold it together. The
    members of an interval repeat one run: the first by (id, uid, line) is kept, and the run's lines are deleted from all
    others. Every start inside a longer repeated run with ``min_words`` words left has an interval of its own; lines
    behind the last of these windows stay.

    With ``whole_runs`` these go too: from each start in an interval, the longest run that occurs at an earlier place as
    well is deleted. It is looked for up to ``min_words`` lines only and still found whole: from the last start of a
    maximal run with ``min_words`` words left, the lines after the first have fewer words, and so are fewer.
    """
    parts = docs.select("uid", "id", F.posexplode(F.filter(_lines(F.col("text")), lambda x: x["line"] != "")).alias("ln", "x"))
    line = F.col("x.line")
    lines = stash(parts.select("uid", "id", "ln", F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"), F.size(F.split(line, " ")).alias("words")))
    keys = _ranked(lines.groupBy(*_KEY).agg(F.count("*").alias("n")).where("n > 1").select(*_KEY), _KEY, "r0")
    doc = Window.partitionBy("uid").orderBy("ln")
    live = lines.join(keys, _KEY).select("uid", "id", "ln", "words", "r0").withColumn("segment", F.col("ln") - F.row_number().over(doc))

    depth = 1
    while depth < min_words:
        depth *= 2
    at = Window.partitionBy("uid", "segment").orderBy("ln").rowsBetween(0, depth - 1)
    last = depth.bit_length() - 1
    ranks = F.struct(*[f"r{k}" for k in range(last + 1)])
    sized = _suffixes(live, depth).withColumn("seq", F.collect_list("r0").over(at)).withColumn("ws", F.collect_list("words").over(at)).withColumn("rs", F.collect_list(ranks).over(at))
    sums = F.transform("ws", lambda w, i: F.aggregate(F.slice("ws", 1, i + 1), F.lit(0), lambda a, b: a + b))
    need = F.size(F.filter(sums, lambda s: s < min_words)) + 1
    sized = sized.withColumn("need", need).where(F.col("need") <= F.size("ws"))

    # The suffixes that share their first ``need`` lines: equal ranks of the run of 2 ** k <= need lines at the start, and
    # of the one that ends with them.
    head, tail = F.col("r0"), F.get("rs", F.col("need") - 1)["r0"]
    for k in range(1, last + 1):
        head = F.when(F.col("need") >= 2**k, F.col(f"r{k}")).otherwise(head)
        tail = F.when(F.col("need") >= 2**k, F.get("rs", F.col("need") - 2**k)[f"r{k}"]).otherwise(tail)
    suffixes = stash(sized.select("uid", "id", "ln", "need", *(["seq"] if whole_runs else []), head.alias("head"), tail.alias("tail")))
    place, interval = F.struct(F.col("id").isNull(), "id", "uid", "ln"), ["need", "head", "tail"]
    firsts = suffixes.groupBy(*interval).agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first != last").drop("last")
    if whole_runs:
        starts = suffixes.join(firsts, interval, "left_semi").select("uid", "id", "ln", "need", "seq")
        runs = starts.withColumn("m", F.explode(F.sequence("need", F.least(F.size("seq"), F.lit(min_words))))).withColumn("run", F.slice("seq", 1, F.col("m")))
        runs = runs.select("uid", place.alias("place"), "ln", "m", F.xxhash64("run").alias("h1"), F.xxhash64(F.lit(1), "run").alias("h2"))
        # The runs' first places are joined, not taken by a window, as a run may occur in any number of places.
        first = runs.groupBy("m", *_KEY).agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first != last").drop("last")
        copies = runs.join(first, ["m", *_KEY]).where("place != first").groupBy("uid", "ln").agg(F.max("m").alias("need"))
    else:
        copies = suffixes.join(firsts, interval).where((F.col("uid") != F.col("first.uid")) | (F.col("ln") != F.col("first.ln")))
    return copies.select("uid", F.explode(F.sequence(F.col("ln"), F.col("ln") + F.col("need") - 1)).alias("ln")).distinct()


def drop_repeated_lines(docs: DataFrame, min_words: int = 10, id_col: str = "doc_id", text_col: str = "text", whole_runs: bool = False) -> DataFrame:
    """Deletes later copies of repeated line runs of at least ``min_words`` words (see ``repeated_lines``).

    Lines are told apart after white space is made single and trimmed (by 128 bits of hash); blank lines count as no
    lines and stay. Runs don't cross documents. Returns a row for each input row: id, n_lines (lines that aren't blank),
    removed (indices among these, ascending) and text (what is left). Null texts are empty; rows with equal ids are
    documents of their own, in an arbitrary order among themselves, and a null id comes last. A document may have any number
    of lines, and any of them deleted: it is one row, and its lines are rows of their own meanwhile.
    """
    docs = stash(docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), whole_text(text_col).alias("text")))
    gone = stash(repeated_lines(docs, min_words, whole_runs).groupBy("uid").agg(F.array_sort(F.collect_set("ln")).alias("removed")))
    full = F.transform(F.filter(_lines(F.col("text")), lambda x: x["line"] != ""), lambda x: x["raw"])
    # Always by a shuffle: the deletions grow with the corpus, and so does what a broadcast of them would take.
    out = docs.join(gone.hint("merge"), "uid", "left").withColumn("removed", F.coalesce("removed", F.array().cast("array<int>"))).withColumn("_full", full)
    raw = bound(F.col("_full"), lambda full: F.transform("removed", lambda i: F.get(full, i)))
    # What is left is a difference of sets of indices, which hashes them: a text may have any number of deleted lines.
    left = bound(F.split("text", "\n"), lambda lines: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), raw), lambda i: F.get(lines, i)), "\n"))
    out = out.select(F.col("id").alias(id_col), F.size("_full").cast("long").alias("n_lines"), "removed", F.when(F.size("removed") == 0, F.col("text")).otherwise(left).alias("text"))
    return out


def _digests(out: DataFrame) -> DataFrame:
    return out.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"), F.sha2("text", 256).alias("text_sha256"))


def op8_line_dedup(spark, sf_dir):
    return _digests(drop_repeated_lines(table(spark, sf_dir, "documents"), whole_runs=True))


def op8_line_dedup_shortest_runs(spark, sf_dir):
    """Deletes the shortest runs of ten words from each start; lines with fewer words behind the last of them stay."""
    return _digests(drop_repeated_lines(table(spark, sf_dir, "documents")))


_ORACLE = r"""
WITH d AS (SELECT doc_id, list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'))) AS t,
                  string_split(coalesce(text, ''), chr(10)) AS raw FROM documents),
l AS (SELECT doc_id, raw, t, list_filter(t, lambda x: x <> '') AS a FROM d),
w AS (SELECT *, list_transform(a, lambda x: len(string_split(x, ' '))) AS n FROM l),
p AS (SELECT doc_id, unnest(range(1, len(a) + 1)) AS i, a, n FROM w),
q0 AS (SELECT doc_id, i, a, len(list_filter(range(1, least(10, len(a) - i + 1) + 1), lambda k: list_sum(n[i:i + k - 1]) < 10)) + 1 AS need FROM p),
q AS (SELECT doc_id, i, a, {LENGTHS} AS m FROM q0),
r AS (SELECT doc_id, i, m, array_to_string(a[i:i + m - 1], chr(10)) AS s FROM q WHERE i + m - 1 <= len(a)),
f AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS rn FROM r),
c AS (SELECT doc_id, i, max(m) AS m FROM f WHERE rn > 1 GROUP BY ALL),
g AS (SELECT doc_id, list_sort(list_distinct(flatten(list(range(i - 1, i + m - 1))))) AS gone FROM c GROUP BY doc_id),
o AS (SELECT w.doc_id, a, raw, t, coalesce(gone, []) AS gone, list_filter(range(1, len(t) + 1), lambda k: t[k] <> '') AS full_at FROM w LEFT JOIN g USING (doc_id))
SELECT doc_id, len(a) AS n_lines, len(gone) AS n_removed, array_to_string(gone, ',') AS removed,
       sha256(coalesce(array_to_string(list_transform(list_filter(range(1, len(raw) + 1), lambda k: NOT list_contains(list_transform(gone, lambda z: full_at[z + 1]), k)), lambda k: raw[k]), chr(10)), '')) AS text_sha256
FROM o
"""

#: From each start, runs of any length up to ten lines, which reach the end of any maximal run from one start or another.
ORACLE = _ORACLE.replace("{LENGTHS}", "unnest(range(need, 11))")
ORACLE_SHORTEST = _ORACLE.replace("{LENGTHS}", "need")
