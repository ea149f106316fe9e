"""Operators on ordered tokens, segments and turns of meetings; times are whole milliseconds.

Rules that look only at neighbours are windows; those that depend on the group so far are first cut into islands at
breaks that hold in any case, and only then folded, island by island.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import saved

_BEFORE, _SO_FAR = (Window.unboundedPreceding, -1), (Window.unboundedPreceding, 0)


def glued_text(tokens: Column) -> Column:
    """Text of ordered structs (text, is_punc): punctuation joins the piece before it, other words follow a space."""
    return F.trim(F.array_join(F.transform(tokens, lambda t, i: F.concat(F.when(t["is_punc"] & (i > 0), "").when(i > 0, " ").otherwise(""), t["text"])), ""))


def utterances(tokens: DataFrame, max_pause_ms: int = 1200, max_dur_ms: int = 30_000) -> DataFrame:
    """Groups tokens (meeting_id, start_ms, end_ms, speaker_letter, text, is_punc, seq) into one speaker's utterances.

    A new one starts at another speaker, after a pause of more than ``max_pause_ms`` since the latest end, or when the
    current one has lasted ``max_dur_ms``. Returns meeting_id, speaker_letter, start_ms, end_ms, text, token_count.
    """
    order = ["start_ms", "end_ms", "speaker_letter", "seq"]
    w = Window.partitionBy("meeting_id").orderBy(*order)
    turn = F.coalesce((F.lag("speaker_letter").over(w) != F.col("speaker_letter")).cast("int"), F.lit(1))
    t = tokens.withColumn("_t", turn).withColumn("_run", F.sum("_t").over(w.rowsBetween(*_SO_FAR)))
    r = Window.partitionBy("meeting_id", "_run").orderBy(*order)
    latest = F.max("end_ms").over(r.rowsBetween(*_BEFORE))
    t = t.withColumn("_b", F.when(latest.isNull() | (F.col("start_ms") - latest > max_pause_ms), 1).otherwise(0)).withColumn("_island", F.sum("_b").over(r.rowsBetween(*_SO_FAR)))
    island = t.groupBy("meeting_id", "_run", "_island").agg(
        F.array_sort(F.collect_list(F.struct("start_ms", "end_ms", "speaker_letter", "seq", "text", "is_punc"))).alias("ts"), (F.max("end_ms") - F.min("start_ms")).alias("dur")
    )
    # Starts (from 0) of the utterances inside an island; one that is short enough has a single one.
    fold = F.expr(
        f"""IF(dur < {max_dur_ms}, array(0), aggregate(sequence(0, size(ts) - 1),
          named_struct('s', -1L, 'e', -1L, 'cuts', cast(array() AS array<int>)),
          (a, i) -> IF(size(a.cuts) = 0 OR ts[i].start_ms - a.e > {max_pause_ms} OR a.e - a.s >= {max_dur_ms},
             named_struct('s', ts[i].start_ms, 'e', ts[i].end_ms, 'cuts', array_append(a.cuts, i)),
             named_struct('s', a.s, 'e', greatest(a.e, ts[i].end_ms), 'cuts', a.cuts)), a -> a.cuts))"""
    )
    pieces = island.withColumn("cuts", fold).select(
        "meeting_id",
        F.explode(F.expr("transform(cuts, (c, k) -> slice(ts, c + 1, IF(k + 1 < size(cuts), cuts[k + 1], size(ts)) - c))")).alias("u"),
    )
    return pieces.select(
        "meeting_id",
        F.col("u")[0]["speaker_letter"].alias("speaker_letter"),
        F.col("u")[0]["start_ms"].alias("start_ms"),
        F.array_max(F.transform("u", lambda x: x["end_ms"])).alias("end_ms"),
        glued_text(F.col("u")).alias("text"),
        F.size(F.filter("u", lambda x: ~x["is_punc"])).alias("token_count"),
    )


def _islands(segments: DataFrame, keys: list[str], order: list[str], max_gap_ms: int) -> DataFrame:
    """Adds _island: a new one where a row starts more than the gap after the latest end before it."""
    w = Window.partitionBy(*keys).orderBy(*order)
    latest = F.max("end_ms").over(w.rowsBetween(*_BEFORE))
    return segments.withColumn("_b", F.when(latest.isNull() | (F.col("start_ms") - latest > max_gap_ms), 1).otherwise(0)).withColumn("_island", F.sum("_b").over(w.rowsBetween(*_SO_FAR))).drop("_b")


def speech_regions(segments: DataFrame, max_gap_ms: int = 50) -> DataFrame:
    """Merges all speakers' segments that overlap or lie within the gap: meeting_id, start_ms, end_ms."""
    order = ["start_ms", "end_ms"]
    return _islands(segments, ["meeting_id"], order, max_gap_ms).groupBy("meeting_id", "_island").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms")).drop("_island")


def merge_same_speaker(segments: DataFrame, max_gap_ms: int) -> DataFrame:
    """Merges segments that follow each other in (start, end, speaker) order with one speaker and at most the gap."""
    w = Window.partitionBy("meeting_id").orderBy("start_ms", "end_ms", "speaker")
    change = F.coalesce((F.lag("speaker").over(w) != F.col("speaker")).cast("int"), F.lit(1))
    runs = segments.withColumn("_c", change).withColumn("_run", F.sum("_c").over(w.rowsBetween(*_SO_FAR))).drop("_c")
    merged = _islands(runs, ["meeting_id", "_run"], ["start_ms", "end_ms"], max_gap_ms)
    return merged.groupBy("meeting_id", "_run", "_island").agg(F.first("speaker").alias("speaker"), F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms")).drop("_run", "_island")


def clean_segments(segments: DataFrame, max_gap_ms: int, min_ms: int = 180) -> DataFrame:
    """Merges, drops short segments, and merges what is left again."""
    valid = segments.where("end_ms > start_ms").select("meeting_id", "speaker", "start_ms", "end_ms")
    return merge_same_speaker(merge_same_speaker(valid, max_gap_ms).where(F.col("end_ms") - F.col("start_ms") >= min_ms), max_gap_ms)


def merge_capped(segments: DataFrame, max_gap_ms: int = 200, max_ms: int = 18_000) -> DataFrame:
    """Merges neighbours of one speaker with a gap from 0 to ``max_gap_ms`` while the whole stays within ``max_ms``."""
    w = Window.partitionBy("meeting_id").orderBy("start_ms", "end_ms", "speaker")
    gap = F.col("start_ms") - F.lag("end_ms").over(w)
    joins = (F.lag("speaker").over(w) == F.col("speaker")) & gap.between(0, max_gap_ms)
    s = segments.withColumn("_b", F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1)).withColumn("_island", F.sum("_b").over(w.rowsBetween(*_SO_FAR)))
    island = s.groupBy("meeting_id", "_island").agg(F.first("speaker").alias("speaker"), F.array_sort(F.collect_list(F.struct("start_ms", "end_ms"))).alias("ts"))
    fold = F.expr(
        f"""aggregate(slice(ts, 2, size(ts)), named_struct('out', cast(array() AS array<struct<start_ms:bigint,end_ms:bigint>>), 's', ts[0].start_ms, 'e', ts[0].end_ms),
          (a, t) -> IF(greatest(a.e, t.end_ms) - a.s <= {max_ms}, named_struct('out', a.out, 's', a.s, 'e', greatest(a.e, t.end_ms)),
             named_struct('out', array_append(a.out, named_struct('start_ms', a.s, 'end_ms', a.e)), 's', t.start_ms, 'e', t.end_ms)),
          a -> array_append(a.out, named_struct('start_ms', a.s, 'end_ms', a.e)))"""
    )
    return island.select("meeting_id", "speaker", F.explode(fold).alias("x")).select("meeting_id", "speaker", "x.start_ms", "x.end_ms")


def split_long(segments: DataFrame, max_ms: int = 25_000) -> DataFrame:
    """Cuts segments into pieces of at most ``max_ms``; 0 or less leaves them."""
    if max_ms <= 0:
        return segments
    n = F.greatest(F.lit(1), F.ceil((F.col("end_ms") - F.col("start_ms")) / max_ms))
    piece = segments.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    start = F.col("start_ms") + F.col("_k") * max_ms
    return piece.withColumn("_s", start).withColumn("end_ms", F.least("end_ms", F.col("_s") + max_ms)).withColumn("start_ms", F.col("_s")).drop("_k", "_s")


def recognition_segments(segments: DataFrame, max_gap_ms: int = 200, merge_ms: int = 18_000, split_ms: int = 25_000, min_ms: int = 150) -> DataFrame:
    """Merges under a cap, cuts, and drops what is too short."""
    out = split_long(merge_capped(segments, max_gap_ms, merge_ms), split_ms)
    return out.where(F.col("end_ms") - F.col("start_ms") >= min_ms)


def grid_segments(meetings: DataFrame, on_ms: int = 20_000, off_ms: int = 1000) -> DataFrame:
    """Fixed segments over each meeting's duration_ms: on, off, on ..."""
    step = on_ms + off_ms
    k = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.ceil(F.col("duration_ms") / step) - 1)))
    return meetings.where("duration_ms > 0").select("meeting_id", "duration_ms", k.alias("k")).select("meeting_id", (F.col("k") * step).alias("start_ms"), F.least("duration_ms", F.col("k") * step + on_ms).alias("end_ms"))


def placeholder_speakers(meetings: DataFrame, n: int = 8, speakers: int = 4) -> DataFrame:
    """Segment i at [10 i, 10 i + 8] seconds with speaker i % speakers + 1."""
    i = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    return meetings.select("meeting_id", i.alias("i")).select("meeting_id", (F.col("i") * 10_000).cast("long").alias("start_ms"), (F.col("i") * 10_000 + 8000).cast("long").alias("end_ms"), F.concat(F.lit("SPEAKER_"), (F.col("i") % speakers + 1).cast("string")).alias("speaker"))


def label_speakers(segments: DataFrame) -> DataFrame:
    """SPEAKER_1, SPEAKER_2 ... by the order of letters in a meeting."""
    rank = F.dense_rank().over(Window.partitionBy("meeting_id").orderBy("speaker_letter"))
    return segments.withColumn("speaker", F.concat(F.lit("SPEAKER_"), rank.cast("string")))


def _numbered(turns: DataFrame, block: int) -> DataFrame:
    """Turns' places s from 0, the words before them (p) and their meeting's n. Sums are made block by block (``block``
    consecutive turn_idx) and carried over a table with a row for each block."""
    t = saved(turns.select("meeting_id", "turn_idx", F.col("words").cast("long").alias("words"), F.floor(F.col("turn_idx") / block).alias("_block")))
    totals = t.groupBy("meeting_id", "_block").agg(F.count("*").alias("_n"), F.sum("words").alias("_w"))
    whole = Window.partitionBy("meeting_id")
    earlier = whole.orderBy("_block").rowsBetween(*_BEFORE)
    zero = F.lit(0).cast("long")
    before = totals.select("meeting_id", "_block", F.coalesce(F.sum("_n").over(earlier), zero).alias("_n0"), F.coalesce(F.sum("_w").over(earlier), zero).alias("_w0"), F.sum("_n").over(whole).alias("n"))
    here = Window.partitionBy("meeting_id", "_block").orderBy("turn_idx")
    p = F.col("_w0") + F.sum("words").over(here.rowsBetween(*_SO_FAR)) - F.col("words")
    return t.join(before, ["meeting_id", "_block"]).select("meeting_id", "turn_idx", (F.col("_n0") + F.row_number().over(here) - 1).alias("s"), p.alias("p"), "words", "n")


def _next_starts(turns: DataFrame, target_words: int, overlap_words: int) -> DataFrame:
    """(meeting_id, s, e, next, n): where a chunk that starts at s ends, and where the one after it starts (n: nowhere).

    Both are looked up by numbers of words, over distinct values of p in buckets of so many words; each value also goes to
    the bucket beside it that can ask for it, so that no bucket has more values than words.
    """
    points = turns.select("meeting_id", F.col("p").alias("v"), F.col("s").alias("j")).unionByName(turns.where("s = n - 1").select("meeting_id", (F.col("p") + F.col("words")).alias("v"), F.col("n").alias("j")))
    values = points.groupBy("meeting_id", "v").agg(F.min("j").alias("lo"), F.max("j").alias("hi"))
    width = 16 * max(target_words, overlap_words, 1)
    bucket = lambda less: F.floor((F.col("v") - less) / width)
    copies = values.withColumn("_b", F.explode(F.array_distinct(F.array(bucket(0), bucket(target_words), bucket(-overlap_words)))))
    w = Window.partitionBy("meeting_id", "_b").orderBy("v")
    ahead, behind = w.rangeBetween(0, target_words), w.rangeBetween(-overlap_words, 0)
    found = copies.select("meeting_id", "_b", "v", F.max("hi").over(ahead).alias("_e"), F.max("v").over(ahead).alias("_q"), F.min("lo").over(behind).alias("_k")).where(F.col("_b") == bucket(0))
    t = turns.join(found.select("meeting_id", F.col("v").alias("p"), "_e", "_q"), ["meeting_id", "p"])
    t = t.select("meeting_id", "s", "n", F.greatest(F.col("s") + 1, "_e").alias("e"), F.when(F.col("_e") > F.col("s"), F.col("_q")).otherwise(F.col("p") + F.col("words")).alias("_q"))
    t = t.join(found.select("meeting_id", F.col("v").alias("_q"), "_k"), ["meeting_id", "_q"])
    same = (F.col("_k") <= F.col("s")) | (F.col("_k") == F.col("e"))
    return t.select("meeting_id", "s", "e", F.when(F.col("e") == F.col("n"), F.col("n")).when(same, F.col("e")).otherwise(F.col("_k")).alias("next"), "n")


def _chunk_ranges(starts: DataFrame, block: int) -> DataFrame:
    """(meeting_id, k, s, e): the chunks that the next starts lead to from 0, numbered from 0.

    Pointers are doubled, first inside blocks of ``block`` turns, which gives for every start where its path leaves the
    block; then between blocks, over the few starts at which paths enter one, in as many joins as the logarithm of a
    meeting's blocks. The starts that a path from 0 meets are found by the same jumps, longest first.
    """
    of = (F.floor(F.col("s") / block)).alias("block")
    lists = lambda c: F.transform("x", lambda r: r[c]).alias(c)
    blocks = starts.groupBy("meeting_id", of).agg(F.array_sort(F.collect_list(F.struct("s", "next", "e"))).alias("x"), F.max("n").alias("n"))
    blocks = blocks.select("meeting_id", "block", (F.col("block") * block).alias("first"), lists("next"), lists("e"), "n")
    hop = "transform({0}, v -> coalesce(get({0}, cast(v - first AS int)), v))"  # a place outside the block stays
    steps = "sequence(1, length(bin(size(next))))"
    blocks = saved(blocks.withColumn("leaves", F.expr(f"aggregate({steps}, next, (a, i) -> {hop.format('a')})")))
    entries = blocks.select("meeting_id", "n", F.explode(F.array_distinct("leaves")).alias("t")).where("t < n").select("meeting_id", "t").distinct()
    reached = blocks.where("block = 0").select("meeting_id", F.lit(0).cast("long").alias("t"), "block")
    if not entries.isEmpty():  # a path leaves its block
        at = lambda df: df.withColumn("block", F.floor(F.col("t") / block))
        jumps = [saved(at(entries).join(blocks.select("meeting_id", "block", "first", "leaves", "n"), ["meeting_id", "block"]).select("meeting_id", "t", F.expr("get(leaves, cast(t - first AS int))").alias("to"), "n").where("`to` < n").drop("n"))]
        while not jumps[-1].isEmpty():
            a = jumps[-1]
            jumps.append(saved(a.join(a.select("meeting_id", F.col("t").alias("to"), F.col("to").alias("_to")), ["meeting_id", "to"]).select("meeting_id", "t", F.col("_to").alias("to"))))
        first = blocks.where("block = 0").select("meeting_id", F.expr("get(leaves, 0)").alias("t"), "n").where("t < n").drop("n")
        for a in reversed(jumps[:-1]):
            first = saved(first.unionByName(first.join(a, ["meeting_id", "t"]).select("meeting_id", F.col("to").alias("t"))))
        reached = reached.unionByName(at(first))
    ladder = f"aggregate({steps}, array(next), (ls, i) -> concat(ls, array({hop.format('element_at(ls, -1)')})))"
    path = "aggregate(reverse(sequence(0, size(ladder) - 1)), array(t), (r, k) -> concat(r, filter(transform(r, v -> get(get(ladder, k), cast(v - first AS int))), v -> v < first + size(next))))"
    paths = reached.join(blocks, ["meeting_id", "block"]).withColumn("ladder", F.expr(ladder)).withColumn("path", F.array_sort(F.expr(path))).select("meeting_id", "block", "first", "e", "path")
    earlier = Window.partitionBy("meeting_id").orderBy("block").rowsBetween(*_BEFORE)
    numbered = paths.withColumn("_k0", F.coalesce(F.sum(F.size("path")).over(earlier), F.lit(0)))
    out = numbered.select("meeting_id", "first", F.col("e").alias("es"), "_k0", F.posexplode("path").alias("i", "s"))
    return out.select("meeting_id", (F.col("_k0") + F.col("i")).cast("int").alias("k"), "s", F.expr("get(es, cast(s - first AS int))").alias("e"))


def chunks(turns: DataFrame, target_words: int = 220, overlap_words: int = 40, block: int = 8192) -> DataFrame:
    """Overlapping chunks of whole turns (meeting_id, turn_idx, speaker, text, words, start_ms, end_ms).

    A chunk takes turns while they fit in ``target_words`` (the first in any case); the next one starts so far back that
    at most ``overlap_words`` are repeated, or right after if that would be the same start. Returns meeting_id,
    chunk_id, chunk_no, turn_indices, start_ms, end_ms, text. A meeting may have any number of turns: where a chunk ends
    and the next one starts is looked up for every turn, and the chain of starts is followed by doubled pointers. turn_idx
    is a turn's own in its meeting; the words of a turn are at least 0.
    """
    numbered = saved(_numbered(turns, block))
    ranges = _chunk_ranges(_next_starts(numbered, target_words, overlap_words), block)
    # By their files' size turns would be broadcast, though they are far larger as rows.
    c = ranges.select("meeting_id", "k", F.explode(F.sequence(F.col("s"), F.col("e") - 1)).alias("s")).join(numbered.select("meeting_id", "turn_idx", "s").hint("merge"), ["meeting_id", "s"])
    said = turns.select("meeting_id", "turn_idx", "start_ms", "end_ms", F.concat("speaker", F.lit(": "), "text").alias("line"))
    g = c.join(said.hint("merge"), ["meeting_id", "turn_idx"]).groupBy("meeting_id", "k").agg(F.array_sort(F.collect_list(F.struct("turn_idx", "start_ms", "end_ms", "line"))).alias("u"))
    return g.select(
        "meeting_id",
        F.format_string("%s_chunk_%04d", F.col("meeting_id").cast("string"), F.col("k") + 1).alias("chunk_id"),
        (F.col("k") + 1).alias("chunk_no"),
        F.transform("u", lambda x: x["turn_idx"]).alias("turn_indices"),
        F.col("u")[0]["start_ms"].alias("start_ms"),
        F.element_at("u", -1)["end_ms"].alias("end_ms"),
        F.array_join(F.transform("u", lambda x: x["line"]), "\n").alias("text"),
    )


def coverage_chunks(table: DataFrame, limit: int = 24) -> DataFrame:
    """Chunks (meeting_id, idx, n, cue) for a prompt: the first max(6, limit / 3) with a cue, then evenly spaced ones."""
    keep = max(6, limit // 3)
    cue_rank = F.sum(F.col("cue").cast("int")).over(Window.partitionBy("meeting_id").orderBy("idx"))
    t = table.withColumn("_must", F.col("cue") & (cue_rank <= keep))
    whole = Window.partitionBy("meeting_id")
    t = t.withColumn("_slots", limit - F.sum(F.col("_must").cast("int")).over(whole))
    spaced = F.when(F.col("_slots") <= 1, F.array(F.lit(0).cast("long"))).otherwise(F.expr("transform(sequence(0, cast(_slots AS int) - 1), i -> cast(bround(i * (n - 1) / (_slots - 1)) AS bigint))"))
    t = t.withColumn("_even", F.array_contains(spaced, F.col("idx").cast("long")) & (F.col("_slots") > 0))
    # Evenly spaced ones are added in order until the limit; must-keep ones among them don't count again.
    added = F.sum(F.when(F.col("_even") & ~F.col("_must"), 1).otherwise(0)).over(Window.partitionBy("meeting_id").orderBy("idx"))
    t = t.withColumn("_added", added)
    return t.where((F.col("n") <= limit) | F.col("_must") | (F.col("_even") & (F.col("_added") <= F.col("_slots")))).drop("_must", "_slots", "_even", "_added")


def batched(table: DataFrame, keys: list[str], order: list[str], size: int) -> DataFrame:
    """Adds batch: rows of a key in order, ``size`` at a time."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return table.withColumn("batch", F.floor(n / size))
