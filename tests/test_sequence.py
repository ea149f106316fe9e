"""Sequence operators against plain sequential definitions on random small inputs."""

import random

from pyspark.sql import functions as F

from convspark.operators import intervals, sequence


def _tokens(seed, n=60, meetings=25):
    r, rows, seq = random.Random(seed), [], 0
    for m in range(meetings):
        for _ in range(r.randint(1, n)):
            s = r.randint(0, 400)
            rows.append((f"m{m}", s, s + r.randint(0, 40), r.choice("AB"), r.choice(["w", "x", "."]), False, seq))
            seq += 1
    return [(m, s, e, sp, t, t == ".", q) for m, s, e, sp, t, _, q in rows]


def _by_meeting(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def test_utterances(spark):
    rows = _tokens(1)
    want = []
    for m, ts in _by_meeting(rows).items():
        cur = None
        for t in sorted(ts, key=lambda t: (t[1], t[2], t[3], t[6])):
            if cur and t[3] == cur[1] and t[1] - cur[3] <= 5 and cur[3] - cur[2] < 30:
                cur[3] = max(cur[3], t[2])
                cur[4] += 1
            else:
                cur = [m, t[3], t[1], t[2], 1]
                want.append(cur)
    df = spark.createDataFrame(rows, "meeting_id string, start_ms long, end_ms long, speaker_letter string, text string, is_punc boolean, seq long")
    got = sequence.utterances(df, 5, 30)
    assert sorted((r.meeting_id, r.speaker_letter, r.start_ms, r.end_ms) for r in got.collect()) == sorted(tuple(w[:4]) for w in want)
    assert got.agg(F.sum("token_count")).first()[0] == sum(not r[5] for r in rows)


def test_merges(spark):
    rows = [(m, s, e, sp) for m, s, e, sp, *_ in _tokens(2) if e > s]
    df = spark.createDataFrame(rows, "meeting_id string, start_ms long, end_ms long, speaker string")
    simple, capped = [], []
    for m, ts in _by_meeting(rows).items():
        a = b = None
        for _, s, e, sp in sorted(ts, key=lambda t: (t[1], t[2], t[3])):
            if a and a[3] == sp and s - a[2] <= 6:
                a[2] = max(a[2], e)
            else:
                a = [m, s, e, sp]
                simple.append(a)
            if b and b[3] == sp and 0 <= s - b[2] <= 6 and max(b[2], e) - b[1] <= 50:
                b[2] = max(b[2], e)
            else:
                b = [m, s, e, sp]
                capped.append(b)
    key = lambda df: sorted((r.meeting_id, r.start_ms, r.end_ms, r.speaker) for r in df.collect())
    assert key(sequence.merge_same_speaker(df, 6)) == sorted(map(tuple, simple))
    assert key(sequence.merge_capped(df, 6, 50)) == sorted(map(tuple, capped))


def test_chunks(spark):
    r = random.Random(3)
    rows = [(f"m{m}", i, "S", "t", r.choice([0, 1, 3, 5, 9, 14])) for m in range(60) for i in range(r.randint(1, 25))]
    df = spark.createDataFrame(rows, "meeting_id string, turn_idx int, speaker string, text string, words long").withColumn("start_ms", F.col("turn_idx").cast("long")).withColumn("end_ms", F.col("turn_idx").cast("long"))
    want = []
    for m, ts in _by_meeting(rows).items():
        w = [t[4] for t in ts]
        s = 0
        while s < len(w):
            e, n = s, 0
            while e < len(w) and (e == s or n + w[e] <= 12):
                n += w[e]
                e += 1
            want.append((m, list(range(s, e))))
            if e >= len(w):
                break
            b, back = e, 0
            while b > s and back + w[b - 1] <= 4:
                back += w[b - 1]
                b -= 1
            s = e if b == s else b
    for block in (8192, 4, 2):  # small blocks: paths cross many of them
        got = sequence.chunks(df, 12, 4, block).collect()
        assert sorted((r.meeting_id, r.turn_indices) for r in got) == sorted(want)
        assert sorted((r.meeting_id, r.chunk_no) for r in got) == sorted((m, k + 1) for m, ts in _by_meeting([(w[0],) for w in want]).items() for k in range(len(ts)))


def test_chunks_of_one_long_meeting(spark):
    """A meeting of a million turns, and no row or task that holds it."""
    n = 1_000_000
    words = F.when(F.col("id") % 1000 < 990, F.col("id") * 7919 % 23).otherwise(0)
    df = spark.range(n).select(F.lit("m").alias("meeting_id"), F.col("id").cast("int").alias("turn_idx"), F.lit("S").alias("speaker"), F.lit("t").alias("text"), words.alias("words"), F.col("id").alias("start_ms"), F.col("id").alias("end_ms"))
    w = [k * 7919 % 23 if k % 1000 < 990 else 0 for k in range(n)]
    want, s = [], 0
    while True:
        e, size = s, 0
        while e < n and (e == s or size + w[e] <= 220):
            size += w[e]
            e += 1
        want.append((s, e))
        if e == n:
            break
        b, back = e, 0
        while b > s and back + w[b - 1] <= 40:
            back += w[b - 1]
            b -= 1
        s = e if b == s else b
    got = sequence.chunks(df).select("chunk_no", F.col("turn_indices")[0].alias("s"), (F.element_at("turn_indices", -1) + 1).alias("e")).orderBy("chunk_no").collect()
    assert [(r.s, r.e) for r in got] == want and [r.chunk_no for r in got] == list(range(1, len(want) + 1))


def test_interval_join_and_atoms(spark):
    rows = [(m, s, e, sp) for m, s, e, sp, *_ in _tokens(4, 20, 8) if e > s]
    df = spark.createDataFrame(rows, "meeting_id string, start_ms long, end_ms long, speaker string")
    got = intervals.interval_join(df, df, ["meeting_id"], bucket_ms=16).count()
    assert got == sum(a[0] == b[0] and a[1] < b[2] and b[1] < a[2] for a in rows for b in rows)
    touching = intervals.interval_join(df, df, ["meeting_id"], touching=True, bucket_ms=16).count()
    assert touching == sum(a[0] == b[0] and a[1] <= b[2] and b[1] <= a[2] for a in rows for b in rows)
    hyp = df.withColumn("start_ms", F.col("start_ms") + 3).where("end_ms > start_ms")
    atoms = {(r.meeting_id, r.start_ms): (r.ref, r.hyp) for r in intervals.atoms(df, hyp).collect()}
    for (m, s), (ref, h) in atoms.items():
        assert ref == sorted({x[3] for x in rows if x[0] == m and x[1] <= s < x[2]})
        assert h == sorted({x[3] for x in rows if x[0] == m and x[1] + 3 <= s < x[2]})


def test_long_intervals_are_few_rows(spark):
    """A segment of a day beside short ones: two nodes at its own level, and each short one a row or two a level."""
    day = 86_400_000
    r = random.Random(8)
    short = [("m", s, s + r.choice([0, 3, 700, 5000])) for s in (r.randrange(day) for _ in range(300))]
    long = [("m", 0, day), ("m", 1234, day - 99), ("m", day - 1, day + 10), ("n", 0, day)]
    schema = "meeting_id string, start_ms long, end_ms long"
    a, b = spark.createDataFrame(short + long, schema), spark.createDataFrame(long + short[:50], schema)
    for touching in (False, True):
        got = intervals.interval_join(a, b, ["meeting_id"], touching=touching)
        hits = [(x, y) for x in short + long for y in long + short[:50] if x[0] == y[0] and (x[1] <= y[2] and y[1] <= x[2] if touching else x[1] < y[2] and y[1] < x[2])]
        assert sorted((g.meeting_id, g.start_ms, g.end_ms, g.r_start_ms, g.r_end_ms) for g in got.collect()) == sorted((*x, y[1], y[2]) for x, y in hits)
    left = intervals.interval_join(a, b.where("meeting_id = 'n'"), ["meeting_id"], how="left")
    assert left.count() == len(short + long) and left.where("r_start_ms IS NOT NULL").count() == 1
    nodes = intervals._at_nodes(b.withColumn("_own", intervals._level("start_ms", "end_ms", 1000)), "start_ms", "end_ms", F.col("_own"), 1000)
    assert nodes.groupBy("meeting_id", "start_ms", "end_ms").count().agg(F.max("count")).first()[0] <= 2 * 2  # an interval may be there twice


def test_sweep_over_many_ranges(spark):
    """One meeting that fills all ranges, with a speaker who is active through ranges without a mark of theirs."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    r = random.Random(9)
    ref = [("m", "A", 0, 5000), ("k", "A", 3, 9)] + [("m", f"S{k % 3}", k * 5, k * 5 + r.randint(1, 30)) for k in range(900)]
    hyp = [("m", "B", 100, 4200)] + [("m", f"H{k % 2}", k * 7, k * 7 + r.randint(1, 9)) for k in range(600)]
    schema = "meeting_id string, speaker string, start_ms long, end_ms long"
    try:
        got = intervals.atoms(spark.createDataFrame(ref, schema), spark.createDataFrame(hyp, schema)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = []
    for m in "km":
        cuts = sorted({t for x in ref + hyp if x[0] == m for t in x[2:]})
        on = lambda side, t, m=m: sorted({x[1] for x in side if x[0] == m and x[2] <= t < x[3]})
        want += [(m, s, e, on(ref, s), on(hyp, s)) for s, e in zip(cuts, cuts[1:])]
    assert sorted((g.meeting_id, g.start_ms, g.end_ms, g.ref, g.hyp) for g in got) == want


def test_small_ones(spark):
    m = spark.createDataFrame([("m", 45_000), ("z", 0)], "meeting_id string, duration_ms long")
    assert [(r.start_ms, r.end_ms) for r in sequence.grid_segments(m).orderBy("start_ms").collect()] == [(0, 20_000), (21_000, 41_000), (42_000, 45_000)]
    s = spark.createDataFrame([("m", "a", 0, 60), ("m", "a", 100, 110)], "meeting_id string, speaker string, start_ms long, end_ms long")
    assert sorted((r.start_ms, r.end_ms) for r in sequence.split_long(s, 25).collect()) == [(0, 25), (25, 50), (50, 60), (100, 110)]
    assert sequence.split_long(s, 0) is s
    t = spark.createDataFrame([("m", i, 40, False) for i in range(40)], "meeting_id string, idx int, n long, cue boolean")
    kept = [r.idx for r in sequence.coverage_chunks(t, 12).orderBy("idx").collect()]
    assert len(kept) == 12 and kept[0] == 0 and kept[-1] == 39
