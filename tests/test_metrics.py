import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from convspark.operators import audio, metrics


def _edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_word_and_char_errors(spark):
    r = random.Random(5)
    text = lambda: " ".join(r.choice(["a", "bb", "ccc", "d!", "[x]"]) for _ in range(r.randint(0, 9)))
    rows = [(i, text(), text()) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, ref string, hyp string")
    norm = lambda s: "".join(c if c.isalnum() else " " for c in s.replace("[x]", " ")).split()
    for x in metrics.with_char_errors(metrics.with_word_errors(df)).collect():
        a, b = norm(x.ref), norm(x.hyp)
        assert x.ref_len == len(a) and x.edits == _edit(a, b)
        assert x.wer is None if not a else abs(x.wer - _edit(a, b) / len(a)) < 1e-12
        ca, cb = "".join(a), "".join(b)
        assert abs(x.cer - (_edit(ca, cb) / len(ca) if ca else float(bool(cb)))) < 1e-12


def test_word_errors_of_long_texts(spark):
    """Pairs of more distinct words than there are characters below the surrogates."""
    words = [f"w{k}" for k in range(40_000)]
    changed = ["x", *words[1:20_000], *words[20_001:]]
    rows = [(1, " ".join(words), " ".join(words)), (2, " ".join(words), " ".join(changed))]
    got = {r.id: (r.ref_len, r.edits, r.wer) for r in metrics.with_word_errors(spark.createDataFrame(rows, "id int, ref string, hyp string")).select("id", "ref_len", "edits", "wer").collect()}
    assert got == {1: (40_000, 0, 0.0), 2: (40_000, 2, 2 / 40_000)}


def test_best_assignment(spark):
    r = random.Random(3)
    rows = [(k, n, [r.randint(0, 4) for _ in range(n * n)]) for k in range(60) for n in [r.randint(1, 5)]] + [(99, 8, [(i * 5 + j * 3) % 7 for i in range(8) for j in range(8)])]
    got = {x.k: x.b for x in spark.createDataFrame(rows, "k int, n int, c array<int>").select("k", metrics.best_assignment(F.col("c"), F.col("n")).alias("b")).collect()}
    for k, n, c in rows:
        cost, perm = min((sum(c[i * n + j] for i, j in enumerate(p)), list(p)) for p in itertools.permutations(range(n)))
        assert (got[k].cost, got[k].perm) == (cost, perm)


def test_evaluation_rows(spark):
    many = [("n", f"s{k}", "a") for k in range(9)]
    views = spark.createDataFrame([("m", "A", "one two"), *many], "meeting_id string, speaker string, text string")
    segs = spark.createDataFrame([("m", 0, 2000, "A")], "meeting_id string, start_ms long, end_ms long, speaker string")
    texts = spark.createDataFrame([("m", "one two", "one")], "meeting_id string, ref string, hyp string")
    got = {r.meeting_id: r for r in metrics.evaluation_rows(views, texts, views, views, segs, segs.selectExpr("meeting_id", "start_ms + 250 AS start_ms", "end_ms - 250 AS end_ms", "speaker"), texts).collect()}
    assert (got["m"].wer, got["m"].cpwer, got["m"].der, got["m"].rouge1, got["m"].speech_metric_errors) == ("0.500000", "0.000000", "0.000000", "0.666667", "")
    assert (got["n"].wer, got["n"].cpwer, got["n"].der, got["n"].rouge1, got["n"].speech_metric_errors) == ("", "", "", "", "cpwer:too_many_speakers")


def test_kernels():
    r = random.Random(6)
    for _ in range(300):
        a, b = ([r.randint(0, 3) for _ in range(r.randint(0, 8))] for _ in range(2))
        lcs = max((len(s) for k in range(len(a) + 1) for s in itertools.combinations(a, k) if _is_sub(s, b)), default=0)
        assert metrics.common(a, b) == lcs


def _is_sub(s, b):
    it = iter(b)
    return all(x in it for x in s)


def test_rouge_edges(spark):
    df = spark.createDataFrame([(1, "", "a b"), (2, "a b c", ""), (3, "the cat sat", "the cat sat"), (4, "a b", "b a")], "id int, ref string, hyp string")
    got = {r.id: (r.rouge1, r.rouge2, r.rougeL) for r in metrics.rouge(df, ["id"]).collect()}
    assert got == {1: (None, None, None), 2: (0.0, 0.0, 0.0), 3: (1.0, 1.0, 1.0), 4: (1.0, 0.0, 0.5)}


def test_cpwer(spark):
    ref = spark.createDataFrame([("m", "A", "one two three"), ("m", "B", "four five"), ("n", "A", "x"), ("e", "A", "")], "meeting_id string, speaker string, text string")
    hyp = spark.createDataFrame([("m", "S1", "four five"), ("m", "S2", "one two"), ("n", "S1", "x"), ("n", "S2", "y z"), ("e", "S1", "b")], "meeting_id string, speaker string, text string")
    got = {r.meeting_id: r for r in metrics.cpwer(ref, hyp).collect()}
    assert got["m"].total_edits == 1 and abs(got["m"].cpwer - 0.2) < 1e-12
    assert [tuple(x) for x in got["m"].assignment] == [("A", "S2"), ("B", "S1")]
    assert got["n"].total_edits == 2 and [tuple(x) for x in got["n"].assignment] == [("A", "S1")]
    assert got["e"].cpwer is None and got["e"].total_ref_words == 0


def test_der(spark):
    schema = "meeting_id string, start_ms long, end_ms long, speaker string"
    ref = spark.createDataFrame([("m", 0, 2000, "A"), ("m", 3000, 5000, "B")], schema)
    same = metrics.der(ref, spark.createDataFrame([("m", 250, 1750, "x"), ("m", 3250, 4750, "y")], schema)).first()
    assert same.der == 0.0 and same.scored_ms == 3000
    r = metrics.der(ref, spark.createDataFrame([("m", 250, 1750, "x"), ("m", 3250, 4250, "x"), ("m", 6000, 6100, "z")], schema)).first()
    assert (r.miss_ms, r.confusion_ms, r.false_alarm_ms) == (500, 1000, 100) and abs(r.der - 1600 / 3000) < 1e-12


def test_greedy_mapping(spark):
    rows = [("m", k * 10, k * 10 + 10, [f"r{k}"], [f"h{k}"]) for k in range(9)]
    line = spark.createDataFrame(rows, "meeting_id string, start_ms long, end_ms long, ref array<string>, hyp array<string>")
    assert {(r.hyp_speaker, r.ref_speaker) for r in metrics.speaker_mapping(line).collect()} == {(f"h{k}", f"r{k}") for k in range(9)}


def test_audio(spark, tmp_path):
    import wave

    samples = np.concatenate([np.zeros(480, np.int16), np.full(480, 1000, np.int16)])
    with wave.open(str(tmp_path / "M1.Mix-Headset.wav"), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(16_000)
        w.writeframes(samples.tobytes())
    (tmp_path / "bad.wav").write_bytes(b"nothing")
    from convspark.sources import files

    q = audio.quality(audio.wav_frames(files.audio_files(spark, str(tmp_path / "*.wav")))).collect()
    assert [(r.meeting_id, r.rms, r.silence_ratio, r.samples) for r in q] == [("M1", 707.0, 0.5, 960)]
    s = spark.createDataFrame([([1, 2, 3, 4],)], "x array<int>").select(audio.sample_slice(F.col("x"), F.lit(1.0), F.lit(1.0), 2.0)).first()[0]
    assert s == [3]


def test_audio_by_ranges(spark, tmp_path):
    """Ranges of frames give what whole files give, for any form of samples and any cut."""
    import wave

    from convspark.sources import files, wav

    r = np.random.default_rng(5)
    for k, (rate, channels, width, n) in enumerate([(16_000, 1, 2, 48_123), (8000, 2, 2, 20_001), (11_025, 1, 3, 9999), (8000, 3, 1, 5000), (8000, 1, 4, 241), (8000, 1, 2, 0), (10, 1, 2, 7)]):
        with wave.open(str(tmp_path / f"M{k}.Mix-Headset.wav"), "wb") as w:
            w.setnchannels(channels)
            w.setsampwidth(width)
            w.setframerate(rate)
            w.writeframes(r.integers(0, 256, n * channels * width, dtype=np.uint8).tobytes())
    (tmp_path / "bad.wav").write_bytes(b"nothing")
    (tmp_path / "empty.wav").write_bytes(b"")
    cut = (tmp_path / "M0.Mix-Headset.wav").read_bytes()
    (tmp_path / "cut.wav").write_bytes(cut[:50_001])  # ends inside a sample, and long before its header says
    want = sorted(map(tuple, audio.wav_frames(files.audio_files(spark, str(tmp_path / "*.wav"))).collect()))
    assert len({x[0] for x in want}) == 7
    for part_bytes in (1 << 26, 50_000, 1000):
        got = wav.wav_frames(spark, str(tmp_path), part_bytes=part_bytes)
        assert sorted(map(tuple, got.collect())) == want, part_bytes
    one = wav.wav_frames(spark, f"file:{tmp_path}/M1.Mix-Headset.wav", frame_ms=7, part_bytes=4096)
    assert sorted((x.frame_no, x.n) for x in one.collect()) == [(k, min(112, 40_002 - k * 112)) for k in range(358)]
    (tmp_path / "none").mkdir()
    assert wav.wav_frames(spark, str(tmp_path / "none")).count() == 0
    parts = wav.ranges([("a", 10), ("b", 250 << 20), ("c", 20)], 64 << 20)
    assert [p.parts[0][1:] for p in parts[1:4]] == [(0, 4), (1, 4), (2, 4)] and sum(len(p.parts) for p in parts) == 6


def test_long_audio_in_bounded_memory(spark, tmp_path):
    """A file of 3 GB, most of which the file system doesn't store: more than a row can hold."""
    import struct

    from convspark.sources import wav

    size, path = 3_000_000_000, tmp_path / "long.wav"
    with open(path, "wb") as f:
        f.write(b"RIFF" + struct.pack("<I", size + 36) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 16_000, 32_000, 2, 16) + b"data" + struct.pack("<I", size))
        f.truncate(44 + size)
        f.seek(44 + size - 960)
        f.write(np.full(480, 100, np.int16).tobytes())
    x = wav.wav_frames(spark, str(path), part_bytes=256 << 20)
    assert x.rdd.getNumPartitions() == 12
    (row,) = x.selectExpr("count(*) AS n", "sum(n) AS samples", "max_by(frame_no, sum_sq) AS last", "max(sum_sq) AS most").collect()
    assert tuple(row) == (3_125_000, size // 2, 3_124_999, 480 * 100.0**2)


def test_fixed_decimals(spark):
    import random

    from convspark.functions.numbers import fixed

    r = random.Random(4)
    xs = [0.7265625, 0.0390625, 0.17968749999999997, 0.5, 1.5, 0.0, 1e-9, 5e-7, 4.9999999999999998e-7, 2.5e-6, 1e-300, 0.9999995, 0.9999994999999999, 123456.1234565, 0.125, 0.375, 2.675, 1e15 + 0.3, -1.0000005, -0.25]
    xs += [r.random() for _ in range(500)] + [r.randrange(10**6) / 1000 for _ in range(500)] + [k / 2**m for k in range(1, 200, 7) for m in range(1, 40)]
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x double").select("x", *[fixed(F.col("x"), d).alias(f"d{d}") for d in (0, 2, 3, 6, 9)])
    for row in df.collect():
        assert [row[f"d{d}"] for d in (0, 2, 3, 6, 9)] == [None if row.x is None else f"{row.x:.{d}f}" for d in (0, 2, 3, 6, 9)], row.x


def test_alignment_kernels(spark):
    import time

    from convspark.functions.alignment import common, edits

    def table(a, b):
        d, c = list(range(len(b) + 1)), [0] * (len(b) + 1)
        for i, x in enumerate(a, 1):
            e, g = [i], [0]
            for j, y in enumerate(b, 1):
                e.append(min(d[j] + 1, e[-1] + 1, d[j - 1] + (x != y)))
                g.append(c[j - 1] + 1 if x == y else max(c[j], g[-1]))
            d, c = e, g
        return d[-1], c[-1]

    r = random.Random(2)
    for _ in range(3000):
        a, b = ([r.choice("abcd"[: r.randint(1, 4)]) for _ in range(r.randint(0, 12))] for _ in range(2))
        assert (edits(a, b), common(a, b)) == table(a, b)
    a, b = ([r.choice("abcdefgh") for _ in range(n)] for n in (300, 260))
    assert (edits(a, b), common(a, b)) == table(a, b)
    a, b = ([f"w{r.randrange(20_000)}" for _ in range(100_000)] for _ in range(2))
    began = time.process_time()
    assert 80_000 < edits(a, b) <= 100_000
    assert time.process_time() - began < 60
    began = time.process_time()
    common(a[:30_000], b[:30_000])
    assert time.process_time() - began < 4
    df = spark.createDataFrame([(["a", "b"], ["a", "c", "b"]), ([], ["x"]), (None, ["x"]), ([], [])], "a array<string>, b array<string>")
    assert [x[0] for x in df.select(metrics.word_edit_distance(F.col("a"), F.col("b"))).collect()] == [1, 1, None, 0]


def test_char_errors_of_long_texts(spark):
    """Texts of 300,000 letters, one letter in ten lost: a table of 8e10 cells, which takes the JVM minutes."""
    import time

    r = random.Random(9)
    ref = "".join(r.choice("abcde") for _ in range(300_000))
    hyp = "".join(c for k, c in enumerate(ref) if k % 10)
    rows = [(1, ref, hyp), (2, ref, None), (3, "ab", "b"), (4, "", hyp), (5, ref, "")]
    began = time.time()
    got = {x.id: x.cer for x in metrics.with_char_errors(spark.createDataFrame(rows, "id int, ref string, hyp string")).collect()}
    assert got == {1: 0.1, 2: None, 3: 0.5, 4: 1.0, 5: 1.0} and time.time() - began < 90


def test_rouge_n_counts_within_pairs(spark):
    from collections import Counter

    r = random.Random(4)
    text = lambda: r.choice([None, "", " ".join(r.choice("abc") for _ in range(r.randint(1, 12)))])
    rows = [(k // 2 if k < 20 else k, text(), text()) for k in range(120)]  # the first ids are those of two pairs
    df = spark.createDataFrame(rows, "id int, ref string, hyp string")
    for n in (1, 2, 3):
        out, want = metrics.rouge_n(df, ["id"], n), []
        assert "gram" not in out._jdf.queryExecution().analyzed().toString()  # n-grams are no rows
        for k, _, _ in rows:
            a, b = (Counter(g for x in rows if x[0] == k for w in [(x[c] or "").split()] for g in zip(*(w[j:] for j in range(n)))) for c in (1, 2))
            p, q = ((a & b).total() / max(1, x.total()) for x in (b, a))
            want.append((k, round(2 * p * q / (p + q), 9) if p else 0.0))
        assert sorted((x.id, round(x.f1, 9)) for x in out.collect()) == sorted(want)


def test_long_texts_take_a_band(monkeypatch):
    """Edits in blocks are those on numbers, whatever the guess; texts of many characters never take the whole table."""
    from convspark.functions import alignment

    r, whole = random.Random(11), alignment._edits_on_numbers
    for _ in range(150):
        n, kinds, changed = r.choice([1, 64, 65, 128, 300, 700]), r.choice([1, 2, 5, 20]), r.choice([0.03, 0.2, 1.0])
        a = [r.randint(0, kinds) for _ in range(n)]
        b = [r.randint(0, kinds) if r.random() < changed else x for x in a if r.random() > changed / 2] or a[:1]
        x, y, k = alignment._coded(a, b)
        want = whole(a, b)
        assert alignment._edits_of_long(x, y, k) == want
        assert {alignment._edits_in_band(x, y, k, most) for most in (want, want + 7, n) if n - len(b) <= most <= n} == {want}
        if want > n - len(b):
            assert alignment._edits_in_band(x, y, k, want - 1) >= want
    words = [r.choice(["click", "view", "purchase", "signup", "error"]) for _ in range(7000)]
    a, b = "".join(words), "".join("error" if k % 13 == 0 else w for k, w in enumerate(words) if k % 9)
    assert len(b) >= alignment.LONG
    want, sizes = whole(a, b), []
    monkeypatch.setattr(alignment, "_edits_on_numbers", lambda x, y: sizes.append(len(x)) or whole(x, y))
    assert alignment.edits(a, b) == want == alignment.edits(list(b), list(a))
    assert max(sizes) < len(a) / 16


def test_long_pairs_share_no_task(spark):
    rows = [(f"2024-01-{k:02}", "a", "b") for k in range(1, 31)]
    pairs = spark.createDataFrame(rows, "meeting_id string, ref string, hyp string").repartition(4, "meeting_id")
    tasks = metrics.dealt(pairs).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert [x["count"] for x in tasks] == [1] * 30
