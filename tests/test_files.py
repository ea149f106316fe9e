"""Readers, writers and the progress stream on small files."""

import json

import pytest
from pyspark.sql import functions as F

from convspark.operators import ops
from convspark.sources import files, keyed_tables, sinks
from convspark.streaming import progress


def test_xml(spark, tmp_path):
    words = tmp_path / "words"
    words.mkdir()
    (words / "T1.A.words.xml").write_text("<nite:root xmlns:nite='n'><w starttime='0.00' endtime='1.00'>hello</w><w starttime='1.0' endtime='1.0' punc='true'>,</w><w starttime='2'>x</w><w starttime='1.00' endtime='2.00'>R&amp;amp;D</w></nite:root>")
    got = [(r.meeting_id, r.speaker_letter, r.start, r.text, r.is_punc) for r in files.word_tokens(spark, str(words)).orderBy("start", "seq").collect()]
    assert got == [("T1", "A", 0.0, "hello", False), ("T1", "A", 1.0, ",", True), ("T1", "A", 1.0, "R&D", False)]
    (tmp_path / "T1.abssumm.xml").write_text("<nite:root xmlns:nite='n'><abstract><sentence>One  two.</sentence><sentence>Three.</sentence></abstract><actions><sentence>Do it.</sentence></actions></nite:root>")
    got = [(r.section, r.pos, r.sentence) for r in files.summary_sections(spark, str(tmp_path / "*.abssumm.xml")).orderBy("section", "pos").collect()]
    assert got == [("abstract", 0, "One two."), ("abstract", 1, "Three."), ("actions", 0, "Do it.")]
    (tmp_path / "meetings.xml").write_text("<root><meeting observation='T1'><speaker nxt_agent='A' role='PM'/><speaker nxt_agent='B' role='PM'/><speaker/></meeting></root>")
    r = files.meeting_reference(spark, str(tmp_path / "meetings.xml")).first()
    assert (r.meeting_id, r.participant_count, r.agents, r.roles) == ("T1", 3, ["A", "B"], ["PM"])


def test_segments_and_rttm(spark, tmp_path):
    d = tmp_path / "seg" / "T1"
    d.mkdir(parents=True)
    (d / "diarization_segments.json").write_text(json.dumps([{"start": 0.5, "end": 2.0, "speaker": "S1"}, {"start": "x", "end": 2}, {"start": 3, "end": 3}, {"start": 1, "end": 2}]))
    got = sorted((r.meeting_id, r.start, r.end, r.speaker) for r in files.segments(spark, str(tmp_path / "seg" / "*" / "*.json")).collect())
    assert got == [("T1", 0.5, 2.0, "S1"), ("T1", 1.0, 2.0, "UNKNOWN")]
    segs = spark.createDataFrame([("T1", 500, 2000, "S1"), ("T1", 0, 250, "S2")], "meeting_id string, start_ms long, end_ms long, speaker string")
    sinks.write_rttm(segs, str(tmp_path / "rttm"))
    (tmp_path / "rttm" / "more.txt").write_text("# c\n\nSPEAKER T2 1 1.0 2.0 <NA>\n")
    back = sorted((r.meeting_id, r.start_ms, r.end_ms, r.speaker) for r in files.rttm(spark, str(tmp_path / "rttm")).select("meeting_id", "start_ms", "end_ms", "speaker").collect())
    assert [x[1:] for x in back] == [(0, 250, "S2"), (500, 2000, "S1")]
    lines = sinks.transcript_lines(segs.selectExpr("*", "'hi' AS text")).first().text
    assert lines == "[0.00-0.25] S2: hi\n[0.50-2.00] S1: hi"


def test_traces_reports_and_upserts(spark, tmp_path):
    d = tmp_path / "T1"
    d.mkdir()
    ev = [{"event": "stage_start", "stage": "asr", "ts_unix": 1.0}, {"event": "stage_end", "stage": "asr", "status": "error", "elapsed_sec": 1.0}, {"event": "stage_end", "stage": "asr", "status": "ok", "elapsed_sec": 2.0}]
    (d / "stage_trace.jsonl").write_text("\n".join(map(json.dumps, ev)) + "\n{bad\n")
    got = [tuple(r) for r in files.stage_trace(spark, str(tmp_path / "*" / "stage_trace.jsonl")).collect()]
    assert got == [("T1", "asr", "ok", 2.0)]
    (tmp_path / "b.summary.json").write_text(json.dumps({"config_path": "c", "validate_only": True, "records": [{"meeting_ids": ["a", "b"], "status": "ok"}, {"status": "x"}]}))
    got = [(r.meeting_id, r.meeting_ids, r.mode) for r in files.batch_records(spark, str(tmp_path / "*.summary.json")).collect()]
    assert got == [("a", ["a", "b"], "validate-only"), ("Unknown", [], "validate-only")]
    table = str(tmp_path / "table")
    rows = lambda *x: spark.createDataFrame(list(x), "k string, v long")
    for part in (rows(("a", 1), ("b", 2)), rows(("b", 3), ("c", 4))):
        keyed_tables.upsert_rows(part, table, ["k"], "k string, v long")
    assert sorted(tuple(r) for r in keyed_tables.read_rows(spark, table, "k string, v long").collect()) == [("a", 1), ("b", 3), ("c", 4)]
    sinks.write_report(rows(("a", None)), str(tmp_path / "report"), ["k", "gone", "v"])
    r = files.csv_rows(spark, str(tmp_path / "report"))
    assert r.columns == ["k", "gone", "v"] and tuple(r.first()) == ("a", None, None)


def test_inventory(spark, tmp_path):
    for name in ("T1/minutes.json", "T1/full_transcript.txt", "T2/a.bin"):
        p = tmp_path / "art" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text("x" * 5)
    inv = files.inventory(spark, str(tmp_path / "art"))
    assert sorted((r.meeting_id, r.name, r.kind, r.length) for r in inv.collect()) == [("T1", "full_transcript.txt", "text", 5), ("T1", "minutes.json", "json", 5), ("T2", "a.bin", "text", 5)]
    audio = tmp_path / "raw"
    audio.mkdir()
    (audio / "T3.Mix-Headset.wav").write_bytes(b"x")
    assert sorted(r[0] for r in files.discover_meetings(spark, str(audio), str(tmp_path / "art")).collect()) == ["T1", "T2", "T3"]
    required = spark.createDataFrame([("minutes.json",)], "name string")
    gone = ops.missing_artifacts(inv.select("meeting_id"), required, inv)
    assert [tuple(r) for r in gone.collect()] == [("T2", "minutes.json")]
    assert files.text_preview(spark, str(tmp_path / "art" / "T1" / "*.txt"), 3).first().text == "xxx"


def test_progress_stream(spark, tmp_path):
    src = tmp_path / "events"
    src.mkdir()
    seen = []

    def sink(batch, _):
        seen.append(sorted((r.stage, r.state) for r in batch.collect()))

    def step(n, *rows):
        (src / f"{n}.json").write_text("\n".join(map(json.dumps, rows)))
        progress.watch(progress.trace_stream(spark, str(src)), sink, str(tmp_path / "cp"), once=True).awaitTermination(60)

    step(1, {"meeting_id": "m", "event": "stage_start", "stage": "asr", "ts_unix": 5.0}, {"meeting_id": "m", "event": "stage_end", "stage": "vad", "status": "ok"})
    step(2, {"meeting_id": "m", "event": "stage_end", "stage": "asr", "status": "error", "elapsed_sec": 2.0})
    assert seen == [[("asr", "running"), ("vad", "completed")], [("asr", "failed")]]
    states = spark.createDataFrame([("m", "asr", "failed"), ("m", "vad", "completed")], "meeting_id string, stage string, state string")
    assert tuple(progress.meeting_progress(states, 5).first()) == ("m", 1, 1, 0, 3)


def test_failed_upsert_leaves_the_table(spark, tmp_path, monkeypatch):
    """A write that fails, in a task or before the manifest's swap, leaves the old rows; only touched buckets are written."""
    table, schema = str(tmp_path / "t"), "k string, v long"
    now = lambda: sorted((tuple(r) for r in keyed_tables.read_rows(spark, table, schema).collect()), key=str)
    rows = lambda *x: spark.createDataFrame(list(x), schema)
    assert now() == []
    keyed_tables.upsert_rows(rows(*[(f"k{i}", i) for i in range(50)], (None, 7)), table, ["k"], schema, buckets=8)
    old, folders = now(), keyed_tables.manifest(spark, table)["folders"]
    assert len(old) == 51
    with pytest.raises(Exception, match="lost"):
        keyed_tables.upsert_rows(rows(("k1", -1)).withColumn("v", F.raise_error(F.lit("lost")).cast("long")), table, ["k"], schema)
    assert now() == old
    with monkeypatch.context() as m:
        m.setattr(keyed_tables, "_swap", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            keyed_tables.upsert_rows(rows(("k1", -1), ("new", 1)), table, ["k"], schema)
    assert now() == old
    keyed_tables.upsert_rows(rows(("k1", -1)), table, ["k"], schema)
    assert len(now()) == 51 and dict(now()) == {**dict(old), "k1": -1}
    changed = keyed_tables.manifest(spark, table)["folders"]
    assert sum(changed[b] != folders[b] for b in folders) == 1
    with pytest.raises(ValueError):
        keyed_tables.upsert_rows(rows(("a", 1)), table, ["v"], schema)


def test_folder_digest(spark):
    """The digest over sorted paths and bytes, computed by hand."""
    import hashlib

    rows = [("m", "b.txt", b"two"), ("m", "a/z.bin", bytes(range(256))), ("m", "a.txt", b""), ("m", "stage_trace.jsonl", b"x"), ("m", "a/run_manifest.json", b"x"), ("n", "\u00e9", None)]
    got = {r.meeting_id: (r.files, r.digest) for r in ops.content_digests(spark.createDataFrame(rows, "meeting_id string, path string, content binary").repartition(3)).collect()}
    m = b"a/z.bin\0" + bytes(range(256)) + b"\0" + b"a.txt\0\0" + b"b.txt\0two\0"
    assert got == {"m": (3, hashlib.sha256(m).hexdigest()), "n": (1, hashlib.sha256("\u00e9".encode() + b"\0\0").hexdigest())}


def test_short_parts_of_sound_share_tasks():
    """Parts of a KB are dealt over the tasks asked for, not a task each, and none is lost."""
    from convspark.sources import wav

    sizes = [(f"f{i}", 4140) for i in range(500)]
    packed = wav.ranges(sizes, 1024, 8)
    assert len(packed) <= 10
    assert [p for r in packed for p in r.parts] == [(f"f{i}", k, 5) for i in range(500) for k in range(5)]
    assert len(wav.ranges(sizes * 100, 1024, 8)) <= -(-250_000 // 255)  # a task holds TASK bytes at most
    assert len(wav.ranges(sizes, 1024)) == 2500


def test_json_arrays_in_parts(spark, tmp_path):
    """A long meeting becomes many files, each a JSON array, and their names have the order of the rows."""
    path = tmp_path / "arrays"
    rows = [("long", float(k * 7919 % 1000), float(k * 7919 % 1000 + 1), f"S{k % 3}") for k in range(1000)] + [("short", 1.0, 2.0, "S")]
    df = spark.createDataFrame(rows, "meeting_id string, start double, end double, speaker string")
    sinks.write_json_arrays(df, str(path), ["start", "end"], most=60)
    parts = [json.loads(p.read_text()) for p in sorted((path / "meeting_id=long").glob("*.txt"))]
    assert len(parts) >= 1000 // 60 and max(map(len, parts)) <= 60
    assert [x["start"] for p in parts for x in p] == [float(k) for k in range(1000)]
    got = sorted((r.meeting_id, r.start, r.end, r.speaker) for r in files.segments(spark, str(path)).collect())
    assert got == sorted(rows)
