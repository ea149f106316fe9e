"""Queries that write the driver's rows in a file format, read them back and return them, beside their DuckDB counterpart."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audio
from ..sources import adapters as A
from ..sources import files, sinks, wav
from ..sources.shared import new_folder, saved
from ..streaming import progress, runs
from . import duck as D
from .registry import _RAW_SEGMENTS, query, raw_segments

_ENTITIES = " R&amp;D &eacute; &#233;"


@query("a1_word_tokens", f"""SELECT meeting_id, speaker_letter, count(*) AS n, count_if(is_punc)::BIGINT AS punc, sum(start_ms)::BIGINT AS starts, sha256(string_agg(text || CASE WHEN seq % 10 = 0 THEN ' R&D é é' ELSE '' END, ' ' ORDER BY start_ms, end_ms, text || CASE WHEN seq % 10 = 0 THEN ' R&D é é' ELSE '' END)) AS text_sha256
  FROM {D.TOKENS} z GROUP BY ALL""")
def _(spark, d):
    t = A.tokens(spark, d).withColumn("text", F.concat("text", F.when(F.col("seq") % 10 == 0, F.lit(_ENTITIES)).otherwise("")))
    path = new_folder(spark)
    sinks.write_word_tokens(t.withColumn("start", F.col("start_ms") / 1000.0).withColumn("end", F.col("end_ms") / 1000.0), path)
    w = files.word_tokens(spark, path)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "end", "text"))), lambda x: x["text"]), " ")
    return w.groupBy("meeting_id", "speaker_letter").agg(F.count("*").alias("n"), F.count_if("is_punc").alias("punc"), F.sum(F.round(F.col("start") * 1000).cast("long")).alias("starts"), F.sha2(text, 256).alias("text_sha256"))


_SECTIONS = ("abstract", "actions", "decisions", "problems")


@query("a2_summary_sections", f"SELECT meeting_id, ['abstract', 'actions', 'decisions', 'problems'][turn_idx % 4 + 1] AS section, CAST(turn_idx // 4 AS INT) AS pos, text_raw AS sentence FROM {D.TRANSCRIPT} z")
def _(spark, d):
    t = A.transcript(spark, d)
    s = t.select("meeting_id", F.get(F.array(*map(F.lit, _SECTIONS)), F.col("turn_idx") % 4).alias("section"), F.floor(F.col("turn_idx") / 4).alias("pos"), F.concat(F.lit("  "), F.replace("text_raw", F.lit(" "), F.lit(" \n "))).alias("sentence"))
    path = new_folder(spark)
    sinks.write_summary_sections(s, path)
    return files.summary_sections(spark, path)


@query("a3_meeting_reference", """WITH s AS (SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS meeting_id, user_id, 'U' || user_id % 50 AS agent, 'R' || user_id % 7 AS role FROM events)
SELECT meeting_id, count(*) AS participant_count, (SELECT string_agg(agent, ',' ORDER BY p) FROM (SELECT agent, min(user_id) AS p FROM s a WHERE a.meeting_id = s.meeting_id GROUP BY agent)) AS agents, (SELECT string_agg(role, ',' ORDER BY p) FROM (SELECT role, min(user_id) AS p FROM s a WHERE a.meeting_id = s.meeting_id GROUP BY role)) AS roles FROM s GROUP BY meeting_id""")
def _(spark, d):
    u = A.read(spark, d, "events").select(F.to_date("ts").cast("string").alias("meeting_id"), F.col("user_id").alias("pos")).distinct()
    u = u.withColumn("agent", F.concat(F.lit("U"), (F.col("pos") % 50).cast("string"))).withColumn("role", F.concat(F.lit("R"), (F.col("pos") % 7).cast("string")))
    path = new_folder(spark)
    sinks.write_meeting_reference(u, path)
    return files.meeting_reference(spark, path).select("meeting_id", F.col("participant_count").cast("long").alias("participant_count"), F.array_join("agents", ",").alias("agents"), F.array_join("roles", ",").alias("roles"))


@query("a4_a5_b4_rttm", f"SELECT meeting_id, start_ms, end_ms, speaker FROM {D.HYP} z")
def _(spark, d):
    path = new_folder(spark)
    sinks.write_rttm(A.hypothesis(spark, d), path)
    return files.rttm(spark, path).select("meeting_id", "start_ms", "end_ms", "speaker")


@query("a6_json_segments", f"""SELECT meeting_id, coalesce(start, 0.0) AS start, "end", coalesce(speaker, 'UNKNOWN') AS speaker, source FROM {_RAW_SEGMENTS} z WHERE "end" > coalesce(start, 0.0)""")
def _(spark, d):
    path = new_folder(spark)
    sinks.write_json_arrays(raw_segments(spark, d), path, ["end", "start"])
    return files.segments(spark, path).select("meeting_id", "start", "end", "speaker", "source")


def _transcript_files(spark, d) -> str:
    """A text file a meeting with a line a turn."""
    path = new_folder(spark)
    t = A.transcript(spark, d).repartition("meeting_id").sortWithinPartitions("meeting_id", "turn_idx")
    t.select("meeting_id", F.col("text_raw").alias("value")).write.partitionBy("meeting_id").text(path)
    return path


@query("a9_discover_meetings", f"SELECT DISTINCT meeting_id FROM {D.TOKENS} z")
def _(spark, d):
    return files.discover_meetings(spark, artifacts=_transcript_files(spark, d))


@query("a10_f9_audio", """WITH w AS (SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1000)) AS s FROM embeddings),
f AS (SELECT vec_id, k, list_sum(list_transform(s[k * 8 + 1:k * 8 + 8], lambda x: x * x)) AS sq, len(s[k * 8 + 1:k * 8 + 8]) AS n FROM (SELECT vec_id, s, unnest(range(0, (len(s) - 1) // 8 + 1)) AS k FROM w)),
t AS (SELECT vec_id, floor(sqrt(sum(sq) / sum(n))) AS rms, CAST(sum(n) AS BIGINT) AS samples FROM f GROUP BY vec_id)
SELECT vec_id AS meeting_id, rms, samples, round_even(avg(CASE WHEN floor(sqrt(sq / n)) <= greatest(5, floor(0.8 * rms)) THEN 1.0 ELSE 0.0 END), 4) AS silence_ratio, round_even(samples / 8000, 3) AS duration_sec, 1 AS channels, 8000 AS sample_rate, 2 AS sample_width_bytes FROM f JOIN t USING (vec_id) GROUP BY vec_id, rms, samples""")
def _(spark, d):
    files_ = audio.wav_files(A.read(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("meeting_id"), F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000).cast("int")).alias("samples")), 8000)
    return audio.quality(audio.wav_frames(files_, 1), 0.8).withColumn("meeting_id", F.col("meeting_id").cast("long"))


def _sound_files(spark, d) -> str:
    """A WAV file for 16 vectors in order, 8,000 values a second."""
    e = A.read(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000).cast("int")).alias("s"))
    parts = F.array_sort(F.collect_list(F.struct("vec_id", "s")))
    path = new_folder(spark)
    wav.write_wav(e.groupBy(F.floor(F.col("vec_id") / 16).cast("string").alias("meeting_id")).agg(F.flatten(F.transform(parts, lambda x: x["s"])).alias("samples")), path, 8000)
    return path


@query("a10_f9_audio_ranges", """WITH w AS (SELECT vec_id // 16 AS id, flatten(list(list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1000)) ORDER BY vec_id)) AS s FROM embeddings GROUP BY vec_id // 16),
f AS (SELECT id, k, list_sum(list_transform(s[k * 40 + 1:k * 40 + 40], lambda x: x * x)) AS sq, len(s[k * 40 + 1:k * 40 + 40]) AS n FROM (SELECT id, s, unnest(range(0, (len(s) - 1) // 40 + 1)) AS k FROM w)),
t AS (SELECT id, floor(sqrt(sum(sq) / sum(n))) AS rms, CAST(sum(n) AS BIGINT) AS samples FROM f GROUP BY id)
SELECT id AS meeting_id, rms, samples, round_even(avg(CASE WHEN floor(sqrt(sq / n)) <= greatest(5, floor(0.9 * rms)) THEN 1.0 ELSE 0.0 END), 4) AS silence_ratio, round_even(samples / 8000, 3) AS duration_sec, 1 AS channels, 8000 AS sample_rate, 2 AS sample_width_bytes FROM f JOIN t USING (id) GROUP BY id, rms, samples""")
def _(spark, d):
    frames = saved(wav.wav_frames(spark, _sound_files(spark, d), frame_ms=5, part_bytes=1024))
    return audio.quality(frames, 0.9).withColumn("meeting_id", F.col("meeting_id").cast("long"))


@query("a9_discover_recorded_meetings", f"SELECT DISTINCT CAST(vec_id // 16 AS VARCHAR) AS meeting_id FROM embeddings UNION SELECT CAST(meeting_id AS VARCHAR) FROM {D.TRANSCRIPT} z")
def _(spark, d):
    return files.discover_meetings(spark, audio=_sound_files(spark, d), artifacts=_transcript_files(spark, d))


@query("a11_sound_inventory", "SELECT 'audio' AS kind, CAST(vec_id // 16 AS VARCHAR) || '.Mix-Headset.wav' AS name, 44 + 2 * sum(len(embedding))::BIGINT AS bytes FROM embeddings GROUP BY vec_id // 16")
def _(spark, d):
    return files.inventory(spark, _sound_files(spark, d)).select("kind", "name", F.col("length").alias("bytes"))


@query("a11_inventory", f"SELECT meeting_id, 'text' AS kind, 1 AS files, sum(strlen(text_raw) + 1)::BIGINT AS bytes FROM {D.TRANSCRIPT} z GROUP BY meeting_id")
def _(spark, d):
    return files.inventory(spark, _transcript_files(spark, d)).groupBy("meeting_id", "kind").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


@query("a13_batch_records", """SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'Unknown' ELSE CAST(o_orderkey AS VARCHAR) END AS meeting_id, CASE WHEN o_orderpriority < '3' THEN 'validate-only' ELSE 'run' END AS mode, CASE WHEN o_orderkey % 3 = 2 THEN o_orderkey || ',x' WHEN o_orderkey % 3 = 1 THEN CAST(o_orderkey AS VARCHAR) ELSE '' END AS meeting_ids, o_orderpriority AS config, o_orderstatus AS status FROM orders""")
def _(spark, d):
    o, k = A.read(spark, d, "orders"), F.col("o_orderkey").cast("string")
    r = F.col("o_orderkey") % 3
    record = F.struct(F.when(r == 1, k).alias("meeting_id"), F.when(r == 2, F.array(k, F.lit("x"))).alias("meeting_ids"), F.col("o_orderstatus").alias("status"))
    # A summary has the runs of a customer's orders of one priority, as a batch has some runs.
    g = o.groupBy("o_orderpriority", (F.col("o_custkey") % 8).alias("part")).agg(F.collect_list(record).alias("records"))
    one = F.to_json(F.struct(F.col("o_orderpriority").alias("config_path"), (F.col("o_orderpriority") < "3").alias("validate_only"), "records"))
    path = new_folder(spark)
    g.select(F.xxhash64("o_orderpriority", "part").alias("batch"), one.alias("value")).write.partitionBy("batch").text(path)
    return files.batch_records(spark, path).select("meeting_id", "mode", F.array_join("meeting_ids", ",").alias("meeting_ids"), "config", "status")


@query("a14_text_preview", f"SELECT meeting_id, length(t) AS chars, sha256(t) AS text_sha256 FROM (SELECT meeting_id, substring(string_agg(text_raw || chr(10), '' ORDER BY turn_idx), 1, 20000) AS t FROM {D.TRANSCRIPT} z GROUP BY meeting_id)")
def _(spark, d):
    p = files.text_preview(spark, _transcript_files(spark, d))
    return p.select(F.col("folder").alias("meeting_id"), F.length("text").cast("long").alias("chars"), F.sha2("text", 256).alias("text_sha256"))


@query("b1_json_lines", r"""SELECT '{"key":' || o_orderkey || ',"nested":{"a":["' || o_orderstatus || '",null],"b":' || o_custkey || '},"note":"caf\u00e9 \ud83d\ude00 \"' || o_orderpriority || '\"","status":null}' AS value FROM orders""")
def _(spark, d):
    note = F.concat(F.lit('café 😀 "'), "o_orderpriority", F.lit('"'))
    rows = A.read(spark, d, "orders").select(F.lit(None).cast("string").alias("status"), note.alias("note"), F.struct(F.col("o_custkey").alias("b"), F.array("o_orderstatus", F.lit(None).cast("string")).alias("a")).alias("nested"), F.col("o_orderkey").alias("key"))
    path = new_folder(spark)
    sinks.write_json_rows(rows, path, ["key"])
    return spark.read.text(path)


@query("b5_transcript_lines", f"SELECT meeting_id, sha256(string_agg(printf('[%.2f-%.2f] ', start_ms / 1000, end_ms / 1000) || speaker || ': ' || text_raw, chr(10) ORDER BY start_ms, end_ms, printf('[%.2f-%.2f] ', start_ms / 1000, end_ms / 1000) || speaker || ': ' || text_raw)) AS text_sha256 FROM (SELECT * REPLACE (start_ms // 1000 * 1000 AS start_ms, end_ms // 1000 * 1000 AS end_ms) FROM {D.TRANSCRIPT} z) GROUP BY meeting_id")
def _(spark, d):
    whole = lambda c: (F.floor(F.col(c) / 1000) * 1000).alias(c)
    t = A.transcript(spark, d).select("meeting_id", whole("start_ms"), whole("end_ms"), "speaker", F.col("text_raw").alias("text"))
    return sinks.transcript_lines(t).select("meeting_id", F.sha2("text", 256).alias("text_sha256"))


@query("b7_report", "SELECT CAST(o_orderkey AS VARCHAR) AS run, NULL::VARCHAR AS gone, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS note FROM orders")
def _(spark, d):
    rows = A.read(spark, d, "orders").select(F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("note"), F.col("o_orderkey").alias("run"), "o_custkey")
    path = new_folder(spark)
    sinks.write_report(rows, path, ["run", "gone", "note"])
    return files.csv_rows(spark, path)


@query("b8_append_events", f"SELECT run_id, count(*) AS events, sum(elapsed_sec) AS elapsed_sec FROM {D.EVENTS} z GROUP BY run_id")
def _(spark, d):
    e, path = A.stage_events(spark, d).select("run_id", "stage_no", "status", "elapsed_sec"), new_folder(spark)
    for part in (F.col("stage_no") <= 3, F.col("stage_no") > 3):
        sinks.append_events(e.where(part), path)
    return spark.read.schema("run_id long, stage_no long, status string, elapsed_sec double").json(path).groupBy("run_id").agg(F.count("*").alias("events"), F.sum("elapsed_sec").alias("elapsed_sec"))


_STATES = """(SELECT CAST(l_orderkey AS VARCHAR) AS meeting_id, 's' || l_linenumber AS stage, CASE WHEN count(*) FILTER (WHERE l_orderkey % 3 <> 0) = 0 THEN 'running' WHEN bool_or(l_returnflag = 'R') THEN 'failed' ELSE 'completed' END AS state FROM (SELECT l_orderkey, l_linenumber, max(l_returnflag) AS l_returnflag FROM lineitem GROUP BY ALL) GROUP BY ALL)"""


@query("j1_progress_stream", f"SELECT meeting_id, count_if(state = 'completed')::BIGINT AS completed, count_if(state = 'failed')::BIGINT AS failed, count_if(state = 'running')::BIGINT AS running, 7 - count(*) AS pending FROM {_STATES} z GROUP BY meeting_id")
def _(spark, d):
    """Order lines as stages: each starts, and ends but for every third run; runs that end are over. Events arrive in three
    parts, the last of which says the first one's again, and are watched as a stream."""
    stage = A.read(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_returnflag").alias("flag"))
    own = [F.col("l_orderkey").cast("string").alias("meeting_id"), F.concat(F.lit("s"), F.col("l_linenumber").cast("string")).alias("stage")]
    start = stage.select(*own, F.lit("stage_start").alias("event"), F.col("l_linenumber").cast("double").alias("ts_unix"))
    ended = stage.where("l_orderkey % 3 <> 0")
    end = ended.select(*own, F.lit("stage_end").alias("event"), F.when(F.col("flag") == "R", "error").otherwise("ok").alias("status"))
    over = ended.groupBy("l_orderkey").agg(F.max("flag").alias("flag")).select(own[0], F.lit("run_end").alias("event"), F.when(F.col("flag") == "R", "failed").otherwise("completed").alias("status"))
    events, updates, checkpoint = (new_folder(spark) for _ in range(3))

    def keep(batch, batch_id):
        batch.withColumn("batch", F.lit(batch_id)).write.mode("append").parquet(updates)

    for part in (start, end.unionByName(over, allowMissingColumns=True), start):
        sinks.append_events(part, events)
        runs.watch_runs(runs.run_updates(progress.trace_stream(spark, events), 7), keep, checkpoint, once=True).awaitTermination()
    last = spark.read.schema(f"{runs.UPDATE}, batch long").parquet(updates).groupBy("meeting_id").agg(F.max_by(F.struct("completed", "failed", "running", "pending"), "batch").alias("x"))
    return last.select("meeting_id", "x.*")
