"""The driver's tables as canonical tables: turns, tokens, segments, text pairs, run logs, contents and signals.

Time is in whole milliseconds from the start of a meeting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as turns: meeting_id, turn_idx, speaker, text_raw, norm."""
    norm = F.lower(F.regexp_replace(F.regexp_replace("text", "[^A-Za-z0-9]+", " "), "^ | $", ""))
    idx = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1
    return read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("meeting_id"), idx.cast("int").alias("turn_idx"), F.col("role").alias("speaker"), F.col("text").alias("text_raw"), norm.alias("norm"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as word tokens: a meeting a day, four speakers, minutes apart."""
    day = F.to_date("ts")
    start = F.expr("(unix_micros(CAST(ts AS TIMESTAMP)) - unix_micros(CAST(CAST(ts AS DATE) AS TIMESTAMP))) DIV 1000")
    letter = F.element_at(F.array(*map(F.lit, "ABCD")), (F.col("user_id") % 4 + 1).cast("int"))
    return read(spark, sf_dir, "events").select(
        day.cast("string").alias("meeting_id"), start.alias("start_ms"), (start + 1000 * (F.col("event_id") % 600)).alias("end_ms"), letter.alias("speaker_letter"), F.col("event_type").alias("text"), (F.col("event_type") == "error").alias("is_punc"), F.col("event_id").alias("seq")
    )


def hypothesis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens as recognised segments: shifted edges, one in eleven mislabelled, a confidence."""
    own = F.when(F.col("seq") % 11 == 0, "1").when(F.col("speaker_letter") == "A", "2").when(F.col("speaker_letter") == "B", "3").when(F.col("speaker_letter") == "C", "4").otherwise("1")
    moved = tokens(spark, sf_dir).select(
        "meeting_id", (F.col("start_ms") + 1000 * (F.col("seq") % 7)).alias("start_ms"), (F.col("end_ms") - 1000 * (F.col("seq") % 5)).alias("end_ms"), F.concat(F.lit("SPEAKER_"), own).alias("speaker"), ((F.col("seq") % 100).cast("double") / 100).alias("confidence"), "seq"
    )
    return moved.where("end_ms > start_ms")


def text_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive turns as reference and hypothesis."""
    t = read(spark, sf_dir, "conversations")
    a, b = t.select("conv_id", "turn", F.col("text").alias("ref")), t.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("hyp"))
    return a.join(b, ["conv_id", "turn"]).select(F.col("conv_id").alias("pair_meeting"), F.col("turn").alias("pair_id"), "ref", "hyp")


# What an event of each type says.
SAYINGS = (("click", "we should review item "), ("view", "general notes about part "), ("purchase", "i will prepare the cost estimate for item "), ("signup", "uh let's decide on concept "))
OTHER_SAYING = "can you compare costs by tomorrow for part "


def transcript(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens as turns of a transcript with decisions and actions."""
    said = F.lit(OTHER_SAYING)
    for kind, words in SAYINGS:
        said = F.when(F.col("text") == kind, words).otherwise(said)
    idx = F.row_number().over(Window.partitionBy("meeting_id").orderBy("start_ms", "seq")) - 1
    return tokens(spark, sf_dir).select(
        "meeting_id", idx.cast("int").alias("turn_idx"), F.concat(F.lit("SPEAKER_"), (F.col("seq") % 4 + 1).cast("string")).alias("speaker"), "start_ms", "end_ms", F.concat(said, (F.col("seq") % 50).cast("string")).alias("text_raw"), "seq"
    )


def stage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as stage events of runs; place is a row's place in the table: its file, and its row there."""
    return read(spark, sf_dir, "lineitem").select(
        F.struct("_metadata.file_path", "_metadata.row_index").alias("place"), F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("stage_no"), F.when(F.col("l_returnflag") == "R", "error").otherwise("ok").alias("status"), F.col("l_quantity").cast("double").alias("elapsed_sec"), F.col("l_shipdate").alias("ts")
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as runs."""
    status = F.when(F.col("o_orderstatus") == "F", "failed").when(F.col("o_orderstatus") == "O", "ok").otherwise("skipped")
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("meeting_id"), status.alias("status"), F.col("o_orderdate").alias("started_at"), F.col("o_totalprice").cast("double").alias("metric"))


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of meetings."""
    return read(spark, sf_dir, "documents").select(F.col("source").alias("meeting_id"), F.col("doc_id").cast("string").alias("path"), F.col("text").alias("content"), F.col("n_chars").alias("size_bytes"))
