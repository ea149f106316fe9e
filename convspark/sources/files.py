"""Readers of meeting files; paths are anything Spark can read.

Meeting and speaker come from file names, or from folders named ``meeting_id=...`` and ``speaker_letter=...`` as Spark's
writers make them. Small line files are read whole, as last-wins rules need the line order.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..schemas import ASR_SEGMENT, TRACE


def _name() -> Column:
    return F.col("_metadata.file_name")


def _named(pattern: str, group: int, name: str) -> Column:
    """A part of the file's name, else of a folder ``name=...`` above it."""
    own, folder = F.regexp_extract(_name(), pattern, group), F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), rf"/{name}=([^/]*)/", 1))
    return F.when(own != "", own).otherwise(folder)


@F.pandas_udf(StringType())
def unescape_html(text: pd.Series) -> pd.Series:
    """Resolves all named and numeric HTML entities; the built-ins know only a few."""
    return text.map(html.unescape, na_action="ignore")


def word_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Tokens of ``{meeting}.{A-Z}.words.xml``: words with both times and text; entities are resolved once more."""
    raw = spark.read.format("xml").option("rowTag", "w").schema("_starttime double, _endtime double, _punc string, _VALUE string").load(path)
    text = F.coalesce(unescape_html(F.when(F.contains("_VALUE", F.lit("&")), F.col("_VALUE"))), "_VALUE")
    pattern = r"^(.+)\.([A-Z])\.words\.xml$"
    parts = raw.select(_named(pattern, 1, "meeting_id").alias("meeting_id"), _named(pattern, 2, "speaker_letter").alias("speaker_letter"), F.col("_starttime").alias("start"), F.col("_endtime").alias("end"), F.trim(text).alias("text"), (F.coalesce("_punc", F.lit("")) == "true").alias("is_punc"), F.monotonically_increasing_id().alias("seq"))
    return parts.where("meeting_id <> '' AND start IS NOT NULL AND end IS NOT NULL AND text <> ''")


def summary_sections(spark: SparkSession, path: str) -> DataFrame:
    """Sentences (meeting_id, section, pos, sentence) of ``{meeting}.abssumm.xml``."""
    names = ("abstract", "actions", "decisions", "problems")
    plain = ", ".join(f"{n} struct<sentence: array<string>>" for n in names)
    raw = spark.read.format("xml").option("rowTag", "root").option("ignoreNamespace", "true").schema(plain).load(path)
    meeting = _named(r"^(.+)\.abssumm\.xml$", 1, "meeting_id").alias("meeting_id")
    rows = raw.select(meeting, F.explode(F.array(*[F.struct(F.lit(n).alias("section"), F.col(f"{n}.sentence").alias("s")) for n in names])).alias("x"))
    out = rows.select("meeting_id", "x.section", F.posexplode("x.s").alias("pos", "sentence"))
    return out.withColumn("sentence", F.trim(F.regexp_replace("sentence", r"\s+", " "))).where("sentence <> ''")


def meeting_reference(spark: SparkSession, path: str) -> DataFrame:
    """participant_count, agents and roles of each meeting of ``meetings.xml``; the count has all speaker elements."""
    raw = spark.read.format("xml").option("rowTag", "meeting").schema("_observation string, speaker array<struct<_nxt_agent: string, _role: string, _VALUE: string>>").load(path)
    named = lambda f: F.array_distinct(F.filter(F.transform("speaker", lambda s: F.trim(s[f])), lambda v: v.isNotNull() & (v != "")))
    return raw.where("_observation IS NOT NULL").select(F.col("_observation").alias("meeting_id"), F.size(F.coalesce("speaker", F.array())).alias("participant_count"), named("_nxt_agent").alias("agents"), named("_role").alias("roles"))


def rttm(spark: SparkSession, path: str) -> DataFrame:
    """(meeting_id, start_ms, end_ms, speaker) of SPEAKER lines with nine fields or more; blanks and # are skipped."""
    f = F.split(F.trim("value"), r"\s+")
    lines = spark.read.text(path).where(~F.trim("value").rlike("^(#|$)")).select(f.alias("f")).where((F.size("f") >= 9) & (F.col("f")[0] == "SPEAKER"))
    ms = lambda k: F.round(F.col("f")[k].try_cast("double") * 1000).cast("long")
    return lines.select(F.col("f")[1].alias("meeting_id"), ms(3).alias("start_ms"), (ms(3) + ms(4)).alias("end_ms"), F.col("f")[7].alias("speaker")).where("start_ms IS NOT NULL AND end_ms IS NOT NULL")


def _meeting_of_path() -> Column:
    """The folder that a file lies in, without ``meeting_id=``."""
    return _folder(F.col("_metadata.file_path"))


def _folder(path: Column) -> Column:
    return F.regexp_replace(F.url_decode(F.element_at(F.split(path, "/"), -2)), "^meeting_id=", "")


def segments(spark: SparkSession, path: str) -> DataFrame:
    """Segments of JSON arrays, in files of meeting folders, each of which is one task's work; rows with bad times, or that end before they start, are dropped."""
    # Of whole texts, as the JSON source opens a file again for each number that it reads as a string.
    whole = spark.read.text(path, wholetext=True).select("*", "_metadata")
    raw = whole.select("_metadata", F.inline(F.from_json("value", "array<struct<start string, end string, speaker string, text string, confidence string, source string>>")))
    num = lambda c: F.col(c).try_cast("double")
    rows = raw.select(_meeting_of_path().alias("meeting_id"), F.coalesce(num("start"), F.when(F.col("start").isNull(), 0.0)).alias("start"), F.coalesce(num("end"), F.when(F.col("end").isNull(), 0.0)).alias("end"), F.coalesce("speaker", F.lit("UNKNOWN")).alias("speaker"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(num("confidence"), F.lit(0.0)).alias("confidence"), F.coalesce("source", F.lit("")).alias("source"))
    return rows.where("start IS NOT NULL AND end > start").selectExpr(*[x.strip().split()[0] for x in ASR_SEGMENT.split(",")])


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of small JSON line files with line_no; lines that don't parse are dropped."""
    whole = spark.read.text(path, wholetext=True).select(_meeting_of_path().alias("folder"), F.posexplode(F.split("value", "\n")).alias("line_no", "line"))
    parsed = whole.where(F.trim("line") != "").withColumn("x", F.from_json("line", schema, {"mode": "PERMISSIVE"}))
    return parsed.where(F.try_parse_json("line").isNotNull()).select("folder", "line_no", "x.*")


def stage_trace(spark: SparkSession, path: str) -> DataFrame:
    """The last end of each meeting's stages in its trace files."""
    t = jsonl(spark, path, TRACE).where("event = 'stage_end'").withColumn("meeting_id", F.coalesce("meeting_id", "folder"))
    return t.groupBy("meeting_id", "stage").agg(F.max_by(F.struct("status", "elapsed_sec"), "line_no").alias("x")).select("meeting_id", "stage", "x.*")


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(path)


def batch_records(spark: SparkSession, path: str) -> DataFrame:
    """Runs in batch summaries (config_path, validate_only, records[]); files that aren't JSON are skipped."""
    rec = "array<struct<meeting_id: string, meeting_ids: array<string>, status: string, action: string, error: string, started_at_utc: string, ended_at_utc: string, artifact_digest: string>>"
    raw = spark.read.option("multiLine", True).option("mode", "DROPMALFORMED").schema(f"config_path string, validate_only boolean, records {rec}").json(path)
    r = raw.select(_name().alias("file"), "config_path", "validate_only", F.explode("records").alias("r"))
    ids = F.coalesce("r.meeting_ids", F.when(F.col("r.meeting_id").isNotNull(), F.array("r.meeting_id")).otherwise(F.array().cast("array<string>")))
    return r.select("file", F.coalesce("r.meeting_id", F.get(ids, F.lit(0)), F.lit("Unknown")).alias("meeting_id"), ids.alias("meeting_ids"), F.col("config_path").alias("config"), F.when(F.col("validate_only"), "validate-only").otherwise("run").alias("mode"), "r.status", "r.action", "r.error", F.col("r.started_at_utc").alias("started_at"), F.col("r.ended_at_utc").alias("ended_at"), "r.artifact_digest")


def discover_meetings(spark: SparkSession, audio: str | None = None, artifacts: str | None = None) -> DataFrame:
    """Meetings that have audio (``*.Mix-Headset.wav``), artifact folders, or either; only file listings are read."""
    found = []
    if audio:
        found.append(spark.read.format("binaryFile").load(audio).select(F.regexp_extract("path", r"([^/]+)\.Mix-Headset\.wav$", 1).alias("meeting_id")))
    if artifacts:
        found.append(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(artifacts).select(_folder(F.col("path")).alias("meeting_id")))
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out.where("meeting_id <> ''").distinct()


# Kinds of files by suffix.
KINDS = (("json", ("json",)), ("jsonl", ("jsonl",)), ("csv", ("csv",)), ("html", ("html", "htm")), ("yaml", ("yaml", "yml")), ("audio", ("wav", "mp3", "flac")), ("text", ("txt", "rttm", "md", "log")))


def kind_of(name: Column) -> Column:
    suffix = F.lower(F.regexp_extract(name, r"\.([^./]+)$", 1))
    out = F.lit("text")
    for kind, ends in KINDS:
        out = F.when(suffix.isin(*ends), kind).otherwise(out)
    return out


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """meeting_id, name, kind, length and modification time of all files below; contents aren't read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    return f.select(_folder(F.col("path")).alias("meeting_id"), F.element_at(F.split("path", "/"), -1).alias("name"), kind_of(F.col("path")).alias("kind"), "length", F.col("modificationTime").alias("modification_time"))


def text_preview(spark: SparkSession, path: str, limit: int = 20_000) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(_meeting_of_path().alias("folder"), _name().alias("name"), F.substring("value", 1, limit).alias("text"))


def audio_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", r"([^/]+?)(?:\.Mix-Headset)?\.wav$", 1).alias("meeting_id"), "content")


# The fields that may hold a confidence, in the order in which they are asked.
SINGLE_FIELDS = ("confidence", "score", "avg_logprob", "y_sequence_score")
LIST_FIELDS = ("word_confidence", "token_confidence", "token_confidences", "frame_confidence", "char_confidence", "char_confidences")


def confidence(item: Column) -> Column:
    """Recognition confidence of a struct of doubles (``SINGLE_FIELDS``) and arrays (``LIST_FIELDS``; that of frames is
    nested): the first in [0, 1], else exp of the first that isn't positive, else the mean of the first list's values in
    [0, 1], else 0; six decimals."""
    finite = lambda v: F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)
    named = [finite(item[n]) for n in SINGLE_FIELDS]
    inside = [F.when(v == 0, v).when(v.between(0, 1), F.bround(v, 6)) for v in named]  # a zero keeps its sign
    log = F.coalesce(*[F.when(v <= 0, v) for v in named])
    valid = lambda a: F.filter(a, lambda v: v.between(0, 1))
    mean = lambda a: F.bround(F.aggregate(a, F.lit(0.0), lambda s, v: s + v) / F.nullif(F.size(a), F.lit(0)), 6)
    lists = [mean(valid(F.flatten(item[n]) if n == "frame_confidence" else item[n])) for n in LIST_FIELDS]
    return F.coalesce(*inside, F.when(log.isNotNull(), F.bround(F.exp(F.greatest(F.lit(-20.0), log)), 6)), *lists, F.lit(0.0))
