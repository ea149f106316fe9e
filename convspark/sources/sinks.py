"""Writers of meeting files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from ..functions.numbers import fixed
from ..operators.scans import in_ranges


def _sorted_fields(value: Column, kind: DataType) -> Column:
    """The value with the fields of all structs in it in name order."""
    if isinstance(kind, StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        return F.when(value.isNotNull(), F.struct(*[_sorted_fields(value[f.name], f.dataType).alias(f.name) for f in fields]))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _sorted_fields(x, kind.elementType))
    if isinstance(kind, MapType):
        return F.map_from_entries(F.array_sort(F.transform(F.map_entries(value), lambda e: F.struct(e["key"].alias("key"), _sorted_fields(e["value"], kind.valueType).alias("value")))))
    return value


def ascii_json(text: Column) -> Column:
    """JSON text whose characters above ASCII are written as escapes of their UTF-16 units."""
    unit = lambda h, at: F.concat(F.lit("\\u"), F.lower(F.substring(h, at, 4)))
    code = lambda h: F.concat(unit(h, 1), F.when(F.length(h) == 8, unit(h, 5)).otherwise(""))
    letters = F.transform(F.regexp_extract_all(text, F.lit("(?s)(.)"), F.lit(1)), lambda c: F.when(c <= "\x7f", c).otherwise(code(F.hex(F.encode(c, "UTF-16BE")))))
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.array_join(letters, "")).otherwise(text)


def canonical_json(rows: DataFrame) -> Column:
    """A row as JSON in one form: keys sorted at every level, nulls written, ASCII only, no spaces."""
    fields = sorted(rows.schema.fields, key=lambda f: f.name)
    return ascii_json(F.to_json(F.struct(*[_sorted_fields(F.col(f.name), f.dataType).alias(f.name) for f in fields]), {"ignoreNullFields": "false"}))


def write_json_rows(rows: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Canonical JSON lines, in the given order inside each file."""
    out = rows.sortWithinPartitions(*order) if order else rows
    out.select(canonical_json(rows).alias("value")).write.mode("overwrite").text(path)


def write_report(rows: DataFrame, path: str, columns: list[str]) -> None:
    """CSV of fixed columns; missing ones and nulls are blank."""
    have = set(rows.columns)
    rows.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns]).write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)


def rttm_lines(segments: DataFrame, label: str | None = None) -> DataFrame:
    """(meeting_id, value): RTTM lines with three decimals; ``label`` stands in for the speaker."""
    who = F.lit(label) if label else F.col("speaker")
    line = F.format_string("SPEAKER %s 1 %s %s <NA> <NA> %s <NA> <NA>", "meeting_id", fixed(F.col("start_ms") / 1000.0, 3), fixed((F.col("end_ms") - F.col("start_ms")) / 1000.0, 3), who)
    return segments.select("meeting_id", line.alias("value"), "start_ms", "end_ms")


def write_rttm(segments: DataFrame, path: str, label: str | None = None) -> None:
    """A folder of RTTM text a meeting."""
    rows = rttm_lines(segments, label).repartition("meeting_id").sortWithinPartitions("meeting_id", "start_ms", "end_ms")
    rows.select("meeting_id", "value").write.mode("overwrite").partitionBy("meeting_id").text(path)


def transcript_lines(segments: DataFrame) -> DataFrame:
    """(meeting_id, text): lines ``[start-end] speaker: text`` in time order."""
    line = F.format_string("[%s-%s] %s: %s", fixed(F.col("start_ms") / 1000.0, 2), fixed(F.col("end_ms") / 1000.0, 2), "speaker", "text")
    g = segments.where("text <> ''").groupBy("meeting_id").agg(F.array_sort(F.collect_list(F.struct("start_ms", "end_ms", line.alias("line")))).alias("x"))
    return g.select("meeting_id", F.array_join(F.transform("x", lambda r: r["line"]), "\n").alias("text"))


def append_events(events: DataFrame, path: str) -> None:
    events.write.mode("append").json(path)


def write_word_tokens(tokens: DataFrame, path: str) -> None:
    """Words (meeting_id, speaker_letter, start, end, text, is_punc) as XML, a folder a meeting and speaker."""
    w = tokens.select("meeting_id", "speaker_letter", F.col("start").alias("_starttime"), F.col("end").alias("_endtime"), F.when(F.col("is_punc"), "true").alias("_punc"), F.col("text").alias("_VALUE"))
    w = w.repartition("meeting_id", "speaker_letter").sortWithinPartitions("meeting_id", "speaker_letter", "_starttime", "_endtime")
    w.write.mode("overwrite").format("xml").option("rowTag", "w").option("rootTag", "words").partitionBy("meeting_id", "speaker_letter").save(path)


def write_summary_sections(sections: DataFrame, path: str) -> None:
    """Sentences (meeting_id, section, pos, sentence) as XML with an element a section, a folder a meeting."""
    of = lambda name: F.struct(F.transform(F.array_sort(F.collect_list(F.when(F.col("section") == name, F.struct("pos", "sentence")))), lambda x: x["sentence"]).alias("sentence")).alias(name)
    rows = sections.groupBy("meeting_id").agg(*[of(n) for n in ("abstract", "actions", "decisions", "problems")])
    rows.write.mode("overwrite").format("xml").option("rowTag", "root").option("rootTag", "summaries").partitionBy("meeting_id").save(path)


def write_meeting_reference(speakers: DataFrame, path: str) -> None:
    """Speakers (meeting_id, pos, agent, role) as XML with an element a meeting."""
    one = F.transform(F.array_sort(F.collect_list(F.struct("pos", "agent", "role"))), lambda s: F.struct(s["agent"].alias("_nxt_agent"), s["role"].alias("_role")))
    rows = speakers.groupBy(F.col("meeting_id").alias("_observation")).agg(one.alias("speaker"))
    rows.write.mode("overwrite").format("xml").option("rowTag", "meeting").option("rootTag", "meetings").save(path)


def write_json_arrays(rows: DataFrame, path: str, order: list[str], most: int = 20_000) -> None:
    """JSON arrays of each meeting's rows in order, in a folder a meeting: files of up to ``most`` rows, in the order of
    their names, so that neither writing nor reading takes a meeting at once."""
    rest = [c for c in rows.columns if c != "meeting_id"]
    parts = in_ranges(rows, ["meeting_id", *order])
    place = F.row_number().over(Window.partitionBy("_range", "meeting_id").orderBy(*order, F.struct(*rest)))
    items = F.transform(F.array_sort(F.collect_list(F.struct(*order, F.struct(*rest).alias("row")))), lambda x: x["row"])
    blocks = parts.withColumn("_block", F.floor((place - 1) / most)).groupBy("meeting_id", "_range", "_block").agg(F.to_json(items).alias("value"))
    # Ranges follow each other, and so do the names of files: those of the tasks, and of the files of a task.
    dealt = blocks.repartitionByRange("meeting_id", "_range", "_block").sortWithinPartitions("meeting_id", "_range", "_block")
    dealt.select("meeting_id", "value").write.mode("overwrite").option("maxRecordsPerFile", 1).partitionBy("meeting_id").text(path)
