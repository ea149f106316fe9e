"""Questions about runs, artifacts and evaluations."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType


def _latest(rows: DataFrame, keys: list[str], order: list[str], place: str) -> DataFrame:
    """The row of each key that is last in ``order``; of equal ones the first in ``place``, which is left out."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order], place)
    return rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k", place)


def last_by_key(rows: DataFrame, keys: list[str], order: str | list[str], place: str | None = None) -> DataFrame:
    """The row of each key with the largest ``order``; rows with a blank or null key are skipped.

    Of rows with equal ``order`` the first in ``place`` counts, where there is such a column, else any.
    """
    for k in keys:
        rows = rows.where(F.trim(F.col(k).cast("string")) != "")
    if place:
        return _latest(rows, keys, [order] if isinstance(order, str) else order, place)
    order = order if isinstance(order, str) else F.struct(*order)
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_x")).select(*keys, *[F.col(f"_x.{c}").alias(c) for c in rest])


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows, and old rows whose key isn't among them; columns are united, missing ones null."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def select_meetings(meetings: DataFrame, explicit: DataFrame | None = None, prefix: str | None = None, limit: int | None = None) -> DataFrame:
    """Explicit ids (meeting_id, pos) in first-seen order, else all in name order; then the prefix, then the limit."""
    if explicit is None:
        out = meetings.select("meeting_id").distinct().withColumn("pos", F.col("meeting_id"))
    else:
        out = explicit.groupBy("meeting_id").agg(F.min("pos").alias("pos"))
    if prefix:
        out = out.where(F.startswith("meeting_id", F.lit(prefix)))
    out = out.orderBy("pos")
    return (out.limit(limit) if limit is not None else out).select("meeting_id")


def check_segments(segments: DataFrame, labels: Iterable[str] | None = None) -> DataFrame:
    """Rows and kinds of invalid rows of each meeting's segments (missing fields, end not after start, unknown label)."""
    missing = F.col("start").isNull() | F.col("end").isNull() | F.col("speaker").isNull()
    order = ~missing & (F.col("end") <= F.col("start"))
    bad_label = ~F.col("label").isin(*labels) if labels else F.lit(False)
    return segments.groupBy("meeting_id").agg(
        F.count("*").alias("n"), F.count_if(missing).alias("missing"), F.count_if(order).alias("bad_order"), F.count_if(F.coalesce(bad_label, F.lit(True))).alias("bad_label"), (F.count_if(missing | order | F.coalesce(bad_label, F.lit(True))) == 0).alias("valid")
    )


def reusable(segments: DataFrame, prefix: str) -> DataFrame:
    """Meetings and whether each non-blank source starts with the prefix."""
    source = F.trim(F.coalesce("source", F.lit("")))
    return segments.groupBy("meeting_id").agg(F.bool_and((source == "") | F.startswith(source, F.lit(prefix))).alias("reusable"))


def search(rows: DataFrame, query: str, columns: list[str]) -> DataFrame:
    """Rows where any column holds the query, whatever its case; arrays are searched as joined text. A blank query keeps all."""
    q = query.strip().lower()
    if not q:
        return rows
    kinds = dict(rows.dtypes)
    text = lambda c: F.array_join(c, ", ") if kinds[c].startswith("array") else F.col(c).cast("string")
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.contains(F.lower(F.coalesce(text(c), F.lit(""))), F.lit(q))
    return rows.where(hit)


def without_columns(rows: DataFrame, part: str) -> DataFrame:
    """Without the columns whose name holds ``part``."""
    return rows.select(*[c for c in rows.columns if part not in c.lower()])


def missing_artifacts(meetings: DataFrame, required: DataFrame, inventory: DataFrame) -> DataFrame:
    """(meeting_id, name) of required artifacts that a meeting has not. ``required`` (name) is what every meeting needs, a
    list of some dozen names, which is put into the plan; meetings and inventory only meet by meeting_id."""
    names = F.array(*[F.lit(r[0]) for r in required.select("name").distinct().orderBy("name").collect()]).cast("array<string>")
    there = inventory.where(F.array_contains(names, F.col("name"))).groupBy("meeting_id").agg(F.collect_set("name").alias("_there"))
    m = meetings.select("meeting_id").distinct().join(there, "meeting_id", "left")
    return m.select("meeting_id", F.explode(F.array_except(names, F.coalesce("_there", F.array().cast("array<string>")))).alias("name"))


def resume_plan(meetings: DataFrame, manifests: DataFrame) -> DataFrame:
    """Each meeting with action skip (a manifest exists) or run."""
    done = manifests.select("meeting_id").distinct().withColumn("_d", F.lit(True))
    return meetings.join(done, "meeting_id", "left").select(*meetings.columns, F.when(F.col("_d"), "skip").otherwise("run").alias("action"))


def validate_meetings(meetings: DataFrame, present: dict[str, DataFrame], missing: DataFrame) -> DataFrame:
    """meeting_id, errors and valid: absent from a table (``no_<table>``) or with missing artifacts (``missing_files``)."""
    out, checks = meetings.select("meeting_id").distinct(), []
    for name, table in present.items():
        out = out.join(table.select("meeting_id").distinct().withColumn(f"_{name}", F.lit(1)), "meeting_id", "left")
        checks.append(F.when(F.col(f"_{name}").isNull(), F.lit(f"no_{name}")))
    out = out.join(missing.groupBy("meeting_id").agg(F.count("*").alias("_missing")), "meeting_id", "left")
    errors = F.array_compact(F.array(*checks, F.when(F.col("_missing") > 0, F.lit("missing_files"))))
    return out.select("meeting_id", errors.alias("errors"), (F.size(errors) == 0).alias("valid"))


def eval_table(wer: DataFrame, rouge: DataFrame) -> DataFrame:
    """Error rates with ROUGE scores beside them; ROUGE columns of the same name override."""
    shared = [c for c in rouge.columns if c in wer.columns and c != "meeting_id"]
    return wer.drop(*shared).join(rouge, "meeting_id", "left")


def means(rows: DataFrame, metrics: list[str]) -> DataFrame:
    """One row: count of rows, and of each metric the mean over values that aren't null (six decimals) and their number."""
    out = [F.count("*").alias("meetings")]
    for m in metrics:
        out += [F.bround(F.avg(m), 6).alias(f"mean_{m}"), F.count(m).alias(f"n_{m}")]
    return rows.agg(*out)


def compare_speaker_counts(predicted: DataFrame, reference: DataFrame) -> DataFrame:
    """Meetings of either table (meeting_id, n) with the difference of the counts and a status."""
    p, r = predicted.select("meeting_id", F.col("n").alias("predicted")), reference.select("meeting_id", F.col("n").alias("reference"))
    d = F.col("predicted") - F.col("reference")
    status = F.when(d == 0, "exact").when(d > 0, "over_clustered").when(d < 0, "under_clustered").when(F.col("reference").isNotNull(), "missing_prediction").when(F.col("predicted").isNotNull(), "missing_reference").otherwise("missing_both")
    return p.join(r, "meeting_id", "full").select("meeting_id", "predicted", "reference", d.alias("delta"), F.abs(d).alias("abs_delta"), status.alias("status"))


def speaker_count_summary(compared: DataFrame) -> DataFrame:
    """One row: counts by status, exact accuracy, and mean absolute and signed errors over comparable meetings."""
    kinds = ("exact", "over_clustered", "under_clustered", "missing_prediction", "missing_reference", "missing_both")
    n = F.count("delta")
    return compared.agg(
        F.count("*").alias("meetings"), n.alias("comparable"), *[F.count_if(F.col("status") == k).alias(k) for k in kinds], F.coalesce(F.count_if(F.col("status") == "exact") / F.nullif(n, F.lit(0)), F.lit(0.0)).alias("accuracy"), F.coalesce(F.avg("abs_delta"), F.lit(0.0)).alias("mean_abs_error"), F.coalesce(F.avg("delta"), F.lit(0.0)).alias("mean_signed_error")
    )


def delta_histogram(compared: DataFrame) -> DataFrame:
    return compared.where("delta IS NOT NULL").groupBy("delta").agg(F.count("*").alias("n"))


def segment_stats(segments: DataFrame) -> DataFrame:
    """Segments, speakers (sorted, joined by ;) and total speech in seconds (where the end isn't before the start)."""
    dur = F.when(F.col("end_ms") >= F.col("start_ms"), F.col("end_ms") - F.col("start_ms")).otherwise(0)
    return segments.groupBy("meeting_id").agg(F.count("*").alias("segments"), F.count_distinct("speaker").alias("speakers"), F.array_join(F.array_sort(F.collect_set("speaker")), ";").alias("names"), (F.sum(dur) / 1000.0).alias("speech_sec"))


def batch_summary(runs: DataFrame) -> DataFrame:
    """Runs and their elapsed time by status."""
    return runs.groupBy("status").agg(F.count("*").alias("runs"), F.sum("elapsed_sec").alias("elapsed_sec"))


def compare_digests(manifests: DataFrame) -> DataFrame:
    """Each meeting's distinct artifact and config digests over all roots, and whether they agree."""
    one = lambda c: F.array_sort(F.collect_set(F.col(c)))
    g = manifests.groupBy("meeting_id").agg(F.count("*").alias("roots"), one("artifact_digest").alias("artifact_digests"), one("config_digest").alias("config_digests"))
    return g.withColumn("artifact_match", F.size("artifact_digests") <= 1).withColumn("config_match", F.size("config_digests") <= 1)


def digest_totals(compared: DataFrame) -> DataFrame:
    """One row: meetings compared, and how many differ in artifacts, in configs, or in either."""
    bad = lambda *c: F.coalesce(F.count_if(~(F.col(c[0]) & F.col(c[-1]))), F.lit(0))
    return compared.agg(F.count("*").alias("meetings_checked"), bad("artifact_match", "config_match").alias("mismatched_meetings"), bad("artifact_match").alias("artifact_digest_mismatches"), bad("config_match").alias("config_digest_mismatches"))


def config_digests(configs: DataFrame, key: str) -> DataFrame:
    """(key, config_digest): SHA-256 of each row's other columns as canonical JSON."""
    from ..sources.sinks import canonical_json

    return configs.select(key, F.sha2(canonical_json(configs.drop(key)), 256).alias("config_digest"))


def code_provenance(files: DataFrame, group: str) -> DataFrame:
    """(group, files, aggregate_sha256) of (group, path, content): a digest over the sorted paths and their digests, each
    ended by a zero character. A group is one string, of some hundred characters a file."""
    each = files.select(group, "path", F.sha2(F.col("content").cast("binary"), 256).alias("h"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("path", "h"))), lambda x: F.concat(x["path"], F.lit("\0"), x["h"], F.lit("\0")))
    return each.groupBy(group).agg(F.count("*").alias("files"), F.sha2(F.array_join(lines, ""), 256).alias("aggregate_sha256"))


#: Files that tell of a run and are no part of what it made.
RUN_FILES = ("run_manifest.json", "stage_trace.jsonl", "preflight_offline_audit.json", "reproducibility_report.json")


def _folder_digests(batches: Iterator[pa.RecordBatch], out: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One running hash a meeting, over files that come in order; no meeting's files are held together."""
    of, files, digest = None, 0, None
    done = lambda: pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((of, files, digest.hexdigest()), out)], schema=out)
    for batch in batches:
        for meeting, path, content in zip(*(batch[c] for c in ("meeting_id", "path", "content"))):
            if digest is None or meeting.as_py() != of:
                if digest is not None:
                    yield done()
                of, files, digest = meeting.as_py(), 0, hashlib.sha256()
            files += 1
            for piece in (path, content):
                digest.update(piece.as_buffer() if piece.is_valid else b"")
                digest.update(b"\0")
    if digest is not None:
        yield done()


def content_digests(files: DataFrame, ignored: Iterable[str] = RUN_FILES) -> DataFrame:
    """The digest of each meeting's folder: SHA-256 over path, zero, content, zero of its files (meeting_id, path, content).

    Files are taken in the order of their paths' parts; those named in ``ignored`` are left out. A hash takes its bytes in
    a row, so a meeting is one task's work, which passes its files through one by one.
    """
    name = F.element_at(F.split("path", "/"), -1)
    kept = files.where(~name.isin(*ignored)) if ignored else files
    kept = kept.select("meeting_id", F.col("path").cast("binary").alias("path"), F.col("content").cast("binary").alias("content"), F.split("path", "/").alias("_parts"))
    out = StructType([kept.schema["meeting_id"], StructField("files", LongType()), StructField("digest", StringType())])
    arrow = to_arrow_schema(out)
    return kept.repartition("meeting_id").sortWithinPartitions("meeting_id", "_parts").drop("_parts").mapInArrow(lambda batches: _folder_digests(batches, arrow), out)


def stage_status(required: DataFrame, inventory: DataFrame, trace: DataFrame) -> DataFrame:
    """Status of each meeting and stage from its artifacts (meeting_id, stage, name) and its last trace event.

    fail where the trace has another status than ok, success with all artifacts, in_progress with some, else not_run.
    """
    have = inventory.select("meeting_id", "name").distinct().withColumn("_have", F.lit(1))
    counts = required.join(have, ["meeting_id", "name"], "left").groupBy("meeting_id", "stage").agg(F.count("*").alias("artifacts"), F.count("_have").alias("present"))
    t = trace.select("meeting_id", "stage", F.col("status").alias("_status"), "elapsed_sec")
    s = F.when(F.col("_status") != "ok", "fail").when(F.col("present") == F.col("artifacts"), "success").when(F.col("present") > 0, "in_progress").otherwise("not_run")
    note = F.when(F.col("_status") != "ok", F.concat(F.lit("Stage trace recorded status: "), F.col("_status"))).when(F.col("elapsed_sec").isNull() & (F.col("status") == "success"), "No stage trace runtime recorded")
    return counts.join(t, ["meeting_id", "stage"], "left").withColumn("status", s).withColumn("note", note).drop("_status")


def meeting_index(meetings: DataFrame, manifests: DataFrame, stages: DataFrame, updated: DataFrame) -> DataFrame:
    """A row a meeting: whether it has a manifest, stages complete, last update; newest first, then by id."""
    done = stages.groupBy("meeting_id").agg(F.count_if(F.col("status") == "success").alias("stages_complete"), F.count("*").alias("stage_count"))
    has = manifests.select("meeting_id").distinct().withColumn("_m", F.lit(True))
    out = meetings.select("meeting_id").distinct().join(has, "meeting_id", "left").join(done, "meeting_id", "left").join(updated, "meeting_id", "left")
    return out.select("meeting_id", F.coalesce("_m", F.lit(False)).alias("has_manifest"), F.coalesce("stages_complete", F.lit(0)).alias("stages_complete"), F.coalesce("stage_count", F.lit(0)).alias("stage_count"), "last_updated").orderBy(F.desc_nulls_last("last_updated"), F.desc("meeting_id"))


def run_progress(events: DataFrame, total: int) -> DataFrame:
    """Progress of runs from stage events (run_id, stage_no, status, elapsed_sec, ts, place): completed and failed stages, the last one, its time.

    A stage's last event counts, by ts and elapsed_sec; of equal ones the first in place.
    """
    last = _latest(events, ["run_id", "stage_no"], ["ts", "elapsed_sec"], "place")
    g = last.groupBy("run_id").agg(F.count_if(F.col("status") == "ok").alias("completed"), F.count_if(F.col("status") != "ok").alias("failed"), F.max_by("stage_no", F.struct("ts", "stage_no")).alias("last_stage"), F.sum("elapsed_sec").alias("elapsed_sec"))
    return g.withColumn("pending", total - F.col("completed") - F.col("failed"))


def current_stage(trace: DataFrame) -> DataFrame:
    """The latest started stage of each meeting that hasn't ended since (meeting_id, stage, event, line_no)."""
    last = trace.groupBy("meeting_id", "stage").agg(F.max_by("event", "line_no").alias("event"), F.max("line_no").alias("line_no"))
    return last.where("event = 'stage_start'").groupBy("meeting_id").agg(F.max_by("stage", "line_no").alias("stage"))


def history_status(status: Column, action: Column, error: Column) -> Column:
    """not_run for a validation that failed as there was no manifest, else the status (unknown if null)."""
    gone = (status == "failed") & (action == "validate") & (error == "run_manifest_missing_for_validate_only")
    return F.when(F.coalesce(gone, F.lit(False)), "not_run").otherwise(F.coalesce(status, F.lit("unknown")))


def audit_paths(settings: DataFrame) -> DataFrame:
    """Violations of each run's settings (run_id, field, kind, value): any URL as a path, with the value; web addresses
    in commands, and commands that call a downloader (both, if both)."""
    v = F.lower("value")
    path, command = F.col("kind") == "path", F.col("kind") == "command"
    found = (
        F.when(path & F.contains("value", F.lit("://")), F.concat_ws(":", "field", F.lit("url_not_allowed"), "value")),
        F.when(command & v.rlike("https?://"), F.concat_ws(":", "field", F.lit("contains_url"))),
        F.when(command & v.rlike("(wget|curl) "), F.concat_ws(":", "field", F.lit("network_downloader_detected"))),
    )
    each = settings.select("run_id", F.explode_outer(F.array_compact(F.array(*found))).alias("bad"))
    return each.groupBy("run_id").agg(F.array_sort(F.collect_set("bad")).alias("violations")).withColumn("ok", F.size("violations") == 0)


def latest(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    return rows.orderBy(*order).limit(n)
