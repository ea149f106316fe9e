"""Decisions, actions and summary points with evidence, from chunks and from stored model responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.json_objects import summaries

_STRINGS = "array<string>"


def rule_decisions(chunks: DataFrame) -> DataFrame:
    """One decision a chunk with a decision phrase: meeting_id, chunk_id, decision, confidence, uncertain."""
    return chunks.where(T.matches_any(F.lower("text"), T.DECISION_PATTERNS)).select("meeting_id", "chunk_id", T.first_line(F.col("text")).alias("decision"), F.lit(0.55).alias("confidence"), F.lit(True).alias("uncertain"))


def rule_actions(chunks: DataFrame) -> DataFrame:
    """One action a chunk with an action phrase, with the first speaker label as owner and a due date if one is named."""
    return chunks.where(T.matches_any(F.lower("text"), T.ACTION_PATTERNS)).select(
        "meeting_id", "chunk_id", T.first_line(F.col("text")).alias("action"), T.owner_of(F.col("text")).alias("owner"), T.due_date_of(F.col("text")).alias("due_date"), F.lit(0.5).alias("confidence"), F.lit(True).alias("uncertain")
    )


def rule_counts(chunks: DataFrame) -> DataFrame:
    """A validation row a meeting: decision_count, action_count and flags where there is none."""
    d, a = (T.matches_any(F.lower("text"), p) for p in (T.DECISION_PATTERNS, T.ACTION_PATTERNS))
    n = chunks.groupBy("meeting_id").agg(F.count_if(d).alias("decision_count"), F.count_if(a).alias("action_count"))
    return n.withColumn("flags", F.array_compact(F.array(F.when(F.col("decision_count") == 0, "no_decisions_detected"), F.when(F.col("action_count") == 0, "no_actions_detected"))))


def merged_snippets(lists: Column) -> Column:
    """Distinct trimmed snippets in order: three at most, 220 characters each."""
    return F.transform(F.slice(F.array_distinct(F.filter(F.transform(F.flatten(lists), lambda x: F.trim(x)), lambda s: s != "")), 1, 3), lambda s: F.substring(s, 1, 220))


def dedupe_items(items: DataFrame, text_col: str, cap: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """Merges items (meeting_id, seq, text, evidence_chunk_ids, evidence_snippets, confidence, uncertain) of equal text.

    Equal means trimmed, in lower case and with single spaces. The first item's text stays, evidence is united, the
    confidence is the largest, and it is uncertain only if all are; of ``extra`` columns the first non-empty value
    stays. The first ``cap`` of a meeting are returned, in order of appearance.
    """
    key = T.dedupe_key(F.col(text_col))
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("seq", F.col(c).alias("v")))), lambda x: x["v"])
    firsts = [F.get(F.filter(ordered(c), lambda v: v.isNotNull() & (v != "")), F.lit(0)).alias(c) for c in extra]
    g = items.where(key != "").groupBy("meeting_id", key.alias("_key")).agg(
        F.min("seq").alias("seq"),
        F.min_by(text_col, "seq").alias(text_col),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("evidence_chunk_ids")))).alias("evidence_chunk_ids"),
        merged_snippets(ordered("evidence_snippets")).alias("evidence_snippets"),
        F.max("confidence").alias("confidence"),
        F.bool_and("uncertain").alias("uncertain"),
        F.count("*").alias("n_merged"),
        *firsts,
    )
    rank = F.row_number().over(Window.partitionBy("meeting_id").orderBy("seq"))
    return g.drop("_key").withColumn("rank", rank).where(F.col("rank") <= cap)


def quality_counts(items: DataFrame, text_col: str, kind: str) -> DataFrame:
    """kept and dropped items of each meeting."""
    bad = T.is_low_quality(F.col(text_col), kind)
    if kind == "action":
        bad = bad | F.coalesce(T.is_speculative_action(F.col(text_col)), F.lit(False))
    return items.groupBy("meeting_id").agg(F.count_if(~bad).alias("kept"), F.count_if(bad).alias("dropped"))


def select_chunks(chunks: DataFrame, cues: Column | None = None) -> DataFrame:
    """Chunks (meeting_id, idx, chunk_id, text) worth extracting from, with their neighbours' ids.

    Up to six chunks all stay; of more, the best max(8, round(0.8 n)) by score and all with an explicit cue (scored 4 at
    least), unless every score is 0. ``cues`` are the summary's terms beside the built-in ones.
    """
    own = F.array(*map(F.lit, T.BASE_CUES))
    cues = own if cues is None else F.array_distinct(F.concat(cues, own))
    whole, order = Window.partitionBy("meeting_id"), Window.partitionBy("meeting_id").orderBy("idx")
    t = chunks.withColumn("cue", T.has_cue(F.col("text"))).withColumn("score", T.extraction_score(F.col("text"), cues))
    t = t.withColumn("score", F.when(F.col("cue"), F.greatest("score", F.lit(4))).otherwise(F.col("score")))
    t = t.withColumn("prev_chunk_id", F.lag("chunk_id").over(order)).withColumn("next_chunk_id", F.lead("chunk_id").over(order))
    t = t.withColumn("_n", F.count("*").over(whole)).withColumn("_top", F.max("score").over(whole))
    t = t.withColumn("_rank", F.row_number().over(Window.partitionBy("meeting_id").orderBy(F.desc("score"), "idx")))
    keep = F.greatest(F.lit(8), F.bround(F.col("_n") * 0.8, 0))
    return t.where((F.col("_n") <= 6) | (F.col("_top") <= 0) | (F.col("_rank") <= keep) | F.col("cue")).drop("_n", "_top", "_rank")


def best_evidence(points: DataFrame, chunks: DataFrame, k: int = 2) -> DataFrame:
    """The k best chunks of each point (meeting_id, point_id, point) among its meeting's (idx, chunk_id, text, asr_confidence).

    Scores count shared terms, reduced by a low recognition confidence; chunks without any score are no evidence.
    Points of the same terms have the same scores and are scored once. Terms meet as postings, whose number in a pair is
    the score; the first term is looked for in chunks that hold its first part, once in a chunk's text for all points. Texts are
    joined to the k best only, and no join hands one side to every task.
    """
    first = T.first_term(F.col("point"))
    asked = F.concat(F.coalesce(F.col("_first"), F.lit("")), F.lit(" "), F.array_join(F.array_sort("_keys"), " "))
    p = points.withColumn("_keys", T.keywords(F.col("point"))).withColumn("_first", first).withColumn("_asked", asked)
    a = p.groupBy("meeting_id", "_asked").agg(F.first("_keys").alias("_keys"), F.first("_first").alias("_first"))
    low = F.lower(F.coalesce("text", F.lit("")))
    at = ["meeting_id", "idx"]
    # Stored texts are far smaller than their rows: by their files' size they would be broadcast, terms and all.
    met = lambda l, r, on, how="inner": l.join(r.hint("merge"), on, how)
    held = chunks.select(*at, F.explode(T.chunk_terms(F.col("text"))).alias("_w"))
    shared = met(a.select("meeting_id", "_asked", F.explode("_keys").alias("_w")), held, ["meeting_id", "_w"]).groupBy("meeting_id", "_asked", "idx").agg(F.count("*").alias("_n"))
    part = F.explode(F.array_distinct(F.regexp_extract_all(low, F.lit("([a-z0-9_]+)"), F.lit(1)))).alias("_part")
    named = a.where("_first IS NOT NULL")
    terms = named.select("meeting_id", "_first", F.regexp_extract("_first", "^[a-z0-9_]+", 0).alias("_part")).distinct()
    looked = met(terms, chunks.select(*at, part), ["meeting_id", "_part"]).groupBy(*at).agg(F.collect_set("_first").alias("_terms"))
    there = F.filter("_terms", lambda t: T.stands_in(t, F.col("_low")))
    found = met(chunks.select(*at, low.alias("_low")), looked, at).select(*at, F.explode(there).alias("_first"))
    stands = met(named.select("meeting_id", "_asked", "_first"), found, ["meeting_id", "_first"]).select("meeting_id", "_asked", "idx", F.lit(True).alias("_stands"))
    both = met(met(shared, stands, ["meeting_id", "_asked", "idx"], "full"), chunks.select(*at, "asr_confidence"), at)
    score = F.least(F.coalesce("_n", F.lit(0)), F.lit(8)).cast("int") + F.when(F.col("_stands"), 2).otherwise(0)
    scored = both.select("meeting_id", "_asked", "idx", T.downranked(score, F.col("asr_confidence")).alias("score")).where("score > 0")
    rank = F.row_number().over(Window.partitionBy("meeting_id", "_asked").orderBy(F.desc("score"), "idx"))
    best = scored.withColumn("rank", rank).where(F.col("rank") <= k)
    return met(met(p.drop("_keys", "_first"), best, ["meeting_id", "_asked"]).drop("_asked"), chunks, at)


def attach_evidence(points: DataFrame, chunks: DataFrame, kind: str) -> DataFrame:
    """Points with evidence whose best chunk scores 2 (discussion) or 4 (follow_up) at least; ten a meeting.

    Returns meeting_id, point_id, text, evidence_chunk_ids, evidence_snippets, confidence (best score / 10 in .2-.95).
    """
    clean = points.withColumn("point", T.clean_summary(F.col("point"))).where("point <> ''")
    best = best_evidence(clean, chunks)
    snippet = T.evidence_snippet(F.col("text"), F.col("point"))
    in_order = lambda x: F.transform(F.array_sort(F.collect_list(F.struct("rank", x.alias("v")))), lambda y: y["v"])
    g = best.groupBy("meeting_id", "point_id", "point").agg(F.max("score").alias("score"), in_order(F.col("chunk_id")).alias("evidence_chunk_ids"), merged_snippets(F.array(in_order(snippet))).alias("evidence_snippets"))
    g = g.where(F.col("score") >= (2 if kind == "discussion" else 4))
    g = g.withColumn("_k", F.row_number().over(Window.partitionBy("meeting_id").orderBy("point_id"))).where("_k <= 10")
    return g.select("meeting_id", "point_id", F.substring("point", 1, 240).alias("text"), F.slice("evidence_chunk_ids", 1, 3).alias("evidence_chunk_ids"), "evidence_snippets", F.bround(F.least(F.lit(0.95), F.greatest(F.lit(0.2), F.col("score") / 10.0)), 3).alias("confidence"))


def filter_points(points: DataFrame, kind: str) -> DataFrame:
    """Points with evidence, of good enough text and confidence, rewritten to canonical phrases: eight a meeting."""
    least = 0.45 if kind == "follow_up" else 0.25
    t = points.where((F.size("evidence_chunk_ids") > 0) & (F.size("evidence_snippets") > 0) & ~T.is_low_quality_point(F.trim("text"), kind) & (F.col("confidence") >= least))
    t = t.withColumn("text", T.normalize_point(F.trim("text"), kind)).where("text <> ''")
    return t.withColumn("_k", F.row_number().over(Window.partitionBy("meeting_id").orderBy("point_id"))).where("_k <= 8").drop("_k")


def recover_follow_ups(points: DataFrame, chunks: DataFrame) -> DataFrame:
    """Follow-ups among other points: the six likeliest (cue first, longest first), with strong evidence; two a meeting."""
    t = points.withColumn("point", T.clean_summary(F.col("point"))).where("point <> ''")
    t = t.groupBy("meeting_id", "point").agg(F.min("point_id").alias("point_id"))
    rank = F.row_number().over(Window.partitionBy("meeting_id").orderBy(F.when(T.looks_like_follow_up(F.col("point")), 0).otherwise(1), F.desc(F.length("point")), "point_id"))
    tried = t.withColumn("_r", rank).where("_r <= 6").select("meeting_id", F.col("_r").cast("long").alias("point_id"), "point")
    strong = filter_points(attach_evidence(tried, chunks, "follow_up"), "follow_up").where((F.col("confidence") >= 0.5) & (T.snippet_quality(F.col("evidence_snippets")[0]) >= 0.35))
    return strong.withColumn("_k", F.row_number().over(Window.partitionBy("meeting_id").orderBy("point_id"))).where("_k <= 2").drop("_k")


def merge_follow_ups(follow_up: DataFrame, actions: DataFrame, cap: int = 8) -> DataFrame:
    """Follow-ups (meeting_id, seq, text, confidence) and the actions that aren't among them, at most ``cap`` a meeting."""
    key = lambda c: F.lower(F.trim(F.col(c)))
    known = follow_up.select("meeting_id", key("text").alias("_key")).distinct()
    new = actions.where(F.trim("action") != "").withColumn("_key", key("action")).join(known, ["meeting_id", "_key"], "left_anti")
    new = new.groupBy("meeting_id", "_key").agg(F.min("seq").alias("seq"), F.min_by(F.trim("action"), "seq").alias("text"), F.min_by("confidence", "seq").alias("confidence"))
    new = new.select("meeting_id", F.lit(1).alias("_src"), "seq", F.substring("text", 1, 240).alias("text"), F.greatest(F.lit(0.45), F.coalesce("confidence", F.lit(0.0))).alias("confidence"))
    both = follow_up.select("meeting_id", F.lit(0).alias("_src"), "seq", "text", "confidence").unionByName(new)
    rank = F.row_number().over(Window.partitionBy("meeting_id").orderBy("_src", "seq"))
    return both.withColumn("rank", rank).where(F.col("rank") <= cap).select("meeting_id", "rank", "text", "confidence")


def baseline_summaries(turns: DataFrame, chunk_counts: DataFrame) -> DataFrame:
    """A summary a meeting without a model: turns, chunks, speakers with their turns, and sample points of the first six turns."""
    speakers = turns.groupBy("meeting_id", "speaker").agg(F.count("*").alias("n")).groupBy("meeting_id").agg(F.sum("n").alias("turns"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("speaker", "n"))), lambda x: F.concat(x["speaker"], F.lit(" ("), x["n"].cast("string"), F.lit(" turns)"))), ", ").alias("who"))
    text = F.trim("text")
    first = turns.where((F.col("turn_idx") < 6) & (text != "") & (text != "[inaudible]"))
    points = first.groupBy("meeting_id").agg(F.slice(F.transform(F.array_sort(F.collect_list(F.struct("turn_idx", F.substring(text, 1, 180).alias("t")))), lambda x: x["t"]), 1, 5).alias("key_points"))
    out = speakers.join(chunk_counts, "meeting_id", "left").join(points, "meeting_id", "left")
    said = F.format_string("Meeting %s processed offline. %d speaker-attributed turns across %d chunks. Detected speakers: %s.", F.col("meeting_id").cast("string"), "turns", F.coalesce("chunks", F.lit(0).cast("long")), "who")
    return out.select("meeting_id", said.alias("summary"), F.coalesce("key_points", F.array().cast(_STRINGS)).alias("key_points"))


def parse_summaries(responses: DataFrame) -> DataFrame:
    """The best summary object in each model response (meeting_id, text); of equal scores the later one.

    Every place with ``{`` is tried; an object counts if its summary is a string. Text after an object is ignored.
    Returns meeting_id, summary, key_points, discussion_points, follow_up, abstract, actions, decisions, problems.
    """
    found = F.pandas_udf(summaries, "array<struct<at:int,body:string>>")(F.col("text"))
    v = responses.select("meeting_id", F.inline(found)).select("meeting_id", "at", F.try_parse_json("body").alias("v"))
    v = v.where(F.schema_of_variant(F.try_variant_get("v", "$.summary", "variant")) == "STRING")
    texts = lambda name: F.coalesce(F.transform(F.try_variant_get("v", f"$.{name}", "array<variant>"), lambda x: F.coalesce(F.try_variant_get(x, "$.text", "string"), F.try_variant_get(x, "$.point", "string"), F.try_variant_get(x, "$.item", "string"), F.try_variant_get(x, "$", "string"))), F.array().cast(_STRINGS))
    names = {"discussion_points": 8, "follow_up": 8, "abstract": 6, "actions": 6, "decisions": 6, "problems": 6}
    lists = {n: T.clean_summary_list(texts(n), k) for n, k in names.items()}
    lists["follow_up"] = T.clean_summary_list(F.when(F.try_variant_get("v", "$.follow_up", "variant").isNotNull(), texts("follow_up")).otherwise(texts("followups")), 8)
    points = F.filter(F.transform(texts("key_points"), T.clean_summary), lambda x: (x != "") & ~(F.startswith(x, F.lit("{")) & F.contains(x, F.lit('"summary"'))))
    o = v.select("meeting_id", "at", T.clean_summary(F.try_variant_get("v", "$.summary", "string")).alias("summary"), points.alias("_points"), *[c.alias(n) for n, c in lists.items()])
    o = o.withColumn("discussion_points", F.when(F.size("discussion_points") == 0, F.col("_points")).otherwise(F.col("discussion_points"))).withColumn("key_points", F.slice("_points", 1, 5)).drop("_points")
    size = lambda c, k: F.least(F.size(c), F.lit(k))
    score = F.least(F.floor(F.length("summary") / 40), F.lit(5)) + size("key_points", 5) + size("discussion_points", 6) + size("follow_up", 4) + F.when(F.contains("summary", F.lit("JSON:")), 0).otherwise(2) + F.when(F.startswith("summary", F.lit("{")), 0).otherwise(2)
    o = o.withColumn("score", F.when(F.col("summary") == "", -1).otherwise(score))
    fields = [c for c in o.columns if c not in ("meeting_id", "at", "score")]
    return o.groupBy("meeting_id").agg(F.max_by(F.struct(*fields), F.struct("score", "at")).alias("b")).select("meeting_id", "b.*")


def parse_extractions(responses: DataFrame) -> DataFrame:
    """Decisions, actions and flags of model responses (meeting_id, chunk_id, text) as JSON texts in arrays.

    The whole text is tried, then from its first ``{`` to its last ``}``; fields that aren't lists are empty.
    """
    t = F.trim("text")
    v = F.coalesce(F.try_parse_json(t), F.try_parse_json(F.regexp_extract(t, r"(?s)\{.*\}", 0)))
    parsed = responses.select("meeting_id", "chunk_id", v.alias("v")).where(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")))
    items = lambda name: F.transform(F.try_variant_get("v", f"$.{name}", "array<variant>"), lambda x: F.to_json(x))
    none = F.array().cast(_STRINGS)
    named = F.when(F.try_variant_get("v", "$.action_items", "variant").isNotNull(), items("action_items")).otherwise(items("actions"))
    return parsed.select("meeting_id", "chunk_id", F.coalesce(items("decisions"), none).alias("decisions"), F.coalesce(named, none).alias("action_items"), F.coalesce(items("flags"), none).alias("flags"))


def quality_checks(summaries: DataFrame, decisions: DataFrame, actions: DataFrame) -> DataFrame:
    """A row a summary (meeting_id, summary, key_points): whether it is there, and how many points, decisions and actions."""
    n = lambda rows, name: rows.groupBy("meeting_id").agg(F.count("*").alias(name))
    out = summaries.join(n(decisions, "_d"), "meeting_id", "left").join(n(actions, "_a"), "meeting_id", "left")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select(
        "meeting_id",
        (F.coalesce("summary", F.lit("")) != "").alias("summary_nonempty"),
        count(F.size("key_points")).alias("key_points_count"),
        F.lit(True).alias("schema_valid"),
        count(F.col("_d")).alias("extraction_decision_count"),
        count(F.col("_a")).alias("extraction_action_count"),
    )


#: What chunk and meeting prompts ask for; callers may give other words.
CHUNK_TASK = "Summarise this part of a meeting as JSON with the keys summary and key_points."
MEETING_TASK = "Write minutes as JSON with the keys summary, abstract, actions, decisions, problems, discussion_points, follow_up and key_points, from the evidence below."


def chunk_prompts(chunks: DataFrame, task: str = CHUNK_TASK) -> DataFrame:
    """(meeting_id, chunk_id, prompt) of each chunk's text without speaker labels."""
    said = F.concat_ws("\n", F.lit(task), F.concat(F.lit("Meeting ID: "), F.col("meeting_id").cast("string")), F.concat(F.lit("Chunk ID: "), "chunk_id"), F.lit("Transcript chunk:"), T.visible_text(F.col("text")), F.lit(""), F.lit("JSON:"))
    return chunks.select("meeting_id", "chunk_id", said.alias("prompt"))


def meeting_prompts(chunks: DataFrame, summaries: DataFrame, turns: DataFrame, most_summaries: int = 80, most_excerpts: int = 24, task: str = MEETING_TASK) -> DataFrame:
    """(meeting_id, prompt): the summaries of the first chunks, and excerpts of chunks that cover the meeting.

    ``chunks`` (meeting_id, idx, chunk_id, text), ``summaries`` (meeting_id, idx, summary), ``turns`` (meeting_id, turns).
    Both limits are the prompt's own; a prompt is one string.
    """
    from .sequence import coverage_chunks

    n = chunks.groupBy("meeting_id").agg(F.count("*").alias("n"))
    covered = coverage_chunks(chunks.join(n, "meeting_id").select("meeting_id", "idx", T.has_cue(F.col("text")).alias("cue"), "n"), most_excerpts).select("meeting_id", "idx")
    joined = lambda x: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", x.alias("x")))), lambda y: y["x"]), "\n\n")
    excerpts = chunks.join(covered, ["meeting_id", "idx"]).groupBy("meeting_id").agg(joined(F.concat(F.lit("["), "chunk_id", F.lit("] "), T.prompt_excerpt(F.col("text")))).alias("excerpts"))
    rank = F.row_number().over(Window.partitionBy("meeting_id").orderBy("idx"))
    body = summaries.withColumn("_k", rank).where(F.col("_k") <= most_summaries).groupBy("meeting_id").agg(joined(F.col("summary")).alias("body"))
    out = n.join(turns, "meeting_id").join(body, "meeting_id", "left").join(excerpts, "meeting_id", "left")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"))
    parts = (F.lit(task), line("Meeting ID", F.col("meeting_id")), line("Turn count", F.col("turns")), line("Chunk count", F.col("n")), F.lit("Evidence summaries:"), F.coalesce("body", F.lit("")), F.lit(""), F.lit("Coverage-oriented raw transcript excerpts:"), F.coalesce("excerpts", F.lit("")), F.lit(""), F.lit("JSON:"))
    return out.select("meeting_id", F.concat_ws("\n", *parts).alias("prompt"))


def extraction_prompts(selected: DataFrame, chunks: DataFrame) -> DataFrame:
    """A prompt text for each selected chunk: the texts of the previous, the focus and the next chunk without labels."""
    texts = chunks.select("meeting_id", "chunk_id", T.visible_text(F.col("text")).alias("x"))
    near = lambda c, name: (selected.select("meeting_id", "chunk_id", F.col(c).alias("_n")).join(texts.select("meeting_id", F.col("chunk_id").alias("_n"), F.col("x").alias(name)), ["meeting_id", "_n"]).drop("_n"))
    out = selected.select("meeting_id", "chunk_id", "idx").join(texts.withColumnRenamed("x", "focus"), ["meeting_id", "chunk_id"]).join(near("prev_chunk_id", "prev"), ["meeting_id", "chunk_id"], "left").join(near("next_chunk_id", "next"), ["meeting_id", "chunk_id"], "left")
    said = F.format_string("Chunk %s\nPrevious: %s\nFocus: %s\nNext: %s", "chunk_id", F.coalesce("prev", F.lit("")), "focus", F.coalesce("next", F.lit("")))
    return out.select("meeting_id", "chunk_id", "idx", said.alias("prompt"))


def minutes_html(summaries: DataFrame) -> DataFrame:
    """meeting_id and an HTML page of (summary, discussion_points, follow_up: arrays of text and evidence_snippets, key_points)."""
    e = T.html_escape
    listed = lambda c: F.array_join(F.transform(c, lambda p: F.concat(F.lit("<li><strong>"), e(p["text"]), F.lit("</strong>"), F.when(F.size(p["evidence_snippets"]) > 0, F.concat(F.lit("\n<ul>\n"), F.array_join(F.transform(p["evidence_snippets"], lambda s: F.concat(F.lit("<li><em>"), e(s), F.lit("</em></li>"))), "\n"), F.lit("\n</ul>\n"))).otherwise("\n"), F.lit("</li>"))), "\n")
    page = F.concat(
        F.lit("<html><head><meta charset='utf-8'><title>MoM Summary</title></head><body>\n<h1>Meeting "), F.col("meeting_id").cast("string"), F.lit("</h1>\n<h2>Summary</h2>\n<p>"), e(F.col("summary")), F.lit("</p>\n<h2>Discussion Points</h2><ul>\n"), listed("discussion_points"), F.lit("\n</ul>\n<h2>Follow Up</h2><ul>\n"), listed("follow_up"),
        F.lit("\n</ul>\n<h2>Key Points</h2><ul>\n"), F.array_join(F.transform("key_points", lambda s: F.concat(F.lit("<li>"), e(s), F.lit("</li>"))), "\n"), F.lit("\n</ul></body></html>"),
    )
    return summaries.select("meeting_id", page.alias("html"))
