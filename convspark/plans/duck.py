"""DuckDB forms of the adapters and of the text expressions, for the counterparts of queries."""

from __future__ import annotations

from ..functions import text as T
from ..sources.adapters import OTHER_SAYING, SAYINGS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


TURNS = r"""(SELECT conv_id AS meeting_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INT) AS turn_idx, role AS speaker, text AS text_raw,
  lower(regexp_replace(regexp_replace(text, '[^A-Za-z0-9]+', ' ', 'g'), '^ | $', '', 'g')) AS norm FROM conversations)"""
_MS = "(epoch_us(ts) - epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP))) // 1000"
TOKENS = f"""(SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS meeting_id, {_MS} AS start_ms, {_MS} + 1000 * (event_id % 600) AS end_ms,
  CASE user_id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE 'D' END AS speaker_letter, event_type AS text, event_type = 'error' AS is_punc, event_id AS seq FROM events)"""
HYP = f"""(SELECT meeting_id, start_ms + 1000 * (seq % 7) AS start_ms, end_ms - 1000 * (seq % 5) AS end_ms,
  'SPEAKER_' || CASE WHEN seq % 11 = 0 THEN '1' WHEN speaker_letter = 'A' THEN '2' WHEN speaker_letter = 'B' THEN '3' WHEN speaker_letter = 'C' THEN '4' ELSE '1' END AS speaker,
  CAST(seq % 100 AS DOUBLE) / 100 AS confidence, seq FROM {TOKENS} WHERE end_ms - 1000 * (seq % 5) > start_ms + 1000 * (seq % 7))"""
PAIRS = """(SELECT a.conv_id AS pair_meeting, a.turn AS pair_id, a.text AS ref, b.text AS hyp FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"""
_SAID = "CASE text " + " ".join(f"WHEN {q(k)} THEN {q(w)}" for k, w in SAYINGS) + f" ELSE {q(OTHER_SAYING)} END"
TRANSCRIPT = f"""(SELECT meeting_id, CAST(row_number() OVER (PARTITION BY meeting_id ORDER BY start_ms, seq) - 1 AS INT) AS turn_idx, 'SPEAKER_' || (seq % 4 + 1) AS speaker,
  start_ms, end_ms, {_SAID} || (seq % 50) AS text_raw, seq FROM {TOKENS})"""
EVENTS = "(SELECT l_orderkey AS run_id, l_linenumber AS stage_no, CASE WHEN l_returnflag = 'R' THEN 'error' ELSE 'ok' END AS status, CAST(l_quantity AS DOUBLE) AS elapsed_sec, l_shipdate AS ts FROM lineitem)"
RUNS = "(SELECT o_orderkey AS run_id, o_custkey AS meeting_id, CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'ok' ELSE 'skipped' END AS status, o_orderdate AS started_at, CAST(o_totalprice AS DOUBLE) AS metric FROM orders)"
FILES = "(SELECT source AS meeting_id, CAST(doc_id AS VARCHAR) AS path, text AS content, n_chars AS size_bytes FROM documents)"


def collapse(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def normalize_transcript(x: str) -> str:
    return collapse(rf"regexp_replace({collapse(x)}, '\buh\b|\bum\b', '', 'gi')")


def normalize_eval(x: str) -> str:
    return collapse(rf"regexp_replace(regexp_replace(regexp_replace(lower({x}), '\[[^\]]+\]', ' ', 'g'), 'speaker_\d+:', ' ', 'g'), '[^a-z0-9\s]', ' ', 'g')")


def eval_words(x: str) -> str:
    return f"list_filter(string_split({normalize_eval(x)}, ' '), lambda w: w <> '')"


def word_count(x: str) -> str:
    return rf"len(list_filter(regexp_split_to_array({x}, '\s+'), lambda w: w <> ''))"


def alpha_words(x: str) -> str:
    return f"regexp_extract_all({x}, '([a-zA-Z'']+)', 1)"


def terms(x: str) -> str:
    return f"list_distinct(regexp_extract_all(lower({x}), '([a-z][a-z0-9_-]{{2,}})', 1))"


def keywords(x: str) -> str:
    return f"list_filter({terms(x)}, lambda w: w NOT IN ({', '.join(map(q, T.STOP_WORDS))}))"


def matches(x: str, patterns) -> str:
    return f"regexp_matches({x}, {q('|'.join(patterns))})"


def holds(x: str, phrases) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(p)})" for p in phrases) + ")"


def starts(x: str, prefixes) -> str:
    return "(" + " OR ".join(f"starts_with({x}, {q(p)})" for p in prefixes) + ")"


def key(x: str) -> str:
    return rf"regexp_replace(lower(trim({x})), '\s+', ' ', 'g')"


def first_line(x: str) -> str:
    return f"substring(trim(string_split({x}, chr(10))[1]), 1, 220)"


def low_quality(x: str, kind: str) -> str:
    s = f"trim({x})"
    out = rf"(len({alpha_words(s)}) < 3 OR length({key(s)}) < 12 OR regexp_matches(lower({s}), '^speaker_\d+\s*:?\s*$') OR lower({s}) IN ({', '.join(map(q, T.BAD_EXACT))}) OR ({starts(f'lower({s})', T.BAD_PREFIXES)} AND len({alpha_words(s)}) < 6)"
    if kind == "action":
        out += f" OR (starts_with(lower({s}), 'speaker_') AND len({alpha_words(s)}) < 6)"
    return out + ")"


def low_point(x: str, kind: str) -> str:
    out = f"({low_quality(x, 'decision')} OR len({alpha_words(x)}) < 4 OR {holds(key(x), T.NOISY_PHRASES)} OR {holds(key(x), T.BRAINSTORM_PHRASES)}"
    if kind == "follow_up":
        out += f" OR (NOT ends_with(trim({x}), '?') AND (NOT {holds(key(x), T.FUTURE_CUES)} OR coalesce(lower({alpha_words(x)}[1]) NOT IN ({', '.join(map(q, T.FOLLOW_UP_VERBS))}), true))) OR {holds(key(x), T.SPECULATIVE_PHRASES)}"
    return out + ")"


def speculative(x: str) -> str:
    return f"({holds(key(x), T.SPECULATIVE_PHRASES)} OR ({starts(key(x), ('find a ', 'find an ', 'find some '))} AND NOT contains({key(x)}, 'next ') AND NOT contains({key(x)}, 'before ')))"


def visible(x: str, by: str = "") -> str:
    return collapse(rf"regexp_replace({x}, '\bSPEAKER_\d+\s*:\s*', {q(by)}, 'gi')")


def extraction_score(x: str, cues: str) -> str:
    phrases = " + ".join(f"3 * CAST(regexp_matches(lower({x}), {q(p)}) AS INT)" for p in T.SCORED_PATTERNS)
    return f"({phrases} + least(len(list_intersect({terms(x)}, {cues})), 6) + least(len({alpha_words(x)}) // 40, 2))"


def point_score(p: str, x: str) -> str:
    first = f"list_filter(regexp_extract_all(lower({p}), '([a-z][a-z0-9_-]{{2,}})', 1), lambda w: w NOT IN ({', '.join(map(q, T.FIRST_TERM_STOPS))}))[1]"
    return rf"(least(len(list_intersect({keywords(p)}, {terms(x)})), 8) + 2 * CAST(coalesce(regexp_matches(lower({x}), '\b' || {first} || '\b'), false) AS INT))"


def downranked(s: str, conf: str) -> str:
    v = f"CAST(round_even({s} * (0.55 + 0.45 * coalesce({conf}, 0.5)), 0) AS INT)"
    return f"CASE WHEN {s} <= 0 THEN 0 WHEN {v} <= 0 AND {s} >= 3 THEN 1 ELSE {v} END"


def chunks(turns: str, target: int = 220, overlap: int = 40) -> str:
    """CTEs ending in ``chunks`` (meeting_id, chunk_no, chunk_id, s, e, text, start_ms, end_ms) of turns (meeting_id, turn_idx, speaker, text, words, start_ms, end_ms)."""
    return f"""tt AS {turns},
mm AS (SELECT meeting_id, count(*) AS n, list(words ORDER BY turn_idx) AS w, list(speaker || ': ' || text ORDER BY turn_idx) AS lines, list(start_ms ORDER BY turn_idx) AS st, list(end_ms ORDER BY turn_idx) AS en FROM tt GROUP BY meeting_id),
pp AS (SELECT *, list_transform(range(0, n + 1), lambda i: coalesce(list_sum(w[1:i]), 0)) AS p FROM mm),
cc(meeting_id, k, s, e) AS (
  SELECT meeting_id, 1, 0, coalesce(list_min(list_filter(range(1, n), lambda x: p[x + 2] - p[1] > {target})), n) FROM pp
  UNION ALL
  SELECT c.meeting_id, k + 1, z.ns, coalesce(list_min(list_filter(range(z.ns + 1, n), lambda x: p[x + 2] - p[z.ns + 1] > {target})), n)
  FROM cc c JOIN pp USING (meeting_id), LATERAL (SELECT CASE WHEN b = c.s THEN c.e ELSE b END AS ns FROM (SELECT list_min(list_filter(range(c.s, c.e + 1), lambda x: p[c.e + 1] - p[x + 1] <= {overlap})) AS b)) z
  WHERE c.e < n),
chunks AS (SELECT meeting_id, k AS chunk_no, meeting_id || '_chunk_' || lpad(CAST(k AS VARCHAR), CAST(greatest(4, length(CAST(k AS VARCHAR))) AS INT), '0') AS chunk_id, s, e, array_to_string(lines[s + 1:e], chr(10)) AS text, st[s + 1] AS start_ms, en[e] AS end_ms FROM cc JOIN pp USING (meeting_id))"""


TURN_TABLE = f"(SELECT meeting_id, turn_idx, speaker, norm AS text, {word_count('norm')} AS words, turn_idx * 1000 AS start_ms, turn_idx * 1000 + 1000 AS end_ms FROM {TURNS} z)"
TRANSCRIPT_TABLE = f"(SELECT meeting_id, turn_idx, speaker, {normalize_transcript('text_raw')} AS text, {word_count(normalize_transcript('text_raw'))} AS words, start_ms, end_ms FROM {TRANSCRIPT} z)"
#: Each turn of the transcript as a chunk of its own.
LINES = f"(SELECT meeting_id, turn_idx AS idx, meeting_id || '_' || turn_idx AS chunk_id, speaker || ': ' || text_raw AS text, text_raw, start_ms, end_ms FROM {TRANSCRIPT} z)"


def snippets(src: str, text: str, point: str) -> str:
    """Rows of src with ``snippet``, the window of the text around the point's first word."""
    return rf"""(SELECT *, CASE WHEN sn_pos = 0 THEN substring(sn_t, 1, 160) ELSE substring(CASE WHEN sn_s > 0 THEN '...' ELSE '' END || trim(substring(sn_t, sn_s + 1, sn_e - sn_s)) || CASE WHEN sn_e < length(sn_t) THEN '...' ELSE '' END, 1, 160) END AS snippet FROM (
  SELECT *, greatest(0, sn_pos - 46) AS sn_s, least(length(sn_t), sn_pos - 1 + length(sn_w) + 95) AS sn_e FROM (SELECT *, CASE WHEN sn_w <> '' AND regexp_matches(lower(sn_t), '\b' || sn_w || '\b') THEN length(regexp_extract(lower(sn_t), '^(.*?)\b' || sn_w || '\b', 1)) + 1 ELSE 0 END AS sn_pos FROM (
  SELECT *, {visible(text, ' ')} AS sn_t, lower(regexp_extract({point}, '([A-Za-z'']+)', 1)) AS sn_w FROM {src} sn_0))))"""


def snippet_quality(x: str) -> str:
    n = f"len(regexp_extract_all({x}, '[A-Za-z'']+'))"
    return rf"CASE WHEN {n} = 0 THEN 0.0 ELSE round_even(least(1.0, {n} / 20.0) * greatest(0.2, len(regexp_extract_all({x}, '[A-Za-z\s]')) / greatest(1, length({x}))), 3) END"


def normalize_follow_up(x: str) -> str:
    said = "CASE " + " ".join(f"WHEN regexp_matches({key(x)}, {q(p)}) THEN {q(w)}" for p, w in T.POINT_REWRITES) + f" ELSE {collapse(x)} END"
    bare = rf"regexp_replace(regexp_replace({said}, '(?i)\bto be done\b', '', 'g'), '(?i)^(?:we will|we should|we need to)\s+', '')"
    return rf"substring(regexp_replace(regexp_replace({bare}, '\s+', ' ', 'g'), '^[ .,:;-]+|[ .,:;-]+$', '', 'g'), 1, 240)"


def clean_items(x: str, limit: int) -> str:
    """Distinct entries that aren't blank, in order; told apart before they are cut."""
    return f"list_transform(list_slice(list_filter({x}, lambda v, i: v <> '' AND list_position({x}, v) = i), 1, {limit}), lambda v: substring(v, 1, 240))"


def html(x: str) -> str:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        x = f"replace({x}, {q(a)}, {q(b)})"
    return x
