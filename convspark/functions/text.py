"""Text expressions over transcript and summary columns; all stay in the JVM.

Null texts give null unless a function says otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word lists, phrases and patterns that decide results.
FILLERS = r"(?i)\buh\b|\bum\b"
STOP_WORDS = (
    "speaker", "meeting", "discussion", "team", "project", "product", "design", "remote", "control", "controls", "their",
    "there", "about", "with", "from", "this", "that", "they", "have", "will", "should",
)
BASE_CUES = ("decide", "decided", "agree", "agreed", "action", "need", "will", "should", "next", "todo", "follow", "plan", "task")
CUE_PATTERNS = (
    r"\bwe should\b", r"\bwe need to\b", r"\bi will\b", r"\bi'll\b", r"\blet'?s\b", r"\bdecid(?:e|ed)\b", r"\bagree(?:d)?\b",
    r"\baction item\b", r"\bnext step\b", r"\bfollow up\b", r"\bcan you\b", r"\byou can\b", r"\byou should\b",
)
SCORED_PATTERNS = (
    r"\bwe should\b", r"\bwe need to\b", r"\bi will\b", r"\blet'?s\b", r"\bdecid(?:e|ed)\b", r"\bagree(?:d)?\b",
    r"\baction item\b", r"\bnext step\b", r"\bfollow up\b", r"\bcan you\b",
)
DECISION_PATTERNS = (r"\bwe should\b", r"\blet'?s\b", r"\bdecid(?:e|ed)\b", r"\bagree(?:d)?\b")
ACTION_PATTERNS = (r"\bi will\b", r"\bwe need to\b", r"\bcan you\b", r"\byou should\b")
DUE_PATTERN = r"(?i)\b(monday|tuesday|wednesday|thursday|friday|next week|tomorrow|\d{1,2}/\d{1,2})\b"
BAD_EXACT = ("okay", "ok", "alright", "right", "so", "yeah", "yes", "no", "speaker_0:", "speaker_1:", "speaker_2:", "speaker_3:", "speaker_4:")
BAD_PREFIXES = ("okay ", "ok ", "right ", "so ", "yeah ", "yes ", "no ")
NOISY_PHRASES = ("speaker_", "warnings for next meetings", "suggested shades or whatever", "or whatever")
BRAINSTORM_PHRASES = (
    "fruit that is spongy", "kind of fruit", "what kind of fruit", "fruit-based remote", "control tv with a fruit",
    "banana-shaped remote control", "banana shaped remote control", "spongy material for the remote",
    "spongy material for the remote's surface", "spongy materials for the remote's surface",
)
SPECULATIVE_PHRASES = ("fruit like", "kind of fruit", "what kind of fruit", "control tv with", "spongy fruit", "banana-shaped remote control", "banana shaped remote control")
WEAK_KEY_POINTS = ("banana-shaped remote control", "banana shaped remote control", "spongy material", "spongy materials", "spongy fruit")
FUTURE_CUES = (
    "next ", "follow up", "review ", "check ", "analyze ", "investigate ", "compare ", "evaluate ", "plan ", "later", "future",
    "before ", "open question", "question",
)
FOLLOW_UP_VERBS = (
    "review", "check", "investigate", "compare", "evaluate", "define", "prepare", "present", "confirm", "plan", "decide",
    "finalize", "finalise", "schedule", "clarify",
)
CANDIDATE_CUES = ("next ", "follow up", "review ", "check ", "analyze ", "investigate ", "compare ", "evaluate ", "before ", "question", "should", "need to")
POINT_REWRITES = (
    (r"\bshow (?:us )?(?:the )?various investigation(?:s)? (?:they(?:'ve| have)? )?done during (?:preview|previous work)\b", "Review prior investigation findings"),
    (r"\btake decision and concept\b", "Decide on the concept direction"),
    (r"\bdefine the next task to be done before the next meeting\b", "Define tasks before the next meeting"),
    (r"\bdefine the next next task\b", "Define tasks before the next meeting"),
)
DECISION_WORDS = (" agreed ", " decided ", " decision ", " chose ", " chosen ", " selected ", " finalized ", " finalised ", " consensus ")
CLAIMS = ("agreed to", "agreed on", "decided to", "finalized", "finalised")
DOWNGRADES = ((r"(?i)\bagreed to\b", "discussed plans to"), (r"(?i)\bagreed on\b", "discussed"), (r"(?i)\bdecided to\b", "discussed plans to"), (r"(?i)\bfinali[sz]ed\b", "discussed"))
REPHRASES = ((r"(?i)\bthe meeting focused on\b", "The team discussed"), (r"(?i)\bthe meeting was about\b", "The team discussed"), (r"(?i)\bwith a focus on\b", "including"))
FIRST_TERM_STOPS = ("the", "and", "for", "with", "that", "this")
PLAN_VERBS = ("prepare ", "review ", "compare ", "evaluate ", "define ", "confirm ", "plan ")
NO_RESULT_FLAGS = ("no clear decisions or action items", "no decisions or action items", "no action items", "no actions")

_WORD = r"([A-Za-z][A-Za-z0-9_-]{2,})"


def bound(value: Column, f) -> Column:
    """f(value) with the value computed once, however often f uses it (also inside lambdas)."""
    return F.transform(F.array(value), f)[0]


def any_of(conditions: Iterable[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def holds_any(text: Column, phrases: Iterable[str]) -> Column:
    return any_of(F.contains(text, F.lit(p)) for p in phrases)


def starts_with_any(text: Column, prefixes: Iterable[str]) -> Column:
    return any_of(F.startswith(text, F.lit(p)) for p in prefixes)


def matches_any(text: Column, patterns: Iterable[str]) -> Column:
    return text.rlike("|".join(patterns))


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def normalize_transcript(text: Column) -> Column:
    """Single spaces, without the fillers uh and um."""
    return collapse(F.regexp_replace(collapse(text), FILLERS, ""))


def normalize_eval(text: Column) -> Column:
    """The token space of scores: lower case a-z and 0-9, without bracketed notes and speaker labels."""
    s = F.regexp_replace(F.lower(text), r"\[[^\]]+\]", " ")
    s = F.regexp_replace(s, r"speaker_\d+:", " ")
    return collapse(F.regexp_replace(s, r"[^a-z0-9\s]", " "))


def split_words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def eval_words(text: Column) -> Column:
    return split_words(normalize_eval(text))


def word_count(text: Column) -> Column:
    return F.size(split_words(text))


def alpha_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"([a-zA-Z']+)"), F.lit(1))


def first_line(text: Column, limit: int = 220) -> Column:
    return F.substring(F.trim(F.split(text, "\n")[0]), 1, limit)


def owner_of(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"(?m)^(SPEAKER_\d+):", 1), F.lit(""))


def due_date_of(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, DUE_PATTERN, 1), F.lit(""))


def visible_text(text: Column) -> Column:
    """Without speaker labels, for prompts."""
    return collapse(F.regexp_replace(text, r"(?i)\bSPEAKER_\d+\s*:\s*", ""))


def evidence_text(text: Column) -> Column:
    """Without speaker labels, each leaving a space."""
    return collapse(F.regexp_replace(text, r"(?i)\bSPEAKER_\d+\s*:\s*", " "))


def prompt_excerpt(text: Column, limit: int = 420) -> Column:
    t = visible_text(text)
    return F.when(F.length(t) <= limit, t).otherwise(F.concat(F.rtrim(F.substring(t, 1, limit - 3)), F.lit("...")))


def clean_summary(text: Column) -> Column:
    """Cuts what follows an echoed prompt, unwraps an echoed JSON object, and collapses white space; null gives ''."""
    t = F.trim(F.split(F.trim(F.coalesce(text, F.lit(""))), r"\bJSON:\b", 2)[0])
    inner = F.get_json_object(t, "$.summary")
    return collapse(F.when(F.startswith(t, F.lit("{")) & F.contains(t, F.lit('"summary"')) & inner.isNotNull(), F.trim(inner)).otherwise(t))


def clean_summary_list(items: Column, limit: int, cut: int = 240) -> Column:
    """Cleaned distinct entries without echoes; told apart before they are cut."""
    cleaned = F.filter(F.transform(items, clean_summary), lambda x: (x != "") & ~(F.startswith(x, F.lit("{")) & F.contains(x, F.lit('"summary"'))))
    return F.transform(F.slice(F.array_distinct(cleaned), 1, limit), lambda x: F.substring(x, 1, cut))


def keywords(text: Column) -> Column:
    """Distinct lower-case terms of three letters or more that aren't stop words."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_WORD), F.lit(1))
    return F.array_distinct(F.filter(found, lambda w: ~w.isin(*STOP_WORDS)))


def chunk_terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_WORD), F.lit(1)))


def has_cue(text: Column) -> Column:
    """Whether the text sounds like a decision or an action."""
    return matches_any(F.lower(F.coalesce(text, F.lit(""))), CUE_PATTERNS)


def dedupe_key(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(text)), r"\s+", " ")


def is_low_quality(text: Column, kind: str) -> Column:
    """Fragments, bare labels and acknowledgements; ``kind`` is decision or action."""
    s = F.trim(F.coalesce(text, F.lit("")))
    low, n = F.lower(s), F.size(alpha_words(s))
    bad = (n < 3) | (F.length(dedupe_key(s)) < 12) | low.rlike(r"^speaker_\d+\s*:?\s*$") | low.isin(*BAD_EXACT) | (starts_with_any(low, BAD_PREFIXES) & (n < 6))
    if kind == "action":
        bad = bad | (F.startswith(low, F.lit("speaker_")) & (n < 6))
    return bad


def is_low_quality_point(text: Column, kind: str) -> Column:
    """Weak summary points; a follow-up needs a future cue and a known first verb unless it is a question."""
    low = dedupe_key(F.coalesce(text, F.lit("")))
    words = alpha_words(F.coalesce(text, F.lit("")))
    bad = is_low_quality(text, "decision") | (F.size(words) < 4) | holds_any(low, NOISY_PHRASES) | holds_any(low, BRAINSTORM_PHRASES)
    if kind == "follow_up":
        asks = F.endswith(F.trim(text), F.lit("?"))
        verb = F.coalesce(F.lower(F.get(words, F.lit(0))).isin(*FOLLOW_UP_VERBS), F.lit(False))
        bad = bad | (~asks & (~holds_any(low, FUTURE_CUES) | ~verb)) | holds_any(low, SPECULATIVE_PHRASES)
    return bad


def is_low_quality_key_point(text: Column) -> Column:
    return is_low_quality_point(text, "discussion") | holds_any(dedupe_key(F.coalesce(text, F.lit(""))), WEAK_KEY_POINTS)


def is_speculative_action(text: Column) -> Column:
    low = dedupe_key(text)
    search = starts_with_any(low, ("find a ", "find an ", "find some ")) & ~F.contains(low, F.lit("next ")) & ~F.contains(low, F.lit("before "))
    return holds_any(low, SPECULATIVE_PHRASES) | search


def looks_like_follow_up(text: Column) -> Column:
    return holds_any(dedupe_key(text), CANDIDATE_CUES) | F.endswith(F.trim(text), F.lit("?"))


def normalize_point(text: Column, kind: str) -> Column:
    """Follow-ups that match a known phrase become its canonical form; leading we-phrases go."""
    t = clean_summary(text)
    if kind != "follow_up":
        return F.substring(t, 1, 240)
    low, out = dedupe_key(t), t
    for pattern, canonical in reversed(POINT_REWRITES):
        out = F.when(low.rlike(pattern), F.lit(canonical)).otherwise(out)
    out = F.regexp_replace(out, r"(?i)\bto be done\b", "")
    out = F.regexp_replace(out, r"(?i)^(?:we will|we should|we need to)\s+", "")
    return F.substring(F.regexp_replace(F.regexp_replace(out, r"\s+", " "), r"^[ .,:;-]+|[ .,:;-]+$", ""), 1, 240)


def normalize_narrative(summary: Column, has_decision_evidence: Column) -> Column:
    """Claims of decisions without evidence become discussions; stock openings are rephrased."""
    t = clean_summary(summary)
    lowered = t
    for pattern, said in DOWNGRADES:
        lowered = F.regexp_replace(lowered, pattern, said)
    t = F.when(holds_any(F.lower(t), CLAIMS) & ~F.coalesce(has_decision_evidence, F.lit(False)), lowered).otherwise(t)
    for pattern, said in REPHRASES:
        t = F.regexp_replace(t, pattern, said)
    return F.substring(collapse(t), 1, 600)


def evidence_snippet(chunk_text: Column, point: Column) -> Column:
    """A window of 45 characters before and 95 after the point's first word in the chunk, at most 160; else the start."""
    pair = F.struct(evidence_text(F.coalesce(chunk_text, F.lit(""))).alias("t"), F.lower(F.regexp_extract(F.coalesce(point, F.lit("")), r"([A-Za-z']+)", 1)).alias("w"))

    def cut(x: Column) -> Column:
        t, w, at = x["t"], x["w"], x["at"]
        start, end = F.greatest(F.lit(0), at - 1 - 45), F.least(F.length(t), at - 1 + F.length(w) + 95)
        window = F.concat(F.when(start > 0, "...").otherwise(""), F.trim(F.substr(t, start + 1, end - start)), F.when(end < F.length(t), "...").otherwise(""))
        return F.when(at > 0, F.substring(window, 1, 160)).otherwise(F.substring(t, 1, 160))

    place = lambda x: F.when(x["w"] == "", 0).otherwise(F.regexp_instr(x["t"], F.concat(F.lit(r"(?i)\b"), x["w"], F.lit(r"\b"))))
    return bound(bound(pair, lambda x: F.struct(x["t"].alias("t"), x["w"].alias("w"), place(x).alias("at"))), cut)


def snippet_quality(snippet: Column) -> Column:
    """min(1, words / 20) times the share of letters and spaces (0.2 at least)."""
    s = F.trim(F.coalesce(snippet, F.lit("")))
    n = F.regexp_count(s, F.lit("[A-Za-z']+"))
    alpha = F.regexp_count(s, F.lit(r"[\p{L}\s]")) / F.greatest(F.lit(1), F.length(s))
    return F.when(n == 0, 0.0).otherwise(F.bround(F.least(F.lit(1.0), n / 20.0) * F.greatest(F.lit(0.2), alpha), 3))


def bounded(value: Column, default: float) -> Column:
    """Within [0, 1], three decimals; what isn't a number is the default."""
    return F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(value.try_cast("double"), F.lit(default)))), 3)


def fallback_key_points(text: Column) -> Column:
    return F.slice(F.filter(F.transform(F.split(text, r"[.;]\s+"), lambda x: F.trim(x)), lambda x: x != ""), 1, 5)


def normalize_flags(flags: Column, has_decisions: Column, has_actions: Column) -> Column:
    """Drops flags that say nothing was found when something was."""
    low = lambda f: F.lower(f)
    found = F.filter(F.transform(flags, lambda x: F.trim(x)), lambda f: f != "")
    kept = F.filter(found, lambda f: ~((has_decisions | has_actions) & holds_any(low(f), NO_RESULT_FLAGS)) & ~(has_decisions & (F.contains(low(f), F.lit("no clear decisions")) | (low(f) == "no decisions"))))
    return F.transform(kept, lambda f: F.substring(f, 1, 120))


def html_escape(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def shares_phrase(text: Column, phrase: Column) -> Column:
    """Whether at least max(2, min(n, 4)) of the phrase's n distinct words are in the text."""
    own = F.array_distinct(eval_words(phrase))
    shared = F.size(F.array_intersect(F.array_distinct(eval_words(text)), own))
    return (F.size(own) > 0) & (shared >= F.greatest(F.lit(2), F.least(F.size(own), F.lit(4))))


def extraction_score(text: Column, cues: Column) -> Column:
    """3 a cue phrase, up to 6 for shared terms, up to 2 for length."""
    low = F.lower(F.coalesce(text, F.lit("")))
    phrases = sum((low.rlike(p).cast("int") * 3 for p in SCORED_PATTERNS), F.lit(0))
    return phrases + F.least(F.size(F.array_intersect(chunk_terms(text), cues)), F.lit(6)) + F.least(F.floor(F.size(alpha_words(F.coalesce(text, F.lit("")))) / 40), F.lit(2)).cast("int")


def first_term(point: Column) -> Column:
    """The point's first term that isn't a function word, in lower case; null if there is none."""
    found = F.regexp_extract_all(F.lower(F.coalesce(point, F.lit(""))), F.lit(_WORD), F.lit(1))
    return F.get(F.filter(found, lambda w: ~w.isin(*FIRST_TERM_STOPS)), F.lit(0))


def stands_in(term: Column, text: Column) -> Column:
    """Whether the term stands between word boundaries in the lower-case text."""
    return F.coalesce(F.regexp_like(text, F.concat(F.lit(r"\b"), term, F.lit(r"\b"))), F.lit(False))


def downranked(score: Column, confidence: Column) -> Column:
    """The score times 0.55 to 1 by the confidence (0.5 where unknown), and 1 at least from a score of 3."""
    conf = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(confidence, F.lit(0.5))))
    out = F.bround(score * (F.lit(0.55) + F.lit(0.45) * conf), 0).cast("int")
    return F.when(score <= 0, 0).when((out <= 0) & (score >= 3), 1).otherwise(out)


def finalize_narrative(summary: Column, decision: Column, action: Column) -> Column:
    """Adds a sentence for the first decision and action that the summary doesn't cover; four sentences, 600 characters."""
    text = collapse(F.coalesce(summary, F.lit("")))
    sentences = F.filter(F.split(text, r"(?<=[.!?])\s+"), lambda s: s != "")
    bare = lambda c: F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), r"\.+$", "")
    lead = lambda c: F.concat(F.lower(F.substring(c, 1, 1)), F.substr(c, F.lit(2)))
    d, a = bare(decision), bare(action)
    say_d = F.when((d != "") & ~shares_phrase(text, d), F.concat(F.lit("The group made decisions on "), lead(d), F.lit(".")))
    plans = F.concat(F.lit("Follow-up work included plans to "), F.lower(a), F.lit("."))
    say_a = F.when((a != "") & ~shares_phrase(text, a), F.when(starts_with_any(F.lower(a), PLAN_VERBS), plans).otherwise(F.concat(F.lit("Follow-up work included "), lead(a), F.lit("."))))
    extra = F.array_compact(F.array(say_d, say_a))
    return F.substring(F.when(F.size(extra) == 0, text).otherwise(F.trim(F.array_join(F.slice(F.concat(sentences, extra), 1, 4), " "))), 1, 600)


def reference_style_summary(abstract: Column, decisions: Column, actions: Column, problems: Column, fallback: Column) -> Column:
    """Up to four abstract sentences and one each of the rest: five at most, distinct, 600 characters."""
    take = lambda items, n: F.slice(F.filter(F.transform(F.coalesce(items, F.array().cast("array<string>")), clean_summary), lambda x: x != ""), 1, n)
    ended = lambda items: F.transform(items, lambda x: F.concat(F.regexp_replace(x, r"\.+$", ""), F.lit(".")))
    all_of = F.slice(F.array_distinct(F.concat(*[ended(take(c, n)) for c, n in ((abstract, 4), (decisions, 1), (actions, 1), (problems, 1))])), 1, 5)
    return F.when(F.size(all_of) == 0, fallback).otherwise(F.substring(F.array_join(all_of, " "), 1, 600))
