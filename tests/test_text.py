"""Worked examples of the text expressions."""

from pyspark.sql import functions as F

from convspark.functions import text as T
from convspark.operators import extraction
from convspark.sources import files


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x"))).first()[0]


def test_normalisation(spark):
    assert one(spark, " uh  We   should   do this  ", T.normalize_transcript) == "We should do this"
    assert one(spark, "SPEAKER_1: Hello, [noise] World-7!", T.normalize_eval) == "hello world 7"
    assert one(spark, "a\nb", T.first_line) == "a"
    assert one(spark, "x\nSPEAKER_3: go by Friday", T.owner_of) == "SPEAKER_3"
    assert one(spark, "by 12/5 or so", T.due_date_of) == "12/5"
    assert one(spark, "nothing", T.due_date_of) is None


def test_predicates(spark):
    follow = lambda c: T.is_low_quality_point(c, "follow_up")
    assert not one(spark, "Review cost assumptions before next meeting", follow)
    assert one(spark, "They talked about the cost of it", follow)
    assert one(spark, "yeah ok", lambda c: T.is_low_quality(c, "decision"))
    assert one(spark, "find a fruit like shape", T.is_speculative_action)
    assert one(spark, "We'll say let's decide", T.has_cue)
    assert one(spark, "Take decision and concept", lambda c: T.normalize_point(c, "follow_up")) == "Decide on the concept direction"
    assert one(spark, "We will define the next next task.", lambda c: T.normalize_point(c, "follow_up")) == "Define tasks before the next meeting"


def test_summaries(spark):
    said = "The meeting focused on costs. The team agreed to finalize the budget"
    assert one(spark, said, lambda c: T.normalize_narrative(c, F.lit(False))) == "The team discussed costs. The team discussed plans to finalize the budget"
    assert one(spark, said, lambda c: T.normalize_narrative(c, F.lit(True))) == "The team discussed costs. The team agreed to finalize the budget"
    out = one(spark, "The group met.", lambda c: T.finalize_narrative(c, F.lit("Using a wheel interface"), F.lit("Prepare a prototype for the next meeting")))
    assert out == "The group met. The group made decisions on using a wheel interface. Follow-up work included plans to prepare a prototype for the next meeting."
    snippet = one(spark, "SPEAKER_1: we will build SPEAKER_2: a prototype soon", lambda c: T.evidence_snippet(c, F.lit("build a prototype")))
    assert snippet == "we will build a prototype soon"
    assert one(spark, "", T.snippet_quality) == 0.0
    assert one(spark, "a<b & 'c'", T.html_escape) == "a&lt;b &amp; &#39;c&#39;"


def test_select_chunks(spark):
    rows = [("m", i, f"c{i + 1}", "I will prepare it" if i == 2 else "plain text") for i in range(7)]
    got = {r.chunk_id: (r.prev_chunk_id, r.next_chunk_id) for r in extraction.select_chunks(spark.createDataFrame(rows, "meeting_id string, idx int, chunk_id string, text string")).collect()}
    assert got["c3"] == ("c2", "c4") and len(got) == 7


def test_responses(spark):
    first, second = '{"summary": "Short", "key_points": []}', '{"summary": "A longer summary of everything that was said there", "key_points": ["one", {"text": "two"}], "follow_up": "x"}'
    df = spark.createDataFrame([("a", f"noise {first} JSON: {second} tail {{"), ("b", "nothing"), ("c", '{"summary": {"x": 1}}')], "meeting_id string, text string")
    got = extraction.parse_summaries(df).collect()
    assert [(r.meeting_id, r.summary, r.key_points, r.follow_up) for r in got] == [("a", "A longer summary of everything that was said there", ["one", "two"], [])]
    df = spark.createDataFrame([("a", "c", 'Sure {"decisions": [{"decision": "d"}], "actions": ["x"], "flags": 3} ok'), ("b", "c", "[1]")], "meeting_id string, chunk_id string, text string")
    got = extraction.parse_extractions(df).collect()
    assert [(r.decisions, r.action_items, r.flags) for r in got] == [(['{"decision":"d"}'], ['"x"'], [])]


def test_confidence(spark):
    lists = ", ".join(f"{n} array<{'array<double>' if n == 'frame_confidence' else 'double'}>" for n in files.LIST_FIELDS)
    schema = ", ".join(f"{n} double" for n in files.SINGLE_FIELDS) + f", {lists}"
    row = lambda **x: tuple(x.get(n) for n in (*files.SINGLE_FIELDS, *files.LIST_FIELDS))
    rows = [
        row(word_confidence=[0.75, 0.85]), row(frame_confidence=[[0.4], [0.6, 2.0]]), row(confidence=0.3), row(score=-1.0), row(), row(token_confidences=[0.1, 7.0]), row(char_confidence=[0.2], char_confidences=[0.9]), row(char_confidences=[0.9]),
        row(confidence=float("nan"), score=-50.0), row(score=float("-inf"), token_confidence=[0.5]), row(confidence=0.12345678),
    ]
    got = [r[0] for r in spark.createDataFrame(rows, schema).select(files.confidence(F.struct("*"))).collect()]
    assert got == [0.8, 0.5, 0.3, 0.367879, 0.0, 0.1, 0.2, 0.9, 0.0, 0.5, 0.123457]


def test_json_objects():
    import json
    import random
    import time

    from convspark.functions.json_objects import objects

    def naive(text):
        out = []
        for i, c in enumerate(text):
            if c == "{":
                try:
                    out.append((i, json.JSONDecoder(parse_constant=lambda _: None).raw_decode(text[i:])[0]))
                except (ValueError, RecursionError):
                    pass
        return out

    r = random.Random(6)
    pieces = ['{', '}', '"', '\\', ':', ',', '[', ']', '"a"', '"summary": ', '{"a": 1}', '{"a": {"b": "}"}}', '"{\\"x\\": 2}"', '{}', ' ', 'é', '\\{}', 'NaN', '{"s": "a\\"{}"}', "it's", "1"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(1, 25))) for _ in range(20_000)]
    texts += ['He said "ok {"summary": "x", "l": [{"y": {}}, {"y": "{"}]} and } more', '{"a": 1, "a": {"b": {}}, "c": {"summary": "z"}}', "{" * 50 + "}" * 50, '{"t": "{\\"summary\\": \\"x\\"}"} {"u": {}}']
    for t in texts:
        assert objects(t) == naive(t), t
    assert sum(len(naive(t)) > 1 for t in texts) > 100
    took = []
    for n in (25_000, 100_000):
        began = time.process_time()
        assert len(objects('noise { "summary" ' + '{"summary": "text", "key_points": ["a", {"text": "b"}]} JSON: ' * n)) == 2 * n
        objects("{" * n), objects('{"a":' * n), objects('"{' * n), objects("{}" * n + "\\{" * n)
        took.append(time.process_time() - began)
    assert took[1] < 6 * took[0] + 0.5
