"""The stream of run updates: what changes is said once, and nothing is kept of a run that is over."""

import json
import time

from convspark.schemas import TRACE
from convspark.streaming import progress, runs


def test_run_updates(spark, tmp_path):
    src, checkpoint, got = tmp_path / "events", str(tmp_path / "cp"), []
    src.mkdir()

    def feed(name, *events, ttl_ms=3_600_000):
        (src / f"{name}.json").write_text("\n".join(json.dumps({"meeting_id": "m", **e}) for e in events))
        got.clear()
        q = runs.watch_runs(runs.run_updates(progress.trace_stream(spark, str(src)), 3, ttl_ms), lambda b, _: got.extend(map(tuple, b.collect())), checkpoint, once=True)
        q.awaitTermination(120)
        return q.lastProgress.stateOperators[0].numRowsTotal

    start = lambda s, ts: {"stage": s, "event": "stage_start", "ts_unix": ts}
    end = lambda s, status="ok": {"stage": s, "event": "stage_end", "status": status, "elapsed_sec": 1.5}
    assert feed("1", start("a", 1.0), start("b", 2.0), {**start("x", 1.0), "meeting_id": None}) == 1
    assert got == [("m", "running", 0, 0, 2, 1, '{"a": "running", "b": "running"}')]
    assert feed("2", start("a", 1.0)) == 1 and got == []  # a duplicate says nothing new
    assert feed("3", end("a")) == 1 and got == [("m", "running", 1, 0, 1, 1, '{"a": "completed", "b": "running"}')]
    feed("4", start("a", 9.0))  # a start after the end: the end stands
    assert got == []
    feed("5", end("b", "error"), start("c", 3.0), {"meeting_id": "n", "event": "run_end", "status": "cancelled"})
    assert sorted(got) == [("m", "running", 1, 1, 1, 0, '{"a": "completed", "b": "failed", "c": "running"}'), ("n", "cancelled", 0, 0, 0, 3, "{}")]
    assert feed("6", end("c")) == 2 and got == [("m", "failed", 2, 1, 0, 0, '{"a": "completed", "b": "failed", "c": "completed"}')]
    assert feed("7", start("d", 99.0), end("d"), {"event": "run_end", "status": "completed"}) == 2 and got == []  # late ones of a run that is over


def test_state_goes(spark, tmp_path):
    src, got = tmp_path / "events", []
    src.mkdir()
    left = []
    for k, rows in enumerate([[{"meeting_id": f"m{i}", "event": "run_end", "status": "ok"} for i in range(20)], [{"meeting_id": "z", "event": "other"}]]):
        (src / f"{k}.json").write_text("\n".join(json.dumps(r) for r in rows))
        q = runs.watch_runs(runs.run_updates(spark.readStream.schema(TRACE).json(str(src)), 3, ttl_ms=3000), lambda b, _: got.extend(map(tuple, b.collect())), str(tmp_path / "cp"), once=True)
        q.awaitTermination(120)
        left.append(q.lastProgress.stateOperators[0].numRowsTotal)
        time.sleep(4)
    assert len(got) == 20 and left == [20, 0]


def test_runs_of_a_bucket(spark, tmp_path):
    """Runs that share a value of the state are told apart, and each goes by its own time."""
    src, got, left = tmp_path / "events", [], []
    src.mkdir()
    old = [{"meeting_id": f"o{i}", "event": "run_end", "status": "ok"} for i in range(50)]
    open_ = [{"meeting_id": f"r{i}", "stage": "a", "event": "stage_start", "ts_unix": 1.0} for i in range(50)]
    ends = [{"meeting_id": f"r{i}", "stage": "a", "event": "stage_end", "status": "ok" if i % 2 else "error"} for i in range(50)]
    for k, rows in enumerate([old + open_, ends + open_ + old, old[:1]]):
        time.sleep(8 * (k == 2))
        (src / f"{k}.json").write_text("\n".join(json.dumps(r) for r in rows))
        got.clear()
        q = runs.watch_runs(runs.run_updates(progress.trace_stream(spark, str(src)), 2, ttl_ms=600_000 if k < 2 else 4000, buckets=1), lambda b, _: got.extend(map(tuple, b.collect())), str(tmp_path / "cp"), once=True)
        q.awaitTermination(120)
        left.append(q.lastProgress.stateOperators[0].numRowsTotal)
        want = [[(f"o{i}", "completed", 0, 0, 0, 2, "{}") for i in range(50)] + [(f"r{i}", "running", 0, 0, 1, 1, '{"a": "running"}') for i in range(50)]]
        want += [[(f"r{i}", "running", i % 2, 1 - i % 2, 0, 1, '{"a": "%s"}' % ("completed" if i % 2 else "failed")) for i in range(50)]]
        want += [[("o0", "completed", 0, 0, 0, 2, "{}")]]  # heard of for the first time again
        assert sorted(got) == sorted(want[k])
    assert left == [1, 1, 1]
