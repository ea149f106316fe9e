"""State of runs as a stream: an update whenever what is known of a run changed, until the run is over."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

#: Statuses after which nothing more is said of a run.
OVER = ("completed", "failed", "cancelled")
UPDATE = "meeting_id string, status string, completed long, failed long, running long, pending long, stages string"
_STATE = "runs string"
#: Groups of runs, by hash: a call of the state store costs milliseconds, and one for each run would be most of the time.
BUCKETS = 1 << 14


def _plain(stages: dict) -> str:
    return json.dumps({s: x[2] for s, x in sorted(stages.items())})


class Runs(StatefulProcessor):
    """The runs of a bucket: each one's stages so far, or only a mark that it is over, and when it was last heard of.

    A stage is running from its start, then completed or failed; an end beats any start, and of equal kinds the later one
    counts, so that events may come late, twice or in any order. The run is over with a ``run_end`` event or when ``total``
    stages have ended; then only a mark is left of it, by which late events are known, and the mark goes after ``ttl_ms``,
    as does a run of which nothing was heard for so long: from what is known of its bucket at the next change there, and
    with the bucket's value when nothing changes in it for so long.
    """

    def __init__(self, total: int, ttl_ms: int):
        self._total, self._ttl_ms = total, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._runs = handle.getValueState("runs", _STATE, ttlDurationMs=self._ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        stored = self._runs.get()
        known = {run: x for run, x in (json.loads(stored[0]) if stored else {}).items() if x[0] + self._ttl_ms > now}
        heard: dict[str, list] = {}
        for _, run, stage, event, status, ts in rows:
            x = heard.get(run)
            if x is None:
                old = known.get(run)
                if old is not None and old[1] is None:
                    continue
                x = heard[run] = [old[1] if old else {}, _plain(old[1]) if old else None, None]
            if event == "run_end":
                x[2] = max(x[2] or "", status if status in OVER else "completed" if status in (None, "ok") else "failed")
                continue
            ended = event == "stage_end"
            new = [int(ended), ts or 0.0, "running" if not ended else "completed" if status in (None, "ok") else "failed"]
            if stage not in x[0] or new[:2] > x[0][stage][:2]:
                x[0][stage] = new
        for run, (stages, before, end) in heard.items():
            states = [x[2] for x in stages.values()]
            completed, failed, running = (states.count(s) for s in ("completed", "failed", "running"))
            if end is None and self._total and completed + failed >= self._total:
                end = "failed" if failed else "completed"
            plain = _plain(stages)
            if end or plain != before:
                yield Row(meeting_id=run, status=end or "running", completed=completed, failed=failed, running=running, pending=self._total - len(states), stages=plain)
            known[run] = [now, None if end else stages]
        if heard:
            self._runs.update((json.dumps(known),))

    def close(self) -> None:
        pass


def run_updates(events: DataFrame, total: int, ttl_ms: int = 7 * 24 * 3600 * 1000, buckets: int = BUCKETS) -> DataFrame:
    """Updates of runs (see ``Runs``) from a stream of events (meeting_id, stage, event, status, ts_unix).

    Runs are dealt to ``buckets`` by hash. What is known of a bucket's runs is one value of the state, whatever the number of
    events; it is read and written once a batch. ``buckets`` must stay as it is while a checkpoint is used. Runs without
    an id are no runs.
    """
    e = events.where("event IN ('stage_start', 'stage_end', 'run_end') AND meeting_id IS NOT NULL AND (stage IS NOT NULL OR event = 'run_end')")
    bucket = F.pmod(F.xxhash64("meeting_id"), F.lit(buckets)).alias("bucket")
    e = e.select(bucket, "meeting_id", "stage", "event", "status", F.col("ts_unix").cast("double").alias("ts_unix"))
    return e.groupBy("bucket").transformWithState(statefulProcessor=Runs(total, ttl_ms), outputStructType=UPDATE, outputMode="Update", timeMode="ProcessingTime")


def watch_runs(updates: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False, every: str = "1 second") -> StreamingQuery:
    """Hands each batch of updates to the sink. State is held in RocksDB, on disk and in the checkpoint folder.

    Batches without events only let old state go; a query that runs once has none, or it would never stop.
    """
    conf = updates.sparkSession.conf
    wanted = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.sql.streaming.noDataMicroBatches.enabled": str(not once).lower()}
    before = {k: conf.get(k) for k in wanted}
    for k, v in wanted.items():
        conf.set(k, v)
    try:
        w = updates.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(sink)
        return (w.trigger(availableNow=True) if once else w.trigger(processingTime=every)).start()
    finally:
        for k, v in before.items():
            conf.set(k, v)
