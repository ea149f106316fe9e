"""Progress of runs as a stream of stage events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import TRACE


def trace_stream(spark: SparkSession, path: str, schema: str = TRACE) -> DataFrame:
    """New JSON event files below the path, as they arrive."""
    return spark.readStream.schema(schema).json(path)


def stage_states(events: DataFrame) -> DataFrame:
    """The state of each meeting's stages: running from a start, then completed or failed; an end beats any start.

    As a stream it runs in update mode, so that only stages whose state changed are emitted. Start events alone carry a
    time; within a run a stage has one start and one end, which is why the order needs no watermark.
    """
    order = F.struct((F.col("event") == "stage_end").alias("ended"), F.coalesce("ts_unix", F.lit(0.0)).alias("ts"))
    g = events.where("event IN ('stage_start', 'stage_end')").groupBy("meeting_id", "stage").agg(F.max_by(F.struct("event", "status", "elapsed_sec"), order).alias("x"))
    state = F.when(F.col("x.event") == "stage_start", "running").when(F.coalesce("x.status", F.lit("ok")) == "ok", "completed").otherwise("failed")
    return g.select("meeting_id", "stage", state.alias("state"), "x.elapsed_sec")


def watch(events: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False) -> StreamingQuery:
    """Hands each batch of changed stages to the sink."""
    w = stage_states(events).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(sink)
    return (w.trigger(availableNow=True) if once else w).start()


def meeting_progress(states: DataFrame, total: int) -> DataFrame:
    """Completed, failed and running stages of each meeting, and how many of ``total`` are left."""
    n = lambda s: F.count_if(F.col("state") == s)
    g = states.groupBy("meeting_id").agg(n("completed").alias("completed"), n("failed").alias("failed"), n("running").alias("running"))
    return g.withColumn("pending", total - F.col("completed") - F.col("failed") - F.col("running"))
