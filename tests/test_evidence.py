"""Evidence of points over stored chunks."""

from convspark.operators import extraction
from convspark.sources.shared import saved


def test_stored_chunks_are_not_broadcast(spark):
    """Files of chunks may be far smaller than their rows; no join of the step hands one side to every task."""
    rows = [(m, i, f"c{i}", f"SPEAKER_1: follow-up on cost_{i % 3} estimate\nSPEAKER_2: notes", 0.9) for m in ("a", "b") for i in range(20)]
    c = saved(spark.createDataFrame(rows, "meeting_id string, idx int, chunk_id string, text string, asr_confidence double"))
    points = spark.createDataFrame([("a", 1, "follow-up on cost_1"), ("a", 2, "follow-up on cost_1"), ("b", 3, "the cost_2 estimate"), ("b", 4, "nothing")], "meeting_id string, point_id int, point string")
    best = extraction.best_evidence(points, c)
    assert "Broadcast" not in best._jdf.queryExecution().sparkPlan().toString()
    assert sorted((x.meeting_id, x.point_id, x.idx, x.score, x.rank) for x in best.collect()) == [("a", 1, 1, 4, 1), ("a", 1, 4, 4, 2), ("a", 2, 1, 4, 1), ("a", 2, 4, 4, 2), ("b", 3, 2, 4, 1), ("b", 3, 5, 4, 2)]
