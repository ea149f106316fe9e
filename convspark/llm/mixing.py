"""Mixing of sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stash, table, whole_text, word_count

#: Tables of at most so many sources are broadcast; larger ones are joined by a shuffle.
BROADCAST_SOURCES = 20_000


def water_fill(sources: DataFrame, total, max_epochs: float) -> DataFrame:
    """Adds ``target`` to rows (source, source_size, weight): ``min(max_epochs * size, level * weight)``.

    The level is where the water stands when everything above a cap has been reshared by weight until nothing is above:
    with caps in ascending order of cap / weight, it is ``(total - caps before) / weights from here on`` of the first
    source whose own cap isn't below it.
    """
    fill = Window.partitionBy(F.lit(0)).orderBy(F.col("_mix_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest, whole = (fill.rowsBetween(*x) for x in ((Window.unboundedPreceding, -1), (0, Window.unboundedFollowing), (Window.unboundedPreceding, Window.unboundedFollowing)))
    fits = F.col("_mix_level") * F.col("weight") <= F.col("_mix_cap") * (1 + 1e-12)
    level = (total - F.coalesce(F.sum("_mix_cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    return (
        sources.withColumn("_mix_cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("_mix_level", level)
        .withColumn("_mix_level", F.first(F.when(fits, F.col("_mix_level")), ignorenulls=True).over(whole))
        .withColumn("target", F.least(F.col("_mix_cap"), F.coalesce("_mix_level", F.lit(0.0)) * F.col("weight")))
        .drop("_mix_level", "_mix_cap")
    )


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, share: float = 1.0, seed: int = 20, buckets: int = 4096, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """Adds to each document how often a mix of its source takes it.

    Sources by code point, null last, get ``weights`` in turn; their targets (in words) share ``share`` of all words by
    weight, and none is above ``max_epochs`` times its source. A source at e epochs takes each of its documents
    floor(e) times, and once more those that come first in a seeded hash order until the rest is full, to the nearest
    document. The order's prefix sums come from sums of ``buckets`` hash ranges a source, so that only the range where a
    source fills up is sorted; a document's fate then depends on its source and hash alone.

    Returns the input's columns (names that start with ``_mix_`` are this operator's own) and ``_mix_size, _mix_source_size, _mix_target, _mix_repeats``. Null texts have no words; rows of the
    same id share their fate; sources without words have target 0; an empty table gives an empty result.
    """
    hashed = F.xxhash64(F.lit(seed), F.col(id_col), F.col(source_col))
    sized = docs.withColumn("_mix_size", word_count(whole_text(text_col)).cast("long")).withColumn("_mix_h", hashed)
    bits = buckets.bit_length() - 1
    slim = stash(sized.select(F.col(source_col).alias("source"), "_mix_size", "_mix_h", (F.shiftright("_mix_h", 64 - bits)).alias("_mix_bucket")))  # texts are counted once for it
    by_bucket = slim.groupBy("source", "_mix_bucket").agg(F.sum("_mix_size").alias("_mix_size"))

    per_source = by_bucket.groupBy("source").agg(F.sum("_mix_size").cast("double").alias("source_size"))
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    total = F.sum("source_size").over(Window.partitionBy(F.lit(0))) * F.lit(float(share))
    targets = water_fill(per_source.withColumn("weight", F.get(cycle, rank % len(weights))).withColumn("_mix_total", total), F.col("_mix_total"), max_epochs).drop("_mix_total")
    targets = targets.withColumn("_mix_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-9)).otherwise(0).cast("int")).withColumn(
        "_mix_rest", F.greatest(F.lit(0.0), F.col("target") - F.col("_mix_whole") * F.col("source_size"))
    )

    # The bucket in which a source fills up, and in it the last hash that still fits.
    before = Window.partitionBy("source").orderBy("_mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    edge = (
        by_bucket.withColumn("_mix_before", F.coalesce(F.sum("_mix_size").over(before), F.lit(0)))
        .join(targets.select(F.col("source").alias("_mix_s"), "_mix_rest"), F.col("source").eqNullSafe(F.col("_mix_s")))
        .where("_mix_before < _mix_rest")
        .groupBy("source")
        .agg(F.max_by(F.struct("_mix_bucket", "_mix_before", "_mix_rest"), "_mix_bucket").alias("_mix_e"))
        .select(F.col("source").alias("_mix_s"), F.col("_mix_e._mix_bucket").alias("_mix_b"), F.col("_mix_e._mix_before").alias("_mix_before"), F.col("_mix_e._mix_rest").alias("_mix_rest"))
    )
    inside = Window.partitionBy("source").orderBy("_mix_h").rowsBetween(Window.unboundedPreceding, 0)
    last = (
        slim.join(_small(edge), F.col("source").eqNullSafe(F.col("_mix_s")) & (F.col("_mix_bucket") == F.col("_mix_b")))
        .groupBy("source", "_mix_b", "_mix_before", "_mix_rest", "_mix_h")
        .agg(F.sum("_mix_size").alias("_mix_size"))
        .withColumn("_mix_mid", F.col("_mix_before") + F.sum("_mix_size").over(inside) - F.col("_mix_size") / 2)
        .groupBy("source", "_mix_b")
        .agg(F.max(F.when(F.col("_mix_mid") < F.col("_mix_rest"), F.col("_mix_h"))).alias("_mix_last"))
        .select(F.col("source").alias("_mix_s"), F.coalesce("_mix_last", F.shiftleft("_mix_b", 64 - bits) - 1).alias("_mix_last"))
    )
    plan = targets.join(last, F.col("source").eqNullSafe(F.col("_mix_s")), "left").select(
        F.col("source").alias("_mix_source"), F.col("source_size").cast("long").alias("_mix_source_size"), F.col("target").alias("_mix_target"), "_mix_whole", "_mix_last"
    )
    extra = F.when(F.col("_mix_last").isNotNull() & (F.col("_mix_whole") < max_epochs) & (F.col("_mix_h") <= F.col("_mix_last")), 1).otherwise(0)
    return sized.join(_small(plan), F.col(source_col).eqNullSafe(F.col("_mix_source"))).withColumn("_mix_repeats", F.col("_mix_whole") + extra).drop("_mix_source", "_mix_whole", "_mix_last", "_mix_h")


def _small(df: DataFrame) -> DataFrame:
    """Marks a table of one row a source for a broadcast, if it is written to the session as small enough."""
    return F.broadcast(df) if df.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES else df


def op9_water_filling(spark, sf_dir):
    mixed = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id", F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"), F.col("_mix_target").alias("target"), (F.col("_mix_size") * F.col("_mix_repeats")).alias("taken"), F.col("_mix_repeats").alias("repeats")
    )
