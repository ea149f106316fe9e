"""Exact deduplication by a distributed content sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, stash, table, whole_text


#: Characters of a text that splitters are made of.
HEAD = 32


def _sized(df: DataFrame, small: int) -> DataFrame:
    """A written table, to be broadcast if it has ``small`` rows at most."""
    return F.broadcast(df) if df.count() <= small else df.hint("merge")


def content_sort_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_share: float = 0.001, salts: int = 16, part_rows: int = 100_000, small: int = 500_000) -> DataFrame:
    """Keeps, of texts that are equal after white space is normalised, the row with the smallest id.

    ``repartitionByRange`` samples splitters and deals out the normalised texts by range: by their first ``HEAD``
    characters, then a hash, so that the samples that Spark brings to the driver are short however long texts are. The
    window's external sort puts equal texts side by side, and its comparison of neighbouring rows (whole texts, no
    digests) ends a group. A
    text held by at least ``hot_share`` of all rows, or by ``part_rows`` of any number, is split over ``salts`` keys, or
    as many as it has ``part_rows`` rows; the first rows of its parts go through a second content sort. Tables of split
    texts are broadcast up to ``small`` rows, and joined by a shuffle beyond that.

    Returns one row per input row: id, keep_id, group_size, kept, text_sha256. Null texts equal the empty text. A null
    id never beats another id; of rows with the same id one is kept. An empty table gives an empty result. Other
    columns are ignored.
    """
    norm = docs.select(F.col(id_col).alias("_id"), F.regexp_replace(whole_text(text_col), SPACES, " ").alias("_norm"))
    digests = norm.select(F.xxhash64("_norm").alias("_h")).groupBy("_h").agg(F.count("*").alias("_n"))
    least = min(max(salts, int(hot_share * docs.count())), max(2, part_rows))
    hot = digests.where(F.col("_n") >= least).select(F.col("_h").alias("_hash"), F.greatest(F.lit(salts), F.ceil(F.col("_n") / part_rows)).alias("_keys"))
    hot = stash(hot)

    # Rows without an id are dealt out by where they stand, as they would all have one key.
    own = F.xxhash64("_id", F.when(F.col("_id").isNull(), F.monotonically_increasing_id()))
    salt = F.when(F.col("_keys").isNotNull(), F.pmod(own, F.col("_keys")) + 1).otherwise(F.lit(0))
    keyed = norm.withColumn("_head", F.substring("_norm", 1, HEAD)).withColumn("_hash", F.xxhash64("_norm")).join(_sized(hot, small), "_hash", "left")
    sorted_rows = keyed.withColumn("_salt", salt).drop("_keys").repartitionByRange("_head", "_hash", "_salt")
    part = Window.partitionBy("_head", "_hash", "_norm", "_salt")
    runs = sorted_rows.select(
        "_id",
        "_salt",
        F.sha2("_norm", 256).alias("text_sha256"),
        F.row_number().over(part.orderBy(F.col("_id").asc_nulls_last())).alias("_rn"),
        F.min("_id").over(part).alias("_first"),
        F.count("*").over(part).alias("_n"),
        "_norm",
    ).withColumn("_norm", F.when((F.col("_salt") > 0) & (F.col("_rn") == 1), F.col("_norm")))
    runs = stash(runs)

    cold = runs.where("_salt = 0").select("_id", F.col("_first").alias("keep_id"), F.col("_n").alias("group_size"), "_rn", "_first", "text_sha256")
    text = Window.partitionBy("_norm")
    heads = stash(
        runs.where("_salt > 0 AND _rn = 1")
        .repartitionByRange("_norm")
        .select("text_sha256", "_salt", F.min("_first").over(text).alias("keep_id"), F.sum("_n").over(text).alias("group_size"))
    )
    split = (
        runs.where("_salt > 0")
        .select("_id", "_salt", "_rn", "_first", "text_sha256")
        .join(_sized(heads, small), ["text_sha256", "_salt"])
        .select("_id", "keep_id", "group_size", "_rn", "_first", "text_sha256")
    )
    return cold.unionByName(split).select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        ((F.col("_rn") == 1) & F.col("_first").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def op7_content_sort_dedup(spark, sf_dir):
    return content_sort_dedup(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1 AS kept, sha256(norm) AS text_sha256
FROM n
"""
