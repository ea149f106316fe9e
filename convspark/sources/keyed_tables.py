"""JSON tables with a row for each key, changed in one step.

A table is a folder of versions and a manifest. Keys are dealt to a fixed number of buckets; an upsert writes those that it
touches, and no others, into a new version, and then puts a new manifest, which names the folder of each bucket, in the
place of the old one by one rename. Whatever fails before that leaves the table as it was.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ops import upsert
from .shared import saved

_MANIFEST = "_manifest.json"


def _at(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def manifest(spark: SparkSession, path: str) -> dict | None:
    """{buckets, keys, folders: {bucket: folder below the path}}, or None where there is no table yet."""
    at, fs = _at(spark, f"{path}/{_MANIFEST}")
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _swap(spark: SparkSession, path: str, new: dict) -> None:
    """Writes the manifest beside the old one and renames it over that."""
    staged, fs = _at(spark, f"{path}/_manifest-{uuid.uuid4().hex}")
    out = fs.create(staged)
    out.write(bytearray(json.dumps(new, sort_keys=True).encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    hadoop.FileContext.getFileContext(staged.toUri(), spark._jsc.hadoopConfiguration()).rename(staged, _at(spark, f"{path}/{_MANIFEST}")[0], how)


def read_rows(spark: SparkSession, path: str, schema: str, buckets: list[int] | None = None) -> DataFrame:
    """The table's rows, or those of some buckets; empty where there is no table."""
    known = (manifest(spark, path) or {"folders": {}})["folders"]
    folders = [f"{path}/{folder}" for b, folder in sorted(known.items()) if buckets is None or int(b) in buckets]
    return spark.read.schema(schema).json(folders) if folders else spark.createDataFrame([], schema)


def upsert_rows(rows: DataFrame, path: str, keys: list[str], schema: str, buckets: int = 64) -> None:
    """Puts rows in the place of those with their keys, and beside all others. One writer at a time.

    The number of buckets is the first upsert's. Versions that neither the new manifest nor the one before it names are
    deleted afterwards, so that who reads the table meanwhile can go on.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    before = manifest(spark, path) or {"buckets": buckets, "keys": keys, "folders": {}}
    if before["keys"] != keys:
        raise ValueError(f"the table's keys are {before['keys']}")
    bucket = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(before["buckets"])).cast("int")
    rows = saved(rows)
    touched = [r[0] for r in rows.select(bucket.alias("b")).distinct().collect()]  # at most as many as there are buckets
    merged = upsert(read_rows(spark, path, schema, touched), rows, keys).withColumn("_bucket", bucket)
    version = f"v-{uuid.uuid4().hex}"
    merged.repartition("_bucket").sortWithinPartitions("_bucket", *keys).write.partitionBy("_bucket").json(f"{path}/{version}")
    folders = before["folders"] | {str(b): f"{version}/_bucket={b}" for b in touched}
    _swap(spark, path, before | {"folders": folders})
    named = {f.split("/")[0] for f in [*folders.values(), *before["folders"].values()]}
    root, fs = _at(spark, path)
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(("v-", "_manifest-")) and name not in named:
            fs.delete(status.getPath(), True)
