"""Helpers that the training-data operators share."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import new_folder

#: ASCII white space and its complement, as Java regular expressions.
SPACES = r"[\x20\x09-\x0D]+"
NON_SPACES = r"[^\x20\x09-\x0D]+"
#: Words of ASCII letters and digits and of every character above ASCII.
ALNUM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_az(col: Column) -> Column:
    """Lower-cases A-Z only; other letters stay as they are."""
    return F.translate(col, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    """Words between ASCII white space: each is cut to its first character, and white space goes."""
    spaces, others = SPACES[1:-2], NON_SPACES[:-1]
    return F.length(F.regexp_replace(text, f"[{spaces}]*+({others}){others}*+|[{spaces}]++", "$1"))


def whole_text(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


#: Written tables that nothing has dropped yet, oldest first.
_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share (see ``new_folder``), noted for ``drop_written``."""
    path = new_folder(spark)
    _written.append(path)
    return path


def stash(df: DataFrame, *partition_by: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them back: a cut in the lineage that outlives lost executors."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written() -> int:
    """A mark for ``drop_written``: how many tables there are now."""
    return len(_written)


def drop_written(spark: SparkSession, since: int = 0, keep: tuple[DataFrame, ...] = ()) -> None:
    """Deletes the tables written since the mark, but for those that ``keep`` reads: what was made of them must have
    been written itself, as nothing can be computed anew from them."""
    names = [f for df in keep for f in df.inputFiles()]
    for path in _written[since:]:
        if not any(path.rpartition("/")[2] in f for f in names):
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
            _written.remove(path)


def free_shuffles(spark: SparkSession) -> None:
    """Lets go of the shuffle files of jobs that are done: Spark deletes them once the driver has collected what refers
    to them, which it may not do for long by itself."""
    gc.collect()
    spark._jvm.System.gc()


def small_batches(spark: SparkSession) -> None:
    """Lets the session hand rows to Python in small Arrow batches: a batch is held whole on both sides, and its texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def crc_held_out(doc_id: Column, mod: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves ``rest`` modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % mod == rest


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
