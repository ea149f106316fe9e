"""Corpus pipeline: from documents to token files, one stage after another.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's docs.
All but the last return the columns of ``documents``.

Nulls in any column, empty and very long texts, repeated rows, equal ids, empty tables and further columns (of any name)
are taken by every stage: a null text counts as empty; without labels no document is rejected; texts without words are
nobody's copies, hold no benchmark item, and are mixed like others, at no cost; of repeated rows one is left after the
second stage; an empty table gives an empty result. Null ids come first in the token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convspark.llm.common import drop_written, shared_folder, table, written
from convspark.llm.decontamination import decontaminate
from convspark.llm.mixing import mix_sources
from convspark.llm.ngram_join import keep_one_of_each
from convspark.llm.quality import fit_rules, keep_good
from convspark.llm.token_files import read_token_files, write_token_files


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from all labels (at most 20,000 rows) and drops the documents that the rules reject."""
    model = fit_rules(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest document of each group that links of five-word shingles at 0.75 join."""
    return keep_one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold three quarters of a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as the mix of sources takes it; one that it doesn't take goes."""
    mixed = mix_sources(docs).where("_mix_repeats > 0")
    return mixed.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_repeats")))).select(*docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes what is left into token files and reads back where each document lies in them."""
    import public_tokenizers

    path = shared_folder(spark)
    write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), path)
    return read_token_files(spark, path)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("mixing", mixing), ("token_files", token_files)]

#: SQL has neither a fitted classifier nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Once a stage's result is written, what it wrote on the way goes, and so do its input's files."""
    docs = table(spark, sf_dir, "documents")
    first = written()
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = shared_folder(spark)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            drop_written(spark, first, keep=(docs,))
    return docs
