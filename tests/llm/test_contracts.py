"""The registered queries' columns and types, and those with a DuckDB counterpart against it, on the smallest tables."""

import os
import zlib

import duckdb
import pandas as pd
import pytest

from convspark.llm.registry import ORACLE_SQL, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

WANT = {
    "op1_suffix_tree": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op2_licence_scan": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op4_chat_round_trip": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op5_ngram_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op6_rule_ensemble": "doc_id bigint, held_out boolean, score double, predicted int",
    "op7_content_sort_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op9_water_filling": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op11_html_extraction": "page_id bigint, url string, text string, n_chars bigint",
    "op12_prefix_trie": "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string",
    "op13_fill_in_middle": "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string",
    "op10_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
}


@pytest.mark.parametrize("name", sorted(WANT))
def test_columns(spark, name):
    out = QUERIES[name](spark, SF)
    assert [f"{c} {t}" for c, t in out.dtypes][: len(WANT[name].split(", "))] == WANT[name].split(", ")
    rows = out.toPandas()
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    if "doc_id" in rows:
        assert len(rows) == documents.count()
    if "page_id" in rows:
        assert len(rows) == spark.read.parquet(f"{SF}/pages.parquet").count() and (rows.text.str.len() == rows.n_chars).all()
    if "held_out" in rows:
        mod = 7 if name.startswith("op1") else 4
        assert (rows.held_out == rows.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % mod == 2)).all()


def _plain(df):
    cell = lambda v: "" if v is None or v is pd.NA or v != v else f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(cell(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_duckdb(spark, name):
    con = duckdb.connect()
    for table in os.listdir(SF):
        con.execute(f"CREATE VIEW {table.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{table}')")
    ours, theirs = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLE_SQL[name]).df()
    assert len(ours) and _plain(ours) == _plain(theirs)
