"""Mixing, token files and the pipeline against brute force."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from convspark.llm import shingles
from convspark.llm.elias_fano import EliasFano
from convspark.llm.mixing import mix_sources
from convspark.llm.token_files import Encoder, Shard, read_token_files, write_token_files

from .conftest import DOCS, odd_rows, rows_of

BPE = public_tokenizers.path("byte_bpe_50k.json")


def _targets(sizes, weights, epochs):
    """Excess is reshared by weight until no target is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, capped = float(sum(sizes.values())), set()
    while True:
        left = total - sum(epochs * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > epochs * sizes[s] + 1e-9]
        if not over:
            return {s: epochs * sizes[s] if s in capped else share[s] for s in names}
        capped.update(over)


@pytest.mark.parametrize("seed", range(3))
def test_mixing(spark, seed):
    r = random.Random(seed)
    rows = [(k, " ".join(["w"] * r.choice([0, 1, 5, 30])), None, r.choice([None, "a", "b", "c", "é", "z"][: r.randint(1, 6)]), None) for k in range(800)]
    rows += [(k, "x " * 400, None, "big", None) for k in range(800, 1500)] + [(3000, "one two", None, "tiny", None), (3001, None, None, "none", None)]
    docs = spark.createDataFrame(rows, DOCS)
    sizes = {}
    for _, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = _targets(sizes, (1, 2, 3), 3)
    got = mix_sources(docs, buckets=64).collect()
    assert len(got) == len(rows)
    taken, largest = {}, {}
    for x in got:
        assert abs(x._mix_target - want[x.source]) < 1e-6 * max(1, want[x.source]) and x._mix_source_size == sizes[x.source]
        assert 0 <= x._mix_repeats <= 3
        taken[x.source] = taken.get(x.source, 0) + x._mix_size * x._mix_repeats
        largest[x.source] = max(largest.get(x.source, 0), x._mix_size)
    for s, n in taken.items():
        assert abs(n - want[s]) <= largest[s] / 2 + 1e-6, s
    assert rows_of(mix_sources(docs.repartition(7), buckets=64).select("doc_id", "_mix_repeats")) == rows_of(mix_sources(docs, buckets=64).select("doc_id", "_mix_repeats"))


def test_mixing_edges(spark, odd, clashing, empty):
    assert mix_sources(empty).count() == 0
    out = mix_sources(clashing)
    assert out.count() == len(odd_rows()) and out.columns[: len(clashing.columns)] == clashing.columns
    assert mix_sources(odd.where("text IS NULL")).where("_mix_target <> 0").count() == 0


@pytest.fixture(scope="module")
def encoder():
    return Encoder(BPE)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list(" \n\t\r\x1c\x85\xa0 ab1'.é漢")), st.characters(exclude_categories=["Cs"])), max_size=25))
def test_encoder(encoder, text):
    assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_special(encoder):
    for text in ("a <|endoftext|> b", "  x   y  ", " a", "a ", "\n a \n"):
        assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_keeps_a_word_once():
    own = Encoder(BPE)
    words = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    ids = [own.tokenizer.encode(" ".join(words), add_special_tokens=False).ids] * 2
    got = lambda: np.frombuffer(own.encode(" ".join(words)), own.dtype).tolist()
    assert [got(), got()] == ids
    pieces = own.pieces
    assert len(pieces.words) + len(pieces.spaced) == len(words)
    pieces.spaced.clear(), pieces.words.clear()
    pieces.spaced.size, pieces.words.size = 30, 20
    assert [got(), got()] == ids and (len(pieces.spaced), len(pieces.words)) == (30, 20)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=600))
def test_elias_fano(values):
    v = np.sort(np.array(values, np.uint64))
    data = b"xx" + EliasFano.encode(v).to_bytes()
    e, end = EliasFano.from_bytes(data, 2)
    assert end == len(data) and (e.decode() == v).all()
    assert all(e[i] == v[i] for i in range(0, len(v), 37))


def test_elias_fano_space():
    v = np.cumsum(np.random.default_rng(1).integers(1, 400, 50_000)).astype(np.uint64)
    e = EliasFano.encode(v)
    assert len(e.to_bytes()) < 50_000 * 10 / 8 + 2000 and e[49_999] == v[-1]
    sparse = EliasFano.encode(np.r_[np.zeros(300, np.uint64), np.array([2**35], np.uint64)])
    assert sparse[300] == 2**35 and sparse[256] == 0


def _want(rows, encoder):
    out, start = [], 0
    for d, t in sorted(((r[0], r[1] or "") for r in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode())):
        ids = np.array([*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4")
        out.append(("" if d is None else str(d), str(start), str(len(ids)), str(zlib.crc32(ids.tobytes()))))
        start += len(ids)
    return sorted(out)


def test_plain_pieces_are_not_split():
    own, split = Encoder(BPE), []
    find = own.pieces.split
    own.pieces.split = lambda piece: split.append(piece) or find(piece)
    text = "First words, plain; words (and) others: don't stop. Twice? twice! x, , ,, 3, a1. é, end."
    assert own.encode(text) == np.array(own.tokenizer.encode(text, add_special_tokens=False).ids, own.dtype).tobytes()
    assert split == ["First", " (and)", " don't", " ,", " ,,", " 3,", " a1.", " é,"]
    assert "words" in own.pieces.spaced and own.pieces.spaced["words,"] == own.pieces.spaced["words"] + own.pieces.words[","]


def test_token_files(spark, odd, clashing, empty, encoder, tmp_path):
    rows = odd_rows() + [(-5, "below zero", None, None, None)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    for k, size in enumerate((40, 1 << 20)):
        write_token_files(docs, BPE, f"{tmp_path}/t{k}", shard_ids=size)
        assert rows_of(read_token_files(spark, f"{tmp_path}/t{k}")) == _want(rows, encoder)
    shard = Shard(bytes(spark.read.parquet(f"{tmp_path}/t0").orderBy("part", "shard").first().payload))
    assert shard.doc_ids()[0] is None and shard.ids.dtype == np.dtype("<u2") and shard.document(0)[-1] == 0
    write_token_files(clashing, BPE, f"{tmp_path}/c")
    assert read_token_files(spark, f"{tmp_path}/c").count() == len(odd_rows())
    write_token_files(empty, BPE, f"{tmp_path}/e")
    assert read_token_files(spark, f"{tmp_path}/e").count() == 0
    write_token_files(docs.limit(0).unionByName(docs.where("doc_id IN (4, 10)")), public_tokenizers.path("word_bpe_49k.json"), f"{tmp_path}/w")
    assert read_token_files(spark, f"{tmp_path}/w").count() == 3


def test_shingles():
    texts = ["", None, "One two  three\tfour FIVE six", "a", "one two three four five six", "x y", " lead", "one two three four"]
    got = list(shingles.text_shingles(pa.array(texts)))
    assert [len(g) for g in got] == [0, 0, 2, 1, 2, 1, 1, 1]
    assert got[2].tolist() == got[4].tolist() and len({int(x) for g in got for x in g}) == 6
    old = shingles.PIECE
    try:
        shingles.PIECE = 10
        assert [g.tolist() for g in shingles.text_shingles(pa.array(texts))] == [g.tolist() for g in got]
        assert [g.tolist() for g in shingles.text_shingles(pa.array(texts).slice(2, 3))] == [g.tolist() for g in got[2:5]]
    finally:
        shingles.PIECE = old
    r = random.Random(1)
    words = {"".join(r.choices("abcXYZ.é", k=r.randint(1, 6))) for _ in range(3000)}
    (_, hashes, _), = shingles.word_hashes(pa.array([" ".join(sorted(words))]))
    assert len(set(hashes.tolist())) == len({re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words})


def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    from pyspark.sql import functions as F

    r = random.Random(7)
    word = lambda: f"w{r.randint(0, 500)}"
    item = " ".join(word() for _ in range(30))
    rows, labels = [], []
    for k in range(120):
        good = k % 4 > 0
        rows.append((k, " ".join(word() if good else f"JUNK{r.randint(0, 99)}!!" for _ in range(40)), "en", f"s{k % 3}", None))
        labels.append((k, int(good), 0))
    rows += [(200, rows[1][1], "en", "s0", None), (201, rows[1][1] + " more", "en", "s0", None), (202, f"{rows[5][1]} {item} {word()}", "en", "s1", None), (203, None, None, None, None), (1, rows[1][1], "en", "s1", None)]
    spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("x")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    good = corpus_pipeline.quality(spark, docs, str(tmp_path))
    assert good.columns == docs.columns and not good.where("doc_id < 120 AND doc_id % 4 = 0").count() and good.where("doc_id < 120").count() == 91
    single = corpus_pipeline.near_duplicates(spark, good, str(tmp_path))
    ids = [x.doc_id for x in single.collect()]
    assert ids.count(1) == 1 and not {200, 201} & set(ids)
    clean = corpus_pipeline.benchmark(spark, single, str(tmp_path))
    assert 202 in ids and {x.doc_id for x in clean.collect()} == set(ids) - {202}
    mixed = corpus_pipeline.mixing(spark, clean, str(tmp_path))
    assert mixed.columns == docs.columns
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(x.doc_id for x in out.collect()) == sorted(x.doc_id for x in mixed.collect())


def test_pipeline_of_empty_tables(spark, tmp_path):
    import corpus_pipeline

    tables = {"documents": DOCS, "labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string"}
    for k, full in enumerate((set(), {"documents"})):
        d = f"{tmp_path}/{k}"
        for name, schema in tables.items():
            rows = [(1, "some words of a text", "en", "s", 20), (None, None, None, None, None), (2, "", "en", "s", 0)] if name in full else []
            spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
        assert corpus_pipeline.run(spark, d).count() == (2 if full else 0)  # a source without any words has nothing to mix
