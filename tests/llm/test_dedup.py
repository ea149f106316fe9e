"""Exact, near and line deduplication against brute force."""

import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from convspark.llm.components import components
from convspark.llm.exact_dedup import content_sort_dedup
from convspark.llm.line_dedup import drop_repeated_lines
from convspark.llm.ngram_join import keep_one_of_each, ngram_components

from .conftest import DOCS, odd_rows, rows_of

INF = float("inf")


def test_exact(spark, odd, clashing, empty):
    groups = defaultdict(list)
    for d, t, *_ in odd_rows():
        groups[re.sub(r"[\x20\x09-\x0d]+", " ", t or "")].append(d)
    want = []
    for t, ids in groups.items():
        ids.sort(key=lambda d: INF if d is None else d)
        want += [(d, ids[0], len(ids), k == 0, hashlib.sha256(t.encode()).hexdigest()) for k, d in enumerate(ids)]
    want = sorted(tuple("" if v is None else str(v) for v in w) for w in want)
    assert rows_of(content_sort_dedup(odd)) == want
    assert rows_of(content_sort_dedup(clashing, hot_share=0.01, salts=2)) == want  # groups of copies are split
    assert rows_of(content_sort_dedup(odd, hot_share=1.0, salts=2, part_rows=2)) == want  # split by number of rows, whatever their share
    assert rows_of(content_sort_dedup(odd, hot_share=0.01, salts=2, small=0)) == want  # nothing is broadcast
    assert content_sort_dedup(empty).count() == 0


def _components(rows):
    sets = []
    for _, t, *_ in rows:
        w = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        d = INF if r[0] is None else r[0]
        least[find(i)] = min(least.get(find(i), INF), d)
    return sorted(("" if r[0] is None else str(r[0]), str(len(sets[i])), "" if (c := least[find(i)]) == INF else str(c)) for i, r in enumerate(rows))


def test_near(spark, odd, clashing, empty):
    want = _components(odd_rows())
    for docs, share in ((odd, 0.0005), (clashing, 0.02), (odd, 1.0)):  # with and without frequent shingles
        got = ngram_components(docs, hot_share=share, bucket_rows=100)
        assert rows_of(got.select("doc_id", "n_shingles", "component_id")) == want
    assert ngram_components(empty).count() == 0


def test_near_random_families(spark):
    r = random.Random(4)
    rows = []
    for f in range(12):
        base = [f"f{f}w{r.randint(0, 30)}" for _ in range(r.randint(5, 50))]
        for _ in range(r.randint(1, 14)):
            own = list(base)
            for _ in range(r.randint(0, 4)):
                own[r.randrange(len(own))] = f"z{r.randint(0, 9)}"
            rows.append((len(rows), " ".join(own), None, None, None))
    shared = " ".join(f"p{k}" for k in range(30))
    rows += [(len(rows) + k, f"{shared} {' '.join(f'q{k}v{j}' for j in range(3 + k))}", None, None, None) for k in range(25)]
    docs = spark.createDataFrame(rows, DOCS)
    want = _components(rows)
    for share in (0.0005, 0.05, 1.0):
        got = ngram_components(docs, hot_share=share, bucket_rows=50)
        assert rows_of(got.select("doc_id", "n_shingles", "component_id")) == want
    for often, long_list, block in ((2, 2, 3), (4, 1, 1000), (3, 8, 7)):  # few frequent shingles, long lists, and blocks of them
        got = ngram_components(docs, hot_share=0.2, often=often, long_list=long_list, bucket_rows=block)
        assert rows_of(got.select("doc_id", "n_shingles", "component_id")) == want
    assert keep_one_of_each(docs).count() == len({w[2] for w in want})


def test_near_bounds():
    """No link is kept back by positions, sizes or parity maps."""
    import numpy as np

    from convspark.llm import ngram_join as J
    from convspark.llm.shingles import U64

    r = np.random.default_rng(5)
    for _ in range(300):
        n = int(r.integers(1, 200))
        a = np.unique(r.integers(0, 1 << 60, n).astype(U64))
        b = np.unique(np.concatenate([a[r.random(len(a)) < r.choice([0.75, 0.9, 1.0])], r.integers(0, 1 << 60, int(r.integers(0, n // 4 + 1))).astype(U64)]))
        shared, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        x, y = sorted((J._parity_map(a).view(U64), J._parity_map(b).view(U64)), key=len)
        if len(y) > len(x):
            assert len(y) == 2 * len(x) or 4 * len(b) < 3 * len(a) or 4 * len(a) < 3 * len(b)
            y = y.reshape(-1, len(x))
            y = np.bitwise_xor.reduce(y, 0)
        assert np.bitwise_count(x ^ y).sum() <= len(a) + len(b) - 2 * shared
        if 100 * shared >= 75 * union and shared:
            assert set(a[: J._prefix(len(a), 75)].tolist()) & set(b[: J._prefix(len(b), 75)].tolist())


def test_near_hub(spark):
    """Copies that link with their original only, not with each other, are one component; unlike ones stay apart."""
    r = random.Random(12)
    base = [f"b{k}" for k in range(120)]
    rows = [(0, " ".join(base), None, None, None)]
    for k in range(1, 90):
        own = list(base)
        for at in r.sample(range(2, 118), 3 if k % 3 else 6):
            own[at] = f"c{k}x{at}"
        rows.append((k, " ".join(own), None, None, None))
    docs = spark.createDataFrame(rows, DOCS)
    want = _components(rows)
    assert len({w[2] for w in want}) > 10
    for options in ({}, {"often": 4, "long_list": 4, "bucket_rows": 16}):
        assert rows_of(ngram_components(docs, **options).select("doc_id", "n_shingles", "component_id")) == want


def test_keep_one(odd, clashing):
    kept = keep_one_of_each(clashing)
    assert kept.columns == clashing.columns
    ids = sorted(r.doc_id for r in kept.where("doc_id BETWEEN 4 AND 59").collect())
    assert ids[:2] == [4, 7] and ids.count(4) == 1 and not [d for d in ids if d >= 20]
    assert kept.where("doc_id IN (1, 2, 3)").count() == 3  # texts without words are nobody's copies


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (5, 9), (4, 4), (30, 29), (29, 28), (28, 27), (27, 26)], "u long, v long")
    got = {r.node: r.root for r in components(e).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 5: 5, 8: 5, 9: 5, **{k: 26 for k in range(26, 31)}}
    assert components(e.where("u < 0")).count() == 0


def _lines(rows, least):
    """Later copies of repeated runs, by comparing every pair of places in order."""
    seqs = []
    for k, (d, t, *_) in enumerate(rows):
        lines = [" ".join(x.split()) for x in (t or "").split("\n")]
        seqs.append(((INF if d is None else d, k), [x for x in lines if x]))
    seqs.sort(key=lambda s: s[0])
    first, gone = {}, [set() for _ in rows]
    for (_, k), lines in seqs:
        for i in range(len(lines)):
            n, m = 0, 0
            while n < least and i + m < len(lines):
                n += len(lines[i + m].split())
                m += 1
            if n < least:
                continue
            run = tuple(lines[i : i + m])
            if run in first:
                gone[k].update(range(i, i + m))
            else:
                first[run] = (k, i)
    return gone, {k: lines for (_, k), lines in seqs}


def test_lines(spark, empty):
    r = random.Random(9)
    pool = [" ".join(f"v{r.randint(0, 20)}" for _ in range(r.randint(1, 4))) for _ in range(12)]
    rows = [(k, "\n".join(r.choice(["", *pool, *pool, f"own {k} {r.random()}"]) for _ in range(r.randint(0, 14))), None, None, None) for k in range(60)]
    rows += [(100, None, None, None, None), (101, "", None, None, None), (102, " \n\t\n", None, None, None), (103, "\n".join(f"long line number {k}" for k in range(3000)), None, None, None), (104, "\n".join(f"long line number {k}" for k in range(3000)), None, None, None)]
    gone, lines = _lines(rows, 7)
    got = {x.doc_id: x for x in drop_repeated_lines(spark.createDataFrame(rows, DOCS).withColumn("uid", F.lit("x")), 7).collect()}
    for k, (d, t, *_) in enumerate(rows):
        assert got[d].removed == sorted(gone[k]) and got[d].n_lines == len(lines[k]), d
        left, i = [], -1
        for x in (t or "").split("\n"):
            i += bool(x.strip(" \t"))
            if not (x.strip(" \t") and i in gone[k]):
                left.append(x)
        assert got[d].text == "\n".join(left)
    assert len(got[104].removed) == 3000 and not got[103].removed
    assert drop_repeated_lines(empty).count() == 0


def _maximal(rows, least):
    """Lines of runs of any length that occur at an earlier place as well, by comparing every pair of places."""
    seqs = [[x for x in (" ".join(x.split()) for x in t.split("\n")) if x] for _, t in rows]
    places, gone = [(k, i) for k, x in enumerate(seqs) for i in range(len(x))], [set() for _ in rows]
    for at, (k, i) in enumerate(places):
        for e, j in places[:at]:
            m = 0
            while i + m < len(seqs[k]) and j + m < len(seqs[e]) and seqs[k][i + m] == seqs[e][j + m]:
                m += 1
            if sum(len(x.split()) for x in seqs[k][i : i + m]) >= least:
                gone[k].update(range(i, i + m))
    return gone


def test_lines_whole_runs(spark):
    twelve, three = "one two three four five six seven eight nine ten eleven twelve", "a b c"
    r = random.Random(4)
    pool = [" ".join(f"v{r.randint(0, 20)}" for _ in range(r.randint(1, 4))) for _ in range(9)]
    rows = [(0, f"{twelve}\n{three}\nx"), (1, f"{twelve}\n{three}\ny"), (2, f"{twelve}\nz z"), (3, f"{twelve}\nz z\nq"), (4, "\n".join([twelve, *"abcdefghi", "end of it"])), (5, "\n".join([twelve, *"abcdefghi", "other"]))]
    rows += [(k, "\n".join(r.choice(["", *pool, *pool, f"own {k} {r.random()}"]) for _ in range(r.randint(0, 14)))) for k in range(6, 50)]
    got = {x.doc_id: x.removed for x in drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), whole_runs=True).collect()}
    assert got[1] == [0, 1] and got[3] == [0, 1] and got[5] == list(range(10))
    gone = _maximal(rows, 10)
    assert {k: sorted(x) for k, x in enumerate(gone)} == got


def test_lines_repeated_rows(spark):
    text = "a line of five words\nand one more of six words"
    docs = spark.createDataFrame([(None, text), (None, text), (1, text), (1, text)], "doc_id long, text string")
    got = sorted((x.doc_id or -1, len(x.removed)) for x in drop_repeated_lines(docs).collect())
    assert got == [(-1, 2), (-1, 2), (1, 0), (1, 2)]


def test_many_deleted_lines(spark):
    """A document whose 20,000 lines all occur in another goes whole, but for its blank lines."""
    lines = [f"line {k} has some words of its own, ten or more of them" for k in range(20_000)]
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, "new\n\n" + "\n".join(lines) + "\n\nend")], "doc_id long, text string")
    got = {x.doc_id: x for x in drop_repeated_lines(docs, whole_runs=True).collect()}
    assert got[1].removed == [] and got[1].text == "\n".join(lines)
    assert got[2].removed == list(range(1, 20_001)) and got[2].text == "new\n\n\nend"
