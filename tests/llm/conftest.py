import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use themselves.
CLASHES = ("score", "predicted", "kept", "keep_id", "n", "token", "block", "bucket", "uid", "ln", "size", "target", "start", "node", "_id", "labels")


def words(r, n, vocabulary=400):
    return " ".join(f"w{r.randint(0, vocabulary)}" for _ in range(n))


def odd_rows():
    """Nulls in any column, empty, blank and very long texts, repeated rows, equal ids, exact and near copies."""
    r = random.Random(11)
    base, long = words(r, 60), words(r, 30_000, 5000)
    rows = [(None, base), (None, None), (1, None), (2, ""), (3, " \t\n "), (4, base), (4, base), (5, base.replace(" ", "\n", 3)), (6, base + " tail"), (7, "Ünï ß 漢字 a b c"), (8, long), (9, long + " end"), (9, "other text under one id"), (10, "a"), (11, "a b c d"), (12, "A B C D")]
    for k in range(20, 60):
        own = base.split()
        own[r.randrange(60)] = f"x{k}"
        rows.append((k, " ".join(own)))
    rows += [(k, words(r, r.randint(1, 80))) for k in range(60, 140)]
    return [(d, t, None if k % 7 == 0 else "en", None if k % 5 == 0 else f"s{k % 3}", None) for k, (d, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def clashing(odd):
    from pyspark.sql import functions as F

    return odd.select("*", *[F.lit("x").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows_of(df):
    return sorted((tuple("" if v is None else str(v) for v in r) for r in df.collect()))
