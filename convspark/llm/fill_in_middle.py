"""Fill-in-the-middle transformation: cuts found by an indexable skip list over a text's tokens."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, table, whole_text

#: What separates the parts; a text that holds one of them stays plain.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def token_widths(text: str) -> np.ndarray:
    """Code points of each token: runs of ASCII letters, and every other code point alone."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    lower = points | 0x20
    letter = (lower >= 97) & (lower <= 122)
    starts = np.flatnonzero(~(letter & np.concatenate(([False], letter[:-1]))))
    return np.diff(starts, append=len(points))


class SkipList:
    """Tokens under express lanes. Each link of a lane carries how many tokens and how many code points it passes.

    The lowest lane has a link for each token; a lane above holds about a quarter of the places below it, by a hash of
    the place, and its links' widths are the sums of those that they pass. Linear to build, and a rank is reached with
    about four steps a lane.
    """

    def __init__(self, widths: np.ndarray):
        #: (tokens a link passes, code points it passes, where a place stands in the lane below)
        self.lanes = [(np.ones(len(widths), np.int64), widths.astype(np.int64), np.arange(len(widths) + 1))]
        places, level = np.arange(len(widths), dtype=np.uint64), 0
        while len(places) > 4:
            level += 1
            mixed = (places + np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            stays = (mixed >> np.uint64(62)) == 0
            stays[0] = True
            down = np.flatnonzero(stays)
            units, points, _ = self.lanes[-1]
            self.lanes.append((np.add.reduceat(units, down), np.add.reduceat(points, down), np.append(down, len(units))))
            places = places[down]

    def code_points_at(self, rank: int) -> int:
        """Code points before the token of that rank (from 0): links are taken while they don't pass it, lane by lane."""
        passed = points = place = 0
        for units, width, down in reversed(self.lanes):
            while place < len(units) and passed + units[place] <= rank:
                passed, points, place = passed + int(units[place]), points + int(width[place]), place + 1
            place = int(down[place])
        return points


def cut(text: str, first: int, second: int) -> tuple[int, int, int]:
    """(tokens, code points of the prefix, of the middle): cuts behind ``first % (tokens + 1)`` and ``second % ...``."""
    if not text:
        return 0, 0, 0
    widths = token_widths(text)
    lanes, n = SkipList(widths), len(widths)
    a, b = sorted((first % (n + 1), second % (n + 1)))
    start = lanes.code_points_at(a)
    return n, start, lanes.code_points_at(b) - start


def _cuts(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, first, second in batches:
        yield pd.DataFrame([cut(*x) for x in zip(texts, first, second)], columns=["n", "prefix_chars", "middle_chars"], dtype="int64")


def fill_in_middle(docs: DataFrame, rate: int = 90, suffix_first: int = 20, seed: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adds fim_n, fim_form, fim_prefix_chars, fim_middle_chars and fim_text to whole documents; other columns stay.

    Four numbers come from the SHA-256 of ``seed:id``: the first two cut the text behind as many of its tokens (modulo one
    more than there are), the third makes ``rate`` per cent of the texts other than plain, the fourth lets the suffix lead
    in ``suffix_first`` per cent of these (spm), and the prefix in the rest (psm). An empty text and one that holds a
    separator stay plain, as does what ``rate`` leaves; their widths are null. A null text is empty, a null id the empty
    text; repeated rows and rows of equal ids are cut alike, whatever their order; an empty table gives an empty one. A
    text is one row's work, linear in its length.
    """
    small_batches(docs.sparkSession)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    t = docs.withColumn("_fim_text", whole_text(text_col)).withColumn("_fim", F.struct(*[x.alias(f"h{k + 1}") for k, x in enumerate(h)]))
    t = t.withColumn("_fim_cut", F.pandas_udf(_cuts, "n long, prefix_chars long, middle_chars long")("_fim_text", "_fim.h1", "_fim.h2"))
    text, held = F.col("_fim_text"), F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        held = held | text.contains(mark)
    form = F.when((text == "") | held | (F.col("_fim.h3") % 100 >= rate), "plain").when(F.col("_fim.h4") % 100 < suffix_first, "spm").otherwise("psm")
    start, width = (F.col(f"_fim_cut.{c}").cast("int") for c in ("prefix_chars", "middle_chars"))
    prefix, middle, suffix = F.substring(text, F.lit(1), start), F.substring(text, start + 1, width), F.substring(text, start + width + 1, F.length(text))
    t = t.withColumn("fim_form", form)
    output = (
        F.when(F.col("fim_form") == "plain", text)
        .when(F.col("fim_form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    cut_only = lambda c: F.when(F.col("fim_form") != "plain", F.col(f"_fim_cut.{c}"))
    new = {"fim_n": F.col("_fim_cut.n"), "fim_prefix_chars": cut_only("prefix_chars"), "fim_middle_chars": cut_only("middle_chars"), "fim_text": output}
    return t.withColumns(new).drop("_fim_text", "_fim", "_fim_cut")


def restored(text: Column, form: Column) -> Column:
    """The original text of an output. No separator begins before a separator and ends in it, so the first ones count."""
    psm = F.regexp_replace(text, f"(?s)^{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*)$", "$1$3$2")
    spm = F.regexp_replace(text, f"(?s)^{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*)$", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(text)


def op13_fill_in_middle(spark, sf_dir):
    out = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = restored(F.col("fim_text"), F.col("fim_form"))
    return out.select(
        "doc_id",
        F.col("fim_n").alias("n"),
        F.col("fim_form").alias("form"),
        F.col("fim_prefix_chars").alias("prefix_chars"),
        F.col("fim_middle_chars").alias("middle_chars"),
        F.sha2("fim_text", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS x FROM documents),
k AS (SELECT *, CASE WHEN t = '' THEN [] ELSE regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') END AS w, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(x, i, 8) AS BIGINT)) AS h FROM d),
c AS (SELECT *, len(w) AS n, least(h[1] % (len(w) + 1), h[2] % (len(w) + 1)) AS a, greatest(h[1] % (len(w) + 1), h[2] % (len(w) + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k),
p AS (SELECT *, coalesce(array_to_string(w[1:a], ''), '') AS pre, coalesce(array_to_string(w[a + 1:b], ''), '') AS mid, coalesce(array_to_string(w[b + 1:], ''), '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""
