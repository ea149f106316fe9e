"""Scores of transcripts, summaries and diarization."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..functions.alignment import common, edit_distances
from ..functions.numbers import fixed
from ..functions.text import eval_words, normalize_eval
from ..sources.shared import saved
from .intervals import atoms, collar

#: Characters up to which the JVM's own table of a text pair is small.
SHORT = 2048
#: Tasks that long texts are dealt to: a pair is one row, and its time the product of its lengths.
TASKS = 128


def word_edit_distance(a: Column, b: Column) -> Column:
    """Edit distance of two word arrays, of any length (see ``functions.alignment``)."""
    return F.pandas_udf(edit_distances, "long")(a, b).cast("int")


def char_edit_distance(a: Column, b: Column) -> Column:
    """Edit distance of two texts, of any length: of long ones on bits, as of words."""
    short = F.greatest(F.length(a), F.length(b)) <= SHORT
    long = F.pandas_udf(edit_distances, "long")(F.when(~short, a), F.when(~short, b)).cast("int")
    return F.when(short, F.levenshtein(a, b)).otherwise(long)


@F.pandas_udf(StructType([StructField(n, IntegerType()) for n in ("ones", "twos", "longest")]))
def overlaps(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Clipped shared words and word pairs of two word arrays, and their longest common subsequence."""
    rows = []
    for x, y in zip(a, b, strict=True):
        x, y = (list(z) if z is not None else [] for z in (x, y))
        rows.append((*(sum((Counter(zip(*(x[k:] for k in range(n)))) & Counter(zip(*(y[k:] for k in range(n))))).values()) for n in (1, 2)), common(x, y)))
    return pd.DataFrame(rows, columns=["ones", "twos", "longest"], dtype="int32")


def dealt(pairs: DataFrame) -> DataFrame:
    """The rows, a meeting in a task of its own where they are few: hashes of some tens of keys would meet in tasks."""
    return pairs.repartitionByRange(TASKS, "meeting_id")


def with_word_errors(pairs: DataFrame, empty_ref: str = "null") -> DataFrame:
    """Adds ref_len, edits and wer to (ref, hyp); without reference words edits are the hypothesis' words, and wer is
    null, or with ``empty_ref="01"`` 0 or 1."""
    p = pairs.withColumn("_r", eval_words(F.col("ref"))).withColumn("_h", eval_words(F.col("hyp")))
    p = p.withColumn("ref_len", F.size("_r")).withColumn("edits", word_edit_distance(F.col("_r"), F.col("_h")))
    none = F.when(F.size("_h") > 0, 1.0).otherwise(0.0) if empty_ref == "01" else F.lit(None).cast("double")
    return p.withColumn("wer", F.when(F.col("ref_len") == 0, none).otherwise(F.col("edits") / F.col("ref_len"))).drop("_r", "_h")


def with_char_errors(pairs: DataFrame) -> DataFrame:
    """Adds cer, over normalised text without spaces; without reference characters 0 or 1."""
    bare = lambda c: F.replace(normalize_eval(F.col(c)), F.lit(" "), F.lit(""))
    p = pairs.withColumn("_r", bare("ref")).withColumn("_h", bare("hyp"))
    n = F.length("_r")
    return p.withColumn("cer", F.when(n == 0, F.when(F.length("_h") > 0, 1.0).otherwise(0.0)).otherwise(char_edit_distance(F.col("_r"), F.col("_h")) / n)).drop("_r", "_h")


def _f1(overlap: Column, ref_total: Column, hyp_total: Column) -> Column:
    p, r = overlap / hyp_total, overlap / ref_total
    return F.when((overlap > 0) & (ref_total > 0) & (hyp_total > 0), 2 * p * r / (p + r)).otherwise(0.0)


def clipped(n: int):
    """How often two arrays of texts (each an array of words) share an n-gram, each as often as the side that has it less,
    and the n-grams of each side."""

    @F.pandas_udf(StructType([StructField(c, LongType()) for c in ("o", "ra", "hb")]))
    def overlap(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        rows = []
        for x, y in zip(a, b, strict=True):
            x, y = (Counter(g for words in side for g in zip(*(words[k:] for k in range(n)))) for side in (x, y))
            rows.append(((x & y).total(), x.total(), y.total()))
        return pd.DataFrame(rows, columns=["o", "ra", "hb"], dtype="int64")

    return overlap


def rouge_n(pairs: DataFrame, keys: list[str], n: int) -> DataFrame:
    """keys and f1 of clipped n-gram overlap of (ref, hyp), a row a pair; pairs of equal keys count as one.

    N-grams are counted where a pair's texts are and are never rows, which there are so many of that they fill a task.
    """
    words = lambda c: F.coalesce(eval_words(F.col(c)), F.array().cast("array<string>"))
    same = pairs.select(*keys, words("ref").alias("_r"), words("hyp").alias("_h")).groupBy(*keys).agg(F.collect_list("_r").alias("_r"), F.collect_list("_h").alias("_h"))
    own = same.select(*keys, F.size("_r").alias("_n"), clipped(n)("_r", "_h").alias("_o"))
    scored = own.select(*keys, "_n", _f1(F.col("_o.o"), F.col("_o.ra"), F.col("_o.hb")).alias("f1"))
    return scored.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_n")))).drop("_n")


def rouge(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, rouge1, rouge2, rougeL of (ref, hyp); null without reference words. A pair is one row's work."""
    p = pairs.select(*keys, eval_words(F.col("ref")).alias("_r"), eval_words(F.col("hyp")).alias("_h")).withColumn("_o", overlaps("_r", "_h"))
    n = lambda c, less: F.greatest(F.size(c) - less, F.lit(0))
    real = lambda name, less: F.when(F.size("_r") > 0, _f1(F.col(f"_o.{name}"), n("_r", less), n("_h", less)))
    return p.select(*keys, real("ones", 0).alias("rouge1"), real("twos", 1).alias("rouge2"), real("longest", 0).alias("rougeL"))


def best_assignment(costs: Column, n: Column) -> Column:
    """struct(cost, perm) of the least total cost of giving each of n rows a column of its own; the first permutation of
    equal ones. ``costs`` has n * n values, row after row.

    Rows are placed one after another; for each set of columns in use (a number by its bits) only the best way is kept,
    so that there are 2 ** n states instead of n! permutations.
    """
    none = F.lit(None).cast("struct<cost: bigint, perm: array<int>>")
    bit = lambda j: F.call_function("shiftleft", F.lit(1), j)
    sets, columns = F.sequence(F.lit(0), bit(n) - 1), F.sequence(F.lit(0), n - 1)
    start = F.transform(sets, lambda m: F.when(m == 0, F.struct(F.lit(0).cast("bigint").alias("cost"), F.array().cast("array<int>").alias("perm"))).otherwise(none))

    def place(state: Column, i: Column) -> Column:
        def best(m: Column) -> Column:
            last = F.filter(columns, lambda j: (m.bitwiseAND(bit(j)) != 0) & F.get(state, m - bit(j)).isNotNull())
            return F.array_min(F.transform(last, lambda j: F.struct((F.get(state, m - bit(j))["cost"] + F.get(costs, i * n + j)).alias("cost"), F.array_append(F.get(state, m - bit(j))["perm"], j).alias("perm"))))

        return F.transform(sets, best)

    return F.get(F.aggregate(columns, start, place), bit(n) - 1)


def cpwer(ref: DataFrame, hyp: DataFrame, max_speakers: int = 8) -> DataFrame:
    """Least word errors over all assignments of speakers, for tables (meeting_id, speaker, text).

    Texts are padded with empty ones to equal numbers (see ``best_assignment``); of equal costs the first permutation wins. Returns meeting_id,
    total_ref_words, total_edits, cpwer and assignment (array of ref_speaker, hyp_speaker); without reference words
    the scores are null; meetings of more than ``max_speakers`` have error ``too_many_speakers``.
    """
    none, whole = F.array().cast("array<string>"), Window.partitionBy("meeting_id")

    def side(df: DataFrame, place: str) -> DataFrame:
        own = df.withColumn(place, F.row_number().over(whole.orderBy("speaker", "text")) - 1).withColumn(f"n_{place}", F.count("*").over(whole))
        return own.select("meeting_id", place, f"n_{place}", F.col("speaker").alias(f"{place}_speaker"), F.coalesce(eval_words(F.col("text")), none).alias(f"{place}_words"))

    def listed(df: DataFrame, place: str, name: str) -> DataFrame:
        return df.groupBy("meeting_id").agg(F.transform(F.array_sort(F.collect_list(F.struct(place, f"{place}_speaker", F.size(f"{place}_words").alias("size")))), lambda x: F.struct(x[f"{place}_speaker"].alias("speaker"), x["size"].alias("size"))).alias(name))

    r, h = saved(side(ref, "i")), saved(side(hyp, "j"))
    m = listed(r, "i", "r").join(listed(h, "j", "h"), "meeting_id", "full")
    no_one = F.array().cast("array<struct<speaker:string,size:int>>")
    m = m.select("meeting_id", F.coalesce("r", no_one).alias("r"), F.coalesce("h", no_one).alias("h")).withColumn("n", F.greatest(F.size("r"), F.size("h")))
    m = m.withColumn("total_ref_words", F.aggregate("r", F.lit(0), lambda a, x: a + x["size"]))
    # A pair of speakers is a row, and meets its texts only here; who has no partner costs as many words as they said.
    pairs = r.where(F.col("n_i") <= max_speakers).join(h.where(F.col("n_j") <= max_speakers), "meeting_id").repartition(TASKS, "meeting_id", "i", "j").select("meeting_id", "i", "j", word_edit_distance(F.col("i_words"), F.col("j_words")).alias("cost"))
    pairs = pairs.groupBy("meeting_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "j", "cost"))), lambda x: x["cost"]).alias("known"))
    size = lambda c, k: F.coalesce(F.get(F.col(c), k)["size"], F.lit(0))
    cell = lambda i, j: F.when((i < F.size("r")) & (j < F.size("h")), F.get("known", i * F.size("h") + j)).otherwise(size("r", i) + size("h", j))
    places = F.sequence(F.lit(0), F.col("n") - 1)
    costs = m.where(F.col("n") <= max_speakers).join(pairs, "meeting_id", "left").withColumn("costs", F.flatten(F.transform(places, lambda i: F.transform(places, lambda j: cell(i, j)))))
    out = m.join(costs.select("meeting_id", best_assignment(F.col("costs"), F.col("n")).alias("best")), "meeting_id", "left")
    named = F.filter(F.transform("best.perm", lambda j, i: F.struct(F.get(F.col("r"), i)["speaker"].alias("ref_speaker"), F.get(F.col("h"), j)["speaker"].alias("hyp_speaker"))), lambda x: x["ref_speaker"].isNotNull() & x["hyp_speaker"].isNotNull())
    scored = F.col("total_ref_words") > 0
    return out.select(
        "meeting_id",
        "total_ref_words",
        F.when(scored, F.col("best.cost")).alias("total_edits"),
        F.when(scored, F.col("best.cost") / F.col("total_ref_words")).alias("cpwer"),
        F.when(scored, named).alias("assignment"),
        F.when(F.col("n") > max_speakers, "too_many_speakers").alias("error"),
    )


def speaker_mapping(timeline: DataFrame, max_speakers: int = 8) -> DataFrame:
    """(meeting_id, hyp_speaker, ref_speaker) that maximises the time both are alone; ties go to the first permutation.

    Meetings of more speakers are mapped greedily by overlap. Padding may map a pair without any overlap.
    """
    alone = timeline.where("size(ref) = 1 AND size(hyp) = 1").select("meeting_id", F.col("hyp")[0].alias("h"), F.col("ref")[0].alias("r"), (F.col("end_ms") - F.col("start_ms")).alias("ms"))
    time = alone.groupBy("meeting_id", "h", "r").agg(F.sum("ms").alias("ms"))
    m = time.groupBy("meeting_id").agg(F.array_sort(F.collect_set("h")).alias("hs"), F.array_sort(F.collect_set("r")).alias("rs"), F.map_from_entries(F.collect_list(F.struct(F.concat("h", F.lit("\u0001"), "r"), "ms"))).alias("w"))
    m = m.withColumn("n", F.greatest(F.size("hs"), F.size("rs")))
    cell = lambda i, j: F.coalesce(F.element_at(F.col("w"), F.concat(F.get(F.col("hs"), i), F.lit("\u0001"), F.get(F.col("rs"), j))), F.lit(0).cast("long"))
    few, places = m.where(F.col("n") <= max_speakers), F.sequence(F.lit(0), F.col("n") - 1)
    best = few.withColumn("c", F.flatten(F.transform(places, lambda i: F.transform(places, lambda j: -cell(i, j))))).withColumn("b", best_assignment(F.col("c"), F.col("n")))
    exact = best.select("meeting_id", F.explode(F.transform("b.perm", lambda j, i: F.struct(F.get(F.col("hs"), i).alias("h"), F.get(F.col("rs"), j).alias("r")))).alias("x")).select("meeting_id", F.col("x.h").alias("hyp_speaker"), F.col("x.r").alias("ref_speaker"))
    many = time.join(m.where(F.col("n") > max_speakers).select("meeting_id"), "meeting_id", "left_semi")
    greedy = many.groupBy("meeting_id").applyInPandas(_greedy, "meeting_id string, hyp_speaker string, ref_speaker string")
    return exact.where("hyp_speaker IS NOT NULL AND ref_speaker IS NOT NULL").unionByName(greedy)


def _greedy(pairs: pd.DataFrame) -> pd.DataFrame:
    taken, used_h, used_r = [], set(), set()
    for x in pairs.sort_values(["ms", "h", "r"], ascending=[False, True, True]).itertuples():
        if x.h not in used_h and x.r not in used_r:
            taken.append((str(x.meeting_id), x.h, x.r))
            used_h.add(x.h)
            used_r.add(x.r)
    return pd.DataFrame(taken, columns=["meeting_id", "hyp_speaker", "ref_speaker"])


def der(reference: DataFrame, hypothesis: DataFrame, collar_ms: int = 250, skip_overlap: bool = True) -> DataFrame:
    """Diarization error of each meeting with a reference: der, and false alarm, miss, confusion, scored and ignored ms."""
    line = saved(atoms(collar(reference, collar_ms), hypothesis))  # for the mapping and for the scores
    mapping = speaker_mapping(line).groupBy("meeting_id").agg(F.map_from_entries(F.collect_list(F.struct("hyp_speaker", "ref_speaker"))).alias("map"))
    a = line.join(mapping, "meeting_id", "left").withColumn("d", F.col("end_ms") - F.col("start_ms"))
    ignored = F.lit(skip_overlap) & (F.size("ref") > 1)
    scored = ~ignored & (F.size("ref") > 0)
    match = F.exists("hyp", lambda h: F.coalesce(F.element_at(F.col("map"), h) == F.col("ref")[0], F.lit(False)))
    add = lambda cond, ms: F.sum(F.when(cond, ms).otherwise(0))
    t = a.groupBy("meeting_id").agg(
        (add(~ignored & (F.size("ref") == 0), F.col("d") * F.size("hyp")) + add(scored & (F.size("hyp") > 1), F.col("d") * (F.size("hyp") - 1))).alias("false_alarm_ms"),
        add(scored & (F.size("hyp") == 0), F.col("d")).alias("miss_ms"),
        add(scored & (F.size("hyp") > 0) & ~match, F.col("d")).alias("confusion_ms"),
        add(scored, F.col("d")).alias("scored_ms"),
        add(ignored, F.col("d")).alias("ignored_ms"),
    )
    return t.withColumn("der", F.when(F.col("scored_ms") > 0, (F.col("false_alarm_ms") + F.col("miss_ms") + F.col("confusion_ms")) / F.col("scored_ms")))


def evaluation_rows(meetings: DataFrame, texts: DataFrame, ref_views: DataFrame, hyp_views: DataFrame, reference: DataFrame, hypothesis: DataFrame, summaries: DataFrame, collar_ms: int = 250) -> DataFrame:
    """A row a meeting with all its scores as text of six decimals, blank where one is missing, and error codes.

    ``texts`` and ``summaries`` (meeting_id, ref, hyp), ``ref_views`` and ``hyp_views`` (meeting_id, speaker, text) for
    cpWER, ``reference`` and ``hypothesis`` segments for DER. A metric that fails or has nothing to score leaves the others
    as they are; a failed one has a code ``metric:reason``.
    """
    blank = lambda c: F.coalesce(fixed(c, 6), F.lit(""))
    sec = lambda c: blank(F.col(c) / 1000.0)
    long = dealt(texts.where(F.coalesce("ref", F.lit("")) != ""))
    words = with_char_errors(with_word_errors(long, empty_ref="01")).select("meeting_id", "wer", "cer")
    cp = cpwer(ref_views, hyp_views).select("meeting_id", "total_ref_words", "total_edits", "cpwer", F.col("error").alias("_error"))
    line = der(reference, hypothesis, collar_ms)
    own = rouge(summaries.where(F.coalesce("ref", F.lit("")) != ""), ["meeting_id"])
    out = meetings.select("meeting_id").distinct()
    for part in (words, cp, line, own):
        out = out.join(part, "meeting_id", "left")
    count = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return out.select(
        "meeting_id",
        *[blank(F.col(c)).alias(c) for c in ("wer", "cer", "cpwer", "der")],
        *[sec(f"{c}_ms").alias(f"der_{n}_sec") for c, n in (("false_alarm", "false_alarm"), ("miss", "miss"), ("confusion", "confusion"), ("scored", "scored_ref_time"), ("ignored", "ignored_ref_overlap_time"))],
        F.when(F.col("scored_ms").isNotNull(), fixed(F.lit(collar_ms / 1000.0), 2)).otherwise("").alias("der_collar_sec"),
        count("total_ref_words").alias("cpwer_total_ref_words"),
        count("total_edits").alias("cpwer_total_edits"),
        F.array_join(F.array_compact(F.array(F.when(F.col("_error").isNotNull(), F.concat(F.lit("cpwer:"), "_error")))), ";").alias("speech_metric_errors"),
        *[blank(F.col(c)).alias(c) for c in ("rouge1", "rouge2", "rougeL")],
    )
