"""Licence scan by a positional index of rare licence words."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_WORDS, lower_az, stash, table, whole_text

# The phrases whose places are counted, and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Label, licence wording as words, and the phrases of it without which there is no such licence.
TEMPLATES = (
    ("gpl", "this work is licensed under the gnu general public license version 3", ("gnu general public license",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version", ("terms of the gnu general public license", "free software foundation")),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", ("gnu lesser general public license",)),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation", ("gnu affero general public license",)),
    ("apache", "licensed under the apache license version 2 0", ("apache license",)),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", ("unless required by applicable law", "as is basis")),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ("permission is hereby granted free of charge", "deal in the software without restriction")),
    ("mit", "released under the mit license", ("mit license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "conditions are met")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "with or without fee is hereby granted")),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software released into the public domain",)),
    ("cc0", "to the extent possible under law the author has dedicated all copyright and related rights to the public domain", ("possible under law", "to the public domain")),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0 international",)),
)


#: All words of the wording and of the base phrases.
VOCABULARY = sorted({w for _, text, _ in TEMPLATES for w in text.split()} | {w for p in BASE_PHRASES for w in p.split()})


def places(hits: Column, phrase: list[str]) -> Column:
    """Starts at which the phrase's words stand consecutively, from a text's hits (word, at) in order. All words of the
    phrase are in the vocabulary, so that neighbours in the text are neighbours among the hits."""

    def here(x: Column, j: Column) -> Column:
        out = x["word"] == phrase[0]
        for k, w in enumerate(phrase[1:], 1):
            after = F.get(hits, j + k)
            out = out & F.coalesce((after["word"] == w) & (after["at"] == x["at"] + k), F.lit(False))
        return out

    return F.transform(F.filter(hits, here), lambda x: x["at"])


def rare_index(df: dict[str, int], n_docs: int, rare_words: int, share: float) -> list[tuple]:
    """Postings (template, label, word, place, weight) of each template's rarest words.

    Words of all templates are ranked by inverse document frequency. A template is looked up by its ``rare_words``
    rarest of those that at most ``share`` of all documents hold; by its two rarest if fewer are so rare.
    """
    idf = {w: math.log((n_docs + 1) / (df.get(w, 0) + 0.5)) for w in VOCABULARY}
    out = []
    for t, (label, text, _) in enumerate(TEMPLATES):
        own = text.split()
        ranked = sorted(set(own), key=lambda w: (-idf[w], w))
        rare = [w for w in ranked if df.get(w, 0) <= share * n_docs][:rare_words]
        rare = rare if len(rare) >= 2 else ranked[:2]
        weight = sum(idf[w] for w in own if w in rare)
        out += [(t, label, w, k, idf[w] / weight if weight > 0 else 1 / sum(x in rare for x in own)) for k, w in enumerate(own) if w in rare]
    return out


def scan_licences(docs: DataFrame, rare_words: int = 6, least: float = 0.8, share: float = 0.02, slack: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Finds licence wording: rare words first, then their relative places, then mandatory phrases.

    Each text is cut into words once, and its words of the vocabulary are written with their places; all else works on
    these. Document frequencies are counted over all documents, and each template is looked up by its rarest words (see
    ``rare_index``). A document's occurrences of such words meet the postings by word; those that agree on where the
    template would start (relative place) add their weight, and a template with at least ``least`` of its rare words'
    weight at one start is a candidate. It is confirmed when all its mandatory phrases stand where that start puts
    them, give or take ``slack`` words: phrases are located once a document, and each place names the starts that it
    can serve, so that candidates and places meet by equality and the work grows with the text's length.

    Returns one row per input row: id, n_words, base (places of the base phrases), base_labels, labels (base and
    found ones), score (the best share of weight, 1 where a base phrase stands, 0 without any find). Null texts are
    empty; repeated rows are scanned each by themselves; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    words = F.regexp_extract_all(lower_az(whole_text(text_col)), F.lit(f"({ALNUM_WORDS})"), F.lit(1))
    cut = docs.select(F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("uid"), F.explode(F.array(words)).alias("_words"))  # a generator's row is computed once
    at = F.filter(F.transform("_words", lambda w, i: F.when(w.isin(VOCABULARY), i)), lambda i: i.isNotNull())
    hits = F.transform(at, lambda i: F.struct(F.get("_words", i).alias("word"), i.alias("at")))
    read = stash(cut.select("_id", "uid", F.size("_words").cast("long").alias("n_words"), hits.alias("hits")))

    seen = read.select(F.explode(F.array_distinct(F.transform("hits", lambda x: x["word"]))).alias("word"))
    df = {r[0]: r[1] for r in seen.groupBy("word").count().collect()}  # a row for each word of the vocabulary at most
    postings = rare_index(df, read.count(), rare_words, share)
    index = spark.createDataFrame(postings, "template int, label string, word string, place int, weight double")
    rare = sorted({x[2] for x in postings})

    found = read.select("uid", F.explode(F.filter("hits", lambda x: x["word"].isin(rare))).alias("x")).select("uid", "x.*")
    starts = found.join(F.broadcast(index), "word").groupBy("uid", "template", "label", (F.col("at") - F.col("place")).alias("start")).agg(F.sum("weight").alias("weight"))
    candidates = starts.where(F.col("weight") >= least - 1e-9)
    located = _phrase_starts(read.join(candidates.select("uid").distinct(), "uid", "left_semi"), slack)
    confirmed = candidates.join(located, ["uid", "template", "start"])
    kept = confirmed.groupBy("uid").agg(F.collect_set("label").alias("_labels"), F.max("weight").alias("_weight"))  # a label a template at most

    base = read.select("_id", "uid", "n_words", *[places(F.col("hits"), p.split()).alias(f"_b{k}") for k, p in enumerate(BASE_PHRASES)])
    base = base.select(
        "_id",
        "uid",
        "n_words",
        F.flatten(F.array(*[F.col(f"_b{k}") for k in range(len(BASE_PHRASES))])).alias("base"),
        F.array_compact(F.array(*[F.when(F.size(f"_b{k}") > 0, F.lit(label)) for k, label in enumerate(BASE_PHRASES.values())])).alias("base_labels"),
    )
    return base.join(kept, "uid", "left").select(
        F.col("_id").alias(id_col),
        "n_words",
        "base",
        F.array_sort(F.array_distinct("base_labels")).alias("base_labels"),
        F.array_sort(F.array_distinct(F.concat("base_labels", F.coalesce("_labels", F.array().cast("array<string>"))))).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.least(F.lit(1.0), F.coalesce("_weight", F.lit(0.0)))).alias("score"),
    )


def _phrase_starts(read: DataFrame, slack: int) -> DataFrame:
    """(uid, template, start) at which all mandatory phrases of the template stand, from texts (uid, hits)."""
    phrases = sorted({p for _, _, own in TEMPLATES for p in own})
    rules = [(t, phrases.index(p), len(f" {text} ".partition(f" {p} ")[0].split()), len(set(own))) for t, (_, text, own) in enumerate(TEMPLATES) for p in own]
    rules = read.sparkSession.createDataFrame(rules, "template int, phrase int, place int, phrases int")
    at = F.arrays_zip(F.array(*map(F.lit, range(len(phrases)))).alias("phrase"), F.array(*[places(F.col("hits"), p.split()) for p in phrases]).alias("at"))
    located = read.select("uid", F.explode(at).alias("x")).select("uid", "x.phrase", F.explode("x.at").alias("at")).join(F.broadcast(rules), "phrase")  # a row for each phrase of a template
    first = F.col("at") - F.col("place")
    starts = located.select("uid", "template", "phrase", "phrases", F.explode(F.sequence(first - slack, first + slack)).alias("start"))
    return starts.groupBy("uid", "template", "start").agg(F.size(F.collect_set("phrase")).alias("n"), F.first("phrases").alias("phrases")).where("n = phrases").drop("n", "phrases")


def op2_licence_scan(spark, sf_dir):
    found = scan_licences(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base").cast("long").alias("first_word"),
        F.array_max("base").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )
