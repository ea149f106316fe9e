"""Quality classifier: a sparse ensemble of rules over text statistics."""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_held_out, shared_folder, table, whole_text, word_count

Rule = tuple[tuple[int, bool, float], ...]  # (feature, at most?, threshold) of each condition


def counts(text: Column) -> dict[str, Column]:
    """What the statistics are made of, each taken from the text once.

    Characters of a kind are counted by the length of the text without all others: a list of matches, as
    ``regexp_count`` makes it, would have an entry for each of them. No pattern looks at a character more than a few times.
    """
    kept = lambda others: F.length(F.regexp_replace(text, others, "")).cast("double")
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    return {
        "chars": F.length(text).cast("double"),
        "words": word_count(text).cast("double"),
        "letters": kept(r"[^\p{L}]+"),
        "upper": kept(r"[^\p{Lu}]+"),
        "digits": kept("[^0-9]+"),
        "symbols": kept(r"[^#$%&*+/<=>@\\^_`|~{}\[\]!]+"),
        "bare": count(r"(?<!\S)[^\p{L}\p{N}\s]++(?!\S)"),
        "marked": count(r"(?<![^\p{L}\p{N}\s])[^\p{L}\p{N}\s]{2,}+(?!\S)"),
        "echoed": count(r"(?<!\S)(\S++)(?=\s\1(?!\S))"),
        "ends": count(r"[.!?](?!\S)"),
        "lines": F.filter(F.split(text, "\n"), lambda x: x != ""),
    }


def shares(c) -> dict[str, Column]:
    """Statistics of a text that don't depend on its language, where ``c`` gives a count by name; all are 0 for the empty text."""
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return {
        "log_words": F.log1p(c("words")),
        "word_length": share(c("chars"), c("words")),
        "upper_share": share(c("upper"), c("letters")),
        "digit_share": share(c("digits"), c("chars")),
        "symbol_share": share(c("symbols"), c("chars")),
        "letter_share": share(c("letters"), c("chars")),
        "bare_words": share(c("bare"), c("words")),
        "marked_words": share(c("marked"), c("words")),
        "echoed_words": share(c("echoed"), c("words")),
        "sentence_ends": share(c("ends"), c("words")),
        "repeated_lines": share(F.size(c("lines")) - F.size(F.array_distinct(c("lines"))), F.size(c("lines")).cast("double")),
    }


def statistics(text: Column) -> Column:
    """A struct of the statistics. The counts are bound to a lambda's variable, as each use would take them anew."""
    once = F.array(F.struct(*[c.alias(n) for n, c in counts(text).items()]))
    return F.transform(once, lambda x: F.struct(*[c.alias(n) for n, c in shares(lambda name: x[name]).items()]))[0]


FEATURES = ("log_words", "word_length", "upper_share", "digit_share", "symbol_share", "letter_share", "bare_words", "marked_words", "echoed_words", "sentence_ends", "repeated_lines")


def tree_rules(description: str) -> set[Rule]:
    """All conjunctions along the paths of a printed tree: one for each node below the root."""
    found, path = set(), []
    for line in description.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)", line)
        if m:
            depth, feature, at_most, threshold = len(m[1]), int(m[2]), m[3] == "<=", float(m[4])
            while path and path[-1][0] >= depth:
                path.pop()
            path.append((depth, (feature, at_most, threshold)))
            found.add(tuple(sorted({c for _, c in path})))
    return found


def rule_column(rule: Rule, value=F.col) -> Column:
    """The conjunction, where ``value`` gives the column of a statistic's name."""
    out = F.lit(True)
    for feature, at_most, threshold in rule:
        x = value(FEATURES[feature])
        out = out & ((x <= threshold) if at_most else (x > threshold))
    return out


class RuleEnsemble:
    """Rules, their weights, and the intercept."""

    def __init__(self, intercept: float, weights: dict[Rule, float]):
        self.intercept, self.weights = intercept, weights

    def score(self, value=F.col) -> Column:
        """The probability of label 1 as a column over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in sorted(self.weights.items()):
            total = total + F.when(rule_column(rule, value), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def score_text(self, text: Column) -> Column:
        """The probability as a column over a text. Its statistics are bound to a lambda's variable, as the optimiser
        would otherwise write them out anew for each condition of each rule."""
        return F.transform(F.array(statistics(text)), lambda s: self.score(lambda name: s[name]))[0]


def fit_rules(
    docs: DataFrame, labels: DataFrame, usable: Column | None = None, max_rows: int = 20_000, trees: int = 12, depth: int = 3, penalty: float = 0.001, seed: int = 6, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> RuleEnsemble:
    """Learns from at most ``max_rows`` labelled rows (the first in a seeded hash order of their ids).

    Trees of a random forest over the statistics give rules, one for each node's path; a logistic regression with an L1
    penalty weighs them, and those of weight 0 go. With labels of one kind only, the score is that label's; without any
    labels it is 1 (nothing is known against any text). Labels without a document, or null, are left out.
    """
    spark = docs.sparkSession
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if usable is not None:
        chosen = chosen.where(usable)
    chosen = chosen.groupBy(id_col).agg(F.max(label_col).cast("double").alias("_y")).orderBy(F.xxhash64(F.lit(seed), F.col(id_col)), id_col).limit(max_rows)
    sample = docs.select(id_col, whole_text(text_col).alias("_text")).join(F.broadcast(chosen), id_col)  # max_rows rows
    sample = sample.select(id_col, "_y", statistics(F.col("_text")).alias("_s")).select(id_col, "_y", "_s.*")
    path = shared_folder(spark)
    sample.write.parquet(path)
    # max_rows rows of a few numbers, in one partition and one order: reruns grow the same trees.
    sample = spark.read.schema(sample.schema).parquet(path).repartition(1).sortWithinPartitions(id_col, *FEATURES).cache()
    n, ones = sample.agg(F.count("*"), F.sum("_y")).first()
    if not n or ones in (0, n):
        return RuleEnsemble(40.0 if not n or ones else -40.0, {})
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="_x").transform(sample)
    forest = RandomForestClassifier(featuresCol="_x", labelCol="_y", numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird").fit(vectors)
    rules = sorted(set().union(*(tree_rules(t.toDebugString) for t in forest.trees)))
    coded = sample.select("_y", F.array(*[rule_column(r).cast("double") for r in rules]).alias("_r"))
    lasso = LogisticRegression(featuresCol="_x", labelCol="_y", elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=100).fit(coded.select("_y", array_to_vector("_r").alias("_x")))
    sample.unpersist()
    return RuleEnsemble(float(lasso.intercept), {r: float(w) for r, w in zip(rules, lasso.coefficients.toArray(), strict=True) if w})


def score_quality(docs: DataFrame, model: RuleEnsemble, least: float = 0.7, text_col: str = "text") -> DataFrame:
    """Adds ``score`` and ``predicted`` (1 if the score is ``least`` or more); columns of these names are replaced.

    Null texts are empty, and the empty text has a score like any other. Repeated rows are scored each, and an empty
    table gives an empty result.
    """
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    scored = docs.select(*kept, F.explode(F.array(model.score_text(whole_text(text_col)))).alias("score"))  # a generator's row is computed once
    return scored.withColumn("predicted", F.when(F.col("score") >= least, 1).otherwise(0))


def keep_good(docs: DataFrame, model: RuleEnsemble, least: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows whose score is ``least`` or more, with all their columns."""
    return docs.where(model.score_text(whole_text(text_col)) >= least)


def op6_rule_ensemble(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = fit_rules(docs, labels, ~crc_held_out(F.col("doc_id"), 4, 2))
    return score_quality(docs, model).select("doc_id", crc_held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted")
