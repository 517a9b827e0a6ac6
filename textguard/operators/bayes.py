"""A text classifier kept as a table of weights (M2-M4).

Multinomial naive Bayes over words, fitted and applied with joins and sums: one
aggregation over the training texts gives the weights (a row for each word and
class), which are written once and serve any number of texts. No model object is
collected to the driver; what SQL can read can be checked, patched and joined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textguard.session import materialize

#: What stands between words (letters and digits of any script).
BETWEEN = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-case words; none of a null text."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN), lambda w: w != "")


@dataclass
class Bayes:
    """``weights`` (word, label, weight) and ``classes`` (label, prior): logarithms, pinned."""

    weights: DataFrame
    classes: DataFrame


def fit(train: DataFrame, text: str = "text", label: str = "label", smoothing: float = 1.0) -> Bayes:
    """M2: log((n + s) / (N + s * V)) for a word's count n in a class of N words,
    over a vocabulary of V; log share of the class's texts. Null labels are left
    out. A word's counts are summed in the tasks before they are sent."""
    rows = train.select(F.col(label).cast("int").alias("label"), words(F.col(text)).alias("w")).filter(F.col("label").isNotNull())
    classes = materialize(rows.groupBy("label").agg(F.count(F.lit(1)).alias("texts"), F.sum(F.size("w")).alias("n_words")), "bayes-classes")
    counts = rows.select("label", F.explode("w").alias("word")).groupBy("word", "label").agg(F.count(F.lit(1)).alias("n"))
    by_word = materialize(counts.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("n")), "bayes-words")  # a class is met once
    # The classes are a few rows: one value of the plan.
    every = classes.agg(F.collect_list(F.struct("label", "n_words")).alias("c")).scalar()
    vocabulary = by_word.agg(F.count(F.lit(1)).alias("v")).scalar()
    spread = by_word.select("word", "n", F.explode(every).alias("c"), vocabulary.alias("v"))
    n = F.coalesce(F.col("n")[F.col("c.label")], F.lit(0))
    weights = spread.select("word", F.col("c.label").alias("label"), F.log((n + smoothing) / (F.col("c.n_words") + smoothing * F.col("v"))).alias("weight"))
    texts = classes.agg(F.sum("texts").alias("t")).scalar()
    return Bayes(materialize(weights, "bayes-weights"), materialize(classes.select("label", F.log(F.col("texts") / texts).alias("prior")), "bayes-priors"))


def predict(model: Bayes, df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """M3: (key, prediction, confidence, probs map<label, probability>), a row for
    every key (unique). Words that were not learnt say nothing; a tie goes to the
    smaller label. A text's words are counted before they are joined."""
    terms = df.select(F.col(key).alias("_k"), F.explode(words(F.col(text))).alias("word")).groupBy("_k", "word").agg(F.count(F.lit(1)).alias("n"))
    told = terms.join(model.weights, "word").groupBy("_k", "label").agg(F.sum(F.col("n") * F.col("weight")).alias("s"))
    every = model.classes.agg(F.collect_list(F.struct("label", "prior")).alias("c")).scalar()
    base = df.select(F.col(key).alias("_k"), F.explode(every).alias("c")).select("_k", "c.label", "c.prior")
    scored = base.join(told, ["_k", "label"], "left").select("_k", "label", (F.col("prior") + F.coalesce("s", F.lit(0.0))).alias("s"))
    by_key = scored.groupBy("_k").agg(F.array_sort(F.collect_list(F.struct((-F.col("s")).alias("cost"), "label"))).alias("c"))  # a few classes
    odds = F.transform("c", lambda x: F.exp(F.col("c")[0]["cost"] - x["cost"]))
    total = F.aggregate(odds, F.lit(0.0), lambda a, x: a + x)
    probs = F.map_from_arrays(F.transform("c", lambda x: x["label"]), F.transform(odds, lambda x: x / F.col("_total")))
    return by_key.withColumn("_total", total).select(F.col("_k").alias(key), F.col("c")[0]["label"].alias("prediction"), (1 / F.col("_total")).alias("confidence"), probs.alias("probs"))
