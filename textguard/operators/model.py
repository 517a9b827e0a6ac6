"""Scoring, classification and evaluation.

The pluggable scorer (M1) is the one place Python runs per batch: Arrow batches
through ``mapInPandas``, for functions of the caller such as a model client. The
default scorer is the lexicon rule, in column expressions. Training and
inference use ``pyspark.ml`` so they run distributed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textguard.functions import lexicon as lx
from textguard.functions import rules
from textguard.functions import text as tx
from textguard.schemas import SAFETY_SCORE_LIMIT, TOXICITY_THRESHOLD
from textguard.session import materialize

SCORE_SCHEMA = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("decision", T.StringType()),
        T.StructField("score", T.IntegerType()),
        T.StructField("reason", T.StringType()),
    ]
)


# --------------------------------------------------------------------------- M1
def rule_scores(df: DataFrame, lexicon=lx.DEFAULT_LEXICON) -> DataFrame:
    """Default scorer as column expressions: ``(row_id, text)`` -> SCORE_SCHEMA.

    score = 1 + min(4, distinct lexicon hits); BLOCK from the screening limit up."""
    kw = F.coalesce(lx.keywords(F.col("text"), lexicon), F.array().cast("array<string>"))
    rows = df.select(F.col("row_id").cast("bigint").alias("row_id"), kw.alias("_kw")).withColumn("score", (F.least(F.size("_kw"), F.lit(4)) + 1).cast("int"))
    return rows.select(
        "row_id",
        F.when(F.col("score") >= SAFETY_SCORE_LIMIT, F.lit("BLOCK")).otherwise(F.lit("PASS")).alias("decision"),
        "score",
        F.when(F.size("_kw") > 0, F.array_join("_kw", ", ")).otherwise(F.lit("none")).alias("reason"),
    )


def score(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame] | None = None,
    schema: T.StructType = SCORE_SCHEMA,
    retries: int = 3,
    error_col: str | None = None,
) -> DataFrame:
    """M1: run a batch scorer over ``(row_id, text)`` in Arrow batches (without
    ``fn``: the rule scorer, as columns).

    A batch that still fails after ``retries`` calls is halved, and its halves
    again, down to the rows that fail on their own: only those get nulls (a
    failed call, dropped downstream by F7), and ``error_col``, if named, says
    why. Keep ``fn`` idempotent: Spark may re-run a task.
    """
    if fn is None:
        out = rule_scores(df)
        return out.withColumn(error_col, F.lit(None).cast("string")) if error_col else out
    names = [f.name for f in schema.fields]
    full = T.StructType([*schema.fields, *([T.StructField(error_col, T.StringType())] if error_col else [])])

    def attempt(pdf: pd.DataFrame) -> list[pd.DataFrame]:
        error = ""
        for _ in range(max(1, retries)):
            try:
                out = fn(pdf)[names]
                return [out.assign(**{error_col: None}) if error_col else out]
            except Exception as e:  # noqa: BLE001 - the scorer is user code; its error is reported by row
                error = f"{type(e).__name__}: {e}"
        if len(pdf) > 1:
            half = len(pdf) // 2
            return attempt(pdf.iloc[:half].reset_index(drop=True)) + attempt(pdf.iloc[half:].reset_index(drop=True))
        failed = pd.DataFrame({n: [None] * len(pdf) for n in names})
        failed[names[0]] = pdf["row_id"].values
        return [failed.assign(**{error_col: error}) if error_col else failed]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for out in attempt(pdf):
                yield out[[f.name for f in full.fields]]

    return df.select(F.col("row_id").cast("bigint").alias("row_id"), F.col("text")).mapInPandas(run, full)


# --------------------------------------------------------------------------- X8
def class_scores(df: DataFrame, logits: str = "logits") -> DataFrame:
    """Softmax probabilities, argmax prediction, confidence and label name."""
    probs = tx.softmax(F.col(logits))
    return (
        df.withColumn("probs", probs)
        .withColumn("prediction", tx.argmax(F.col("probs")))
        .withColumn("confidence", tx.confidence(F.col("probs")))
        .withColumn("label_name", tx.label_of(F.col("prediction")))
    )


# --------------------------------------------------------------------------- A11-A13
def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction) with a correct flag."""
    return pred.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    ).withColumn("correct", F.col("label") == F.col("prediction"))


def weighted_f1(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Sum over classes of support/N * 2TP/(2TP+FP+FN) (0 when undefined).

    Computed from the confusion relation (classes^2 rows), never from rows on
    the driver. 2TP+FP+FN = support + predicted count of the class.
    """
    cm = confusion(pred, label, prediction)
    roles = F.array(
        F.struct(F.col("label").alias("c"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"), F.lit(0).cast("bigint").alias("tp")),
        F.struct(F.col("prediction").alias("c"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"), F.when(F.col("correct"), F.col("n")).otherwise(F.lit(0)).cast("bigint").alias("tp")),
    )
    per_class = cm.select(F.explode(roles).alias("r")).groupBy(F.col("r.c").alias("c")).agg(
        F.sum("r.support").alias("support"), F.sum("r.predicted").alias("predicted"), F.sum("r.tp").alias("tp")
    )
    f1 = F.when(F.col("support") + F.col("predicted") > 0, 2.0 * F.col("tp") / (F.col("support") + F.col("predicted"))).otherwise(0.0)
    return per_class.agg(
        (F.sum(F.col("support") * f1) / F.sum("support")).alias("weighted_f1"),
        F.sum("support").alias("n"),
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
    )


def build_vocab(df: DataFrame, side: str, min_freq: int = 1) -> DataFrame:
    """Whitespace tokens of one side with frequency >= min_freq."""
    return (
        df.select(F.explode(tx.tokens(F.col(side))).alias("token"))
        .filter(F.length("token") > 0)
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_freq)
    )


# --------------------------------------------------------------------------- M2-M4
def fit_classifier(
    train: DataFrame,
    text: str = "text",
    label: str = "label",
    num_features: int = 1 << 18,
    algo: str = "nb",
    max_iter: int = 50,
    reg: float = 0.01,
) -> PipelineModel:
    """M2: tokenise -> hashed term frequencies -> IDF -> classifier.

    ``algo='nb'`` (default) is multinomial naive Bayes: training is one
    aggregation pass over the data, which is what a corpus of any size can
    afford. ``algo='lr'`` is multinomial logistic regression (one pass per
    optimiser iteration; better calibrated, costlier at scale). Texts are read and
    cut into words once: what is fitted reads the pinned term frequencies.
    """
    if algo == "nb":
        clf = NaiveBayes(featuresCol="_features", labelCol=label, modelType="multinomial", smoothing=1.0)
    elif algo == "lr":
        clf = LogisticRegression(featuresCol="_features", labelCol=label, family="multinomial", maxIter=max_iter, regParam=reg)
    else:
        raise ValueError("algo must be 'nb' or 'lr'")
    words = PipelineModel(
        [
            RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=r"[^\p{L}\p{N}]+", minTokenLength=1),
            HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features),
        ]
    )
    rows = words.transform(train.select(text, F.col(label).cast("double").alias(label))).select("_tf", label)
    fitted = Pipeline(stages=[IDF(inputCol="_tf", outputCol="_features"), clf]).fit(materialize(rows, "term-counts"))
    return PipelineModel([*words.stages, *fitted.stages])


def classify(model: PipelineModel, df: DataFrame, text: str = "text", theta: float = TOXICITY_THRESHOLD) -> DataFrame:
    """M3: predictions with class probabilities, confidence, label name and the
    F12 route: toxicity (1 - P(NORMAL)) >= theta -> purified text, else original."""
    out = model.transform(df).withColumn("probs", vector_to_array("probability"))
    out = (
        out.withColumn("prediction", F.col("prediction").cast("int"))
        .withColumn("confidence", tx.confidence(F.col("probs")))
        .withColumn("label_name", tx.label_of(F.col("prediction")))
        .withColumn("toxicity", 1.0 - F.element_at("probs", 1))
    )
    routed = rules.threshold_route(F.col("toxicity"), lx.purify(F.col(text)), F.col(text), theta)
    return out.withColumn("output", routed).drop("_tokens", "_tf", "_features", "rawPrediction", "probability")


def evaluate(model: PipelineModel, test: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """M4: weighted F1 (ours) next to the ML evaluator's value on the held-out split."""
    pred = classify(model, test.withColumn(label, F.col(label).cast("double")), text)
    pred = materialize(pred.select(label, "prediction"), "predictions")  # both measures read it
    ml = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="f1").evaluate(
        pred.withColumn("prediction", F.col("prediction").cast("double"))
    )
    return weighted_f1(pred, label, "prediction").withColumn("evaluator_f1", F.lit(ml))
