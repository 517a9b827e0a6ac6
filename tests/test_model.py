"""Scorer, class scores and evaluation."""

import pandas as pd
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

import __spark_entry__ as se
from conftest import SF_SMALL
from textguard.operators import model
from textguard.plans import fixtures as fx


def test_weighted_f1_equals_ml_evaluator(spark):
    p = model.class_scores(fx.preds(spark, SF_SMALL))
    ours = model.weighted_f1(p).first().weighted_f1
    ml = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="f1").evaluate(
        p.select(F.col("label").cast("double"), F.col("prediction").cast("double"))
    )
    assert abs(ours - ml) < 1e-9


def test_scorer_failures_become_null_rows(spark):
    calls = {"n": 0}

    def flaky(pdf: pd.DataFrame) -> pd.DataFrame:
        raise RuntimeError("service down")

    df = spark.createDataFrame([(i, "you idiot") for i in range(5)], "row_id long, text string")
    out = model.score(df, flaky, retries=2).collect()
    assert len(out) == 5 and all(r.decision is None for r in out)
    ok = model.score(df).collect()
    assert all(r.decision == "PASS" and r.score == 2 and r.reason == "idiot" for r in ok)
    del calls


def test_one_poison_row_nulls_one_row(spark):
    def picky(pdf: pd.DataFrame) -> pd.DataFrame:
        if (pdf["text"] == "poison").any():
            raise ValueError("bad row")
        return pd.DataFrame({"row_id": pdf["row_id"], "decision": "PASS", "score": 1, "reason": "none"})

    df = spark.range(2000).select(F.col("id").alias("row_id"), F.when(F.col("id") == 77, "poison").otherwise("fine").alias("text")).coalesce(1)
    out = model.score(df, picky, retries=1, error_col="error").toPandas()
    assert len(out) == 2000 and out[out.decision.isna()].row_id.tolist() == [77]
    assert out[out.error.notna()].error.tolist() == ["ValueError: bad row"]


def test_classifier_reads_hangul(spark):
    from textguard.plans.fixtures import KOREAN_SENTENCES

    texts = [k[0] if isinstance(k, tuple) else k for k in KOREAN_SENTENCES]
    df = spark.createDataFrame([(t, float(i % 2)) for i, t in enumerate(texts)], "text string, label double")
    assert model.fit_classifier(df).transform(df).filter(F.size("_tokens") == 0).count() == 0


def test_classifier_end_to_end(spark):
    ev = se.queries()["m4_evaluate"](spark, SF_SMALL).first()
    assert 0.0 <= ev.weighted_f1 <= 1.0
    assert abs(ev.weighted_f1 - ev.evaluator_f1) < 1e-9
    pred = se.queries()["m3_classify"](spark, SF_SMALL)
    assert pred.filter("confidence < 0 OR confidence > 1").count() == 0


def test_evaluation_labels_and_reads_the_texts_once(spark, monkeypatch):
    """The labelled table is made once for both splits, and the measures of a model
    read its predictions, not the texts again."""
    made, labelled = [], fx.labelled
    monkeypatch.setattr(fx, "labelled", lambda *a: made.append(1) or labelled(*a))
    ev = se.queries()["m4_evaluate"](spark, SF_SMALL)
    assert len(made) == 1 and ev.first().n > 0
    assert "UDF" not in ev._jdf.queryExecution().optimizedPlan().toString()


def test_table_classifier_on_awkward_texts(spark):
    from textguard.operators import bayes

    train = spark.createDataFrame([("good words here", 0), ("bad words", 1), ("bad 나쁜 말", 1), (None, 0), ("", 0), ("no label", None)], "text string, label int").repartition(2)
    fitted = bayes.fit(train)
    weights = {(r["word"], r["label"]): r["weight"] for r in fitted.weights.collect()}
    assert len(weights) == 2 * 6 and weights["bad", 1] > weights["bad", 0] and ("label", 0) not in weights
    texts = [(1, "BAD, 나쁜!"), (2, "good here"), (3, None), (4, "unknown"), (5, "bad " * 500)]
    got = {r["id"]: r for r in bayes.predict(fitted, spark.createDataFrame(texts, "id long, text string"), "id").collect()}
    assert [got[i]["prediction"] for i in (1, 2, 3, 4, 5)] == [1, 0, 0, 0, 1]
    assert all(abs(sum(r["probs"].values()) - 1) < 1e-9 and r["confidence"] == max(r["probs"].values()) for r in got.values())
    assert got[3]["probs"] == got[4]["probs"] and abs(got[3]["probs"][0] - 0.6) < 1e-9  # the classes' shares
    assert bayes.predict(bayes.fit(train.limit(0)), spark.createDataFrame(texts, "id long, text string"), "id").count() == 0


def test_null_text_has_no_words(spark):
    from textguard.operators import policy

    row = policy.label(spark.createDataFrame([(1, None)], "doc_id long, text string"), toxic_col=None, quality_col=None).first()
    assert (row["action"], row["severity"], row["target"], row["category"]) == (0, 0, None, "NORMAL")
