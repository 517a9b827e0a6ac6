"""A third of all rows share one key: hot groups must collapse before the shuffle."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from textguard.operators import audit, curate
from textguard.sources.readers import table


@pytest.fixture(scope="module")
def skewed(spark):
    d = table(spark, SF_SMALL, "documents").select("doc_id", "text", "lang")
    hot = F.when(F.col("doc_id") % 3 == 0, F.lit("the same comment")).otherwise(F.col("text"))
    return d.withColumn("text", hot).withColumn("split", F.when(F.col("doc_id") % 2 == 0, "train").otherwise("test"))


def _partial_before_exchange(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.find("partial_") > plan.find("Exchange hashpartitioning") >= 0


def test_dedup_hot_text(spark, skewed):
    out = curate.dedup_exact(skewed.select("doc_id", "text"), "text", "doc_id")
    assert out.filter(F.col("text") == "the same comment").first().doc_id == 0
    assert out.count() == skewed.select("text").distinct().count()
    assert _partial_before_exchange(out)


def test_leakage_hot_text(spark, skewed):
    out = audit.leakage(skewed.withColumnRenamed("text", "source"))
    hot = out.filter(F.col("source") == "the same comment").first()
    assert hot.n_splits == 2 and hot.n_rows == skewed.filter("doc_id % 3 = 0").count()


def test_tag_integrity_does_not_multiply_rows(spark, skewed):
    lab = skewed.select("doc_id", F.col("text").alias("source"), F.col("lang").alias("origin_tags"))
    bad = audit.tag_integrity(lab, lab)
    assert bad.count() == 0  # each row's own tag is in its source's tag set
    changed = lab.withColumn("origin_tags", F.lit("zz"))
    assert audit.tag_integrity(changed, lab).count() == lab.count()
