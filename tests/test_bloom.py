"""Anti-joins behind a filter give the rows of the plain join, and shuffle hits only."""

import random

import pytest
from pyspark.sql import functions as F

from textguard.operators import bloom


@pytest.mark.parametrize("max_bits", [bloom.MAX_BITS, 0])
@pytest.mark.parametrize("kind", ["long", "string", "binary"])
def test_rows_of_the_plain_join(spark, kind, max_bits):
    rng = random.Random(1)
    rows = spark.createDataFrame([(i, None if i % 50 == 0 else rng.randrange(3000)) for i in range(2000)], "i long, k long").withColumn("k", F.col("k").cast("string").cast(kind) if kind != "long" else F.col("k"))
    done = spark.createDataFrame([(rng.randrange(3000) if i % 9 else None,) for i in range(700)], "k long").withColumn("k", F.col("k").cast("string").cast(kind) if kind != "long" else F.col("k"))
    got = bloom.anti_join(rows, done, "k", max_bits)
    assert got.columns == rows.columns
    want = rows.join(done, "k", "left_anti")
    assert sorted(r["i"] for r in got.collect()) == sorted(r["i"] for r in want.collect())


def test_nothing_done_and_no_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "i long, k string")
    none = spark.createDataFrame([], "k string")
    assert bloom.anti_join(rows, none, "k").count() == 2 and bloom.anti_join(rows, spark.createDataFrame([(None,)], "k string"), "k").count() == 2
    assert bloom.anti_join(rows.limit(0), rows, "k").count() == 0 and [r["i"] for r in bloom.anti_join(rows, rows, "k").collect()] == [2]


def test_excluded_rows_are_not_shuffled(spark, tmp_path):
    spark.range(0, 5000).select(F.col("id").alias("k"), F.lit("wide text").alias("text")).write.parquet(str(tmp_path / "rows"))
    rows, done = spark.read.parquet(str(tmp_path / "rows")), spark.range(0, 300).select(F.col("id").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = bloom.anti_join(rows, done, "k")._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    passing, joined = plan.split("LeftAnti")[0].strip(), plan
    first = plan[plan.index("Union") : plan.index("LeftAnti")]
    assert "Exchange" not in first and "Scan parquet" in first and "scalar-subquery" in passing and joined.count("LeftAnti") == 1


def test_false_hits_are_few(spark):
    keys = spark.range(0, 2000).select(F.col("id").alias("k"))
    bits = 1 << 15
    words = bloom.build(keys, "k", bits).scalar()
    others = spark.range(10_000, 30_000).select(F.col("id").alias("k"))
    assert keys.filter(bloom.may_hold(words, F.col("k"), bits)).count() == 2000
    assert others.filter(bloom.may_hold(words, F.col("k"), bits)).count() < 600


def test_missing_rows_digest_each_text_once(spark):
    """The anti-join and its filter use the digests over and over; no text is read for them again."""
    from textguard.operators import diff

    rows = [(i, None if i % 11 == 0 else f"text, number {i % 400}!") for i in range(600)]
    raw = spark.createDataFrame(rows, "doc_id long, text string")
    proc = raw.filter("doc_id % 400 not in (5, 77)").filter("text is not null").withColumn("text", F.upper("text")).withColumn("text", F.lower("text"))
    out = diff.missing_rows(raw, proc)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "md5(" not in plan and "regexp" not in plan
    want = sorted(i for i, t in rows if t is None or i % 400 in (5, 77))
    assert out.columns == raw.columns and sorted(r[0] for r in out.collect()) == want
