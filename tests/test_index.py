"""Positions: equal to a plain window, invariant to input partitioning, and never
planned through a single-partition exchange over the data."""

import pytest
import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from textguard.operators import index, split
from textguard.operators.index import global_index, hex_buckets
from textguard.sources.readers import table


def _docs(spark):
    return table(spark, SF_SMALL, "documents").select("doc_id", "lang", "n_chars")


def _plain(df, order, strata=()):
    w = Window.partitionBy(*strata).orderBy(*order) if strata else Window.orderBy(*order)
    return df.withColumn("want", F.row_number().over(w) - 1)


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_range_index_matches_window_and_partitioning(spark, parts):
    d = _docs(spark).repartition(parts)
    got = global_index(d, ["lang", "doc_id"], out="idx")
    both = got.join(_plain(_docs(spark), ["lang", "doc_id"]).select("doc_id", "want"), "doc_id")
    assert both.count() == _docs(spark).count()
    assert both.filter("idx <> want").count() == 0


@pytest.mark.parametrize("parts", [1, 5])
def test_bucket_index_with_strata(spark, parts):
    d = _docs(spark).repartition(parts).withColumn("_h", split.shuffle_key(F.col("doc_id")))
    got = global_index(d, ["_h", "doc_id"], strata=["lang"], out="idx", buckets=hex_buckets(F.col("_h")))
    want = _plain(d, ["_h", "doc_id"], ["lang"]).select("doc_id", "want")
    assert got.join(want, "doc_id").filter("idx <> want").count() == 0


def test_ranges_follow_the_input_of_a_join(spark, monkeypatch):
    """The planner's estimate of a join is the product of both sides; the number
    of ranges grows with their sum."""
    d, labels = _docs(spark), table(spark, SF_SMALL, "labels")
    read = sum(os.path.getsize(f"{SF_SMALL}/{n}.parquet") for n in ("documents", "labels"))
    monkeypatch.setattr(index, "RANGE_BYTES", read // 40)
    joined = d.join(labels, "doc_id", "left").select("doc_id")
    assert 8 <= index.ranges_for(joined) <= 41
    both = global_index(joined, ["doc_id"]).join(_plain(_docs(spark), ["doc_id"]).select("doc_id", "want"), "doc_id")
    assert both.count() == d.count() and both.filter("idx <> want").count() == 0


def test_skewed_key_index(spark):
    # one order value holds most rows; the tie-break keeps the order total
    d = _docs(spark).withColumn("k", F.when(F.col("doc_id") % 10 < 7, F.lit(0)).otherwise(F.col("doc_id")))
    got = global_index(d, ["k", "doc_id"], out="idx")
    want = _plain(d, ["k", "doc_id"]).select("doc_id", "want")
    assert got.join(want, "doc_id").filter("idx <> want").count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("which", ["range", "bucket", "stratified"])
def test_no_single_partition_exchange_over_data(spark, which):
    d = _docs(spark)
    if which == "range":
        df = global_index(d, ["lang", "doc_id"])
    elif which == "bucket":
        df = split.shuffle(d, "doc_id")
    else:
        df = split.stratified_split(d, "doc_id", "lang")
    plan = _plan(df)
    # only the tiny per-bucket count relation may be gathered, and it is broadcast
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]


def test_split_sizes_are_exact(spark):
    d = _docs(spark)
    n = d.count()
    got = {r["split"]: r["count"] for r in split.random_split(d, "doc_id").groupBy("split").count().collect()}
    assert got["train"] == n * 8 // 10 and got["valid"] == n // 10 and got["test"] == n - n * 8 // 10 - n // 10


def test_sample_is_topk(spark):
    d = _docs(spark)
    s = split.sample_n(d, "doc_id", 7)
    assert s.count() == 7
    assert "TakeOrderedAndProject" in _plan(s)


def test_threshold_split_moves_no_rows(spark):
    d = _docs(spark)
    plan = _plan(split.stratified_split(d, "doc_id", "lang"))
    data_path = plan.split("BroadcastExchange")[0]
    assert "Exchange" not in data_path and "Window" not in data_path


def test_threshold_split_equals_ranked_split(spark):
    d = _docs(spark).repartition(3)
    a = split.stratified_split(d, "doc_id", "lang").select("doc_id", F.col("split").alias("a"))
    b = split.stratified_split_ranked(d, "doc_id", "lang").select("doc_id", F.col("split").alias("b"))
    j = a.join(b, "doc_id")
    assert j.count() == d.count() and j.filter("a <> b").count() == 0


def test_drop_range_labels_its_rows_once(spark, monkeypatch):
    """The pass that samples the bounds of the ranges reads a written table, not
    the texts and their rules again."""
    import __spark_entry__ as entry
    from textguard.operators import index

    read = []

    def seen(df, *args, **kwargs):
        read.append(df._jdf.queryExecution().optimizedPlan().toString())
        return ranges_for(df, *args, **kwargs)

    ranges_for = index.ranges_for
    monkeypatch.setattr(index, "ranges_for", seen)
    assert entry.queries()["f4_drop_range"](spark, "/root/testdata/sf0.001").count() > 0
    assert len(read) == 1 and "Join" not in read[0] and "regexp" not in read[0] and "RegExp" not in read[0]


def test_intermediate_tables_are_released(spark, tmp_path):
    from textguard import session

    session._written.clear()  # what other tests wrote stays
    kept = session.materialize(spark.range(5), "one")
    session.materialize(spark.range(3), "two")
    paths = list(session._written)
    assert len(paths) == 2 and kept.count() == 5 and all(os.path.isdir(p.removeprefix("file:")) for p in paths)
    assert session.release(spark) == 2 and not any(os.path.exists(p.removeprefix("file:")) for p in paths)
    assert session.release(spark) == 0
