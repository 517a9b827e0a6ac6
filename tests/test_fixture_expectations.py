"""Figures stated in FIXTURES.md for sf0.01, checked on Spark."""

from pyspark.sql import functions as F

import __spark_entry__ as se
from conftest import SF_CHECK
from textguard.plans import fixtures as fx


def _q(spark, name):
    return se.queries()[name](spark, SF_CHECK)


def test_labelled_action_mix(spark):
    got = {r["action"]: r["count"] for r in fx.labelled(spark, SF_CHECK).groupBy("action").count().collect()}
    assert got == {0: 930, 1: 51, 2: 19}


def test_audit_counts(spark):
    r = _q(spark, "a3_audit_counts").first()
    assert (r.n_toxic_clean, r.n_block_mismatch, r.n_normal_mismatch) == (10, 7, 18)


def test_stratified_split_sizes(spark):
    got = {(r["action"], r["split"]): r["n"] for r in _q(spark, "a5_split_counts").collect()}
    want = {(0, "train"): 744, (0, "valid"): 93, (0, "test"): 93, (1, "train"): 41, (1, "valid"): 5, (1, "test"): 5,
            (2, "train"): 15, (2, "valid"): 2, (2, "test"): 2}
    assert got == want


def test_verdicts(spark):
    routed = _q(spark, "f6_safety_gate")
    assert routed.filter("route = 'passed'").count() == 333
    assert routed.filter("route = 'blocked'").count() == 667
    assert routed.filter("decision = 'ERROR' AND score = 5 AND reason = 'Parsing Failed'").count() == 333
    assert routed.filter("route = 'passed' AND score = 1 AND reason = 'ok'").count() == 167
    assert routed.filter("route = 'passed' AND score = 2 AND reason = 'N/A'").count() == 166


def test_batch_replies(spark):
    parsed = _q(spark, "x4_parse_batch")
    assert parsed.count() == 941
    assert parsed.select("batch").distinct().count() == 50


def test_first_gap(spark):
    rows = _q(spark, "j6_find_gaps").orderBy("missing_line").collect()
    assert [(r.gap_line, r.n_missing, r.missing_line) for r in rows] == [(121, 2, 121), (121, 2, 122)]


def test_weighted_f1(spark):
    assert abs(_q(spark, "a11_weighted_f1").first().weighted_f1 - 0.736314) < 1e-6


def test_overrides_hit_count(spark):
    from pyspark.sql import Observation

    from textguard.operators import overrides

    obs = Observation("fixes")
    out = overrides.apply_overrides(fx.labelled(spark, SF_CHECK), fx.source_fixes(spark, SF_CHECK), on="source", observation=obs)
    out.write.format("noop").mode("overwrite").save()
    assert obs.get["n_modified"] == 19
    assert out.filter(F.col("target").startswith("fixed: ")).count() == 19
