"""Metamorphic properties: idempotent overrides and appends, padding shape."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from textguard.functions import text as tx
from textguard.operators import curate, overrides
from textguard.plans import fixtures as fx


def test_override_is_idempotent(spark):
    lab = fx.labelled(spark, SF_SMALL)
    fixes = fx.source_fixes(spark, SF_SMALL)
    once = overrides.apply_overrides(lab, fixes, on="source")
    twice = overrides.apply_overrides(once, fixes, on="source")
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_duplicate_override_keys_rejected(spark):
    import pytest

    lab = fx.labelled(spark, SF_SMALL)
    bad = spark.createDataFrame([("k", "a"), ("k", "b")], "key string, new_target string")
    with pytest.raises(overrides.DuplicateOverrideKeys):
        overrides.apply_overrides(lab, bad, validate="eager")
    clash = spark.createDataFrame([(lab.first().source, "a"), (lab.first().source, "b")], "key string, new_target string")
    with pytest.raises(Exception, match="two targets"):
        overrides.apply_overrides(lab, clash).collect()


def test_append_new_is_idempotent(spark):
    lab = fx.labelled(spark, SF_SMALL).select("row_id", "source")
    base = lab.filter(F.col("row_id") % 2 == 0)
    batch = lab.filter(F.col("row_id") % 3 == 0)
    once = curate.append_new(base, batch, "source")
    twice = curate.append_new(once, batch, "source")
    assert once.count() == twice.count()
    assert once.exceptAll(twice).count() == 0


def test_repairs_fix_everything_they_report(spark):
    from pyspark.sql import Observation

    from textguard.operators import audit

    d = fx.dirty(spark, SF_SMALL)
    obs = Observation("normal")
    fixed = overrides.repair_block(overrides.repair_normal(d, obs))
    r = audit.audit_counts(fixed).first()
    assert (r.n_block_mismatch, r.n_normal_mismatch) == (0, 0)
    assert obs.get["n_modified"] == audit.audit_counts(d).first().n_normal_mismatch


def test_padding_shape(spark):
    df = spark.createDataFrame([(" a  b c ",), ("x " * 300,)], "t string")
    rows = df.select(tx.pad_tokens(tx.tokens(F.col("t")), 5).alias("p"), tx.attention_mask(tx.tokens(F.col("t")), 5).alias("m")).collect()
    assert rows[0].p == ["a", "b", "c", "[PAD]", "[PAD]"] and rows[0].m == [1, 1, 1, 0, 0]
    assert rows[1].p == ["x"] * 5 and rows[1].m == [1] * 5
