"""Hard-negative mining against a scan of all rows for every anchor."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from textguard.llm import hard_negatives

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType()), T.StructField("uid", T.StringType()), T.StructField("limits", T.StringType())])


MOST = float(np.finfo(float).max)


def brute(rows, positives=5, negatives=3, low=50, high=95, every=50):
    ok = [(i, [math.floor(max(-MOST, min(MOST, 256 * x))) for x in v], y) for i, v, y in rows if i is not None and y is not None and v is not None and None not in v and all(map(math.isfinite, v))]
    out = []
    for n, (i, v, y) in enumerate(ok):
        if i % every:
            continue
        scored = sorted((-max(-(2**63 - 1), min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), j, z) for m, (j, w, z) in enumerate(ok) if m != n)
        for p, j, _ in [s for s in scored if s[2] == y][:positives]:
            fits = [s for s in scored if s[2] != y and low * -p <= 100 * -s[0] <= high * -p][:negatives]
            out += [(i, j, r + 1, k, -p, -s) for r, (s, k, _) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in hard_negatives.mine(df, "id % 50 = 0", **how).collect())


def _rows(n, dim, labels, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(labels, dim))
    return [(i, (middle[i % labels] * 0.7 + spread * rng.normal(size=dim)).tolist(), int(rng.integers(labels)) if i % 3 else i % labels) for i in range(n)]


@pytest.mark.parametrize("how", [{}, {"positives": 1, "negatives": 1}, {"positives": 9, "negatives": 7, "low": 0, "high": 100}])
def test_equals_brute_force(spark, how):
    rows = _rows(900, 6, 4, 1)
    assert mined(spark, rows, **how) == brute(rows, **how)


def test_ties_copies_and_awkward_rows(spark):
    rows = _rows(260, 3, 3, 2, spread=0.01)
    rows += [(1000 + i, [0.5, 0.25, 0.0], i % 2) for i in range(120)]  # equal vectors: ties everywhere
    rows += [(50, rows[50][1], rows[50][2]), (7, rows[7][1], rows[7][2])]  # repeated rows, one of an anchor
    rows += [(None, [1.0, 1.0, 1.0], 0), (2000, None, 0), (2001, [1.0, None, 1.0], 0), (2002, [float("nan")] * 3, 0), (2003, [float("inf"), 0.0, 0.0], 1), (2004, [1.0] * 3, None)]
    rows += [(2050, [], 1), (2100, [0.0] * 3, 2), (2150, [1.0], 0), (2200, [-1.0, -1.0, -1.0], 0), (2250, [0.3] * 3, 77)]
    assert mined(spark, rows) == brute(rows)


def test_scores_past_doubles_and_longs(spark):
    rows = [(i, [float(i % 13 - 6) * 10.0 ** (i % 9), 3.0], i % 3) for i in range(150)] + [(200, [1e300, 1.0], 0), (201, [1e17, 1.0], 1), (202, [-1e308, 1.0], 0)]
    assert mined(spark, rows) == brute(rows)


def test_blocks_change_nothing(spark, monkeypatch):
    rows = _rows(700, 5, 3, 3) + [(1000 + i, [1.0] * 5, 0) for i in range(300)]
    whole = mined(spark, rows)
    monkeypatch.setattr(hard_negatives, "LEAST", 16)
    monkeypatch.setattr(hard_negatives, "BLOCKS", 7)
    assert mined(spark, rows) == whole == brute(rows)


def test_empty(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 0)]) == [] and mined(spark, [(50, [1.0], 0)]) == []


def test_sql_twin(spark, duck_small, duck_check):
    import __spark_entry__ as entry
    from oracle_check import compare

    for duck, sf in ((duck_small, "sf0.001"), (duck_check, "sf0.01")):
        _, status, n, _, message = compare(spark, duck, "op13_slot_hard_negatives", f"/root/testdata/{sf}")
        assert status == "OK" and n > 0, message
    assert "op13_slot_hard_negatives" in entry.oracle_sql()
