"""Every registered query against its DuckDB twin on the smallest tables."""

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as se  # noqa: E402
from oracle_check import compare  # noqa: E402
from textguard.plans.catalog import QUERIES  # noqa: E402
from textguard.plans.oracle import ORACLE as TWINS  # noqa: E402

ORACLE = sorted(se.oracle_sql())


@pytest.mark.parametrize("name", ORACLE)
def test_query_matches_sql_twin(spark, duck_small, name):
    _, status, nrows, _, msg = compare(spark, duck_small, name, SF_SMALL)
    assert status == "OK", msg


def test_every_query_has_a_twin_or_is_declared_rows_only():
    """Of the corpus operators; a subpackage's own queries are declared in its own tests."""
    assert set(QUERIES) - set(TWINS) == {"m2_fit_classifier", "m3_classify", "m4_evaluate", "t3_manner_score_stream"}


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == ["row_id", "source", "target", "action", "severity", "category", "reason", "origin_tags"]
    assert df.count() >= 200
