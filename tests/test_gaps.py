"""All gaps (J6): whatever was lost, raw without the reported rows is processed."""

import random

import pytest
from pyspark.sql import functions as F

from textguard.operators import diff, gaps


def _found(spark, raw, proc, **how):
    """Reported rows as (gap_line, n_missing, missing_line), of lists of texts."""
    frame = lambda texts: spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    out = diff.find_gaps(frame(raw), frame(proc), ["id"], first_only=False, **how).collect()
    for r in out:
        assert r["missing_text"] == raw[r["missing_line"] - 1] and r["within_k"] == (r["n_missing"] <= how.get("k", 4))
    return sorted((r["gap_line"], r["n_missing"], r["missing_line"]) for r in out)


def _explains(spark, raw, proc):
    """Raw less the reported rows begins with processed, and gaps are whole runs."""
    out = _found(spark, raw, proc)
    lost = {line - 1 for _, _, line in out}
    assert len(lost) == len(out)
    left = [t for i, t in enumerate(raw) if i not in lost]
    assert left[: len(proc)] == proc
    for at, n, line in out:
        assert sum(a == at for a, _, _ in out) == n
        assert line - 1 >= at - 1
    return out


CASES = {
    "different": lambda rng, i: f"row {i}",
    "few texts": lambda rng, i: f"row {rng.randrange(4)}",
    "one text": lambda rng, i: "same",
    "long runs": lambda rng, i: f"row {i // 40}" if i % 7 else f"one {i}",
    "nulls": lambda rng, i: None if rng.random() < 0.3 else f"row {rng.randrange(60)}",
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("ranges", [gaps.SPAN, 16])
def test_lost_rows_only(spark, monkeypatch, case, ranges):
    monkeypatch.setattr(gaps, "SPAN", ranges)
    rng = random.Random(f"{case}{ranges}")
    raw = [CASES[case](rng, i) for i in range(400)]
    proc, i = [], 0
    while i < len(raw):
        if rng.random() < 0.04:
            i += rng.randrange(1, 12)
        proc += raw[i : i + 1]
        i += 1
    _explains(spark, raw, proc)


def test_exact_runs_long_ones_and_the_ends(spark):
    raw = [f"row {i}" for i in range(300)]
    lost = [*range(0, 3), *range(50, 51), *range(90, 140), 200, *range(297, 300)]
    proc = [t for i, t in enumerate(raw) if i not in set(lost)]
    got = _found(spark, raw, proc)
    assert [line - 1 for _, _, line in got] == lost[:-3]  # what follows the last row may be yet to come
    assert {(at, n) for at, n, _ in got} == {(1, 3), (48, 1), (87, 50), (147, 1)}
    assert _found(spark, raw, raw) == [] == _found(spark, raw, []) == _found(spark, [], raw) == _found(spark, [], [])


def test_changed_added_and_moved_rows(spark):
    raw = [f"row {i}" for i in range(200)]
    proc = [t for i, t in enumerate(raw) if i not in (20, 21, 150)]
    proc[60] = "changed"
    proc[100:100] = ["only here", "and here"]
    proc[5], proc[6] = proc[6], proc[5]
    proc[140:140] = [proc.pop(30)]
    got = {line - 1 for _, _, line in _found(spark, raw, proc)}
    assert {20, 21, 150} <= got and got - {20, 21, 150} <= {5, 6, 32}  # a moved row is lost at its place


def test_stretches_longer_than_a_task_looks_through(spark, monkeypatch):
    """Their lost rows are counted, and reported after the stretch."""
    monkeypatch.setattr(gaps, "LIMIT", 8)
    raw = ["first"] + [f"row {i % 3}" for i in range(60)] + ["last"] + [f"tail {i}" for i in range(5)]
    proc = [t for i, t in enumerate(raw) if i not in (15, 40)]
    got = _found(spark, raw, proc)
    assert len(got) == 2 and all(1 <= line - 1 <= 60 for _, _, line in got)


def test_longest_run():
    rng = random.Random(1)
    for _ in range(50):
        v = rng.sample(range(30), rng.randrange(0, 12))
        got = [v[i] for i in gaps.longest_run(v)]
        assert got == sorted(got)
        best = [1] * len(v)
        for i in range(len(v)):
            best[i] = 1 + max((best[j] for j in range(i) if v[j] < v[i]), default=0)
        assert len(got) == max(best, default=0)


def test_neighbours_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(gaps, "SPAN", 5)
    rng = random.Random(2)
    rows = [(i, rng.randrange(100) if rng.random() < 0.6 else None) for i in rng.sample(range(90), 40)]
    got = {r["at"]: (r["v_before"], r["v_after"]) for r in gaps.neighbours(spark.createDataFrame(rows, "at long, x long"), "at", v=F.col("x")).collect()}
    for at, _ in rows:
        before, after = [x for i, x in rows if i < at and x is not None], [x for i, x in rows if i > at and x is not None]
        assert got[at] == (max(before, default=None), min(after, default=None))
