"""Parallel scan of files with quoted line ends equals the serial one."""

import random

import pytest
from pyspark.sql import types as T

from textguard.sources import ranges, readers

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])
CELLS = ["x", "", "two words", '"q"', '"a\nb"', '"tab\there"', '"say ""hi"""', '""', '"\n\n"', 'inch 5"', '"open ""\n"" again"', "é한", '"' + "long line\n" * 30 + '"', 'a"b"c', '"x"tail']


def _file(path, seed, ending="\n", bom=False, rows=100, last=True):
    rng = random.Random(seed)
    lines = ["h1\th2\th3"] + ["\t".join(rng.choice(CELLS) for _ in range(rng.choice([3, 3, 3, 2, 4, 1]))) for _ in range(rows)]
    text = ending.join(line.replace("\n", ending) for line in lines) + (ending if last else "")
    path.write_bytes(("﻿" if bom else "").encode() + text.encode())


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [500, 1 << 20])
def test_equals_the_serial_scan(spark, tmp_path, ending, size):
    for i in range(3):
        _file(tmp_path / f"f{i}.tsv", i, ending, bom=i == 1, last=i != 2)
    (tmp_path / "empty.tsv").write_bytes(b"")
    (tmp_path / "header.tsv").write_bytes(b"h1\th2\th3\n")
    for header in (True, False):
        for malformed in ("keep", "skip"):
            want = _rows(readers.read_tsv(spark, str(tmp_path), SCHEMA, header, malformed, range_bytes=0))
            got = _rows(readers.read_tsv(spark, str(tmp_path), SCHEMA, header, malformed, range_bytes=size))
            assert got == want and len(want) > 100


def test_as_many_tasks_as_ranges(spark, tmp_path):
    cell = '"' + "a quoted\nline end " * 400 + '"'
    (tmp_path / "big.tsv").write_text("h1\th2\th3\n" + "".join(f"{i}\t{cell}\tz\n" for i in range(1500)))
    size = (tmp_path / "big.tsv").stat().st_size
    records = ranges.read_records(spark, str(tmp_path / "big.tsv"), range_bytes=1 << 20)
    assert records.rdd.getNumPartitions() > 1
    parts = -(-size // (1 << 20))
    session = spark.newSession()
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    session.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    session.conf.set("spark.sql.files.openCostInBytes", str(1 << 20))
    assert session.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() == parts > 8
    rows = readers.read_tsv(spark, str(tmp_path / "big.tsv"), SCHEMA, range_bytes=1 << 20)
    assert rows.count() == 1500 and {r[0] for r in rows.select("b").distinct().collect()} == {cell[1:-1]}
    assert readers.largest_file(spark, str(tmp_path)) == size


def test_state_after_a_line():
    cases = [("a\tb", False, False), ('a\t"b', False, True), ('b"\tc', True, False), ('b""\tc', True, True), ('5" x\t"y"', False, False), ('"x"tail "\ty', False, False), ('""', False, False), ('"""', False, True), ("", True, True), ('"\t"x', True, True)]
    for line, quoted, want in cases:
        assert ranges.after(line, quoted) == want, line


def test_ranges_that_keep_or_turn_the_state(spark):
    """Ranges in the middle of a cell, ranges that turn either state, ranges that decide."""
    rng = random.Random(5)
    rows, want = [], {}
    for file in "xyz":
        state = False
        for start in range(0, 400, 10):
            effect = rng.choice([(False, True), (False, True), (True, False), (False, False), (True, True)])
            want[file, start] = state
            rows.append((file, start, *effect))
            state = effect[state]
    got = ranges.begins(spark.createDataFrame(rows, "file string, start long, from_record boolean, from_cell boolean").repartition(3)).collect()
    assert {(r["file"], r["start"]): r["inside"] for r in got} == want
