"""Parallel scan of delimited files whose quoted cells hold line ends.

A reader that must not cut such a file reads it in one task. Here every byte
range of a file is read by a task of its own:

1. Spark's line reader gives each range its lines. A line turns the state it
   begins in - at a record's start, or inside a quoted cell - into the state it
   ends in; so does, by composition, a range. Each range reports what it makes of
   both states: one row a range.
2. A window over a file's ranges combines them, which gives the state that each
   range really begins in.
3. Every range parses from its first true record on. Lines before it, and a last
   record that isn't over at the range's end, are fragments: a few rows a range,
   put together by a grouping.

Both passes must cut the files alike, whatever executors there are, so they run
in a session of their own with fixed split sizes, and the records are written
once (as a landing table) before anything else reads them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from textguard.session import materialize

#: Bytes of a range, and ranges whose states may be sent to the tasks.
RANGE_BYTES = 64 << 20
MOST_RANGES = 1 << 20

LINES = "value string, file string, start long"
PART = "file string, start long, seq long, kind int, closed boolean, first boolean, text string"


def after(line: str, quoted: bool, sep: str = "\t") -> bool:
    """Does ``line`` end inside a quoted cell, if it begins inside one or not?

    A quote opens a cell only where the cell begins; in a quoted cell two quotes
    are one, and a single one closes it, whatever follows up to the separator."""
    at = 0
    while True:
        if not quoted and line.startswith('"', at):
            quoted, at = True, at + 1
        if quoted:
            while True:
                at = line.find('"', at)
                if at < 0:
                    return True
                if not line.startswith('"', at + 1):
                    break
                at += 2
            quoted = False
        at = line.find(sep, at)
        if at < 0:
            return False
        at += len(sep)


def _stretches(batch: pa.RecordBatch, begun: set[str]):
    """(file, start, lines) of the runs of one range in a batch of lines, without
    the byte order mark of a file's first line. ``begun``: files met before."""
    if not batch.num_rows:
        return
    files, starts = batch.column(1), batch.column(2).to_numpy()
    codes = pc.dictionary_encode(files).indices.to_numpy()
    cuts = [0, *(np.flatnonzero((codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1])) + 1).tolist(), batch.num_rows]
    for i, j in zip(cuts, cuts[1:]):
        file, start, lines = files[i].as_py(), int(starts[i]), batch.column(0).slice(i, j - i)
        if start == 0 and file not in begun:
            begun.add(file)
            if lines[0].as_py().startswith("\ufeff"):
                lines = pa.concat_arrays([pa.array([lines[0].as_py()[1:]], lines.type), lines.slice(1)])
        yield file, start, lines


def effects(lines: DataFrame, sep: str) -> DataFrame:
    """(file, start, from_record, from_cell): the state (inside a cell) that a
    range ends in, for either state that it may begin in."""

    def run(batches):
        found: dict[tuple[str, int], list[bool]] = {}
        begun: set[str] = set()
        for batch in batches:
            for file, start, values in _stretches(batch, begun):
                both = found.setdefault((file, start), [False, True])
                for line in values.filter(pc.match_substring(values, '"')).to_pylist():
                    both[:] = [after(line, both[0], sep), after(line, both[1], sep)]
        rows = [(*key, *both) for key, both in found.items()]
        columns = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.bool_(), pa.bool_()))], names=["file", "start", "from_record", "from_cell"])

    return lines.mapInArrow(run, "file string, start long, from_record boolean, from_cell boolean")


def begins(ranges: DataFrame) -> DataFrame:
    """(file, start, inside): does a range begin inside a quoted cell? Ranges
    that forget the state they begin in decide; those between carry it on."""
    order = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("from_record") == F.col("from_cell")
    turns = F.when(~fixed & F.col("from_record"), 1).otherwise(0)  # a range that turns either state into the other
    told = ranges.withColumn("fixed_at", F.max(F.when(fixed, F.col("start"))).over(order)).withColumn("turned", F.coalesce(F.sum(turns).over(order), F.lit(0)))
    last = told.filter(fixed).select("file", F.col("start").alias("fixed_at"), F.col("from_record").alias("value"), (F.col("turned")).alias("turned_there"))
    joined = told.join(last, ["file", "fixed_at"], "left")
    inside = (F.coalesce(F.col("value").cast("int"), F.lit(0)) + F.col("turned") - F.coalesce("turned_there", F.lit(0))) % 2 == 1
    return joined.select("file", "start", inside.alias("inside"))


def records(lines: DataFrame, inside: dict[tuple[str, int], bool], sep: str) -> DataFrame:
    """PART rows: whole records (kind 0), and fragments of those that cross a
    range's end: what a range begins with (1), and the record it ends in (2)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    known = lines.sparkSession.sparkContext.broadcast(inside)
    schema = to_arrow_schema(T._parse_datatype_string(PART))

    def run(batches):
        here, quoted, seq, kind, open_ = None, False, 0, 0, None  # open_: lines of the record that is not over
        begun: set[str] = set()

        def row(texts, kinds, closed):
            nonlocal seq
            n = len(texts)
            first = np.zeros(n, bool)
            if n and here[1] == 0 and seq == 0:
                first[0] = True
            columns = [pa.array([here[0]] * n, pa.string()), pa.array(np.full(n, here[1])), pa.array(np.arange(seq, seq + n)), pa.array(np.full(n, kinds, np.int32)), pa.array(np.full(n, closed)), pa.array(first), texts]
            seq += n
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        def over():
            """The end of a range: its last record may go on in the next one."""
            if here is not None and open_ is not None:
                yield row(pa.array(["\n".join(open_)], pa.string()), kind or 2, False)

        for batch in batches:
            for file, start, values in _stretches(batch, begun):
                if here != (file, start):
                    yield from over()
                    here, quoted, seq = (file, start), known.value[file, start], 0
                    kind, open_ = (1, []) if quoted else (0, None)
                # The state at each line's end; lines without quotes keep it.
                n, ends = len(values), np.zeros(len(values), bool)
                marked = np.flatnonzero(pc.match_substring(values, '"').to_numpy(zero_copy_only=False))
                at = 0
                for i, line in zip(marked.tolist(), values.take(pa.array(marked)).to_pylist()):
                    ends[at:i] = quoted
                    quoted = after(line, quoted, sep)
                    ends[i], at = quoted, i + 1
                ends[at:] = quoted
                closing = np.flatnonzero(~ends)
                done = 0
                if open_ is not None:
                    done = int(closing[0]) + 1 if len(closing) else n
                    open_ += values.slice(0, done).to_pylist()
                    if len(closing):
                        yield row(pa.array(["\n".join(open_)], pa.string()), kind, True)
                        kind, open_ = 0, None
                if open_ is None and done < n:
                    offsets = np.concatenate(([done], closing[closing >= done] + 1))
                    if len(offsets) > 1:
                        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
                        yield row(pc.binary_join(lists, "\n") if (np.diff(offsets) > 1).any() else values.slice(done, len(offsets) - 1), 0, True)
                    if offsets[-1] < n:
                        open_ = values.slice(int(offsets[-1])).to_pylist()
        yield from over()

    return lines.mapInArrow(run, PART)


def read_records(spark: SparkSession, path: str, header: bool = True, sep: str = "\t", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(record): the text of every record of the files under ``path``,
    without header records and empty lines. Line ends inside cells are kept,
    as ``\\n`` in files whose first line ends in ``\\r\\n``."""
    session = spark.newSession()
    # The size of a split is a given, not a share of the cores that there are.
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    session.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
    session.conf.set("spark.sql.files.openCostInBytes", str(min(range_bytes, 4 << 20)))
    lines = session.read.option("lineSep", "\n").text(path)
    meta = lines.metadataColumn("_metadata")
    lines = lines.select("value", meta["file_path"].alias("file"), meta["file_block_start"].alias("start"))

    ranges = materialize(effects(lines, sep), "scan-ranges")
    if (n := ranges.count()) > MOST_RANGES:
        raise ValueError(f"{n} ranges of {range_bytes} bytes: take larger ranges ({MOST_RANGES} at most)")
    inside = {(r["file"], r["start"]): r["inside"] for r in begins(ranges).collect()}  # one row a range
    # From here on everything is read from the table of records, in the caller's session.
    parts = materialize(records(lines, inside, sep), "scan-parts", spark)

    # A record that crosses ranges: its beginning (kind 2) and what the next ranges begin with (kind 1).
    pieces = parts.filter("kind > 0")
    order = Window.partitionBy("file").orderBy("start", "seq")
    number = F.sum(F.when(F.col("kind") == 2, 1).otherwise(0)).over(order)
    whole = pieces.withColumn("number", number).groupBy("file", "number").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "seq", "text"))), lambda x: x["text"]), "\n").alias("text"), F.max("first").alias("first")
    )
    every = parts.filter("kind = 0").select("file", "text", "first").unionByName(whole.select("file", "text", "first"))
    # The first line tells how a file's lines end.
    crlf = parts.filter("first").groupBy("file").agg(F.max(F.substring_index("text", "\n", 1).endswith("\r")).alias("crlf"))
    every = every.join(F.broadcast(crlf), "file", "left")  # one row a file, and there are no more files than ranges
    unified = F.regexp_replace(F.regexp_replace("text", "\r\n", "\n"), "\r\\z", "")
    text = F.when(F.col("crlf"), unified).otherwise(F.col("text"))
    kept = every.select(text.alias("record"), "first").filter(F.col("record") != "")
    return (kept.filter(~F.col("first")) if header else kept).select("record")
