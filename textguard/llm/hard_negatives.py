"""Hard-negative mining by slot-decomposed selection.

Components become integers, floor(scale * x), and a row's score for an anchor
is their integer inner product; higher scores come first, ties by smaller id.
An anchor's positives are its first rows of the same label. A positive with
score p asks for the first rows of other labels with low * p <= 100 * score <=
high * p, so windows of one anchor's positives overlap.

Method: the windows' upper limits cut the scores into disjoint slots, one from
each limit down to the next. A row falls into one slot at most, and of a slot
only the first k rows can be in any window: combiners keep those for each block
of rows, and again over the blocks. A window is all slots from its own limit
downwards, so merging the slots from the last one up, k rows kept at each step,
gives every window's first k rows; what lies under its lower limit goes last.

Scale: anchors are a stated part of the rows and are compared with all of them
(positives: with those of their label), block by block; rows that a block holds
are bounded, and so is a block's answer: (slots * k) rows an anchor. A label
with a third of all rows is cut into blocks like any other. Blocks grow with
the table up to a bound, which keeps the copies that are sent few. Nothing is
broadcast or collected but the numbers of rows.

Defined results: rows with a null id, label or vector, or a null or non-finite
component, take no part; shorter vectors count as ended by zeros, an empty one
as all zeros; repeated rows are rows each, so an anchor's copy is another row of its
label; scores beyond 64 bits stop at their ends; an anchor without positives, and a
positive whose window is empty, give no rows; an empty table gives none; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textguard.llm.common import pin

#: Rows of a block: LEAST at least, MOST at most, and else so many that there are BLOCKS.
LEAST, MOST, BLOCKS = 4096, 65536, 64
#: Scores that are computed at a time.
AT_ONCE = 1 << 22


def finite(vector: Column) -> Column:
    """Not null and finite in all components."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, zeros after the shorter ones."""
    lists = column.combine_chunks()
    flat, offsets = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``a`` and ``b``, as int64."""
    size = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if size < 2**53:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (a, b)]
    return np.clip(whole[0] @ whole[1].T, -(2**63 - 1), 2**63 - 1).astype(np.int64)


def first(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` highest allowed scores of every row, ties to
    the column further left, in order."""
    n = scores.shape[1]
    k = min(k, n)
    if not k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if float(np.abs(scores).max(initial=0)) * n < 2**61:
        order = np.where(allowed, scores * n + (n - 1 - np.arange(n)), -(2**62))  # no two alike
        top = np.argpartition(order, n - k, axis=1)[:, n - k :]
        top = np.take_along_axis(top, np.argsort(-np.take_along_axis(order, top, 1), axis=1), 1)
    else:
        top = np.lexsort((-scores, ~allowed), axis=1)[:, :k]
    kept = np.take_along_axis(allowed, top, 1)
    return np.repeat(np.arange(len(scores)), kept.sum(axis=1)), top[kept]


def _floor(x: Column) -> Column:
    """floor, as a double; doubles from 2**53 on are whole, infinite ones stop at the largest."""
    top = F.lit(float(np.finfo(float).max))
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(F.greatest(F.least(x, top), -top))


def _blocks(n: Column) -> Column:
    return F.ceil(n / F.greatest(F.lit(LEAST), F.least(F.lit(MOST), F.ceil(n / F.lit(BLOCKS))))).cast("int")


def _met(rows: DataFrame, anchors: DataFrame, by: list[str]):
    """Both sides by block: a row stands in as many blocks as its class (``by``)
    has blocks of anchors, an anchor in as many as it has blocks of rows."""
    count = lambda df, name: df.groupBy(*by).agg(_blocks(F.count(F.lit(1)).cast("double")).alias(name))
    sizes = pin(count(rows, "p").join(count(anchors, "q"), by), "mining-blocks")
    here = lambda n: F.pmod(F.xxhash64("uid"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.join(sizes, by).withColumn("pi", here("p")).withColumn("qi", every("q")).drop("p", "q")
    right = anchors.join(sizes, by).withColumn("qi", here("q")).withColumn("pi", every("p")).drop("p", "q")
    block, right = [*by, "pi", "qi"], right.toDF(*right.columns)  # columns of its own: both sides stem from one table
    return left.groupBy(*block).cogroup(right.groupBy(*block))


def _compare(rows: pa.Table, anchors: pa.Table):
    """Anchors in parts, each with its scores over the block's rows in id order."""
    rows = rows.sort_by([("id", "ascending"), ("uid", "ascending")])
    width = max((len(v) for t in (rows, anchors) for v in t["v"]), default=0)
    x, a = matrix(rows["v"], width), matrix(anchors["v"], width)
    step = max(1, AT_ONCE // max(1, len(x)))
    for i in range(0, len(a), step):
        yield rows, anchors.slice(i, step), products(a[i : i + step], x)


def positives_of(rows: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """(anchor, positive rank from 1, id, score) of every anchor, by its uid."""

    def run(left, right):
        out = [_none(("anchor", "id", "score"))]
        for rows, anchors, scores in _compare(left, right):
            other = anchors["uid"].to_numpy()[:, None] != rows["uid"].to_numpy()[None, :]
            at, found = first(scores, other, k)
            out.append(pa.table({"anchor": anchors["uid"].to_numpy()[at], "id": rows["id"].to_numpy()[found], "score": scores[at, found]}))
        return pa.concat_tables(out)

    near = _met(rows, anchors, ["label"]).applyInArrow(run, "anchor long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k)


def slots_of(rows: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """(anchor, slot, id, score): the first ``k`` rows of other labels in every
    slot. ``anchors`` have ``limits``, descending: slot i is from limit i (1 is
    the first) down to the next one."""

    def run(left, right):
        out = [_none(("anchor", "slot", "id", "score"))]
        for rows, anchors, scores in _compare(left, right):
            limits = anchors["limits"].to_pylist()
            slot = np.zeros(scores.shape, np.int8)
            for i in range(max(map(len, limits), default=0)):
                # An anchor with fewer limits has no slot here: its last limit's slot goes on.
                has = np.array([i < len(u) for u in limits])
                limit = np.array([u[i] if i < len(u) else 0 for u in limits], np.int64)
                slot += (scores <= limit[:, None]) & has[:, None]
            slot[anchors["label"].to_numpy()[:, None] == rows["label"].to_numpy()[None, :]] = 0
            for s in range(1, int(slot.max(initial=0)) + 1):
                at, found = first(scores, slot == s, k)
                out.append(pa.table({"anchor": anchors["uid"].to_numpy()[at], "slot": np.full(len(at), s), "id": rows["id"].to_numpy()[found], "score": scores[at, found]}))
        return pa.concat_tables(out)

    met = _met(rows.withColumn("g", F.lit(0)), anchors.withColumn("g", F.lit(0)), ["g"])
    near = met.applyInArrow(run, "anchor long, slot long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank")


def _none(names) -> pa.Table:
    return pa.table({c: pa.array([], pa.int64()) for c in names})


def mine(
    vectors: DataFrame, anchors: str, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    scale: float = 256.0, key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)
    of the rows that ``anchors`` (SQL on the column ``id``) holds for."""
    ok = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    ok = ok.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & finite(F.col("v")))
    # Written once with its number, so every later job sees the same rows.
    rows = pin(ok.withColumn("v", F.transform("v", lambda x: _floor(scale * x))).withColumn("uid", F.monotonically_increasing_id()), "mining-rows")
    asked = rows.filter(F.expr(anchors))
    found = pin(positives_of(rows, asked, positives), "mining-positives")

    per_anchor = found.groupBy(F.col("anchor").alias("uid")).agg(F.array_sort(F.collect_list(F.struct("rank", F.col("id").alias("p_id"), F.col("score").alias("p")))).alias("asked"))
    per_anchor = pin(per_anchor, "mining-windows")  # positives rows an anchor at most
    limit = f"transform(asked, x -> cast(floor(cast(x.p as decimal(19,0)) * {int(high)} / 100) as bigint))"  # exact for any long
    limited = asked.join(per_anchor.select("uid", F.expr(limit).alias("limits")), "uid")
    slots = slots_of(rows, limited, negatives)

    # Slots of an anchor, merged from the last one up; negated scores sort the higher ones first.
    held = slots.groupBy(F.col("anchor").alias("uid")).agg(F.collect_list(F.struct("slot", F.col("score").alias("n"), F.col("id").alias("id"))).alias("held"))
    answered = F.expr(f"""
        aggregate(reverse(asked), named_struct('run', cast(array() as array<struct<n:bigint,id:bigint>>),
                                               'out', cast(array() as array<struct<p_id:bigint,p:bigint,run:array<struct<n:bigint,id:bigint>>>>)),
          (s, x) -> transform(
            array(slice(array_sort(concat(s.run, transform(filter(held, h -> h.slot = x.rank), h -> named_struct('n', -h.n, 'id', h.id)))), 1, {int(negatives)})),
            run -> named_struct('run', run,
                                'out', concat(s.out, array(named_struct('p_id', x.p_id, 'p', x.p, 'run',
                                              filter(run, h -> 100 * cast(-h.n as decimal(19,0)) >= {int(low)} * cast(x.p as decimal(19,0))))))))[0],
          s -> s.out)""")
    merged = per_anchor.join(held, "uid").join(asked.select("uid", F.col("id").alias("anchor_id")), "uid").select("anchor_id", F.explode(answered).alias("w"))
    each = merged.select("anchor_id", F.col("w.p_id").alias("positive_id"), F.col("w.p").alias("positive_score"), F.posexplode("w.run").alias("at", "r"))
    return each.select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("r.id").alias("negative_id"), "positive_score", (-F.col("r.n")).alias("negative_score"))
