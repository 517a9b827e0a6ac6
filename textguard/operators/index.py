"""Global positions without a single-partition window.

``row_number() OVER (ORDER BY k)`` moves every row into one task. Instead rows
get a *logical bucket* that is monotone in the order, a position inside their
bucket, and a start offset per bucket computed from per-bucket counts (a
relation of at most buckets x strata rows, broadcast after its size is checked).
The result equals ``row_number() OVER (PARTITION BY strata ORDER BY order) - 1``
for a total order (callers pass a tie-breaking key). Two ways to get buckets:

* ``buckets=`` a column that is already monotone in the order and spread evenly,
  e.g. the leading hex digits of an md5 order key. Position in bucket is a
  ``row_number`` over (strata, bucket) - small, evenly sized windows, fully
  deterministic, so no lineage cut is needed.
* otherwise range partitioning: bounds come from sampling, so buckets are
  balanced even for skewed keys. The bucket is the partition id and the
  position is the low bits of ``monotonically_increasing_id``; both are pinned
  by writing the relation once to the checkpoint folder before they are used
  twice (counts and rows), so a re-run task can never renumber rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textguard.session import bounded_broadcast, materialize

# Offsets relations up to this many rows are broadcast; beyond, a shuffle join.
OFFSETS_BROADCAST_ROWS = 2_000_000


# Rows from the head up to which a slice is a top-k.
HEAD_ROWS = 100_000

# Bytes of its input that a range of the index should hold, by the planner's estimate.
RANGE_BYTES = 256 << 20


def input_bytes(df: DataFrame) -> int:
    """The planner's estimate of ``df``, and no more than that of all it reads: of a
    join the planner takes the product of both sides, which grows with the square
    of the tables. 0 if nothing is known."""
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    read = sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    estimate = min(int(plan.stats().sizeInBytes()), read)
    return estimate if estimate < 1 << 62 else 0  # no estimate: the planner's default is a huge number


def ranges_for(df: DataFrame) -> int:
    """Ranges for ``df``: as many as its estimated bytes ask for, and no fewer
    than the session's shuffle partitions."""
    wanted = -(-input_bytes(df) // RANGE_BYTES)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(wanted, 1_000_000))


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def hex_buckets(hex_col: Column, digits: int = 3) -> Column:
    """Monotone bucket of a hex-string order key: its first ``digits`` hex digits."""
    return F.conv(F.substring(hex_col, 1, digits), 16, 10).cast("int")


def bucket_counts(df: DataFrame, buckets: Column, strata=()) -> DataFrame:
    """Rows per (bucket, stratum): a small relation (buckets x strata rows),
    computed with map-side partial aggregation and kept for reuse."""
    return df.groupBy(buckets.alias("_p"), *strata).agg(F.count(F.lit(1)).alias("_n")).persist()


def _with_offsets(rows: DataFrame, counts: DataFrame, strata: list[str], out: str, local: Column) -> DataFrame:
    counts = counts if counts.is_cached else counts.persist()
    w = Window.partitionBy(*strata).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_p", *strata, *([c for c in counts.columns if c == "_m0"]), F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    offsets = bounded_broadcast(offsets, OFFSETS_BROADCAST_ROWS)
    return rows.join(offsets, ["_p", *strata]).withColumn(out, (F.col("_off") + local).cast("bigint"))


def global_index(
    df: DataFrame,
    order_cols,
    strata=(),
    out: str = "idx",
    num_partitions: int | None = None,
    buckets: Column | None = None,
    counts: DataFrame | None = None,
    derive: dict[str, Column] | None = None,
    drop=(),
) -> DataFrame:
    """0-based position of each row in ``order_cols`` order (within ``strata``).

    ``counts`` may pass the ``bucket_counts`` of the same input and buckets when
    the caller needs them too (computed once). ``derive`` adds columns after the
    exchange (in range mode: computed in parallel once and pinned with the rows),
    so costly per-row work never runs in a scan that may have few splits nor in
    the range-sampling pass; ``drop`` then removes inputs of that work (say, a
    long text) before anything is pinned or joined.
    """
    spark = df.sparkSession
    strata = list(strata)
    order = _cols(order_cols)
    if buckets is not None:
        b = df.withColumn("_p", buckets)
        counts = counts if counts is not None else bucket_counts(df, buckets, strata)
        rn = F.row_number().over(Window.partitionBy("_p", *strata).orderBy(*order)) - 1
        rows = b.withColumn("_r", rn)
        for name, col in (derive or {}).items():
            rows = rows.withColumn(name, col)
        rows = rows.drop(*drop)
        return _with_offsets(rows, counts, strata, out, F.col("_r")).drop("_p", "_r", "_off")

    n = num_partitions or ranges_for(df)
    keys = _cols(strata) + order
    ranged = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_p", F.spark_partition_id())
        .withColumn("_m", F.monotonically_increasing_id())
    )
    for name, col in (derive or {}).items():
        ranged = ranged.withColumn(name, col)
    ranged = materialize(ranged.drop(*drop), "index")
    counts = ranged.groupBy("_p", *strata).agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_m0"))
    return _with_offsets(ranged, counts, strata, out, F.col("_m") - F.col("_m0")).drop("_p", "_m", "_m0", "_off")


def batch_id(df: DataFrame, order_cols, size: int, out: str = "batch", idx: str = "idx") -> DataFrame:
    """Fixed-size batches by position (``batch = idx div size``)."""
    if idx not in df.columns:
        df = global_index(df, order_cols, out=idx)
    return df.withColumn(out, F.expr(f"{idx} div {int(size)}").cast("bigint"))


def slice_rows(df: DataFrame, order_cols, start: int, count: int, idx: str = "idx") -> DataFrame:
    """rows at positions ``[start, start + count)``. A slice near the head is
    cut from the first rows alone, which each task keeps without sorting the rest."""
    if start + count <= HEAD_ROWS:
        first = df.orderBy(*_cols(order_cols)).limit(start + count)
        position = F.row_number().over(Window.orderBy(*_cols(order_cols))).cast("bigint") - 1  # over HEAD_ROWS rows at most
        return first.withColumn(idx, position).filter(F.col(idx) >= start)
    return global_index(df, order_cols, out=idx).filter((F.col(idx) >= start) & (F.col(idx) < start + count))


def drop_range(df: DataFrame, order_cols, lo: int, hi: int, idx: str = "idx") -> DataFrame:
    """delete positions ``[lo, hi)`` (keep ``[:lo] + [hi:]``)."""
    return global_index(df, order_cols, out=idx).filter((F.col(idx) < lo) | (F.col(idx) >= hi))
