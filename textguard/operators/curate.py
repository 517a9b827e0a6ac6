"""Curation core: filters, dedup, resume anti-joins, unions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textguard.functions import parse
from textguard.operators import bloom
from textguard.operators.index import batch_id
from textguard.schemas import BLOCK, SAFETY_SCORE_LIMIT


# --------------------------------------------------------------------------- filters
def filter_flagged(df: DataFrame, flag: str, value: int = 1) -> DataFrame:
    """rows whose label column equals ``value`` (pushed to the Parquet scan)."""
    return df.filter(F.col(flag) == value)


def project(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """select and rename, ``{new_name: source_column}``."""
    return df.select(*[F.col(src).alias(dst) for dst, src in mapping.items()])


def nmt_subset(df: DataFrame, action: str = "action") -> DataFrame:
    """drop BLOCK rows from the rewrite corpus."""
    return df.filter(F.col(action) != BLOCK)


def safety_gate(verdicts: DataFrame, decision: str = "decision", score: str = "score", out: str = "route") -> DataFrame:
    """PASS with score below the limit passes; BLOCK, ERROR and high-score PASS block."""
    passed = (F.col(decision) == "PASS") & (F.col(score) < SAFETY_SCORE_LIMIT)
    return verdicts.withColumn(out, F.when(F.coalesce(passed, F.lit(False)), "passed").otherwise("blocked"))


def drop_failed(df: DataFrame, col: str) -> DataFrame:
    """drop rows whose model output is null or empty (a failed call)."""
    return df.filter(F.length(F.coalesce(F.col(col), F.lit(""))) > 0)


def head(df: DataFrame, n: int, *order) -> DataFrame:
    """F8: first n rows in an explicit order (top-k, no global sort)."""
    return df.orderBy(*order).limit(n)


def typed(df: DataFrame, cols: dict[str, str], required=()) -> DataFrame:
    """tolerant casts; rows whose ``required`` casts fail are skipped."""
    out = df
    for c, t in cols.items():
        out = out.withColumn(c, parse.strip(F.col(c)).try_cast(t))
    for c in required:
        out = out.filter(F.col(c).isNotNull())
    return out


# --------------------------------------------------------------------------- dedup / counts
def dedup_exact(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """A1: one row per distinct ``key``, the first by ``order_col``.

    Grouping on (xxhash64(key), key) keeps the comparison exact while the hash
    spreads long keys evenly; ``min_by`` is a partial aggregate, so a hot key
    (many copies of one text) collapses map-side before the shuffle.
    """
    others = [c for c in df.columns if c != key]
    first = F.min_by(F.struct(*others), F.col(order_col)).alias("_first")
    return (
        df.groupBy(F.xxhash64(key).alias("_h"), F.col(key))
        .agg(first)
        .select(F.col(key), *[F.col(f"_first.{c}").alias(c) for c in others])
        .select(*df.columns)
    )


def funnel(df: DataFrame, flag: str, key: str) -> DataFrame:
    """A2: total rows, flagged rows and distinct flagged keys in one aggregate.
    Keys are told apart by their 128-bit digests, so no text is shuffled."""
    flagged = F.col(flag) == 1
    return df.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.coalesce(flagged, F.lit(False))).alias("n_flagged"),
        F.count_distinct(F.when(flagged, F.unhex(F.md5(F.col(key).cast("string"))))).alias("n_distinct_flagged"),
    )


def verdict_counts(routed: DataFrame, route: str = "route") -> DataFrame:
    """A4: rows per route (passed / blocked)."""
    return routed.groupBy(route).agg(F.count(F.lit(1)).alias("n"))


def done_keys(done: DataFrame, key: str) -> DataFrame:
    """Distinct processed keys (feeds J3/J4; never collected)."""
    return done.select(key).distinct()


# --------------------------------------------------------------------------- resume
def pending(df: DataFrame, done: DataFrame, on: str) -> DataFrame:
    """Rows whose key is not yet processed. Rows that a filter over the
    processed keys excludes are not shuffled (``operators.bloom``)."""
    return bloom.anti_join(df, done, on)


def pending_batches(df: DataFrame, done: DataFrame, id_col: str, size: int, mode: str = "complete") -> DataFrame:
    """Rows still to process when work is done in batches of ``size`` by ``id_col``.

    ``complete`` (default): per-id anti-join, a half-finished batch resumes its
    missing ids. ``first_id``: a batch is skipped iff its first id is processed
    (compatibility mode; it never revisits a batch that stopped midway).
    """
    ids = done_keys(done, id_col)
    if mode == "complete":
        return batch_id(df, [id_col], size).join(ids, id_col, "left_anti")
    if mode != "first_id":
        raise ValueError("mode must be 'complete' or 'first_id'")
    batched = batch_id(df, [id_col], size)
    firsts = batched.groupBy("batch").agg(F.min(id_col).alias(id_col))
    skipped = firsts.join(ids, id_col, "left_semi").select("batch")
    return batched.join(skipped, "batch", "left_anti")


# --------------------------------------------------------------------------- set operations
def union_batches(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def append_new(df: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Idempotent append: only batch rows whose key is not present yet. New
    rows are not shuffled where a filter over the keys can tell."""
    return df.unionByName(bloom.anti_join(batch, df, key))


def complement_check(inputs: DataFrame, routed: DataFrame, key: str, failed: Column, route: str = "route") -> DataFrame:
    """Passed + blocked must equal input minus failed, with no key lost or routed twice.

    One equi-join on the key and one aggregate; returns a single row of counts.
    """
    j = inputs.select(key, F.coalesce(failed, F.lit(False)).alias("_failed")).join(
        routed.select(key, route), key, "left"
    )
    r = F.col(route)
    out = j.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(F.col(key)).alias("n_input"),
        F.count_if(F.col("_failed")).alias("n_failed"),
        F.count_if(r == "passed").alias("n_passed"),
        F.count_if(r == "blocked").alias("n_blocked"),
        F.count_if(~F.col("_failed") & r.isNull()).alias("n_lost"),
    )
    holds = (
        (F.col("n_passed") + F.col("n_blocked") == F.col("n_input") - F.col("n_failed"))
        & (F.col("n_rows") == F.col("n_input"))
        & (F.col("n_lost") == 0)
    )
    return out.withColumn("holds", holds).drop("n_rows")
