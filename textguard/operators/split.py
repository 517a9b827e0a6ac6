"""Reproducible shuffles, splits and samples.

Order is ``md5(seed ':' key)`` with the key as tie-break: the same on any
partitioning and in any engine, unlike ``rand(seed)``. Sizes follow the
integer rules (train = n*8 div 10, valid = n div 10; stratified hold-out =
ceil(2n/10), test = ceil(hold-out/2), per class by largest remainder with ties
to the lower class), so they never depend on float rounding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textguard.operators.index import bucket_counts, global_index, hex_buckets
from textguard.session import bounded_broadcast


def shuffle_key(key: Column, seed: int = 42) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def shuffle(df: DataFrame, key: str, seed: int = 42, out: str = "pos") -> DataFrame:
    """Seeded full shuffle; ``out`` is the 0-based shuffled position."""
    h = df.withColumn("_h", shuffle_key(F.col(key), seed))
    return global_index(h, ["_h", key], out=out, buckets=hex_buckets(F.col("_h"))).drop("_h")


def _cut_rows(h: DataFrame, key: str, strata: list[str], counts: DataFrame, cuts: DataFrame) -> DataFrame:
    """For each stratum and cut rank q, the (hash, key) of the row at 0-based
    rank q in (hash, key) order - null when q is past the last row.

    Only the bucket that holds rank q is ranked: per-bucket counts give each
    bucket's first rank, so the boundary bucket and the rank inside it are
    known; those few rows (about n/4096 per cut) get a window, nothing else
    moves.
    """
    w = Window.partitionBy(*strata).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_p", *strata, "_n", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    where = cuts.join(offs, strata).filter((F.col("_q") >= F.col("_off")) & (F.col("_q") < F.col("_off") + F.col("_n")))
    where = bounded_broadcast(where.select(*strata, "_cut", "_p", (F.col("_q") - F.col("_off")).alias("_local")).persist())
    rows = h.join(where.select(*strata, "_p").distinct(), [*strata, "_p"], "left_semi")
    rn = F.row_number().over(Window.partitionBy(*strata, "_p").orderBy("_h", key)) - 1
    ranked = rows.select(*strata, "_p", "_h", F.col(key).alias("_k"), rn.alias("_local"))
    found = ranked.join(where, [*strata, "_p", "_local"]).select(*strata, "_cut", "_h", "_k")
    return cuts.select(*strata, "_cut").join(found, [*strata, "_cut"], "left")


def assign_by_rank(df: DataFrame, key: str, cuts, labels, strata=(), seed: int = 42, out: str = "split") -> DataFrame:
    """Label rows by their rank in seeded-hash order without moving them.

    ``cuts`` has one row per stratum with columns ``q1 <= q2``: ranks below q1
    get ``labels[0]``, below q2 ``labels[1]``, the rest ``labels[2]``. The
    boundary rows are found on the small per-bucket relation and a few
    boundary buckets; the rows themselves are labelled by comparing their
    (hash, key) with the broadcast boundaries - a map-only pass, so a corpus of
    any size is split without shuffling its text.
    """
    strata = list(strata)
    drop_all = not strata
    h = df.withColumn("_h", shuffle_key(F.col(key), seed)).withColumn("_p", hex_buckets(F.col("_h")))
    if drop_all:  # one stratum for everything; derived from data (not a literal)
        # so joins on it stay equi-joins instead of being folded into cross joins
        h, strata = h.withColumn("_all", F.coalesce(F.col("_p") * 0, F.lit(0))), ["_all"]
        if not callable(cuts):
            cuts = cuts.withColumn("_all", F.lit(0))
    counts = h.groupBy("_p", *strata).agg(F.count(F.lit(1)).alias("_n")).persist()
    if callable(cuts):  # cuts computed from the per-bucket counts (no extra pass)
        cuts = cuts(counts)
    long_cuts = cuts.select(
        *strata, F.explode(F.array(F.struct(F.lit(1).alias("_cut"), F.col("q1").alias("_q")), F.struct(F.lit(2).alias("_cut"), F.col("q2").alias("_q")))).alias("c")
    ).select(*strata, "c._cut", F.col("c._q").cast("bigint").alias("_q"))
    bounds = _cut_rows(h, key, strata, counts, long_cuts)
    wide = bounds.groupBy(*strata).agg(
        F.max(F.when(F.col("_cut") == 1, F.col("_h"))).alias("_h1"),
        F.max(F.when(F.col("_cut") == 1, F.col("_k"))).alias("_k1"),
        F.max(F.when(F.col("_cut") == 2, F.col("_h"))).alias("_h2"),
        F.max(F.when(F.col("_cut") == 2, F.col("_k"))).alias("_k2"),
    ).persist()  # one row per stratum; reused by every job that reads the split

    def below(hc: str, kc: str) -> Column:
        return F.col(hc).isNull() | (F.col("_h") < F.col(hc)) | ((F.col("_h") == F.col(hc)) & (F.col(key) < F.col(kc)))

    label = F.when(below("_h1", "_k1"), F.lit(labels[0])).when(below("_h2", "_k2"), F.lit(labels[1])).otherwise(F.lit(labels[2]))
    joined = h.join(bounded_broadcast(wide), strata, "left")  # one row per stratum
    out_df = joined.withColumn(out, label).drop("_h", "_p", "_h1", "_k1", "_h2", "_k2")
    return out_df.drop("_all") if drop_all else out_df


def random_split(df: DataFrame, key: str, seed: int = 42, split_col: str = "split") -> DataFrame:
    """80/10/10 in seeded-hash order: train = floor(.8n), valid = floor(.1n), test = rest."""

    def cuts(counts: DataFrame) -> DataFrame:  # sizes from the bucket counts, no extra pass
        n = counts.groupBy("_all").agg(F.sum("_n").alias("_N"))
        return n.select("_all", F.expr("_N * 8 div 10").alias("q1"), F.expr("_N * 8 div 10 + _N div 10").alias("q2"))

    return assign_by_rank(df, key, cuts, ("train", "valid", "test"), seed=seed, out=split_col)


def _largest_remainder(counts: DataFrame, strata: str, base: str, total: Column, take: Column, out: str) -> DataFrame:
    """Split ``take`` of ``total`` across classes in proportion to ``base``.

    floor quotas first, the leftover to the largest remainders (ties: lower
    class). Runs over the per-class relation only (one row per class).
    """
    everything = Window.partitionBy(F.lit(0))
    c = counts.withColumn("_take", take.cast("bigint")).withColumn("_total", total.cast("bigint"))
    c = c.withColumn("_q", F.expr(f"({base} * _take) div _total")).withColumn("_r", F.expr(f"({base} * _take) % _total"))
    c = c.withColumn("_left", F.col("_take") - F.sum("_q").over(everything))
    c = c.withColumn("_rk", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("_r"), F.asc(strata))))
    return c.withColumn(out, (F.col("_q") + F.when(F.col("_rk") <= F.col("_left"), 1).otherwise(0)).cast("bigint")).drop(
        "_q", "_r", "_left", "_rk", "_take", "_total"
    )


def stratified_quotas(df: DataFrame, strata: str, counts: DataFrame | None = None) -> DataFrame:
    """Per class: n, hold-out size and test size (one row per class).

    ``counts`` may give per-(bucket, class) counts already computed (``_n``)."""
    if counts is not None:
        counts = counts.groupBy(strata).agg(F.sum("_n").alias("n_class"))
    else:
        counts = df.groupBy(strata).agg(F.count(F.lit(1)).alias("n_class"))
    everything = Window.partitionBy(F.lit(0))
    counts = counts.withColumn("_N", F.sum("n_class").over(everything))
    counts = counts.withColumn("_H", F.expr("(_N * 2 + 9) div 10"))
    q = _largest_remainder(counts, strata, "n_class", F.col("_N"), F.col("_H"), "n_hold")
    q = q.withColumn("_T", F.expr("(_H + 1) div 2"))
    q = _largest_remainder(q, strata, "n_hold", F.col("_H"), F.col("_T"), "n_test")
    return q.select(strata, "n_class", "n_hold", "n_test")


def check_strata(df: DataFrame, strata: str, minimum: int = 2) -> DataFrame:
    """Rows per class and whether it can be stratified: at least ``minimum``
    rows in the class and in its hold-out (the input of the second step)."""
    q = stratified_quotas(df, strata)
    ok = (F.col("n_class") >= minimum) & (F.col("n_hold") >= minimum)
    return q.withColumn("ok", ok)


def stratified_split(df: DataFrame, key: str, strata: str, seed: int = 42, split_col: str = "split") -> DataFrame:
    """Stratified 80/10/10; within a class, first n_test (md5 order) -> test,
    next n_hold - n_test -> valid, rest -> train. Rows are labelled in place
    (``assign_by_rank``); only per-class quotas and boundary rows are computed.
    A row without a class is refused: the job fails with its key."""
    refuse = F.raise_error(F.concat(F.lit("no class for row "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).cast(df.schema[strata].dataType)
    df = df.withColumn(strata, F.coalesce(F.col(strata), refuse))

    def cuts(counts: DataFrame) -> DataFrame:
        q = stratified_quotas(df, strata, counts)
        return q.select(strata, F.col("n_test").alias("q1"), F.col("n_hold").alias("q2"))

    return assign_by_rank(df, key, cuts, ("test", "valid", "train"), strata=[strata], seed=seed, out=split_col)


def stratified_split_ranked(df: DataFrame, key: str, strata: str, seed: int = 42, split_col: str = "split") -> DataFrame:
    """P3 through explicit within-class ranks (a window over (class, hash
    bucket) moves every row once); kept for callers that need the rank."""
    h = df.withColumn("_h", shuffle_key(F.col(key), seed))
    buckets = hex_buckets(F.col("_h"))
    counts = bucket_counts(h, buckets, [strata])  # one pass, shared by quotas and ranks
    quotas = bounded_broadcast(stratified_quotas(df, strata, counts).persist())  # one row per class
    ranked = global_index(h, ["_h", key], strata=[strata], out="_rank", buckets=buckets, counts=counts).drop("_h")
    split = (
        F.when(F.col("_rank") < F.col("n_test"), F.lit("test"))
        .when(F.col("_rank") < F.col("n_hold"), F.lit("valid"))
        .otherwise(F.lit("train"))
    )
    return ranked.join(quotas, strata).withColumn(split_col, split).drop("_rank", "n_class", "n_hold", "n_test")


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """P5: n rows in seeded-hash order (top-k: no full sort, bounded by n)."""
    return df.orderBy(shuffle_key(F.col(key), seed), F.col(key)).limit(n)
