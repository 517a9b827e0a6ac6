"""Keyed corrections and column repairs.

An override map is a relation ``(key, new_target)``. It is joined, never looked
up row by row; AQE broadcasts it when its measured size is small and falls
back to a shuffle join otherwise. Modified-row counts are reported through
``DataFrame.observe`` so counting costs no extra pass over the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from textguard.schemas import BLOCK, BLOCK_TARGET, NORMAL


class DuplicateOverrideKeys(ValueError):
    pass


def check_unique(fixes: DataFrame, key: str) -> None:
    """Reject maps that give one key two targets (a dict would silently keep the last)."""
    dup = fixes.groupBy(key).agg(F.count_distinct("new_target").alias("n")).filter("n > 1").limit(1).count()
    if dup:
        raise DuplicateOverrideKeys(f"override map has conflicting targets for some {key}")


def apply_overrides(
    df: DataFrame,
    fixes: DataFrame,
    on: str = "source",
    target: str = "target",
    observation: Observation | None = None,
    validate: str = "lazy",
) -> DataFrame:
    """J1 (on='source') / J2 (on='target'): replace ``target`` where ``on`` is in the map.

    Counts matches (including no-op replacements) in ``observation`` under
    ``n_modified``. Identical duplicate map rows collapse; a key with two
    different targets fails the job: ``validate='lazy'`` (default) raises from
    inside the same job that applies the map (no extra pass), ``'eager'``
    checks with a separate job first and raises ``DuplicateOverrideKeys``.
    """
    if validate == "eager":
        check_unique(fixes, "key")
    # The 128-bit digest is the join key; the text itself is never hashed or compared in a shuffle.
    m = fixes.groupBy(F.md5("key").alias("_digest")).agg(F.min("new_target").alias("_lo"), F.max("new_target").alias("_hi"), F.min("key").alias("_key"))
    conflict = F.raise_error(F.concat(F.lit("override map has two targets for key: "), F.substring(F.col("_key"), 1, 80)))
    m = m.filter(F.col("_digest").isNotNull()).select("_digest", F.when(F.col("_lo").eqNullSafe(F.col("_hi")), F.col("_lo")).otherwise(conflict).alias("_new"))
    joined = df.join(m, F.md5(df[on]) == m["_digest"], "left")
    hit = F.col("_digest").isNotNull()
    out = joined.withColumn(target, F.when(hit, F.col("_new")).otherwise(F.col(target)))
    if observation is not None:
        out = out.observe(observation, F.count_if(hit).alias("n_modified"))
    return out.drop("_digest", "_new")


def repair_normal(df: DataFrame, observation: Observation | None = None) -> DataFrame:
    """NORMAL rows must keep the source: ``action=0 AND target<>source => target=source``."""
    bad = (F.col("action") == NORMAL) & ~F.col("target").eqNullSafe(F.col("source"))
    out = df.withColumn("_bad", F.coalesce(bad, F.lit(False))).withColumn(
        "target", F.when(F.col("_bad"), F.col("source")).otherwise(F.col("target"))
    )
    if observation is not None:
        out = out.observe(observation, F.count_if(F.col("_bad")).alias("n_modified"))
    return out.drop("_bad")


def repair_block(df: DataFrame, observation: Observation | None = None) -> DataFrame:
    """BLOCK rows carry the fixed block message as target."""
    bad = (F.col("action") == BLOCK) & ~F.col("target").eqNullSafe(F.lit(BLOCK_TARGET))
    out = df.withColumn("_bad", F.coalesce(bad, F.lit(False))).withColumn(
        "target", F.when(F.col("action") == BLOCK, F.lit(BLOCK_TARGET)).otherwise(F.col("target"))
    )
    if observation is not None:
        out = out.observe(observation, F.count_if(F.col("_bad")).alias("n_modified"))
    return out.drop("_bad")


def apply_steps(df: DataFrame, steps) -> DataFrame:
    """Ordered override steps: each ``(fixes, on)`` sees the result of the previous one."""
    for fixes, on in steps:
        df = apply_overrides(df, fixes, on=on)
    return df
