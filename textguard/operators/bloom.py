"""Anti-joins that shuffle only what may be a hit.

A Bloom filter is built over the keys to leave out. Rows that it excludes are
surely new and pass as they are, without a shuffle; only rows that it doesn't
exclude are joined with the keys. The filter's size is bounded by a parameter:
more keys than it is good for give the plain join, with the same rows.

The filter is made of SQL functions: a key's bits are positions from seeded
hashes, combined by ``bit_or`` into 64-bit words before anything is collected;
the rows look their words up in one array that travels with the plan.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits that a filter may have (16 MiB), bits a key, and positions a key has.
MAX_BITS, BITS_PER_KEY, POSITIONS = 1 << 27, 10, 4


def _positions(key: Column, bits: int) -> list[Column]:
    return [F.xxhash64(key, F.lit(i)).bitwiseAND(F.lit(bits - 1)) for i in range(POSITIONS)]


def build(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """One row (words array<bigint>): the filter of the column's values."""
    at = keys.select(F.explode(F.array(*_positions(F.col(key), bits))).alias("at"))
    word = _bit(F.col("at"))
    found = at.groupBy(F.shiftright("at", 6).alias("w")).agg(F.bit_or(word).alias("v")).toArrow()  # bits / 64 rows at most
    words = np.zeros(bits >> 6, np.int64)
    words[found.column("w").to_numpy()] = found.column("v").to_numpy()
    return keys.sparkSession.createDataFrame(pa.table({"words": pa.array([words], pa.list_(pa.int64()))}))


def may_hold(words: Column, key: Column, bits: int) -> Column:
    """False only for keys that the filter was not built from. Never null."""
    hit = F.lit(True)
    for at in _positions(key, bits):
        hit = hit & (F.get(words, F.shiftright(at, 6).cast("int")).bitwiseAND(_bit(at)) != 0)
    return F.coalesce(hit, F.lit(True))


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))


def anti_join(rows: DataFrame, keys: DataFrame, key: str, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows of ``rows`` whose ``key`` is not among ``keys`` (a null key never
    is), as a left anti join gives them. ``rows`` is read twice: for the rows
    that pass, and for those that are joined."""
    keys = keys.select(key).filter(F.col(key).isNotNull()).distinct()
    count = keys.count()
    bits = max(1 << 10, 1 << (count * BITS_PER_KEY - 1).bit_length()) if count else 0
    if not count:
        return rows
    if bits > max_bits:
        return rows.join(keys, key, "left_anti").select(*rows.columns)
    hit = may_hold(build(keys, key, bits).scalar(), F.col(key), bits)
    return rows.filter(~hit).unionByName(rows.filter(hit).join(keys, key, "left_anti").select(*rows.columns))
