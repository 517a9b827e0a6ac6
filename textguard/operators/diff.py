"""Positional comparison of two versions of a corpus.

Both sides get a global position (two-level index, no single-task window) and
a 128-bit digest of the sanitised text; all comparisons are equi-joins on
position and digest, so no text is pinned or shuffled as a key. Texts are
fetched by order key for the few lines that are reported. A lost row has no
digest, a null text has one of its own, so the two are told apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textguard.functions import text as tx
from textguard.operators import bloom, gaps
from textguard.operators.index import global_index
from textguard.session import materialize

# Positions of the first look-ahead pass for the first gap.
LOOK_AT_ONCE = 1_000_000


def digest(text: Column, strict_reference: bool = False) -> Column:
    """128-bit digest of the sanitised text; a null text has a digest of its own."""
    return F.unhex(F.md5(F.coalesce(F.concat(F.lit("t"), tx.sanitize(text, strict_reference)), F.lit("null"))))


def _keyed(df: DataFrame, order_cols, text: str, strict_reference: bool, prefix: str) -> DataFrame:
    """Order columns, position and digest, pinned. The digest is computed once,
    after the range exchange, and the text is dropped before anything is written."""
    keyed = df.select(*order_cols, F.col(text).alias(f"{prefix}_text"))
    key = {f"{prefix}_key": digest(F.col(f"{prefix}_text"), strict_reference)}
    return global_index(keyed, order_cols, out=f"{prefix}_pos", derive=key, drop=(f"{prefix}_text",))


def positional_diff(raw: DataFrame, proc: DataFrame, order_cols, text: str = "text", strict_reference: bool = False) -> DataFrame:
    """Positions where raw and processed differ after sanitising, including
    positions present on one side only (full outer join on position).
    ``line`` is 1-based; ``order_cols`` is a total order of each side."""
    sides = {}
    for name, df in (("raw", raw), ("proc", proc)):
        keyed = _keyed(df, order_cols, text, strict_reference, name)
        sides[name] = keyed.select(f"{name}_pos", f"{name}_key", F.struct(*order_cols).alias(f"{name}_at"))
    j = sides["raw"].join(sides["proc"], F.col("raw_pos") == F.col("proc_pos"), "full_outer")
    kind = (
        F.when(F.col("proc_pos").isNull(), F.lit("missing_in_proc"))
        .when(F.col("raw_pos").isNull(), F.lit("extra_in_proc"))
        .otherwise(F.lit("changed"))
    )
    found = j.filter(~F.col("raw_key").eqNullSafe(F.col("proc_key"))).select(
        (F.coalesce("raw_pos", "proc_pos") + 1).alias("line"), kind.alias("kind"), "raw_at", "proc_at"
    )
    for name, df in (("raw", raw), ("proc", proc)):
        texts = df.select(F.struct(*order_cols).alias(f"{name}_at"), F.col(text).alias(f"{name}_text"))
        found = found.join(texts, f"{name}_at", "left")
    return found.select("line", "kind", "raw_text", "proc_text")


def find_gaps(raw: DataFrame, proc: DataFrame, order_cols, text: str = "text", k: int = 4, first_only: bool = True, strict_reference: bool = False) -> DataFrame:
    """Raw rows that processed lost, one row for each: (gap_line, n_missing,
    missing_line, missing_text, within_k); lines are 1-based, the gap's line in
    processed, the missing line in raw. ``within_k``: the gap has at most ``k`` rows.

    ``first_only``: the first mismatch at position i for which a smallest j in
    1..k has raw[i+j] == proc[i]: raw rows i..i+j-1 are missing. Otherwise all
    gaps, short and long, by aligning both sides (``operators.gaps``)."""
    r = _keyed(raw, order_cols, text, strict_reference, "raw")
    p = _keyed(proc, order_cols, text, strict_reference, "proc").select("proc_pos", "proc_key")
    found = _first_gap(r, p, k) if first_only else gaps.gaps(r.select("raw_pos", "raw_key"), p)
    located = gaps.lost_rows(found).join(r.select("raw_pos", *order_cols), "raw_pos")
    texts = located.join(raw.select(*order_cols, F.col(text).alias("missing_text")), list(order_cols))
    return texts.select(
        (F.col("at") + 1).alias("gap_line"), F.col("n").cast("int").alias("n_missing"), (F.col("raw_pos") + 1).alias("missing_line"), "missing_text", (F.col("n") <= k).alias("within_k")
    )


def _first_gap(r: DataFrame, p: DataFrame, k: int) -> DataFrame:
    """(at, first, n) of the first gap that looking up to ``k`` rows ahead
    explains: among the LOOK_AT_ONCE positions from the first mismatch on or, if
    there is none, among all that follow. One row at most is brought back."""
    spark = p.sparkSession
    differ = p.join(r.select(F.col("raw_pos").alias("proc_pos"), F.col("raw_key").alias("_raw")), "proc_pos").filter(F.col("proc_key") != F.col("_raw"))
    start, first = differ.agg(F.min("proc_pos")).first()[0], None
    for here in () if start is None else (F.col("proc_pos") < start + LOOK_AT_ONCE, F.col("proc_pos") >= start + LOOK_AT_ONCE):
        ahead = differ.filter(here).select("proc_pos", F.col("proc_key").alias("raw_key"), F.explode(F.sequence(F.lit(1), F.lit(k))).alias("j")).withColumn("raw_pos", F.col("proc_pos") + F.col("j"))
        first = ahead.join(r.select("raw_pos", "raw_key"), ["raw_pos", "raw_key"]).agg(F.min(F.struct("proc_pos", "j"))).first()[0]
        if first is not None:
            break
    return spark.createDataFrame([(first["proc_pos"], first["proc_pos"], first["j"])] if first else [], "at long, first long, n long")


def coverage(raw: DataFrame, proc: DataFrame, order_cols, text: str = "text", strict_reference: bool = False) -> DataFrame:
    """One row - counts, mismatching positions and a verdict:
    'match' (equal everywhere, same length), 'prefix' (processed is a prefix of
    raw; ``next_line`` is the next expected raw line), 'longer' (processed has
    extra rows) or 'discrepancy'."""
    r = _keyed(raw, order_cols, text, strict_reference, "raw").select("raw_pos", "raw_key")
    p = _keyed(proc, order_cols, text, strict_reference, "proc").select("proc_pos", "proc_key")
    j = r.join(p, r["raw_pos"] == p["proc_pos"], "full_outer")
    agg = j.agg(
        F.count("raw_pos").alias("n_raw"),
        F.count("proc_pos").alias("n_proc"),
        F.count_if(F.col("raw_pos").isNotNull() & F.col("proc_pos").isNotNull() & (F.col("raw_key") != F.col("proc_key"))).alias("n_mismatch"),
    )
    verdict = (
        F.when(F.col("n_mismatch") > 0, F.lit("discrepancy"))
        .when(F.col("n_proc") > F.col("n_raw"), F.lit("longer"))
        .when(F.col("n_proc") < F.col("n_raw"), F.lit("prefix"))
        .otherwise(F.lit("match"))
    )
    return agg.withColumn("verdict", verdict).withColumn(
        "next_line", F.when(F.col("verdict") == "prefix", F.col("n_proc") + 1)
    )


def missing_rows(raw: DataFrame, proc: DataFrame, text: str = "text", strict_reference: bool = False) -> DataFrame:
    """Raw rows whose sanitised text occurs nowhere in processed (order-free).
    Each side's digests are computed once and pinned: the anti-join reads them a
    few times, and its filter uses a key eight times a row."""
    key = digest(F.col(text), strict_reference).alias("_key")
    keys = materialize(proc.select(key).distinct(), "processed-keys")
    rows = materialize(raw.select("*", key), "raw-keyed")
    return bloom.anti_join(rows, keys, "_key").drop("_key")
