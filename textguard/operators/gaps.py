"""Rows that a processed corpus lost, found by aligning it with the raw one.

Both sides are (position, digest of the sanitised text). All steps are joins
and windows over ranges of positions, whatever the number of gaps:

1. Anchors: digests that stand once on either side, joined. An anchor whose
   shift (raw less processed position) is far from the median of its range was
   moved, and is left out.
2. Anchors that cross no other cut the sequence; between two cuts the longest
   increasing run is taken. Where the cuts lie follows from the running maximum
   and the coming minimum of raw positions: in a range, and over the ranges'
   own extremes, so no task sees the whole sequence.
3. Between two anchors that are further apart in raw than in processed, rows
   were lost. With no processed row between them these are known. Otherwise the
   processed rows are compared at the left anchor's shift up to the first
   mismatch, and at the right anchor's back to the last one; what stays between
   is looked ahead row by row, the smallest step first. Only rows that no anchor
   covers get there (texts that stand several times, or were changed).

If rows were only lost - whatever the texts, copies included - then raw without
the rows reported is processed and what follows its last row, which is not
reported: it may be yet to come. Changed rows are passed over. A stretch that
neither side's shift explains and that is longer than LIMIT rows isn't looked
through: its lost rows are reported together, after it.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textguard.session import materialize

#: Positions of a range; the ranges' extremes are one row each.
SPAN = 1 << 16
#: Rows of a stretch, or anchors of a tangle, that one task looks through.
LIMIT = 1 << 14
#: Lost rows that are listed at a time.
LISTED = 1 << 16


def neighbours(df: DataFrame, at: str, **values: Column) -> DataFrame:
    """Add ``<name>_before``, the largest value of the rows before (by ``at``,
    which is different in every row), and ``<name>_after``, the smallest of the
    rows after. Ranges of SPAN positions are windows of their own; their
    extremes, one row a range, are passed on from range to range."""
    span = F.expr(f"`{at}` div {SPAN}")
    held = df.withColumns({f"_v_{n}": c for n, c in values.items()}).withColumn("_span", span)
    ends = held.groupBy("_span").agg(*(f(f"_v_{n}").alias(f"_{k}_{n}") for n in values for f, k in ((F.max, "hi"), (F.min, "lo"))))
    ranges = Window.orderBy("_span")
    earlier, later = ranges.rowsBetween(Window.unboundedPreceding, -1), ranges.rowsBetween(1, Window.unboundedFollowing)
    ends = ends.select("_span", *(F.max(f"_hi_{n}").over(earlier).alias(f"_b_{n}") for n in values), *(F.min(f"_lo_{n}").over(later).alias(f"_a_{n}") for n in values))
    inside = Window.partitionBy("_span")
    up = inside.orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    down = inside.orderBy(F.desc(at)).rowsBetween(Window.unboundedPreceding, -1)  # the rows after, without a frame of its own for each row
    held = held.withColumns({f"{n}_before": F.max(f"_v_{n}").over(up) for n in values}).withColumns({f"{n}_after": F.min(f"_v_{n}").over(down) for n in values})
    joined = held.join(ends, "_span")
    return joined.select(
        *df.columns,
        *(F.greatest(f"{n}_before", f"_b_{n}").alias(f"{n}_before") for n in values),
        *(F.least(f"{n}_after", f"_a_{n}").alias(f"{n}_after") for n in values),
    )


def anchors(raw: DataFrame, proc: DataFrame) -> DataFrame:
    """(proc_pos, raw_pos) of digests that stand once on either side, but for
    those moved further than SPAN from where their range lies."""
    once = lambda df, side: df.groupBy(F.col(f"{side}_key").alias("_key")).agg(F.count(F.lit(1)).alias("_n"), F.min(f"{side}_pos").alias(f"{side}_pos")).filter("_n = 1").drop("_n")
    met = materialize(once(proc, "proc").join(once(raw, "raw"), "_key").select("proc_pos", "raw_pos"), "gap-anchors")
    span, shift = F.expr(f"proc_pos div {SPAN}").alias("_span"), F.col("raw_pos") - F.col("proc_pos")
    middle = met.groupBy(span).agg(F.percentile_approx(shift, 0.5, F.lit(1000)).alias("_middle"))
    near = met.select("*", span).join(middle, "_span").filter(F.abs(shift - F.col("_middle")) <= SPAN)
    return materialize(near.select("proc_pos", "raw_pos"), "gap-anchors")


def longest_run(values: list[int]) -> list[int]:
    """Places of a longest increasing run of ``values``."""
    tops, places, before = [], [], []
    for i, v in enumerate(values):
        n = bisect.bisect_left(tops, v)
        tops[n:], places[n:] = ([v], [i]) if n == len(tops) else ([v, *tops[n + 1 :]], [i, *places[n + 1 :]])
        before.append(places[n - 1] if n else -1)
    out, i = [], places[-1] if places else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def increasing(met: DataFrame) -> DataFrame:
    """The anchors of ``met`` (pinned) that rise together on both sides."""
    cut = F.col("raw_before").isNull() | (F.col("raw_before") < F.least(F.col("raw_pos"), F.col("raw_after")))
    cuts = neighbours(met, "proc_pos", raw=F.col("raw_pos")).select("proc_pos", "raw_pos", F.when(cut, F.col("proc_pos")).alias("_cut"))
    tangles = neighbours(cuts, "proc_pos", cut=F.col("_cut")).select("proc_pos", "raw_pos", F.coalesce("_cut", "cut_before").alias("_tangle"))
    # A tangle of more than LIMIT anchors is untangled range by range; the second pass below joins the ranges.
    tangles = materialize(tangles.withColumn("_part", F.expr(f"proc_pos div {LIMIT}")), "gap-tangles")
    several = tangles.groupBy("_tangle").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_tangle")
    alone = tangles.join(several, "_tangle", "left_anti").select("proc_pos", "raw_pos")

    def untangle(pdf):
        pdf = pdf.sort_values("proc_pos")
        return pdf.iloc[longest_run(pdf["raw_pos"].tolist())][["proc_pos", "raw_pos"]]

    few = tangles.join(several, "_tangle", "left_semi").groupBy("_tangle", "_part").applyInPandas(untangle, "proc_pos long, raw_pos long")
    kept = materialize(alone.unionByName(few), "gap-runs")
    rising = neighbours(kept, "proc_pos", raw=F.col("raw_pos")).filter(F.col("raw_before").isNull() | (F.col("raw_before") < F.col("raw_pos")))
    return materialize(rising.select("proc_pos", "raw_pos"), "gap-runs")


def look_ahead(proc: list, raw: list, at: int, shift: int, last_shift: int | None) -> list[tuple[int, int, int]]:
    """(position in processed, first lost raw position, rows lost): processed
    rows from position ``at`` on against raw rows from ``at + shift`` on. What
    is left to the ``last_shift`` was lost after them."""
    gaps, skipped, places = [], 0, {}
    for j, key in enumerate(raw):
        places.setdefault(key, []).append(j)
    for i, key in enumerate(proc):
        there = places.get(key, ())
        n = bisect.bisect_left(there, i + skipped)
        if n < len(there):
            if there[n] > i + skipped:
                gaps.append((at + i, at + shift + i + skipped, there[n] - i - skipped))
            skipped = there[n] - i
    n = len(proc)
    if last_shift is not None and last_shift > shift + skipped:
        gaps.append((at + n, at + n + shift + skipped, last_shift - shift - skipped))
    return gaps


def gaps(raw: DataFrame, proc: DataFrame) -> DataFrame:
    """(at, first, n), pinned: before processed position ``at`` the ``n`` raw
    rows from position ``first`` on are lost. ``raw`` (raw_pos, raw_key) and
    ``proc`` (proc_pos, proc_key) hold every position from 0 on once."""
    runs = increasing(anchors(raw, proc))
    rows = proc.select("proc_pos", "proc_key").join(runs, "proc_pos", "left")
    known = F.col("raw_pos").isNotNull()
    rows = neighbours(rows, "proc_pos", p=F.when(known, F.col("proc_pos")), r=F.col("raw_pos"))
    rows = rows.withColumn("p0", F.coalesce("p_before", F.lit(-1))).withColumn("r0", F.coalesce("r_before", F.lit(-1)))
    rows = rows.select("proc_pos", "proc_key", "raw_pos", "p0", "r0", F.col("p_after").alias("p1"), F.col("r_after").alias("r1"))
    rows = rows.withColumn("s0", F.col("r0") - F.col("p0")).withColumn("s1", F.col("r1") - F.col("p1"))
    # Only rows at a loss go on: anchors right after another one, and rows that no anchor covers.
    at_loss = F.when(known, (F.col("p0") == F.col("proc_pos") - 1) & (F.col("raw_pos") - F.col("proc_pos") > F.col("s0"))).otherwise(F.col("s1").isNull() | (F.col("s1") > F.col("s0")))
    rows = materialize(rows.filter(at_loss), "gap-rows")
    plain = rows.filter(known).select(F.col("proc_pos").alias("at"), (F.col("r0") + 1).alias("first"), (F.col("raw_pos") - F.col("r0") - 1).alias("n"))

    # A stretch without anchors is known by its left one. Its rows at both shifts:
    loose = rows.filter(~known).select("proc_pos", "proc_key", "p0", "s0", "s1")
    sides = raw.select("raw_pos", "raw_key")
    for side in ("s0", "s1"):
        there = sides.select((F.col("raw_pos")).alias(f"_at_{side}"), F.col("raw_key").alias(f"_key_{side}"))
        loose = loose.withColumn(f"_at_{side}", F.col("proc_pos") + F.col(side)).join(there, f"_at_{side}", "left").withColumn(f"same_{side}", F.col("proc_key").eqNullSafe(F.col(f"_key_{side}")))
    loose = materialize(loose.select("proc_pos", "proc_key", "p0", "s0", "s1", "same_s0", "same_s1"), "gap-loose")
    stretch = loose.groupBy("p0", "s0", "s1").agg(
        F.min(F.when(~F.col("same_s0"), F.col("proc_pos"))).alias("a"),  # first that the left shift doesn't explain
        F.max(F.when(~F.col("same_s1"), F.col("proc_pos"))).alias("c"),  # last that the right shift doesn't explain
        F.max("proc_pos").alias("end"),
    )
    closed = F.col("s1").isNotNull()
    at = F.when(F.col("a").isNull(), F.col("end") + 1).when(F.col("c").isNull() | (F.col("c") < F.col("a")), F.col("a"))
    stretch = materialize(stretch.withColumn("at", at).withColumn("to", F.when(closed, F.col("c")).otherwise(F.col("end"))), "gap-stretches")
    rows_between = F.col("to") - F.col("a") + 1 + F.coalesce(F.col("s1") - F.col("s0"), F.lit(0))
    between = stretch.filter(F.col("a").isNotNull() & (~closed | F.col("at").isNull()))
    small, large = between.filter(rows_between <= LIMIT), between.filter((rows_between > LIMIT) & closed)
    whole = stretch.filter(closed & F.col("at").isNotNull()).unionByName(large.withColumn("at", F.col("to") + 1))
    whole = whole.select("at", (F.col("at") + F.col("s0")).alias("first"), (F.col("s1") - F.col("s0")).alias("n"))

    inner = loose.join(small.select("p0", "a", "to"), "p0").filter("proc_pos BETWEEN a AND to").select("p0", "proc_pos", "proc_key")
    # Of an open stretch at the end there may be as many raw rows again as LIMIT.
    last = F.when(closed, F.col("to") + F.col("s1")).otherwise(F.col("to") + F.col("s0") + LIMIT)
    reach = small.select("p0", "s0", "s1", "a", F.explode(F.sequence(F.col("a") + F.col("s0"), last)).alias("raw_pos"))
    outer = reach.join(sides, "raw_pos").select("p0", "s0", "s1", "a", "raw_pos", "raw_key")

    def search(left, right):
        import pandas as pd

        if not len(left) or not len(right):
            return pd.DataFrame({"at": [], "first": [], "n": []})
        left, right = left.sort_values("proc_pos"), right.sort_values("raw_pos")
        a, s0, s1 = right["a"].iloc[0], right["s0"].iloc[0], right["s1"].iloc[0]
        found = look_ahead(left["proc_key"].tolist(), right["raw_key"].tolist(), int(a), int(s0), None if pd.isna(s1) else int(s1))
        return pd.DataFrame(found, columns=["at", "first", "n"])

    searched = inner.groupBy("p0").cogroup(outer.groupBy("p0")).applyInPandas(search, "at long, first long, n long")
    return materialize(plain.unionByName(whole).unionByName(searched), "gaps")


def lost_rows(found: DataFrame) -> DataFrame:
    """(at, n, raw_pos): a row for every lost one, long gaps listed piece by piece."""
    pieces = found.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {LISTED}"))))
    start = F.col("first") + F.col("_piece") * LISTED
    return pieces.select("at", "n", F.explode(F.sequence(start, F.least(start + LISTED, F.col("first") + F.col("n")) - 1)).alias("raw_pos"))
