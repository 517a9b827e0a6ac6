"""Packing rows into scorer requests and reading replies back.

A request batch holds a fixed number of rows (20 by default), so every group
that is collected is bounded by the batch size; the few-shot block is bounded
by its k. Context (policy, few-shot) attaches by an equi-join on a context key,
broadcast because it is a handful of rows by construction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textguard.functions import parse
from textguard.functions import text as tx
from textguard.operators.index import batch_id
from textguard.session import bounded_broadcast


def _ordered_join(items: Column, order: Column, sep: str) -> Column:
    """Join ``items`` of a bounded group in ``order``."""
    return F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), items.alias("v")))), lambda s: s["v"]), sep
    )


def fewshot_block(df: DataFrame, k: int, order_col: str, fmt: str = "tsv", ctx_key: str | None = None) -> DataFrame:
    """The first k pairs as one text block, ``source\\ttarget\\n`` each
    (``fmt='arrow'``: '원문: s -> 순화문: t'). One row, or one for each ``ctx_key``
    with the first k pairs of that key. The formats are fixed values."""
    if fmt == "tsv":
        line = F.concat(tx.one_line(F.col("source")), F.lit("\t"), tx.one_line(F.col("target")), F.lit("\n"))
    elif fmt == "arrow":
        line = F.concat(F.lit("원문: "), tx.one_line(F.col("source")), F.lit(" -> 순화문: "), tx.one_line(F.col("target")), F.lit("\n"))
    else:
        raise ValueError("fmt must be 'tsv' or 'arrow'")
    keys = [ctx_key] if ctx_key else []
    if ctx_key:  # k rows of each key; a task keeps no more than k of a key before the shuffle
        top = df.withColumn("_rank", F.row_number().over(Window.partitionBy(ctx_key).orderBy(order_col))).filter(F.col("_rank") <= k)
    else:
        top = df.orderBy(order_col).limit(k)  # top-k: bounded by k
    return top.groupBy(*keys).agg(_ordered_join(line, F.col(order_col), "").alias("fewshot"), F.count(F.lit(1)).alias("n_examples"))


def sample_per_key(df: DataFrame, key: str | None, k: int, id_col: str, seed: int = 0) -> DataFrame:
    """A7 sketch: ``k`` rows of every ``key`` (of all rows without one) drawn at
    random, the same ones for the same seed.

    A row's rank is md5('<seed>:' || id); the ``k`` least ranks of a key are its
    bottom-k sketch. Sketches merge: the least of two sketches' rows are the
    sketch of both. So every task keeps ``k`` rows a key while its rows stream by,
    sends only those, and the few that arrive are merged in one grouping; there
    is no window over the rows and nothing is sorted but sketches. Rows with a
    null id, and repeated ids, are ranked alike, ties by a hash of all columns.
    Passes SKETCH_ROWS on and starts anew where a task meets more keys than that."""
    names = df.columns
    ranked = df.select("*", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("_rank"), F.xxhash64(*names).alias("_tie"))
    groups = [key] if key else []

    def least(batches):
        import pyarrow as pa

        held = None
        for b in batches:
            both = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            held = _least(both, groups, k)
            if held.num_rows >= SKETCH_ROWS:
                yield from held.to_batches()
                held = None
        if held is not None:
            yield from held.to_batches()

    sketches = ranked.mapInArrow(least, ranked.schema)
    row = F.struct("_rank", "_tie", F.struct(*names).alias("_row"))
    merged = sketches.groupBy(*groups).agg(F.slice(F.array_sort(F.collect_list(row)), 1, k).alias("_kept"))  # k rows a key and task
    return merged.select(F.explode("_kept").alias("_one")).select("_one._row.*")


#: Rows that a task's sketches may have before they are passed on.
SKETCH_ROWS = 1 << 17


def _least(rows, groups: list[str], k: int):
    """The first ``k`` rows of every group of an Arrow table by (_rank, _tie)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    rows = rows.combine_chunks()
    order = pc.sort_indices(rows, [(c, "ascending") for c in (*groups, "_rank", "_tie")]).to_numpy()
    if groups:
        code = pc.dictionary_encode(rows[groups[0]], null_encoding="encode").combine_chunks()
        code = (code.chunk(0) if isinstance(code, pa.ChunkedArray) else code).indices.to_numpy()[order]
    else:
        code = np.zeros(len(order), np.int64)
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
    place = np.arange(len(code)) - np.repeat(first, np.diff(np.append(first, len(code))))
    return rows.take(order[place < k])


def pack_batches(df: DataFrame, size: int, order_col: str, text: str = "source") -> DataFrame:
    """Consecutive groups of ``size`` rows -> one request body of
    'ID:i | TEXT:t' lines; plus the batch's first id and row count."""
    b = batch_id(df.select(order_col, text), [order_col], size)
    line = parse.request_line(F.col(order_col), tx.one_line(F.col(text)))
    return b.groupBy("batch").agg(
        F.min(order_col).alias("first_id"),
        F.count(F.lit(1)).alias("n_rows"),
        _ordered_join(line, F.col("idx"), "\n").alias("body"),
    )


def with_context(df: DataFrame, ctx: DataFrame, on: str | None = None, ctx_rows_at_most: int | None = None) -> DataFrame:
    """Attach context columns (policy text, few-shot block) to every row.

    With ``on`` the context is per key (e.g. per language) and joined, broadcast
    under ``ctx_rows_at_most`` when the caller knows that bound by construction
    (a limit, a global aggregate), else after a count. Without ``on`` the
    context must be a single row (enforced by the scalar subquery).
    """
    if on is None:
        # one row: each context column becomes a scalar subquery, evaluated once
        # and shipped to the tasks as a value (no join at all)
        out = df
        for c in ctx.columns:
            out = out.withColumn(c, ctx.select(c).scalar())
        return out
    return df.join(bounded_broadcast(ctx, rows_at_most=ctx_rows_at_most), on, "left")


def build_requests(batches: DataFrame, policy: DataFrame, fewshot: DataFrame, on: str | None = None) -> DataFrame:
    """Policy + few-shot + packed rows -> the full prompt per batch.

    ``policy`` is one row (a limit 1), or one for each key ``on`` of the batches;
    ``fewshot`` is one row (a global aggregate of ``fewshot_block``)."""
    with_policy = with_context(batches, policy, on=on, ctx_rows_at_most=None if on else 1)
    full = with_context(with_policy, fewshot, ctx_rows_at_most=1)
    prompt = F.concat_ws("\n---\n", F.col("policy"), F.col("fewshot"), F.col("body"))
    return full.select("batch", "first_id", "n_rows", prompt.alias("prompt"))


def parse_batch(replies: DataFrame, raw_col: str = "raw", keep=()) -> DataFrame:
    """One output row per usable reply line: (id, id_info, decision, score, target).

    A line is usable when it has a '|' and at least four fields; extra fields
    are dropped; fields are trimmed; ``id`` is the number after 'ID:'.
    """
    lines = replies.select(*keep, F.explode(parse.reply_lines(F.col(raw_col))).alias("_line"))
    f = parse.line_fields(F.col("_line"))
    return lines.select(*keep, f.alias("_f")).select(
        *keep,
        parse.parse_id(F.col("_f.id_info")).alias("id"),
        "_f.id_info",
        "_f.decision",
        "_f.score",
        "_f.target",
    )


def attach_responses(df: DataFrame, parsed: DataFrame, id_col: str = "row_id") -> DataFrame:
    """Inputs left-joined with parsed replies by id; rows without a reply
    keep null reply fields (``has_reply`` false) so dropped ids are visible.
    Of repeated replies for one id the least (decision, score, target) counts,
    and ``n_replies`` says how many there were, so no input row is multiplied."""
    r = parsed.groupBy(F.col("id").alias(id_col)).agg(F.min(F.struct("decision", "score", "target")).alias("_r"), F.count(F.lit(1)).alias("n_replies"))
    r = r.select(id_col, F.col("_r.decision").alias("decision"), F.col("_r.score").alias("reply_score"), F.col("_r.target").alias("reply"), "n_replies")
    out = df.join(r, id_col, "left").withColumn("has_reply", F.col("decision").isNotNull())
    return out.withColumn("n_replies", F.coalesce("n_replies", F.lit(0)))


# Persona tones used when expanding pairs for the scorer.
DEFAULT_TONES = ["격식체", "해요체", "비즈니스 톤"]


def expand_tones(df: DataFrame, tones=DEFAULT_TONES) -> DataFrame:
    """M5: every row once per tone (a fixed, small list: an explode, no join)."""
    return df.withColumn("tone", F.explode(F.array(*[F.lit(t) for t in tones])))
