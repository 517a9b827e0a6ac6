"""Looking up what texts need in a keyed table that is too large to send.

Texts are put into packs; a pack's distinct keys, with the pack's number, are
joined with the table, and what is found goes to the pack's texts. A key that
stands in very many packs is a row of two plain tables' join, which may be
split; a pack is bounded by its bytes, or is one longer text.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textguard.llm.common import fields, fresh, nullable, pin

#: Bytes of text in a pack, of texts that are handled at a time, and keys of a batch.
PACK, SLICE, KEYS = 32 << 20, 4 << 20, 1 << 20


def runs(sizes, limit: int = SLICE) -> list[tuple[int, int]]:
    """[i, j) of successive rows of about ``limit`` bytes, or of one longer row."""
    out, i, total = [], 0, 0
    for j, n in enumerate(sizes):
        if total and total + n > limit:
            out.append((i, j))
            i, total = j, 0
        total += n + 64
    return [*out, (i, len(sizes))] if i < len(sizes) else out


def text_sizes(column) -> list[int]:
    """UTF-8 bytes of every text, 0 for null."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_pylist()


def looked_up(read: DataFrame, keyed: DataFrame, text: str, wanted: Callable, valued: Callable, out: T.StructType, name: str) -> DataFrame:
    """``valued(rows, known)`` of every pack of ``read``'s rows, both Arrow tables.

    ``wanted(texts)`` gives the distinct int64 keys of a column of texts;
    ``known`` are the rows of ``keyed`` (by its column ``key``) with such a key."""
    pack, held = fresh(read, "pack"), fresh(read, "keys")
    schema = T.StructType([*read.schema.fields, T.StructField(pack, T.LongType()), T.StructField(held, T.BinaryType())])

    def gather(batches):
        from pyspark import TaskContext
        from zstandard import compress

        number, seen, whole = TaskContext.get().partitionId() << 33, np.zeros(0, np.int64), 0
        for b in batches:
            at = b.schema.get_field_index(text)
            sizes = text_sizes(b.column(at))
            for i, j in runs(sizes):
                seen, whole = np.union1d(seen, wanted(b.column(at).slice(i, j - i))), whole + sum(sizes[i:j])
                keys, numbers = [None] * (j - i), np.full(j - i, number)
                if whole >= PACK or j == b.num_rows:  # the last row of a pack holds its keys
                    keys[-1] = compress(seen.astype("<i8").tobytes(), 1)
                    number, seen, whole = number + 1, np.zeros(0, np.int64), 0
                yield pa.RecordBatch.from_arrays([*b.slice(i, j - i).columns, pa.array(numbers), pa.array(keys, pa.binary())], names=schema.names)

    def spread(batches):
        from zstandard import decompress

        for b in batches:
            for number, keys in zip(b.column(0).to_pylist(), b.column(1)):
                keys = np.frombuffer(decompress(keys.as_buffer()), "<i8")
                for i in range(0, len(keys), KEYS):
                    part = keys[i : i + KEYS]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), number)), pa.array(part)], names=["pack", "key"])

    def run(rows, known):
        return valued(rows.drop_columns([pack]).combine_chunks(), known.drop_columns(["pack"]).combine_chunks())

    # Packs are stored: each later job sees the same ones.
    packed = pin(read.mapInArrow(gather, schema), f"{name}-packs", "zstd")
    asked = packed.filter(F.col(held).isNotNull()).select(pack, held).mapInArrow(spread, fields(pack="long", key="long"))
    known = asked.join(keyed.hint("merge"), "key")
    return packed.drop(held).groupBy(pack).cogroup(known.groupBy("pack")).applyInArrow(run, nullable(out))
