"""Token counts of sections by offset-mapped attribution.

A document is encoded once, as a whole; every token has a byte span in the text
(the vocabulary is byte-level, so its ids' sizes give the offsets). Sections
are byte spans too. Both lists are sorted, so joining them by overlap is a
merge: for each token the first and the last section that it touches.

Allocation of tokens that cross a boundary (``rule``):
  ``start``     the whole token goes to the section of its first byte (default);
  ``majority``  to the section that holds most of its bytes, the earlier one if
                two hold as many;
  ``split``     each section gets the share of the bytes that it holds.
Under every rule a document's sections add up to its number of tokens, which
is not so when sections are encoded one by one.

Scale: one pass over the texts, no shuffle; a document's spans live only in
its own row's step, in bounded slices of tokens.

Defined results: null and empty texts have one empty section with no tokens;
empty sections get none; repeated rows are counted one by one; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textguard.llm.bpe import ByteBpe

RULES = ("start", "majority", "split")


def paragraphs(data: bytes) -> np.ndarray:
    """Starts of the sections of a text: its lines, with their line feed."""
    raw = np.frombuffer(data, np.uint8)
    starts = np.concatenate(([0], np.flatnonzero(raw == 10) + 1))
    return starts[: len(starts) - 1] if len(starts) > 1 and starts[-1] == len(raw) else starts


def attribute(sizes: np.ndarray, starts: np.ndarray, total: int, rule: str = "start") -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing) of every section: ``sizes`` are the tokens' bytes,
    ``starts`` the sections' first bytes (the first is 0), ``total`` the text's
    length. crossing: tokens that touch the section and another one."""
    count = len(starts)
    if not len(sizes):
        return np.zeros(count), np.zeros(count, np.int64)
    ends = np.cumsum(sizes)
    begin = ends - sizes
    bounds = np.append(starts, total)
    first = np.searchsorted(starts, begin, "right") - 1
    last = np.searchsorted(starts, ends - 1, "right") - 1
    cross = np.flatnonzero(last > first)
    inside = np.ones(len(sizes), bool)
    inside[cross] = False
    tokens = np.bincount(first[inside], minlength=count).astype(float)
    crossing = np.zeros(count, np.int64)
    for t in cross.tolist():  # few: a token is a word's part, and sections are longer
        touched = np.arange(first[t], last[t] + 1)
        held = np.minimum(ends[t], bounds[touched + 1]) - np.maximum(begin[t], bounds[touched])
        touched, held = touched[held > 0], held[held > 0]
        crossing[touched] += 1
        if rule == "start":
            tokens[touched[0]] += 1
        elif rule == "majority":
            tokens[touched[int(held.argmax())]] += 1
        else:
            tokens[touched] += held / held.sum()
    return tokens, crossing


def count_tokens(
    docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", rule: str = "start", sections=paragraphs, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per section: (key, section, start_byte, end_byte, n_tokens,
    n_crossing, doc_tokens). ``sections`` gives the section starts of a text."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    schema = T.StructType(
        [docs.schema[key]]
        + [T.StructField("section", T.IntegerType()), T.StructField("start_byte", T.LongType()), T.StructField("end_byte", T.LongType())]
        + [T.StructField("n_tokens", T.DoubleType()), T.StructField("n_crossing", T.LongType()), T.StructField("doc_tokens", T.LongType())]
    )

    def run(batches):
        codec = ByteBpe.cached(vocabulary)
        for b in batches:
            parts, owner = [], []
            for i, t in enumerate(b.column(1).cast(pa.binary())):
                data = t.as_buffer().to_pybytes() if t.is_valid else b""
                ids = codec.encode(data.decode()) if data else np.zeros(0, np.uint32)
                starts = sections(data)
                tokens, crossing = attribute(codec.sizes[ids], starts, len(data), rule)
                n = len(starts)
                parts.append((np.arange(n, dtype=np.int32), starts.astype(np.int64), np.append(starts[1:], len(data)).astype(np.int64), tokens, crossing, np.full(n, len(ids), np.int64)))
                owner.append(np.full(n, i))
            if parts:
                columns = [np.concatenate(c) for c in zip(*parts)]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.concatenate(owner))), *(pa.array(c) for c in columns)], names=schema.names)

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)
