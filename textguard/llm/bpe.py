"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the last 32 bytes cuts texts into chunks of about a
kilobyte, so a passage that stands in many documents gives the same chunks in
each. A chunk's digest is counted over the corpus; of a chunk that occurs again
one document is the owner, whose chunk is encoded once for all. What surrounds
the chunks of a document is encoded with it.

Repair of the joins: a chunk's own ids are right only between its first and
last *safe cut* - a space or line feed after a printable ASCII character, where
the vocabulary's pattern always begins a new piece, whatever follows or went
before. Only that interior is reused. From the last safe cut of one chunk to
the first of the next that has one - over as many chunks as it takes - the text
is encoded anew, so every join agrees exactly with the whole text's encoding.

Scale: the corpus-wide step moves digests (16 bytes a kilobyte); only chunks
that occur again are written and sent to the documents that hold them. Texts
are shuffled once, compressed, by row, for owners and readers alike. A digest in very many
documents is a row of two plain tables' join, which may be split. A row's
chunks are bounded by its text.

Defined results: null and empty texts have no ids; repeated rows are encoded
each; strings of special tokens are those tokens; an empty table gives no rows.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textguard.llm.common import fields, numbered, pin, sliced, worker_cache

#: Chunks end where the hash's top MASK_BITS bits are zero; so large on average.
MASK_BITS = 10
_GEAR = np.random.default_rng(20240101).integers(0, 1 << 32, 256, dtype=np.uint32)


class ByteBpe:
    """The byte-level vocabulary ``name`` (.json of the tokenizers library, with
    the same vocabulary as ranks beside it), by whichever library can do a text."""

    def __init__(self, name: str):
        import base64
        import json

        import public_tokenizers
        import tiktoken

        self.path = public_tokenizers.path(name)
        with open(self.path, encoding="utf-8") as f:
            special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        with open(public_tokenizers.path(name.removesuffix(".json") + ".tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.special = tuple(special)
        self.fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.sizes = np.zeros(1 + max([*ranks.values(), *special.values()]), np.int64)
        for token, i in [*ranks.items(), *((k.encode(), i) for k, i in special.items())]:
            self.sizes[i] = len(token)

    @cached_property
    def whole(self):
        """The library's tokenizer, loaded by the first text that needs it: it
        would cost every worker as much memory again as the ranks do."""
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    @staticmethod
    def cached(name: str) -> "ByteBpe":
        cache = worker_cache()
        return cache.get(("bpe", name)) or cache.setdefault(("bpe", name), ByteBpe(name))

    def encode(self, text: str) -> np.ndarray:
        """Ids as uint32. The ranks give the tokenizer's ids, many times faster;
        runs of white space too long for their pattern go the tokenizer's way."""
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all" if any(s in text for s in self.special) else set(), disallowed_special=())
        except ValueError:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        return self.fast.decode_bytes(ids.tolist()).decode("utf-8", errors="replace")


# --------------------------------------------------------------------------- chunks
def chunk_ends(raw: np.ndarray) -> np.ndarray:
    """Ends of the content-defined chunks of the bytes ``raw``, the last one at
    its end. A gear hash of the last 32 bytes, by doubling its window."""
    h = _GEAR[raw]
    for width in (1, 2, 4, 8, 16):
        h[width:] += h[:-width] << np.uint32(width)
    ends = np.flatnonzero(h >> np.uint32(32 - MASK_BITS) == 0) + 1
    return np.unique(np.append(ends[ends < len(raw)], len(raw))) if len(raw) else np.zeros(0, np.int64)


def safe_cuts(raw: np.ndarray) -> np.ndarray:
    """Places p with a space or line feed at p and a printable ASCII byte before."""
    blank = (raw[1:] == 32) | (raw[1:] == 10)
    return np.flatnonzero(blank & (raw[:-1] > 32) & (raw[:-1] < 127)) + 1


def chunks(data: bytes) -> list[tuple[int, int, int, bytes]]:
    """(start, first, last, digest) of every chunk with an interior: first and
    last are its outermost safe cuts, counted from the chunk's start. Equal
    digests mean equal bytes, so equal cuts."""
    from xxhash import xxh3_128_digest

    raw = np.frombuffer(data, np.uint8)
    ends = chunk_ends(raw)
    if not len(ends):
        return []
    starts, cuts = np.concatenate(([0], ends[:-1])), safe_cuts(raw)
    # A cut looks at the byte before it, which must lie in the chunk too.
    first, last = np.searchsorted(cuts, starts + 1, "left"), np.searchsorted(cuts, ends, "left") - 1
    return [(s, int(cuts[a]) - s, int(cuts[b]) - s, xxh3_128_digest(data[s:e])) for s, e, a, b in zip(starts.tolist(), ends.tolist(), first.tolist(), last.tolist()) if a < b]


def assemble(data: bytes, shared: list[tuple[int, int, int, bytes]], codec: ByteBpe) -> np.ndarray:
    """Ids of ``data``: shared (start, first, last, ids as little-endian uint32)
    are put in, and everything between them is encoded here."""
    parts, at = [], 0
    for start, first, last, ids in sorted(shared):
        if start + first > at:
            parts.append(codec.encode(data[at : start + first].decode()))
        parts.append(np.frombuffer(ids, "<u4"))
        at = start + last
    if at < len(data):
        parts.append(codec.encode(data[at:].decode()))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


# --------------------------------------------------------------------------- on Spark
CHUNK = fields(uid="binary", start="int", first="int", last="int", digest="binary")


def encode(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", text: str = "text", out: str = "ids") -> DataFrame:
    """Replace the text by ``out``: its ids, binary, little-endian uint32.
    ``docs`` has at least one more column."""
    from pyspark.sql.pandas.types import to_arrow_schema

    carried = [c for c in docs.columns if c != text]
    rows = numbered(docs.select(F.struct(*carried).alias("row"), F.col(text).alias("text")), "uid").select("uid", "row", "text")

    def cut(batches):
        schema = to_arrow_schema(CHUNK)
        for b in sliced(batches):
            found = [(u, *c) for u, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())) if t.is_valid for c in chunks(t.as_buffer().to_pybytes())]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*found) if found else [[]] * 5, schema)], schema=schema)

    def squeeze(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for b in sliced(batches):
            packed = [pack(t.as_buffer()) if t.is_valid else None for t in b.column(2).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(packed, pa.binary())], names=["uid", "row", "packed"])

    def own(batches):
        import zstandard

        codec, unpack = ByteBpe.cached(vocabulary), zstandard.ZstdDecompressor().decompress
        for b in sliced(batches):
            digests, ids = [], []
            for t, owned in zip(b.column(2), b.column(3)):
                data = unpack(t.as_buffer())
                for c in owned.as_py():
                    digests.append(c["digest"])
                    ids.append(codec.encode(data[c["start"] + c["first"] : c["start"] + c["last"]].decode()).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(ids, pa.binary())], names=["digest", "interior"])

    def join(batches):
        import zstandard

        codec, unpack = ByteBpe.cached(vocabulary), zstandard.ZstdDecompressor().decompress
        for b in sliced(batches):
            ids = []
            for t, shared in zip(b.column(2), b.column(3)):
                data = unpack(t.as_buffer()) if t.is_valid else b""
                ids.append(assemble(data, [(c["start"], c["first"], c["last"], c["interior"]) for c in shared.as_py() or ()], codec).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(ids, pa.binary())], names=["row", "ids"])

    cuts = pin(rows.select("uid", "text").mapInArrow(cut, CHUNK), "bpe-chunks")
    repeated = cuts.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("uid", "start", "first", "last")).alias("own")).filter("n > 1")
    owners = repeated.groupBy("own.uid").agg(F.collect_list(F.struct("own.start", "own.first", "own.last", "digest")).alias("owned"))
    # Both joins read the same exchange of the texts by row: neither is a broadcast, at any size.
    sent = rows.mapInArrow(squeeze, T.StructType([rows.schema["uid"], rows.schema["row"], T.StructField("packed", T.BinaryType())]))
    encoded = sent.join(owners.hint("merge"), "uid").select("uid", "row", "packed", "owned").mapInArrow(own, "digest binary, interior binary")
    held = cuts.join(encoded, "digest").groupBy("uid").agg(F.collect_list(F.struct("start", "first", "last", "interior")).alias("shared"))
    schema = T.StructType([rows.schema["row"], T.StructField("ids", T.BinaryType())])
    done = sent.join(held.hint("merge"), "uid", "left").select("uid", "row", "packed", "shared").mapInArrow(join, schema)
    return done.select(*(F.col("row")[c].alias(c) for c in carried), F.col("ids").alias(out))


def decode(encoded: DataFrame, vocabulary: str = "byte_bpe_50k.json", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``: the text of the ids, special tokens included."""
    schema = T.StructType([*encoded.schema.fields, T.StructField(out, T.StringType())])

    def run(batches):
        codec = ByteBpe.cached(vocabulary)
        for b in sliced(batches):
            text = [codec.decode(np.frombuffer(x.as_buffer(), "<u4")) if x.is_valid else None for x in b.column(b.schema.get_field_index(ids))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.string())], names=schema.names)

    return encoded.mapInArrow(run, schema)
