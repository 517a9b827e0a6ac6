"""Cross-tokenizer alignment as an Arrow pipeline.

A text is encoded by two vocabularies, A and B, whose tokens spell the same
bytes. Places where a token of A and a token of B both end cut them into
groups; every A token of a group is linked with every B token of it. Over the
corpus a pair of ids counts the documents that hold it linked.

Method: a batch's id lists are flattened, with the parent index of every token;
the tokens' sizes are summed segment by segment, which gives each token its
end, and (document, end) is a key. An Acero hash join of both sides' keys finds
the common ends; tokens grouped by (group, id) and joined by group are the
links, and ``Table.group_by`` counts them: by document, then over a pack of
documents. Spark sums the packs' partial counts.

Scale: texts are read, encoded and aligned once; their groups, spelt out, and
their links, each with the place of its pair among those of the pack, are
written, compressed, with the number of the pack (PACK bytes of text, or one
longer document), in fewer bytes than the ids would take. What is shuffled is
one row for each pack and distinct pair, twice - to be summed, and to take the
sum back to the pack - and groups and links, by pack, where a link's count is
looked up by its place. No count is broadcast: they grow with the corpus. A pair
in very many packs is a row of two plain tables' join, which may be split. Inside
a task a document is aligned in pieces of about PIECE tokens, cut at common ends,
and links are made PAIRS at a time.

Defined results: null and empty texts, and texts whose tokens don't spell them
(a literal U+2581, say), have no tokens, groups or links; strings of special
tokens are plain text; repeated rows each count as a document; an empty table
gives no rows; a column called like one of the results gets underscores before
its name.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from textguard.llm.common import fields, pin, worker_cache

#: Bytes of text whose pairs are counted and looked up together.
PACK = 4 << 20
#: Bytes of text that are encoded, and tokens that are aligned, at a time.
SLICE, PIECE = 1 << 19, 1 << 18
#: Links that are made at a time.
PAIRS = 1 << 22
#: Results, beside the columns that pass through.
RESULTS = fields(n_a="long", n_b="long", n_groups="long", n_links="long", n_best="long", count_sum="long", groups="string")


class Pair:
    """Both vocabularies, with the bytes of every token."""

    def __init__(self, a: str, b: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        self.path = public_tokenizers.path(a)
        with open(public_tokenizers.path(a.removesuffix(".json") + ".tiktoken"), "rb") as f:
            ranks = {base64.b64decode(token): int(i) for token, i in map(bytes.split, f)}
        self.fast = tiktoken.Encoding(a, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        spelt = [b""] * (1 + max(ranks.values()))
        for token, i in ranks.items():
            spelt[i] = token
        self.a = pa.array(spelt, pa.large_binary())
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(b))
        named = map(self.pieces.id_to_piece, range(self.pieces.vocab_size()))
        self.b = pa.array([bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(named)], pa.large_binary())
        self.sizes = [pc.cast(pc.binary_length(v), pa.int64()) for v in (self.a, self.b)]
        self.small = max(len(self.a), len(self.b)) <= 1 << 16
        self.names = pa.array([f"{i}{end}" for i in range(max(len(self.a), len(self.b))) for end in ",|;"], pa.large_string())

    @staticmethod
    def cached(a: str, b: str) -> "Pair":
        cache = worker_cache()
        return cache.get(("pair", a, b)) or cache.setdefault(("pair", a, b), Pair(a, b))

    def _library(self):
        """The library's own tokenizer, for what its ranks can't do."""
        if not hasattr(self, "whole"):
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.path)
            self.whole.no_truncation()
            self.whole.no_padding()
            self.whole.encode_special_tokens = True
        return self.whole

    def _one(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=())
        except ValueError:  # runs of white space too long for the pattern
            return np.array(self._library().encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> tuple[pa.LargeListArray, pa.LargeListArray]:
        """Ids of A and B of the texts; none of a text that they don't spell."""
        texts = [t or "" for t in texts]
        whole = [f" {t}" if t else "" for t in texts]
        sides = lists([self._one(t) for t in whole]), lists(self.pieces.encode(texts, num_threads=1))
        want = pa.array([t.encode() for t in whole], pa.large_binary())
        found = [self.spelt(ids, table) for ids, table in zip(sides, (self.a, self.b))]
        if all(f.equals(want) for f in found):
            return sides
        right = [f[0].equals(want[i]) and f[1].equals(want[i]) for i, f in enumerate(zip(*found))]
        return tuple(lists([ids[i].values.to_numpy() if ok else () for i, ok in enumerate(right)]) for ids in sides)

    @staticmethod
    def spelt(ids: pa.LargeListArray, table: pa.Array) -> pa.LargeBinaryArray:
        """The joined bytes of every list's tokens: one buffer, cut where lists end."""
        tokens = pc.take(table, ids.values)
        starts = np.frombuffer(tokens.buffers()[1], np.int64, len(tokens) + 1)
        cuts = starts[ids.offsets.to_numpy()]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(np.ascontiguousarray(cuts)), tokens.buffers()[2]])

    def pack(self, ids: list[np.ndarray]) -> bytes:
        import zstandard

        return zstandard.compress(np.concatenate(ids).astype("<u2" if self.small else "<u4").tobytes(), 3)

    def unpack(self, data: bytes, sizes: list[int]) -> list[np.ndarray]:
        import zstandard

        flat = np.frombuffer(zstandard.decompress(data), "<u2" if self.small else "<u4").astype(np.int32)
        return np.split(flat, np.cumsum(sizes)[:-1])


def lists(values) -> pa.LargeListArray:
    """One list array of int32 ids, without an offset, of arrays or lists."""
    from itertools import chain

    offsets = np.zeros(len(values) + 1, np.int64)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    if values and isinstance(values[0], np.ndarray):
        flat = np.concatenate(values).astype(np.int32)
    else:
        flat = np.fromiter(chain.from_iterable(values), np.int32, offsets[-1])
    return pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(flat))


# --------------------------------------------------------------------------- alignment
def tokens(ids: pa.LargeListArray, sizes: pa.Array) -> pa.Table:
    """(piece, id, key) of every token: its list, its id, and (list, end) in one."""
    flat, parent = pc.list_flatten(ids), pc.list_parent_indices(ids)
    total = pc.cumulative_sum(pc.take(sizes, flat)).to_numpy()
    before = np.concatenate(([0], total))[ids.offsets.to_numpy()[:-1]]  # what the lists before sum up to
    ends = pc.subtract(pa.array(total), pc.take(pa.array(before), parent))
    return pa.table({"piece": parent, "id": flat, "key": pc.add(pc.shift_left(parent, 40), ends)})


def grouped(a: pa.Table, b: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group of every A token, of every B token, piece of every group): groups
    end at the keys that both sides have."""
    common = a.select(["key"]).join(b.select(["key"]), "key", join_type="left semi", use_threads=False)
    ends = np.sort(common["key"].to_numpy())
    return *(np.searchsorted(ends, t["key"].to_numpy()) for t in (a, b)), ends >> 40


def links(a: pa.Table, b: pa.Table, groups: tuple, doc_of: np.ndarray) -> pa.Table:
    """(doc, pair, times): the linked id pairs of every document, ``a << 32 | b``,
    with the number of their links."""
    # Most groups have one token on either side, which are linked as they stand.
    n, doc_of_group = len(groups[2]), doc_of[groups[2]]
    one = (np.bincount(groups[0], minlength=n) == 1) & (np.bincount(groups[1], minlength=n) == 1)
    alone = [one[g] for g in groups[:2]]
    pair = pc.bit_wise_or(pc.shift_left(pc.cast(a["id"].filter(alone[0]), pa.int64()), 32), pc.cast(b["id"].filter(alone[1]), pa.int64()))
    plain = pa.table({"doc": doc_of_group[groups[0][alone[0]]], "pair": pair})
    found = [plain.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["doc", "pair", "times"])]

    sides = []
    for t, g, rest, name in ((a, groups[0], ~alone[0], "a"), (b, groups[1], ~alone[1], "b")):
        many = pa.table({"group": g[rest], name: pc.cast(t["id"].filter(rest), pa.int64())})
        sides.append(many.group_by(["group", name], use_threads=False).aggregate([([], "count_all")]).rename_columns(["group", name, f"n_{name}"]))
    left, right = sides
    partners = np.bincount(right["group"].to_numpy(), minlength=n)
    at = np.cumsum(partners[left["group"].to_numpy()])
    cuts = [0, *np.searchsorted(at, np.arange(PAIRS, at[-1] if len(at) else 0, PAIRS), "right").tolist(), len(left)]
    for i, j in zip(cuts, cuts[1:]):
        if i == j:
            continue
        part = left.slice(i, j - i)
        there = right if len(cuts) == 2 else right.filter(pc.is_in(right["group"], pc.unique(part["group"])))
        met = part.join(there, "group", join_type="inner", use_threads=False)
        pair = pc.bit_wise_or(pc.shift_left(met["a"], 32), met["b"])
        found.append(_by_document(pa.table({"doc": doc_of_group[met["group"].to_numpy()], "pair": pair, "times": pc.multiply(met["n_a"], met["n_b"])})))
    return found[0] if len(found) == 1 else _by_document(pa.concat_tables(found))


def _by_document(t: pa.Table) -> pa.Table:
    return t.group_by(["doc", "pair"], use_threads=False).aggregate([("times", "sum")]).rename_columns(["doc", "pair", "times"])


def spelled(a: pa.Table, b: pa.Table, groups: tuple, names: pa.Array) -> tuple[np.ndarray, memoryview]:
    """``a1,a2|b1;a3|b2;`` of the pieces' groups in order: where each group
    begins (and the last one ends), and the text as bytes. ``names``: of every
    id, as text, followed by a comma, a bar and a semicolon."""
    (ga, gb, _), n = groups, len(groups[2])
    na, nb = np.bincount(ga, minlength=n), np.bincount(gb, minlength=n)
    at_a = np.arange(len(ga)) + (np.cumsum(nb) - nb)[ga]
    at_b = np.arange(len(gb)) + np.cumsum(na)[gb]
    order = np.empty(len(ga) + len(gb), np.int64)
    order[at_a], order[at_b] = np.arange(len(ga)), len(ga) + np.arange(len(gb))
    ids = np.concatenate((a["id"].to_numpy(), b["id"].to_numpy()))[order]
    end = np.full(len(order), 0)
    last_a, last_b = np.append(ga[1:] != ga[:-1], True), np.append(gb[1:] != gb[:-1], True)
    end[at_a[last_a]], end[at_b[last_b]] = 1, 2
    texts = pc.take(names, pa.array(3 * ids.astype(np.int64) + end))
    starts = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1)
    return starts[np.concatenate(([0], np.cumsum(na + nb)))], memoryview(texts.buffers()[2] or b"")


def pieces(ids: list[tuple[np.ndarray, np.ndarray]], sizes: list[np.ndarray]):
    """Lists of (document, A ids, B ids) of about PIECE tokens: many short
    documents, or a part of a long one that ends at a common end."""
    ready, size = [], 0
    for doc, (a, b) in enumerate(ids):
        if not len(a):
            continue
        at, ends_a, ends_b = [(0, 0)], None, None
        if len(a) > PIECE:
            ends_a, ends_b = np.cumsum(sizes[0][a]), np.cumsum(sizes[1][b])
            common = np.isin(ends_a, ends_b, assume_unique=True).nonzero()[0]
            wanted = common[np.unique(np.minimum(np.searchsorted(common, np.arange(PIECE, len(a), PIECE)), len(common) - 1))]
            at += [(i + 1, int(np.searchsorted(ends_b, ends_a[i])) + 1) for i in wanted.tolist() if i + 1 < len(a)]
        at.append((len(a), len(b)))
        for (i, k), (j, m) in zip(at, at[1:]):
            ready.append((doc, a[i:j], b[k:m]))
            size += j - i
            if size >= PIECE:
                yield ready
                ready, size = [], 0
    if ready:
        yield ready


def align(ids: list[tuple[np.ndarray, np.ndarray]], sizes: list[pa.Array], names: pa.Array | None = None):
    """(links, groups and links of every document, its groups spelt by ``names``) of documents' ids."""
    found, n_groups, n_links = [], np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    texts: list[list[memoryview]] = [[] for _ in ids]
    for ready in pieces(ids, [s.to_numpy() for s in sizes]):
        doc_of = np.array([doc for doc, _, _ in ready])
        a, b = (tokens(lists([r[side] for r in ready]), sizes[side - 1]) for side in (1, 2))
        groups = grouped(a, b)
        found.append(links(a, b, groups, doc_of))
        doc_of_group, n = doc_of[groups[2]], len(groups[2])
        np.add.at(n_groups, doc_of_group, 1)
        np.add.at(n_links, doc_of_group, np.bincount(groups[0], minlength=n) * np.bincount(groups[1], minlength=n))
        if names is not None:
            cuts, told = spelled(a, b, groups, names)
            first = np.flatnonzero(np.append(True, groups[2][1:] != groups[2][:-1])) if n else []
            for i, j in zip(first, [*first[1:], n]):
                texts[doc_of_group[i]].append(told[cuts[i] : cuts[j]])
    whole = pa.concat_tables(found) if found else pa.table({c: pa.array([], pa.int64()) for c in ("doc", "pair", "times")})
    whole = _by_document(whole) if len(found) > 1 else whole
    return whole, n_groups, n_links, [b"".join(parts)[:-1].decode() for parts in texts] if names is not None else None


# --------------------------------------------------------------------------- on Spark
ENCODED = fields(groups="binary", links="binary", pack="long", pairs="binary").fields
#: What is counted of every document.
COUNTED = ("n_a", "n_b", "n_groups", "n_links")


def packed(*columns: np.ndarray) -> bytes:
    """Columns of as many numbers each, compressed by planes of bytes."""
    from zstandard import compress

    flat = np.concatenate(columns).astype("<i8")
    return compress(np.ascontiguousarray(flat.view(np.uint8).reshape(-1, 8).T).tobytes(), 3)


def unpacked(data: bytes, columns: int) -> np.ndarray:
    from zstandard import decompress

    planes = np.frombuffer(decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").reshape(columns, -1)


def encode(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", text: str = "text") -> DataFrame:
    """(rows, n_a, n_b, n_groups, n_links, groups, links, pack, pairs), pinned, for
    runs of documents: their other columns as structs, their counts, their groups
    spelt out, a line each; (document, place of the pair, times) of their links;
    the pack, and in a pack's last row the sorted pairs of the pack with the
    number of its documents that hold them."""
    carried = [c for c in docs.columns if c != text]
    row = F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(carried))) if carried else F.struct(F.lit(0).alias("c0"))
    read = docs.select(row.alias("row"), F.col(text).alias("text"))

    def run(batches):
        from pyspark import TaskContext
        from zstandard import compress

        both, number = Pair.cached(a, b), TaskContext.get().partitionId() << 33
        for batch in batches:
            sizes = np.array([len(t.as_buffer() or b"") if t.is_valid else 0 for t in batch.column(1).cast(pa.binary())])
            waiting, held = 0, []
            for i, j in _runs(sizes):
                ids = both.encode(batch.column(1).slice(i, j - i).to_pylist())
                ids = [(x.values.to_numpy(), y.values.to_numpy()) for x, y in zip(*ids)]
                linked, n_groups, n_links, told = align(ids, both.sizes, both.names)
                counted = [*([len(x[s]) for x in ids] for s in (0, 1)), n_groups.tolist(), n_links.tolist()]
                held.append((i, j, counted, compress("\n".join(told).encode(), 3), linked.sort_by([("doc", "ascending"), ("pair", "ascending")])))
                waiting += sizes[i:j].sum()
                if waiting < PACK and j < batch.num_rows:
                    continue
                counts = [linked.group_by("pair", use_threads=False).aggregate([([], "count_all")]) for *_, linked in held]
                summed = pa.concat_tables(counts).group_by("pair", use_threads=False).aggregate([("count_all", "sum")]).sort_by("pair")
                pair = summed["pair"].to_numpy()
                for at, (i, j, counted, told, linked) in enumerate(held, 1):
                    place = np.searchsorted(pair, linked["pair"].to_numpy())
                    one = [pa.ListArray.from_arrays([0, j - i], batch.column(0).slice(i, j - i))]
                    one += [pa.array([n], pa.list_(pa.int64())) for n in counted]
                    one += [pa.array([x], pa.binary()) for x in (told, packed(linked["doc"].to_numpy(), place, linked["times"].to_numpy()))]
                    pairs = compress(pair.astype("<i8").tobytes() + summed["count_all_sum"].to_numpy().astype("<i8").tobytes(), 1) if at == len(held) else None
                    yield pa.RecordBatch.from_arrays([*one, pa.array([number]), pa.array([pairs], pa.binary())], names=schema.names)
                waiting, held, number = 0, [], number + 1

    schema = T.StructType([T.StructField("rows", T.ArrayType(read.schema["row"].dataType)), *(T.StructField(n, T.ArrayType(T.LongType())) for n in COUNTED), *ENCODED])
    return pin(read.mapInArrow(run, schema), "alignment-links")


def _runs(sizes: np.ndarray) -> list[tuple[int, int]]:
    """[i, j) runs of rows of about SLICE bytes."""
    out, i, total = [], 0, 0
    for j, n in enumerate(sizes.tolist()):
        total += n + 64
        if total >= SLICE:
            out.append((i, j + 1))
            i, total = j + 1, 0
    return [*out, (i, len(sizes))] if i < len(sizes) else out


def _spread(encoded: DataFrame) -> DataFrame:
    """(pack, pair, n) of every pack."""

    def run(batches):
        from zstandard import decompress

        for batch in batches:
            for pack, held in zip(batch.column(0).to_pylist(), batch.column(1)):
                pair, n = np.frombuffer(decompress(held.as_buffer()), "<i8").reshape(2, -1)
                for i in range(0, len(pair), SLICE):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair[i : i + SLICE]), pack)), pa.array(pair[i : i + SLICE]), pa.array(n[i : i + SLICE])], names=["pack", "pair", "n"])

    return encoded.filter(F.col("pairs").isNotNull()).select("pack", "pairs").mapInArrow(run, fields(pack="long", pair="long", n="long"))


def pair_counts(encoded: DataFrame) -> DataFrame:
    """(pair, n, best), pinned: the documents that hold a pair linked, and whether
    no other pair of its A id has more. ``pair`` is ``a << 32 | b``."""
    counts = _spread(encoded).groupBy("pair").agg(F.sum("n").alias("n"))
    of_a = Window.partitionBy(F.shiftright("pair", 32))  # as many rows as B has ids, at most
    return pin(counts.withColumn("best", (F.col("n") == F.max("n").over(of_a)).cast("long")), "alignment-counts")


def alignment(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", text: str = "text") -> DataFrame:
    """The columns of ``docs`` without its text, and for every document n_a, n_b,
    n_groups, n_links, n_best (links whose count is the highest of their A id),
    count_sum (of the counts, over links) and groups ("a1,a2|b1;a3|b2,b3")."""
    carried = [c for c in docs.columns if c != text]
    encoded = encode(docs, a, b, text)
    counts = pair_counts(encoded)
    known = _spread(encoded).select("pack", "pair").join(counts.hint("merge"), "pair")
    row = encoded.schema["rows"].dataType.elementType
    schema = T.StructType([T.StructField("row", row), *RESULTS.fields])

    def run(runs, known):
        from zstandard import decompress

        known = known.sort_by("pair")  # the pairs of the pack, all and in order: a link's place is a row
        count, top = known["n"].to_numpy(), known["best"].to_numpy()
        out = [_arrow(schema).empty_table()]
        for i in range(len(runs)):
            rows, *counted = (runs[c][i].values for c in ("rows", *COUNTED))
            doc, place, times = unpacked(runs["links"][i].as_buffer(), 3)
            best, total = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
            np.add.at(best, doc, times * top[place])
            np.add.at(total, doc, times * count[place])
            told = decompress(runs["groups"][i].as_buffer()).decode().split("\n")
            out.append(pa.table([rows, *counted, best, total, pa.array(told, pa.string())], schema=_arrow(schema)))
        return pa.concat_tables(out)

    sent = encoded.drop("pairs")
    done = sent.groupBy("pack").cogroup(known.groupBy("pack")).applyInArrow(run, schema)
    taken, kept = {f.lower() for f in RESULTS.names}, []
    for i, c in enumerate(carried):
        while c.lower() in taken:
            c = f"_{c}"
        taken.add(c.lower())
        kept.append(F.col("row")[f"c{i}"].alias(c))
    return done.select(*kept, *RESULTS.names)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
