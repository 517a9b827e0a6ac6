"""Packing token sequences by non-negative least squares.

Every document becomes token ids with an end id. Full windows are cut off
first; what is left of a document is one remainder. Remainders are counted in
bins of UNIT tokens. Shallow combinations of up to DEPTH bins that fill a
window exactly are enumerated, and non-negative least squares finds how often
to repeat each so that the bins' counts are met. The counts are rounded down
to what the histogram holds; the remainders that no combination takes are
packed greedily, next to next, cut where a window ends.

Scale: the driver sees the histogram only (at most WINDOW / UNIT numbers). A
remainder's place follows from its rank in its bin, and ranks come from small
window groups of even size. Token ids are written once and joined once to the
pieces of their document; other shuffles move narrow rows. A document of any
length travels as one row and its pieces are slices of it.

Defined results: a null text is an empty one (its end id alone); repeated rows
are packed one by one; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from textguard.llm.common import pin, spread_groups, worker_cache

WINDOW, UNIT, DEPTH = 2048, 8, 4
#: Words whose ids a Python worker remembers, and their longest length in bytes.
MEMO, MEMO_BYTES = 400_000, 64


# --------------------------------------------------------------------------- tokens
class WordMemo(dict):
    """Word bytes -> its ids as little-endian uint16, encoded when first met.

    ``path``: a BPE with word ends of the tokenizers library. Its merges are also
    put as ranks, the word's end being one more byte (MARK) whose union with any
    byte comes before all merges; so new words of a text are encoded together
    in one call. Words that hold the mark, a special token or a character that
    Unicode has got since 3.2 (libraries know different ones) are left to the
    library itself.
    """

    MARK = "\x01"

    def __init__(self, path: str):
        import json
        import os

        import regex
        import tiktoken

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        model, mark = config["model"], self.MARK.encode()
        self.pieces = regex.compile(config["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        suffix = model["end_of_word_suffix"]
        letters = {c: b for b, c in _byte_letters().items()}
        raw = lambda token: bytes(letters[c] for c in token.removesuffix(suffix)) + (mark if token.endswith(suffix) else b"")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [*_byte_letters().values(), *(c + suffix for c in _byte_letters().values()), *("".join(m) for m in merges)]
        ranks: dict[bytes, int] = {}
        ids = []
        for token in order:
            if ranks.setdefault(raw(token), len(ids)) == len(ids):
                ids.append(model["vocab"][token])
        self.ids = np.array(ids, "<u2")
        self.last = np.array([k.endswith(mark) and len(k) > 1 for k in ranks])
        self.fast = tiktoken.Encoding("words", pat_str=rf"[^{self.MARK}]*{self.MARK}", mergeable_ranks=ranks, special_tokens={})
        self.odd = [self.MARK, *(t.content for t in self.tokenizer.get_added_tokens_decoder().values())]
        self.settled: dict[str, bool] = {}

    def _odd(self, text: str) -> bool:
        """Whether ``text`` holds anything that the ranks may not treat alike."""
        if any(o in text for o in self.odd):
            return True
        if text.isascii():
            return False
        from unicodedata import ucd_3_2_0

        for c in set(text):
            if c not in self.settled:
                self.settled[c] = ucd_3_2_0.category(c) != "Cn"
            if not self.settled[c]:
                return True
        return False

    def learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of ``words``; those of short ones are remembered."""
        plain, found = words, {}
        if self._odd(b" ".join(words).decode()):
            plain = [w for w in words if not self._odd(w.decode())]
            found = {w: np.array(self.tokenizer.encode(w.decode(), add_special_tokens=False).ids, "<u2").tobytes() for w in set(words) - set(plain)}
        found.update(zip(plain, self._encode(plain)))
        self.update(found if max(map(len, words)) <= MEMO_BYTES else {w: v for w, v in found.items() if len(w) <= MEMO_BYTES})
        return found

    def _encode(self, words: list[bytes]) -> list[bytes]:
        from unicodedata import is_normalized, normalize

        if not words:
            return []
        text = b" ".join(words).decode()
        if not is_normalized("NFC", text):
            text = normalize("NFC", text)
        # Lower case letter by letter: a final sigma is like any other.
        text = text.replace("\u03a3", "\u03c3").lower()
        parts = [[w] if w.isalpha() else self.pieces(w) for w in text.split(" ")]
        flat = [p for ps in parts for p in ps]
        if not flat:
            return [b""] * len(words)
        ranks = self.fast.encode_to_numpy(self.MARK.join(flat) + self.MARK, disallowed_special=())
        ends = np.concatenate(([0], np.flatnonzero(self.last[ranks]) + 1))
        data = self.ids[ranks].tobytes()
        cuts = (2 * ends[np.cumsum([0, *map(len, parts)])]).tolist()
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode(self, data: bytes) -> bytes:
        """Ids of a whole text. The vocabulary drops white space and no token
        crosses it, so the text's ids are those of its words in order."""
        words = data.split()
        parts = list(map(self.get, words))
        if None in parts:
            if len(self) > MEMO:
                self.clear()
            ids = self.learn(list({w for w, p in zip(words, parts) if p is None}))
            parts = [ids[w] if p is None else p for w, p in zip(words, parts)]
        return b"".join(parts)


def _byte_letters() -> dict[int, str]:
    """Byte -> the letter that stands for it in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others for code points from 256 on."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


def tokenize(docs: DataFrame, path: str, end_id: int = 1, text: str = "text") -> DataFrame:
    """Replace the text by ``ids`` (binary, little-endian uint16, with the end
    id) and their number ``n``. ``path``: the tokenizer's file, by its name in
    public_tokenizers, found on each worker."""
    carried = [c for c in docs.columns if c != text]
    schema = T.StructType([f for f in docs.schema if f.name != text] + [T.StructField("ids", T.BinaryType()), T.StructField("n", T.LongType())])
    end = np.array([end_id], "<u2").tobytes()

    def run(batches):
        import public_tokenizers

        cache = worker_cache()
        memo = cache.get(path) or cache.setdefault(path, WordMemo(public_tokenizers.path(path)))
        for b in batches:
            texts = b.column(b.schema.get_field_index(text)).cast(pa.binary())
            ids = [(memo.encode(t.as_buffer().to_pybytes()) if t.is_valid else b"") + end for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(b.schema.get_field_index(c)) for c in carried), pa.array(ids, pa.binary()), pa.array([len(x) // 2 for x in ids], pa.int64())], names=[*carried, "ids", "n"]
            )

    return docs.mapInArrow(run, schema)


# --------------------------------------------------------------------------- the plan
def combinations(bins: list[int], full: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Multisets of up to ``depth`` of the ``bins`` that sum to ``full``."""
    have, out = set(bins), []
    for k in range(1, depth + 1):
        for head in combinations_with_replacement(sorted(have), k - 1) if k < 4 else _heads(sorted(have), full, k - 1):
            last = full - sum(head)
            if last in have and (not head or last >= head[-1]):
                out.append((*head, last))
    return out


def _heads(bins: list[int], full: int, k: int, least: int = 0, used: int = 0):
    """Ascending choices of k bins that leave at least as much for one more."""
    if k == 0:
        yield ()
        return
    for b in bins:
        if b >= least and used + b * (k + 1) <= full:
            for rest in _heads(bins, full, k - 1, b, used + b):
                yield (b, *rest)


def nnls(columns: np.ndarray, target: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """Non-negative least squares by active sets: min |A x - target|, x >= 0.

    ``columns``: (n, depth) indices into ``target``, -1 for none; column j of A
    counts how often it names each index."""
    n, size = len(columns), len(target)
    x, active = np.zeros(n), []

    def dense(js):
        a = np.zeros((size, len(js)))
        for d in range(columns.shape[1]):
            c = columns[js, d]
            np.add.at(a, (c[c >= 0], np.flatnonzero(c >= 0)), 1)
        return a

    padded = lambda r: np.append(r, 0.0)  # noqa: E731  index -1 reads the zero
    scale = max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(rounds):
        r = target - (dense(active) @ x[active] if active else 0)
        w = padded(r)[columns].sum(axis=1)
        w[active] = -np.inf
        j = int(w.argmax()) if n else 0
        if not n or w[j] <= 1e-7 * scale:
            break
        active.append(j)
        while active:
            a = dense(active)
            z = np.linalg.solve(a.T @ a + 1e-9 * np.eye(len(active)), a.T @ target)
            if (z > 0).all():
                x[active] = z
                break
            low = z <= 0
            old = x[active]
            step = (old[low] / np.maximum(old[low] - z[low], 1e-300)).min()
            x[active] = np.maximum(old + step * (z - old), 0)
            gone = [k for k, v in zip(active, x[active]) if v <= 1e-9 * scale]
            x[gone] = 0
            active = [k for k in active if k not in gone]
            if j in gone:
                break
        if active and active[-1] != j:
            break  # the new column left at once: no further progress in rounding
    return x


def plan(histogram: dict[int, int], full: int = WINDOW // UNIT, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """(bins of a window, repeats), which together take no more than there is."""
    bins = sorted(b for b, c in histogram.items() if c > 0 and 0 < b <= full)
    found = combinations(bins, full, depth)
    if not found:
        return []
    place = {b: i for i, b in enumerate(bins)}
    columns = np.full((len(found), depth), -1)
    for i, c in enumerate(found):
        columns[i, : len(c)] = [place[b] for b in c]
    x = nnls(columns, np.array([histogram[b] for b in bins], float))
    left, out = dict(histogram), []
    for j in np.argsort(-x, kind="stable")[: int((x > 0).sum())].tolist():
        need = {b: found[j].count(b) for b in found[j]}
        times = min(int(np.floor(x[j] + 1e-6)), *(left[b] // k for b, k in need.items()))
        if times > 0:
            out.append((found[j], times))
            for b, k in need.items():
                left[b] -= k * times
    return out


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(bin, r_from, r_to, seq0, slot): ranks of a bin that fill that slot of
    the windows seq0 .. seq0 + (r_to - r_from) - 1."""
    used: dict[int, int] = {}
    seq, out = 0, []
    for bins, times in patterns:
        for slot, b in enumerate(bins):
            at = used.get(b, 0)
            out.append((b, at, at + times, seq, slot))
            used[b] = at + times
        seq += times
    return out


# --------------------------------------------------------------------------- on Spark
def layout(lengths: DataFrame) -> DataFrame:
    """(uid, pieces array<struct<start, length, sequence_id, offset>>) of rows
    (uid, n): every token of 0 .. n - 1 in one piece. ``lengths`` is pinned."""
    spark = lengths.sparkSession
    total = lengths.count()
    rows = lengths.select("uid", "n", F.expr(f"n div {WINDOW}").alias("full"), (F.col("n") % WINDOW).alias("rem")).withColumn("bin", F.ceil(F.col("rem") / UNIT).cast("long"))
    grouped = spread_groups(rows, "bin", "uid", total)
    order = Window.partitionBy("bin", "sub").orderBy("uid")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = grouped.withColumn("r", F.row_number().over(order).cast("long") - 1).withColumn("full0", F.coalesce(F.sum("full").over(before), F.lit(0)))
    ranked = pin(ranked.withColumn("rem0", F.coalesce(F.sum("rem").over(before), F.lit(0))), "packing-ranked")
    # One row for each window group: their number is bounded.
    sums = ranked.groupBy("bin", "sub").agg(F.count(F.lit(1)).alias("c"), F.sum("full").alias("fulls"))
    everywhere = Window.orderBy("bin", "sub").rowsBetween(Window.unboundedPreceding, -1)
    in_bin = Window.partitionBy("bin").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pin(
        sums.select(
            "bin", "sub", "c", "fulls", F.coalesce(F.sum("fulls").over(everywhere), F.lit(0)).alias("full_off"), F.coalesce(F.sum("c").over(in_bin), F.lit(0)).alias("r_off")
        ),
        "packing-offsets",
    )
    histogram = {r["bin"]: r["c"] for r in offsets.filter("bin > 0").groupBy("bin").agg(F.sum("c").alias("c")).collect()}  # WINDOW / UNIT rows at most
    patterns = plan(histogram)
    fulls = offsets.agg(F.coalesce(F.sum("fulls"), F.lit(0))).first()[0]
    lines = fulls + sum(times for _, times in patterns)
    taken: dict[int, int] = {}
    for b, _, r_to, _, _ in slots(patterns):
        taken[b] = max(taken.get(b, 0), r_to)
    table = spark.createDataFrame(slots(patterns), "bin long, r_from long, r_to long, seq0 long, slot int")
    used = spark.createDataFrame(sorted(taken.items()), "bin long, taken long")
    placed = (
        ranked.join(F.broadcast(offsets.drop("c", "fulls")), ["bin", "sub"]).join(F.broadcast(used), "bin", "left")
        .withColumn("rank", F.col("r_off") + F.col("r")).withColumn("taken", F.coalesce("taken", F.lit(0)))
    )
    piece = lambda start, length, seq, off: F.struct(start.cast("long").alias("start"), length.cast("long").alias("length"), seq.cast("long").alias("sequence_id"), off.cast("long").alias("offset"))
    window = piece(F.col("j") * WINDOW, F.lit(WINDOW), F.col("full_off") + F.col("full0") + F.col("j"), F.lit(0))
    whole = placed.filter("full > 0").select("uid", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") - 1)).alias("j"), "full_off", "full0").select("uid", window.alias("p"))
    combined = (
        placed.filter("rem > 0 AND rank < taken").join(F.broadcast(table), "bin").filter("rank >= r_from AND rank < r_to")
        .select("uid", "full", "rem", "slot", (F.col("seq0") + F.col("rank") - F.col("r_from")).alias("seq"))
        .withColumn("off", F.coalesce(F.sum("rem").over(Window.partitionBy("seq").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select("uid", piece(F.col("full") * WINDOW, F.col("rem"), F.lit(fulls) + F.col("seq"), F.col("off")).alias("p"))
    )
    # The rest lies on one line of tokens, cut at every window's end.
    rest = placed.filter("rem > 0 AND rank >= taken").select("uid", "full", "rem", "bin", "sub", "rem0")
    spans = rest.groupBy("bin", "sub").agg(F.sum("rem").alias("tokens"), F.min("rem0").alias("first"))
    spans = pin(spans.withColumn("line", F.coalesce(F.sum("tokens").over(everywhere), F.lit(0))), "packing-rest")
    at = rest.join(F.broadcast(spans.drop("tokens")), ["bin", "sub"]).withColumn("at", F.col("line") + F.col("rem0") - F.col("first"))
    head = F.least(F.col("rem"), F.lit(WINDOW) - F.col("at") % WINDOW)
    seq = F.lit(lines) + F.expr(f"at div {WINDOW}")
    greedy = at.withColumn("head", head).select(
        "uid",
        F.explode(
            F.filter(
                F.array(
                    piece(F.col("full") * WINDOW, F.col("head"), seq, F.col("at") % WINDOW),
                    piece(F.col("full") * WINDOW + F.col("head"), F.col("rem") - F.col("head"), seq + 1, F.lit(0)),
                ),
                lambda p: p["length"] > 0,
            )
        ).alias("p"),
    )
    return whole.unionByName(combined).unionByName(greedy).groupBy("uid").agg(F.sort_array(F.collect_list("p")).alias("pieces"))


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: (key, start, length, doc_tokens, sequence_id, offset,
    ids binary), ids as little-endian unsigned 32-bit numbers."""
    read = docs.select(F.col(key), F.monotonically_increasing_id().alias("uid"), F.col(text))
    tokens = pin(tokenize(read, tokenizer, end_id, text), "packing-tokens", "zstd")
    placed = tokens.join(layout(tokens.select("uid", "n")), "uid").select(key, "n", "ids", "pieces")
    schema = T.StructType([docs.schema[key]] + [T.StructField(c, T.LongType()) for c in ("start", "length", "doc_tokens", "sequence_id", "offset")] + [T.StructField("ids", T.BinaryType())])

    def run(batches):
        for b in batches:
            lists = b.column(3)
            rows = lists.flatten()
            owner = np.repeat(np.arange(b.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            start, length, seq, off = (rows.field(i).to_numpy(zero_copy_only=False) for i in range(4))
            ids = [np.frombuffer(x.as_buffer(), "<u2") for x in b.column(2)]
            cut = [ids[o][s : s + n].astype("<u4").tobytes() for o, s, n in zip(owner.tolist(), start.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(owner)), pa.array(start), pa.array(length), b.column(1).take(pa.array(owner)), pa.array(seq), pa.array(off), pa.array(cut, pa.binary())], names=schema.names
            )

    return placed.mapInArrow(run, schema)
