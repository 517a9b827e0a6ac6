"""Language identification by prediction by partial matching (PPM).

Texts are lower-cased, everything but letters becomes one space, and the UTF-8
bytes are the symbols. Of every language a context tree is counted: for each
context of up to ORDER bytes, how often each symbol followed. A symbol's code
length under a language is exact PPM (escape method C, full exclusion): from
the longest context that was seen, a symbol counted n times there costs
log2((T + D) / n), T being the context's symbols and D its distinct ones; a
symbol not seen there costs an escape, log2((T + D) / D), and is looked for in
the context one byte shorter, without the symbols that the longer one had; past
the empty context all symbols not seen are alike. The statistics are frozen:
a text is scored as it stands and teaches nothing.

A text's language is the one with the shortest code (ties: the smaller name),
its score that language's share of the probability, 2 ** -bits, among all.

Scale: counts cover all rows that are not held out; a task sends each n-gram of
a language once, summed. Exclusion needs only sums over a context's own
symbols, so the tree's logarithms come from joins and groupings of the table of
n-grams. Texts are scored in slices: the distinct n-grams of a slice are coded
once, and summed by text. A tree of at most ``most_nodes`` rows (NODE_BYTES
each) is broadcast, and scoring is one pass over the texts; a larger one stays a
table that packs of texts are joined with (``packs``), with the same results.

Defined results: null and letterless texts are ``und`` with score 0, and so is
every text if nothing can be learnt; rows with a null language teach nothing; a
null id is never held out; repeated rows count each; extra columns pass
through, one called like a result gets underscores before its name. Languages
are collected to the driver: they are classes, bounded in number.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textguard.llm.common import crc_of, fields, pin
from textguard.llm.packs import looked_up, runs, text_sizes

ORDER = 4
#: Rows of the tree that may be sent to the tasks, and bytes of one.
MOST_NODES, NODE_BYTES = 2 << 20, 52
#: N-grams that are coded at a time.
GRAMS = 1 << 20
UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")
#: Of a node: as a symbol after its context; as a context the denominator and the
#: escape, read first or after an escape from it into the context one shorter.
LOGS = ("symbol", "whole", "escape", "rest", "rest_escape")


def symbols(text: str | None) -> np.ndarray:
    """ORDER spaces, then the letters of ``text`` in lower case with a space
    after every word, as bytes. No letters: nothing."""
    words = _OTHER.sub(" ", (text or "").lower()).strip()
    return np.frombuffer(f"{' ' * ORDER}{words} ".encode(), np.uint8) if words else np.zeros(0, np.uint8)


def grams(raw: np.ndarray) -> np.ndarray:
    """Every symbol after the first ORDER bytes with its context, packed into an int64."""
    out = np.zeros(max(0, len(raw) - ORDER), np.int64)
    for j in range(ORDER + 1):
        out = (out << 8) | raw[j : j + len(out)]
    return out


def node(packed, length: int):
    """The key of the last ``length`` bytes: a one before them tells lengths apart."""
    return (packed & ((1 << 8 * length) - 1)) | (1 << 8 * length)


def held_out(key: str, parts: int = 5, part: int = 0):
    """Rows that are never learnt from: crc32(key as text) mod parts = part."""
    return F.coalesce(crc_of(F.col(key)) % parts == part, F.lit(False))


# --------------------------------------------------------------------------- the trees
def count(train: DataFrame) -> DataFrame:
    """(lang, gram, n) of the rows (lang, text)."""

    def summed(lang, waiting):
        gram, n = np.unique(np.concatenate(waiting), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n)], names=["lang", "gram", "n"])

    def run(batches):
        waiting: dict[str, list] = {}
        size = 0
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                raw = symbols(text.as_py())
                for i in range(0, max(0, len(raw) - ORDER), GRAMS):
                    waiting.setdefault(lang, []).append(grams(raw[i : i + GRAMS + ORDER]))
                    size += len(waiting[lang][-1])
                    if size >= 2 * GRAMS:  # of all languages together
                        yield from (summed(*one) for one in waiting.items())
                        waiting, size = {}, 0
        yield from (summed(*one) for one in waiting.items())

    return train.mapInArrow(run, fields(lang="string", gram="long", n="long")).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def trees(counts: DataFrame) -> DataFrame:
    """(lang, key, *LOGS), one row for every node of a language's tree, pinned.

    ``counts`` are the n-grams of the longest contexts, pinned."""
    last = lambda o: F.col("gram").bitwiseAND(F.lit((1 << 8 * o) - 1))
    level, contexts, parts = {ORDER: counts}, {}, []
    for o in range(ORDER - 1, -1, -1):
        level[o] = pin(level[o + 1].groupBy("lang", last(o + 1).alias("gram")).agg(F.sum("n").alias("n")), "ppm-counts")
    nothing = {name: F.lit(None).cast("double") for name in LOGS}
    row = lambda length, **logs: [F.col("gram").bitwiseOR(F.lit(1 << 8 * length)).alias("key"), *((nothing | logs)[n].alias(n) for n in LOGS)]
    for o in range(ORDER + 1):
        parts.append(level[o].select("lang", *row(o + 1, symbol=F.log2(F.col("n").cast("double")))))
        follow = level[o].select("lang", F.shiftright("gram", 8).alias("gram"), "n")
        own = [F.sum("n").alias("t"), F.count(F.lit(1)).alias("d")]
        if o:  # what the context one shorter counted of this context's symbols
            short = level[o - 1].select("lang", F.col("gram").alias("end"), F.col("n").alias("m"))
            follow = level[o].select("lang", "gram", "n", last(o).alias("end")).join(short, ["lang", "end"]).select("lang", F.shiftright("gram", 8).alias("gram"), "n", "m")
            own.append(F.sum("m").alias("e"))
        contexts[o] = pin(follow.groupBy("lang", "gram").agg(*own), "ppm-contexts")
        whole = (F.col("t") + F.col("d")).cast("double")
        logs = {"whole": F.log2(whole), "escape": F.log2(whole / F.col("d"))}
        at = contexts[o]
        if o:
            shorter = contexts[o - 1].select("lang", F.col("gram").alias("end"), F.col("t").alias("st"), F.col("d").alias("sd"))
            at = at.withColumn("end", last(o - 1)).join(shorter, ["lang", "end"])
            fresh_ = F.col("sd") - F.col("d")  # symbols that the shorter context adds
            rest = (F.col("st") - F.col("e") + fresh_).cast("double")
            logs |= {"rest": F.when(fresh_ > 0, F.log2(rest)), "rest_escape": F.when(fresh_ > 0, F.log2(rest / fresh_)).otherwise(F.lit(0.0))}
        else:
            # Past the empty context: the symbols never seen are alike.
            logs["rest"] = F.when(F.col("d") < 256, F.log2((256 - F.col("d")).cast("double"))).otherwise(F.lit(0.0))
        parts.append(at.select("lang", *row(o, **logs)))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return pin(every.groupBy("lang", "key").agg(*(F.max(n).alias(n) for n in LOGS)), "ppm-trees")


@dataclass
class Trees:
    """Rows of the trees as arrays: logarithms by node and language, NaN for none."""

    keys: np.ndarray  # (nodes,), sorted
    logs: dict[str, np.ndarray]  # (nodes + 1, languages); the last node is none

    @staticmethod
    def of(lang: np.ndarray, key: np.ndarray, logs: dict[str, np.ndarray], languages: int) -> "Trees":
        keys, at = np.unique(key, return_inverse=True)
        out = {}
        for name, values in logs.items():
            out[name] = np.full((len(keys) + 1, languages), np.nan)
            out[name][at, lang] = values
        return Trees(keys, out)

    def at(self, key: np.ndarray) -> np.ndarray:
        """Numbers of the nodes; the last one for a key that is not there."""
        if not len(self.keys):
            return np.zeros(len(key), np.int64)
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[i] == key, i, len(self.keys))

    def code(self, gram: np.ndarray) -> np.ndarray:
        """(n-grams, languages): bits of the last symbol after its context."""
        logs = self.logs
        bits = np.zeros((len(gram), logs["symbol"].shape[1]))
        open_ = np.ones(bits.shape, bool)
        whole, escape = np.full(bits.shape, np.nan), np.full(bits.shape, np.nan)  # of the context escaped from
        for o in range(ORDER, -1, -1):
            context, symbol = self.at(node(gram >> 8, o)), logs["symbol"][self.at(node(gram, o + 1))]
            seen = open_ & ~np.isnan(logs["whole"][context])
            first = np.isnan(escape)  # nothing longer was seen: nothing is excluded
            found = seen & ~np.isnan(symbol)
            bits += np.where(found, np.where(first, logs["whole"][context], whole) - symbol, 0)
            missed = seen & ~found
            bits += np.where(missed, np.where(first, logs["escape"][context], escape), 0)
            whole = np.where(missed, logs["rest"][context], whole)
            escape = np.where(missed, np.nan_to_num(logs["rest_escape"][context]), escape)
            open_ &= ~found
        return bits + np.where(open_, whole, 0)  # past the empty context

    def bits(self, texts: list[np.ndarray]) -> np.ndarray:
        """(texts, languages): code lengths of whole texts."""
        out = np.zeros((len(texts), self.logs["symbol"].shape[1]))
        waiting: list[tuple[int, np.ndarray]] = []
        size = 0
        for doc, raw in enumerate(texts):
            for i in range(0, max(0, len(raw) - ORDER), GRAMS):
                waiting.append((doc, grams(raw[i : i + GRAMS + ORDER])))
                size += len(waiting[-1][1])
                if size >= GRAMS:
                    self._add(out, waiting)
                    waiting, size = [], 0
        self._add(out, waiting)
        return out

    def _add(self, out: np.ndarray, waiting: list[tuple[int, np.ndarray]]) -> None:
        if not waiting:
            return
        gram, place = np.unique(np.concatenate([g for _, g in waiting]), return_inverse=True)
        starts = np.cumsum([0, *(len(g) for _, g in waiting[:-1])])
        docs = np.array([doc for doc, _ in waiting])
        for i, code in enumerate(self.code(gram).T):
            np.add.at(out[:, i], docs, np.add.reduceat(code[place], starts))


def wanted(texts) -> np.ndarray:
    """Keys of all nodes that coding the texts can ask for."""
    gram = np.unique(np.concatenate([np.zeros(0, np.int64), *(grams(symbols(t)) for t in texts.to_pylist())]))
    return np.unique(np.concatenate([node(gram >> s, o) for s, orders in ((0, range(1, ORDER + 2)), (8, range(ORDER + 1))) for o in orders])) if len(gram) else gram


# --------------------------------------------------------------------------- on Spark
def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", keep=None, most_nodes: int = MOST_NODES) -> DataFrame:
    """``keep`` columns of ``docs`` (all by default) and lang_pred, score and
    bits (the shortest code's length), learnt from rows that are not held out."""
    spark = docs.sparkSession
    keep = list(docs.columns if keep is None else keep)
    train = docs.filter(~held_out(key) & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    counts = pin(count(train), "ppm-grams")
    languages = [r[0] for r in counts.select("lang").distinct().orderBy("lang").collect()]  # bounded: classes
    tree = trees(counts)
    number = F.array_position(F.array(*(F.lit(x) for x in languages)), F.col("lang")).cast("int") - 1 if languages else F.lit(0)
    flat = tree.select(number.alias("lang"), "key", *LOGS)

    read = docs.select(F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(keep)), F.lit(0).alias("none")).alias("row"), F.col(text).alias("text"))
    schema = T.StructType([read.schema["row"], *fields(lang_pred="string", score="double", bits="double").fields])
    unpacked = lambda t: Trees.of(*(t.column(c).to_numpy() for c in ("lang", "key")), {n: t.column(n).to_numpy() for n in LOGS}, len(languages))

    def judged(rows, model: Trees):
        names, scores, lengths = [], [], []
        for i, j in runs(text_sizes(rows.column("text"))):
            texts = [symbols(t) for t in rows.column("text").slice(i, j - i).to_pylist()]
            for raw, bits in zip(texts, model.bits(texts) if languages else [()] * (j - i)):
                known = bool(languages) and len(raw) > 0
                names.append(languages[int(np.argmin(bits))] if known else UNKNOWN)
                lengths.append(float(bits.min()) if known else 0.0)
                scores.append(float(1 / np.exp2(bits.min() - bits).sum()) if known else 0.0)
        return [rows.column("row"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(lengths, pa.float64())]

    if tree.count() <= most_nodes:
        sent = spark.sparkContext.broadcast(vars(unpacked(flat.toArrow())))  # arrays only

        def run(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays(judged(b, Trees(**sent.value)), names=schema.names)

        done = read.mapInArrow(run, schema)
    else:
        done = looked_up(read, flat, "text", wanted, lambda rows, known: pa.Table.from_arrays(judged(rows, unpacked(known)), names=schema.names), schema, "ppm")
    taken, named = {"lang_pred", "score", "bits"}, []
    for i, c in enumerate(keep):
        while c.lower() in taken:
            c = f"_{c}"
        taken.add(c.lower())
        named.append(F.col("row")[f"c{i}"].alias(c))
    return done.select(*named, "lang_pred", "score", "bits")
