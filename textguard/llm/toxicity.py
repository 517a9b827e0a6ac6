"""Toxicity: class-conditional Kneser-Ney models over letters.

Texts are lower-cased, everything but letters becomes one space, and the UTF-8
bytes are the symbols, so compounds and spellings never seen as words still
share their parts with those that were. Two interpolated Kneser-Ney models, one
of toxic and one of ordinary documents, give the probability of a symbol after
the ORDER - 1 before it: with a class's counts n of a symbol after a context,
their sum N and the number K of symbols over the context,

    P(symbol | context) = max(n - d, 0) / N + d * K / N * P(symbol | context without its first symbol)

where the longest contexts count occurrences, the shorter ones Kneser-Ney's
continuations (in how many longer contexts of the class), a class that never saw a
context gives P of the shorter one alone, and under the empty context lie the
continuation counts of both classes together. So rare expressions are smoothed
through shared counts, and what neither class has seen weighs as the contexts do
that were: their backoff weights d * K / N.

A document has two values, both normalised by length: ``mean``, the mean
difference of the two models' log-likelihoods over its symbols, and ``peak``,
the largest such mean over SPAN successive ones, for a short expression in a
long document. A logistic curve in both, fitted on the histogram of the labelled
documents' values, gives the score; a labelled document's values for the fit come
from models that were not learnt from its half of the rows.

Scale: counts cover all labelled rows that are not held out; a task sends each
n-gram once, summed. The models are computed by joins and windows on the tables
of n-grams, whose contexts have at most 256 members. Only differences are kept: of
the n-grams of every order, and of the contexts' weights, which add up on the way
down to an n-gram that was seen. A table
of at most ``most_rows`` rows (20 bytes each) is broadcast, and scoring is one
pass over the texts; a larger one is joined with packs of texts (``packs``). Both
ways give the same values. A very long text is read in slices.

Defined results: null and letterless texts have values 0; a label row repeated
for one id counts by its mean; with no labels of one class every score is the
share of toxic labels (0.5 without any); repeated rows are scored each; ties at
0.5 count as toxic; an empty table gives no rows; extra columns pass through, and
one called like the result, ``out``, is replaced by it.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from textguard.llm.common import crc_of, fields, pin
from textguard.llm.packs import looked_up, runs, text_sizes

ORDER, SPAN, DISCOUNT, SHARED_DISCOUNT = 5, 8, 0.75, 0.75
#: Symbols that are turned into n-grams at a time.
SLICE = 1 << 20
#: A one bit before the symbols tells lengths apart; with this bit a context is meant.
CONTEXT = 1 << 8 * (ORDER + 1)
#: Values are counted in steps of 1 / STEPS to fit the curve, means and peaks within BOUNDS.
STEPS, BOUNDS = (200, 50), ((-2.0, 2.0), (-4.0, 8.0))
_OTHER = re.compile(r"[\W\d_]+")


def symbols(text: str) -> np.ndarray:
    """Letters of ``text`` in lower case, single spaces for all else, as bytes."""
    return np.frombuffer(f" {_OTHER.sub(' ', text.lower())} ".replace("  ", " ").encode(), np.uint8)


def grams(raw: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The n-gram that ends at each symbol, its bytes packed into an int64."""
    out = np.zeros(max(0, len(raw) - order + 1), np.int64)
    for j in range(order):
        out = (out << 8) | raw[j : j + len(out)]
    return out


def held_out(key: str, parts: int = 5, part: int = 0):
    """Rows whose labels are never learnt: crc32(key as text) mod parts = part."""
    return F.coalesce(crc_of(F.col(key)) % parts == part, F.lit(False))


def half_of(key: str):
    """The half, 0 or 1, that a document's counts belong to."""
    return F.coalesce(F.pmod(F.floor(crc_of(F.col(key)) / 5), F.lit(2)), F.lit(0)).cast("long")


def count(train: DataFrame) -> DataFrame:
    """(gram, n00, n01, n10, n11): occurrences by half and class in the texts of
    the rows (text, half * 2 + class)."""
    names = ("n00", "n01", "n10", "n11")
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("gram", *names)])

    def summed(waiting):
        keys, at = np.unique(np.concatenate([g for g, _ in waiting]), return_inverse=True)
        part = np.concatenate([np.full(len(g), y) for g, y in waiting])
        return [pa.array(keys), *(pa.array(np.bincount(at, part == y, len(keys)).astype(np.int64)) for y in range(4))]

    def run(batches):
        waiting, size = [], 0
        for b in batches:
            for text, y in zip(b.column(0), b.column(1).to_pylist()):
                raw = symbols(text.as_py() or "")
                for i in range(0, max(1, len(raw) - ORDER + 1), SLICE):
                    waiting.append((grams(raw[i : i + SLICE + ORDER - 1]), y))
                    size += len(waiting[-1][0])
                    if size >= 4 * SLICE:
                        yield pa.RecordBatch.from_arrays(summed(waiting), names=schema.names)
                        waiting, size = [], 0
        if waiting:
            yield pa.RecordBatch.from_arrays(summed(waiting), names=schema.names)

    return train.mapInArrow(run, schema).groupBy("gram").agg(*(F.sum(n).alias(n) for n in names))


def node(packed, length: int):
    """The key of the last ``length`` symbols."""
    return (packed & ((1 << 8 * length) - 1)) | (1 << 8 * length)


def differences(counts: DataFrame) -> DataFrame:
    """(key, all, without0, without1): of every n-gram of any order log P of the
    toxic model less that of the ordinary one, and of every context, by the bit
    CONTEXT, log of their backoff weights; by the models of all rows and by those
    without each half. ``counts`` (pinned): the n-grams of order ORDER."""
    models = {"all": (0, 1), "without0": (1,), "without1": (0,)}
    sides = [f"{m}_{y}" for m in models for y in (0, 1)]
    suffix = lambda o: F.col("gram").bitwiseAND(F.lit((1 << 8 * o) - 1))
    levels = {ORDER: counts.select("gram", *(sum(F.col(f"n{h}{y}") for h in halves).alias(f"{m}_{y}") for m, halves in models.items() for y in (0, 1)))}
    for o in range(ORDER - 1, 0, -1):  # of how many longer n-grams of the class is this the end?
        shorter = levels[o + 1].groupBy(suffix(o).alias("gram")).agg(*(F.sum((F.col(c) > 0).cast("long")).alias(c) for c in sides), F.count(F.lit(1)).alias("kinds"))
        levels[o] = pin(shorter, "toxicity-orders")
    context = Window.partitionBy(F.shiftright("gram", 8))  # 256 symbols at most

    def weight(c: str):
        """What the discount took from the context's counts: the share of the shorter context."""
        return F.when(F.col(f"n_{c}") > 0, DISCOUNT * F.col(f"k_{c}") / F.col(f"n_{c}")).otherwise(F.lit(1.0))

    def p(c: str):
        own = F.when(F.col(f"n_{c}") > 0, F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / F.col(f"n_{c}")).otherwise(F.lit(0.0))
        return own + weight(c) * F.col(f"low_{c}")

    rows, below = [], None
    for o in range(1, ORDER + 1):
        t = levels[o]
        if below is None:  # the continuation counts of both classes, over all symbols there are
            total, symbols_ = F.sum("kinds").over(context), F.count(F.lit(1)).over(context)
            low = (F.greatest(F.col("kinds") - SHARED_DISCOUNT, F.lit(0.0)) + SHARED_DISCOUNT * symbols_ / 256) / total
            t = t.select("gram", *sides, *(low.alias(f"low_{c}") for c in sides))
        else:
            t = t.select("gram", *sides, suffix(o - 1).alias("end")).join(below.select(F.col("gram").alias("end"), *(F.col(f"p_{c}").alias(f"low_{c}") for c in sides)), "end")
        t = t.select("*", *(F.sum(c).over(context).alias(f"n_{c}") for c in sides), *(F.sum((F.col(c) > 0).cast("long")).over(context).alias(f"k_{c}") for c in sides))
        t = pin(t.select("gram", *(p(c).alias(f"p_{c}") for c in sides), *(weight(c).alias(f"w_{c}") for c in sides)), "toxicity-model")
        log = lambda kind, m: F.log(F.col(f"{kind}_{m}_1") / F.col(f"{kind}_{m}_0"))
        rows.append(t.select(F.col("gram").bitwiseOR(F.lit(1 << 8 * o)).alias("key"), *(log("p", m).alias(m) for m in models)))
        key = F.shiftright("gram", 8).bitwiseOR(F.lit(CONTEXT | 1 << 8 * (o - 1)))
        rows.append(t.groupBy(key.alias("key")).agg(*(F.first(log("w", m)).alias(m) for m in models)))
        below = t
    every = rows[0]
    for r in rows[1:]:
        every = every.unionByName(r)
    return every


def looked(gram: np.ndarray, keys: np.ndarray, *models: np.ndarray) -> list[np.ndarray]:
    """Differences of n-grams: of the longest end that was seen, and of the
    weights of the contexts on the way down to it."""
    out = [np.zeros(len(gram)) for _ in models]
    todo = np.arange(len(gram)) if len(keys) else np.zeros(0, np.int64)

    def add(places, key):
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        known = keys[at] == key
        for o, m in zip(out, models):
            o[places[known]] += m[at[known]]
        return known

    for length in range(ORDER, 0, -1):
        if not len(todo):
            break
        todo = todo[~add(todo, node(gram[todo], length))]
        add(todo, node(gram[todo] >> 8, length - 1) | CONTEXT)
    return out


def values(texts: list[np.ndarray], keys: np.ndarray, *models: np.ndarray) -> np.ndarray:
    """(texts, models, 2): mean and peak of every text under every model.

    Equal n-grams of the texts are looked up once for each slice."""
    out = np.zeros((len(texts), len(models), 2))
    sums, peaks = np.zeros((len(texts), len(models))), np.full((len(texts), len(models)), -np.inf)
    waiting: list[tuple[int, np.ndarray, int, bool]] = []
    size = 0

    def take():
        nonlocal waiting, size
        if not waiting:
            return
        gram, place = np.unique(np.concatenate([g for _, g, _, _ in waiting]), return_inverse=True)
        for m, diff in enumerate(looked(gram, keys, *models)):
            line, at = diff[place], 0
            for doc, g, own, windows in waiting:
                v = line[at : at + len(g)]
                at += len(g)
                sums[doc, m] += v[:own].sum()
                if not windows:
                    continue
                run, span = np.concatenate(([0.0], np.cumsum(v))), min(SPAN, len(v))
                peaks[doc, m] = max(peaks[doc, m], float((run[span:] - run[: len(run) - span]).max()) / span)
        waiting, size = [], 0

    for doc, raw in enumerate(texts):
        n = len(raw) - ORDER + 1
        for i in range(0, max(n, 0), SLICE):
            # A slice's windows reach into the next one; what is shorter than a window at the end has none of its own.
            g = grams(raw[i : i + SLICE + SPAN - 1 + ORDER - 1])
            waiting.append((doc, g, min(SLICE, len(g)), i == 0 or n - i >= SPAN))
            size += len(g)
            if size >= SLICE:
                take()
    take()
    for doc, raw in enumerate(texts):
        if len(raw) >= ORDER:
            out[doc, :, 0], out[doc, :, 1] = sums[doc] / (len(raw) - ORDER + 1), peaks[doc]
    return out


def wanted(texts) -> np.ndarray:
    """Keys that the values of the texts can ask for."""
    gram = np.unique(np.concatenate([np.zeros(0, np.int64), *(grams(symbols(t or "")) for t in texts.to_pylist())]))
    asked = [np.unique(k) for o in range(1, ORDER + 1) for k in (node(gram, o), node(gram >> 8, o - 1) | CONTEXT)]
    return np.concatenate(asked) if len(gram) else gram


def curve(histogram: list[tuple[float, float, int, int]]) -> tuple[float, float, float]:
    """(weight of mean, weight of peak, constant) of the logistic curve of (mean,
    peak, ordinary, toxic) counts. With one class only: weights 0, its share."""
    x, z, n0, n1 = (np.array(v, float) for v in zip(*histogram)) if histogram else (np.zeros(0),) * 4
    total = n0.sum() + n1.sum()
    if n0.sum() == 0 or n1.sum() == 0:
        share = float(n1.sum() / total) if total else 0.5
        return 0.0, 0.0, float(np.log(max(share, 1e-12) / max(1 - share, 1e-12)))
    f, w0, w1 = np.stack([x, z], axis=1), n0 / total, n1 / total
    middle, scale = np.average(f, axis=0, weights=w0 + w1), np.sqrt(np.average((f - np.average(f, axis=0, weights=w0 + w1)) ** 2, axis=0, weights=w0 + w1)) + 1e-9
    f = np.concatenate([(f - middle) / scale, np.ones((len(x), 1))], axis=1)
    b, ridge = np.zeros(3), np.diag([1e-5, 1e-5, 1e-9])  # a small penalty for classes that don't overlap
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(f @ b, -40, 40)))
        step = np.linalg.solve((f * (p * (1 - p) * (w0 + w1))[:, None]).T @ f + ridge, f.T @ (p * w0 - (1 - p) * w1) + ridge @ b)
        b -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    mean, peak = b[:2] / scale
    return float(mean), float(peak), float(b[2] - mean * middle[0] - peak * middle[1])


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text", out: str = "score", keep=None, most_rows: int = 4 << 20) -> DataFrame:
    """``keep`` columns of ``docs`` (all by default) and the score, learnt from
    the labelled rows that are not held out. Of more than ``most_rows`` rows of
    differences none is broadcast; they are joined."""
    spark = docs.sparkSession
    keep = list(docs.columns if keep is None else keep)
    known = labels.filter(F.col(label).isNotNull() & ~held_out(key)).groupBy(F.col(key).alias("id")).agg((F.avg(label) >= 0.5).cast("long").alias("y"))
    train = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).filter(~held_out("id") & F.col("text").isNotNull())
    # The same plan at every size: labels grow with the texts, so they are never broadcast.
    counts = pin(count(train.join(known.hint("merge"), "id").select("text", (half_of("id") * 2 + F.col("y")).alias("y"))), "toxicity-counts")
    model = pin(differences(counts), "toxicity-model")
    row = F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(keep)), F.lit(None).cast("int").alias("none"))
    read = docs.select(row.alias("row"), F.col(key).alias("id"), F.col(text).alias("text"), half_of(key).alias("half"))
    found = fields(mean="double", peak="double", unseen_mean="double", unseen_peak="double")
    schema = T.StructType([read.schema["row"], read.schema["id"], *found.fields])

    def valued(b, keys, all_, *without):
        """The columns of a batch or table with the values of its texts."""
        halves, texts = np.array(b.column("half").to_pylist(), int), b.column("text")
        got = np.zeros((len(texts), 2, 2))
        for i, j in runs(text_sizes(texts)):
            raws = [symbols(t or "") for t in texts.slice(i, j - i).to_pylist()]
            got[i:j, 0] = values(raws, keys, all_)[:, 0]
            for h in (0, 1):  # a row's values for the fit: by the models without its half
                of = np.flatnonzero(halves[i:j] == h)
                got[i + of, 1] = values([raws[k] for k in of], keys, without[h])[:, 0]
        return [b.column("row"), b.column("id"), *(pa.array(got[:, m, k]) for m in (0, 1) for k in (0, 1))]

    names = ("key", "all", "without0", "without1")
    sorted_ = lambda t: [t.column(c).to_numpy()[np.argsort(t.column("key").to_numpy())] for c in names]
    if model.count() <= most_rows:
        sent = spark.sparkContext.broadcast(sorted_(model.select(*names).toArrow()))

        def run(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays(valued(b, *sent.value), names=schema.names)

        scored = read.mapInArrow(run, schema)
    else:
        scored = looked_up(read, model.select(*names), "text", wanted, lambda rows, known: pa.Table.from_arrays(valued(rows, *sorted_(known)), names=schema.names), schema, "toxicity")
    valued_rows = pin(scored, "toxicity-values")
    bound = lambda c, i: F.round(F.greatest(F.least(F.col(c), F.lit(BOUNDS[i][1])), F.lit(BOUNDS[i][0])) * STEPS[i]).cast("long")
    bins = valued_rows.join(known, "id").groupBy(bound("unseen_mean", 0).alias("mean"), bound("unseen_peak", 1).alias("peak")).agg(F.count_if(F.col("y") == 0).alias("n0"), F.count_if(F.col("y") == 1).alias("n1"))
    # The steps within the bounds limit the bins.
    mean, peak, constant = curve([(r["mean"] / STEPS[0], r["peak"] / STEPS[1], r["n0"], r["n1"]) for r in bins.collect()])
    odds = F.lit(mean) * F.col("mean") + F.lit(peak) * F.col("peak") + F.lit(constant)
    return valued_rows.select(*(F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(keep) if c.lower() != out.lower()), (1 / (1 + F.exp(-odds))).alias(out))
