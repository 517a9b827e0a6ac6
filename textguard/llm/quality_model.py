"""Quality classifier: histogram gradient-boosted trees over document statistics.

``statistics`` turns a text into a fixed vector of ratios (characters, words,
lines, repetition). Trees are grown level by level on binned statistics with
logistic loss: per node a histogram of gradients, the best cut by gain. A
fitted forest is three flat arrays (feature, threshold, value), every tree a
complete binary tree, so scoring walks all trees of all rows level by level
with numpy indexing and no per-row code.

Scale: the model is fitted on a bounded sample of labelled rows (``sample``
rows, those with the smallest hash of their id, at most a few MB on the
driver); its ids are broadcast to find their texts. Every row is scored in one
pass over the table with no shuffle.

Defined results: null and empty texts have all statistics zero and get the
score that the trees give those; a label row repeated for one id counts by its
mean; without labelled rows, or with one class only, every score is the share
of label 1 (0.5 without any); extra columns pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textguard.llm.common import crc_of

#: Names of the statistics, in the order of the vector.
STATISTICS = (
    "log_words", "word_length", "long_words", "distinct_words", "repeated_pairs", "lower", "upper", "digit", "space", "symbol",
    "other_punct", "pipe", "exclaim", "upper_words", "marked_words", "lines", "line_words", "repeated_lines", "top_word", "char_entropy",
)
_KIND = np.zeros(256, np.int64)
for _i, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\r\x0b\x0c", b"#*$%&<>~^_=+\\@", b".,;:'\"()[]{}?/-`", b"|", b"!"), 1):
    _KIND[list(_chars)] = _i


def statistics(data: bytes) -> list[float]:
    """The vector of one UTF-8 text (see STATISTICS); zeros if it has no word."""
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    raw = np.frombuffer(data, np.uint8)
    bytes_ = np.bincount(raw, minlength=256)
    kind = np.bincount(_KIND, bytes_, 9) / len(raw)
    share = bytes_[bytes_ > 0] / len(raw)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.frombuffer(b"".join([w[-1:] for w in words]), np.uint8)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = [x for x in data.split(b"\n") if x.strip()]
    upper = sum(map(bytes.isupper, words))
    marked = int(((_KIND[ends] == 5) | (_KIND[ends] == 8)).sum())
    return [
        float(np.log1p(n)), float(lengths.mean()), float((lengths > 12).mean()), len(seen) / n, 1 - len(set(zip(words, words[1:]))) / max(1, n - 1),
        *(kind[1:9].tolist()), upper / n, marked / n, len(lines) / n, n / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
        max(seen.values()) / n, float(-(share * np.log2(share)).sum()),
    ]


@dataclass
class Forest:
    """``trees`` complete binary trees of ``depth`` levels as flat arrays."""

    depth: int
    feature: np.ndarray  # (trees, 2^depth - 1)
    threshold: np.ndarray  # same; a row goes right if its value is larger
    value: np.ndarray  # (trees, 2^depth)
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every row of ``x``."""
        rows, tree = np.arange(len(x))[:, None], np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[rows, self.feature[tree, node]] > self.threshold[tree, node])
        margin = self.base + self.value[tree, node - (2**self.depth - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, l2: float = 1.0, least: float = 5.0) -> Forest:
    """Boost ``trees`` trees on logistic loss; ``least``: hessian a leaf needs."""
    inner, leaves = 2**depth - 1, 2**depth
    p = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
    base = float(np.log(p / (1 - p)))
    if len(y) == 0 or y.min() == y.max():
        return Forest(depth, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), base)
    width = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    code = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)  # value <= cuts[code]
    flat = code + np.arange(width) * bins
    margin = np.full(len(y), base)
    feature, threshold, value = (np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)))
    for t in range(trees):
        prob = 1 / (1 + np.exp(-margin))
        g, h = prob - y, prob * (1 - prob)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            at = ((node - first) * (width * bins))[:, None] + flat
            shape = (count, width, bins)
            gs, hs = (np.bincount(at.ravel(), np.repeat(v, width), count * width * bins).reshape(shape).cumsum(axis=2) for v in (g, h))
            gt, ht = gs[:, :1, -1:], hs[:, :1, -1:]
            gain = gs**2 / (hs + l2) + (gt - gs) ** 2 / (ht - hs + l2) - gt**2 / (ht + l2)
            gain[(hs < least) | (ht - hs < least)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            for i, b in enumerate(best.tolist()):
                f, c = divmod(b, bins)
                if gain[i, f, c] > 1e-9 and c < len(cuts[f]):
                    feature[t, first + i], threshold[t, first + i] = f, cuts[f][c]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > threshold[t, node])
        leaf = node - inner
        value[t] = -rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + l2)
        margin += value[t, leaf]
    return Forest(depth, feature, threshold, value, base)


def _vectors(column: pa.Array) -> np.ndarray:
    """Statistics of a batch of texts, a row each."""
    texts = column.cast(pa.binary())
    out = [statistics(t.as_buffer().to_pybytes()) if t.is_valid else [0.0] * len(STATISTICS) for t in texts]
    return np.array(out, float).reshape(-1, len(STATISTICS))


def held_out(key: str, parts: int = 3, part: int = 1):
    """Rows whose labels are never learnt: crc32(key as text) mod parts = part."""
    return F.coalesce(crc_of(F.col(key)) % parts == part, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = 20_000, key: str = "doc_id", text: str = "text") -> Forest:
    """Fit on at most ``sample`` labelled rows that are not held out."""
    known = labels.filter(~held_out(key) & F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg((F.avg(label) >= 0.5).cast("double").alias("y"))
    some = known.orderBy(F.xxhash64(F.lit("sample"), F.col(key)), key).limit(sample).select(F.col(key).alias("_id"), "y")
    width = len(STATISTICS)

    def run(batches):
        for b in batches:
            x = _vectors(b.column(0))
            yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), width).cast(pa.list_(pa.float64())), b.column(1), b.column(2)], names=["x", "y", "_id"])

    # The sample is bounded by its parameter, so its ids can be sent to every task.
    texts = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(some), "_id").select("_text", "y", "_id")
    rows = texts.mapInArrow(run, T.StructType([T.StructField("x", T.ArrayType(T.DoubleType())), T.StructField("y", T.DoubleType()), T.StructField("_id", docs.schema[key].dataType)]))
    got = rows.orderBy(F.xxhash64("_id"), "_id", "x").limit(sample).toArrow()  # repeated documents can't pass the bound
    if got.num_rows == 0:
        return fit(np.zeros((0, width)), np.zeros(0))
    x = got.column("x").combine_chunks().flatten().to_numpy().reshape(-1, width)
    return fit(x, got.column("y").to_numpy())


def score(docs: DataFrame, forest: Forest, text: str = "text", out: str = "score", keep=None) -> DataFrame:
    """``keep`` columns of ``docs`` (all by default) and the score, in one pass."""
    keep = list(docs.columns if keep is None else keep)
    read = docs.select(*(F.col(c) for c in keep), *([] if text in keep else [text]))
    schema = T.StructType([read.schema[c] for c in keep] + [T.StructField(out, T.DoubleType())])

    def run(batches):
        for b in batches:
            s = forest.score(_vectors(b.column(b.schema.get_field_index(text))))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(s)], names=[*keep, out])

    return read.mapInArrow(run, schema)
