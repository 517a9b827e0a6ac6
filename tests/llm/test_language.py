"""Language identification against a symbol-by-symbol PPM with explicit exclusion sets."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from textguard.llm import language

from .conftest import TEXTS


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


class Brute:
    """One language's context tree, read as PPM reads it."""

    def __init__(self, texts):
        self.tree = defaultdict(Counter)
        for t in texts:
            raw = bytes(language.symbols(t))
            for i in range(language.ORDER, len(raw)):
                for o in range(language.ORDER + 1):
                    self.tree[raw[i - o : i]][raw[i]] += 1

    def bits(self, text):
        raw, total = bytes(language.symbols(text)), 0.0
        for i in range(language.ORDER, len(raw)):
            excluded = set()
            for o in range(language.ORDER, -1, -1):
                follow = {s: n for s, n in self.tree.get(raw[i - o : i], {}).items() if s not in excluded}
                if not follow:
                    continue
                whole = sum(follow.values()) + len(follow)
                if raw[i] in follow:
                    total += math.log2(whole / follow[raw[i]])
                    break
                total += math.log2(whole / len(follow))
                excluded |= set(follow)
            else:
                total += math.log2(256 - len(excluded))
        return total


def brute(rows):
    texts = defaultdict(list)
    for i, t, lang in rows:
        if lang is not None and t is not None and not held(i):
            texts[lang].append(t)
    trees = {lang: Brute(t) for lang, t in sorted(texts.items()) if any(len(language.symbols(x)) for x in t)}
    out = []
    for _, t, _ in rows:
        if not len(language.symbols(t)) or not trees:
            out.append(("und", 0.0, 0.0))
            continue
        bits = {lang: b.bits(t) for lang, b in trees.items()}
        best = min(bits, key=bits.get)
        out.append((best, 1 / sum(2 ** max(bits[best] - b, -1000) for b in bits.values()), bits[best]))
    return out


def corpus(n, seed=0):
    rng = random.Random(seed)
    words = {"xx": "alpha beta gamma delta zeta".split(), "yy": "alfa bêta gamma straße über".split(), "zz": "один два три 한국어 文字".split()}
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(words))
        rows.append((i, " ".join(rng.choice(words[lang]) for _ in range(rng.randrange(1, 12))) + rng.choice([".", " 12", "qx", ""]), lang if i % 9 else None))
    return rows


def results(df):
    got = df.select("n", "lang_pred", "score", "bits").orderBy("n").collect()
    return [(r["lang_pred"], r["score"], r["bits"]) for r in got]


def same(got, want):
    assert [g[0] for g in got] == [w[0] for w in want]
    for g, w in zip(got, want):
        assert g[1] == pytest.approx(w[1], rel=1e-6, abs=1e-9) and g[2] == pytest.approx(w[2], rel=1e-9, abs=1e-6)


@pytest.mark.parametrize("most_nodes", [language.MOST_NODES, 0])
def test_equals_brute_force(spark, most_nodes):
    rows = corpus(120) + [(500 + n, t if t is None or len(t) < 6000 else t[:6000], "xx" if n % 2 else "yy") for n, (_, t) in enumerate(TEXTS)]
    df = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "n long, doc_id long, text string, lang string").repartition(3)
    same(results(language.identify(df, most_nodes=most_nodes)), brute(rows))


def test_slices_change_nothing(monkeypatch):
    """N-grams coded a few at a time, on the task side."""
    import numpy as np

    logs = {n: np.random.default_rng(1).random(300) for n in language.LOGS}
    texts = [language.symbols(t) for _, t, _ in corpus(40, 3)] + [language.symbols("one very long word after another " * 400), language.symbols(None)]
    keys = np.unique(np.concatenate([language.node(language.grams(t), o) for t in texts for o in (0, 1, 2, 3, 5)]))[:300]
    trees = language.Trees.of(np.arange(len(keys)) % 2, keys, {n: v[: len(keys)] for n, v in logs.items()}, 2)
    whole = trees.bits(texts)
    monkeypatch.setattr(language, "GRAMS", 7)
    assert np.allclose(trees.bits(texts), whole, equal_nan=True)


def test_edges(spark, docs, empty):
    out = language.identify(docs)
    assert out.columns == [*("_score" if c == "score" else c for c in docs.columns), "lang_pred", "score", "bits"] and out.count() == len(TEXTS)
    none = out.filter("doc_id IN (2, 3, 4)").select("lang_pred", "score").collect()
    assert [tuple(r) for r in none] == [("und", 0.0)] * 3
    assert {r[0] for r in out.select("lang_pred").distinct().collect()} == {"en", "und"}
    assert language.identify(empty).count() == 0
    unlabelled = language.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {tuple(r) for r in unlabelled.select("lang_pred", "score").distinct().collect()} == {("und", 0.0)}
    clash = language.identify(docs.select("doc_id", "text", "lang", F.lit("x").alias("bits"), F.lit("x").alias("row")), keep=["bits", "row", "doc_id"])
    assert clash.columns == ["_bits", "row", "doc_id", "lang_pred", "score", "bits"] and clash.count() == len(TEXTS)


def test_held_out_accuracy(spark):
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.01"
    got = entry.queries()["op12_ppm_language"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    rows = got.join(docs, "doc_id").filter("held_out AND lang IS NOT NULL AND length(text) > 200").collect()
    assert len(rows) > 50 and sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 and r["held_out"] == held(r["doc_id"]) for r in got.collect())
