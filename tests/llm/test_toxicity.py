"""The Kneser-Ney models against one written out symbol by symbol; scores of both forms."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textguard.llm import packs, toxicity


def _corpus(n, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 6))) for _ in range(30)]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 15))) + (" zword" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(n)]


class Brute:
    """Interpolated Kneser-Ney of both classes, read off the texts."""

    def __init__(self, rows, halves):
        o = toxicity.ORDER
        every, self.counts = set(), [{o: collections.Counter()}, {o: collections.Counter()}]
        for half, text, y in rows:
            raw = bytes(toxicity.symbols(text))
            for i in range(len(raw) - o + 1):
                every.add(raw[i : i + o])
                self.counts[y][o][raw[i : i + o]] += half in halves
        for side in self.counts:
            for k in range(o - 1, 0, -1):
                side[k] = collections.Counter(g[1:] for g, n in side[k + 1].items() if n)
        pairs = {g[-2:] for g in every}
        self.base = collections.Counter(g[1:] for g in pairs)

    def _context(self, y, context):
        return {g: n for g, n in self.counts[y][len(context) + 1].items() if g[:-1] == context and n}

    def p(self, y, gram):
        if not gram:
            raise ValueError
        low = self.p(y, gram[1:]) if len(gram) > 1 else self.shared(gram)
        table, d = self._context(y, gram[:-1]), toxicity.DISCOUNT
        total = sum(table.values())
        return (max(table.get(gram, 0) - d, 0) + d * len(table) * low) / total if total else low

    def shared(self, gram):
        d = toxicity.SHARED_DISCOUNT
        return (max(self.base.get(gram, 0) - d, 0) + d * len(self.base) / 256) / sum(self.base.values())

    def weight(self, y, context):
        table = self._context(y, context)
        return toxicity.DISCOUNT * len(table) / sum(table.values()) if table else 1.0

    def difference(self, gram):
        return math.log(self.p(1, gram) / self.p(0, gram))


def test_differences_are_those_of_kneser_ney(spark):
    """Of n-grams that were seen, and of others, through the backoff."""
    corpus = _corpus(50)
    rows = spark.createDataFrame([(t, (i % 2) * 2 + y) for i, t, y in corpus], "text string, y long").repartition(3)
    got = toxicity.differences(toxicity.count(rows)).toPandas().sort_values("key")
    halves = [(i % 2, t, y) for i, t, y in corpus]
    seen = {bytes(toxicity.symbols(t))[i : i + toxicity.ORDER] for _, t, _ in corpus for i in range(len(toxicity.symbols(t)) - toxicity.ORDER + 1)}
    rng = random.Random(3)
    unseen = {bytes(rng.choice(b"abcdez qw") for _ in range(toxicity.ORDER)) for _ in range(200)} | {g[:-1] + b"q" for g in seen} | {g[:2] + rng.choice(sorted(seen))[2:] for g in seen}
    grams = sorted(seen | unseen)
    packed = np.array([int.from_bytes(g, "big") for g in grams])
    for name, used in (("all", (0, 1)), ("without0", (1,)), ("without1", (0,))):
        brute = Brute(halves, used)
        have = toxicity.looked(packed, got["key"].to_numpy(), got[name].to_numpy())[0]
        assert np.allclose(have, [brute.difference(g) for g in grams], rtol=0, atol=1e-9)
    assert len(seen) > 100 and len(grams) > 2 * len(seen) and got["key"].is_unique


@pytest.mark.parametrize("size", [1, 5, 8, 37, 1 << 20])
def test_slices_do_not_change_a_value(monkeypatch, size):
    keys = np.unique(toxicity.node(toxicity.grams(toxicity.symbols("some words and idiots here")), toxicity.ORDER))
    diff = np.random.default_rng(0).normal(size=len(keys))
    texts = [toxicity.symbols(t) for t in ("many other words and then idiots here with some words " * 9, "", "a", "idio", "some wor", "words", "x" * 90)]
    want = []
    for raw in texts:
        v = toxicity.looked(toxicity.grams(raw), keys, diff)[0]
        span = min(toxicity.SPAN, len(v))
        want.append((v.mean(), max(v[i : i + span].mean() for i in range(len(v) - span + 1))) if len(v) else (0, 0))
    monkeypatch.setattr(toxicity, "SLICE", size)
    assert np.allclose(toxicity.values(texts, keys, diff)[:, 0], want)


def test_a_joined_model_scores_as_a_sent_one(spark, empty, labels):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdefghilmnoprstu"), rng.integers(2, 8))) for _ in range(150)]
    rows = [(i, " ".join(rng.choice(words, 40)) + (" zwork" if i % 6 == 0 else ""), int(i % 6 == 0), "x", "y") for i in range(300)]
    rows += [rows[0], (301, None, 0, "x", "y"), (302, "", 1, "x", "y"), (303, " ".join(rng.choice(words, 3000)), 0, "x", "y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int, pack string, _id string").repartition(3)
    known = frame.select("doc_id", "toxic")
    sent = toxicity.score(frame.drop("toxic"), known)
    assert sent.columns == ["doc_id", "text", "pack", "_id", "score"]
    joined = toxicity.score(frame.drop("toxic"), known, most_rows=0)
    told = lambda df: collections.Counter((r["doc_id"], r["text"], round(r["score"], 9)) for r in df.collect())
    assert told(sent) == told(joined) and len(told(sent)) > 20
    assert toxicity.score(empty, labels, out="_p", most_rows=-1).count() == 0


def test_wanted_keys_are_all_that_is_looked_up():
    import pyarrow as pa

    texts = pa.array(["some words", None, "", "other é words"])
    keys = toxicity.wanted(texts)
    assert len(set(keys.tolist())) == len(keys)
    for t in texts.to_pylist():
        g = toxicity.grams(toxicity.symbols(t or ""))
        for o in range(1, toxicity.ORDER + 1):
            assert set(toxicity.node(g, o)) | set(toxicity.node(g >> 8, o - 1) | toxicity.CONTEXT) <= set(keys.tolist())
    assert packs.runs([5, 5, 5], limit=70) == [(0, 1), (1, 2), (2, 3)] and packs.runs([]) == []


def test_held_out_by_length(spark):
    """Insults in ordinary text: found in short and long held-out documents, clean ones left alone."""
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghilmnoprstuw") for _ in range(rng.randrange(2, 8))) for _ in range(2000)]
    bad = ["idiot", "trash", "clown", "moron", "stupid"]
    rows = []
    for i in range(1500):
        text = [rng.choice(words) for _ in range(rng.choice([20, 60, 400]))]
        toxic = int(i % 5 == 0)
        for _ in range(toxic * 2):
            text.insert(rng.randrange(len(text)), rng.choice(bad))
        rows.append((i, " ".join(text), toxic, len(text) // 100))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int, size int")
    out = toxicity.score(frame.drop("toxic"), frame.select("doc_id", "toxic")).join(frame.select("doc_id", "toxic"), "doc_id").filter(toxicity.held_out("doc_id"))
    by = out.groupBy("size").agg(F.avg(F.when(F.col("toxic") == 1, (F.col("score") >= 0.5).cast("double"))).alias("caught"), F.avg(F.when(F.col("toxic") == 0, (F.col("score") >= 0.5).cast("double"))).alias("wrong")).collect()
    assert len(by) == 2 and all(r["caught"] > 0.85 and r["wrong"] < 0.05 for r in by), by
