"""Every operator on the awkward table: brute force, repeated rows, empty tables."""

import collections
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from textguard.llm import bpe, packing, quality_model, quality_rules, sharding, simhash, token_counts, toxicity
from textguard.llm.common import spread_groups

from .conftest import TEXTS

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def tokenizer(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


# --------------------------------------------------------------------------- 1
@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts_add_up(docs, empty, rule):
    whole = tokenizer("byte_bpe_50k.json")
    rows = token_counts.count_tokens(docs, rule=rule).collect()
    want = sorted(len(whole.encode(t or "", add_special_tokens=False).ids) for _, t in TEXTS)
    by_doc = collections.Counter()
    for r in rows:
        by_doc[r["doc_id"], r["doc_tokens"]] += r["n_tokens"]
    copies = collections.Counter(i for i, _ in TEXTS)
    assert all(abs(v - copies[i] * n) < 1e-6 for (i, n), v in by_doc.items())
    assert sorted(n for (i, n) in by_doc for _ in range(copies[i])) == want
    assert token_counts.count_tokens(empty).count() == 0


def test_boundary_tokens_follow_the_rule():
    sizes, starts = np.array([3, 4, 3]), np.array([0, 4, 8])  # the second token spans bytes 3..6, the third 7..9
    assert token_counts.attribute(sizes, starts, 10, "start")[0].tolist() == [2, 1, 0]
    assert token_counts.attribute(sizes, starts, 10, "majority")[0].tolist() == [1, 1, 1]
    split, crossing = token_counts.attribute(sizes, starts, 10, "split")
    assert np.allclose(split, [1.25, 0.75 + 1 / 3, 2 / 3]) and crossing.tolist() == [1, 2, 1]


# --------------------------------------------------------------------------- 2
def test_ring_matches_a_walk_round_it(spark, docs, empty):
    out = sharding.ring_shards(docs, shards=5).collect()
    assert len(out) == len(TEXTS)
    slots = collections.defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    sizes = [len(slots.get(s, [])) for s in range(5)]
    assert max(sizes) - min(sizes) <= 1
    assert sorted((r["size"], r["text_crc32"]) for r in out) == sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t in TEXTS)
    assert sharding.ring_shards(empty, shards=5).count() == 0


@pytest.mark.parametrize("slack", [0.0, 0.1])
def test_overflow_continues_clockwise(spark, slack):
    """Counts per shard equal those of moving the surplus one row at a time."""
    shards, n = 7, 900
    rows = spark.range(n).select((F.col("id") % 300).alias("doc_id"), F.lit("t").alias("text"))
    out = sharding.ring_shards(rows, shards=shards, replicas=9, slack=slack).toPandas()
    ring = sharding.ring(spark, shards, 9).toPandas().sort_values("cell")
    cap = [n // shards + (s < n % shards) for s in range(shards)] if not slack else [int(-(-n * (1 + slack) // shards))] * shards
    cell = spark.range(300).select("id", F.pmod(F.xxhash64("id"), F.lit(sharding.CELLS)).alias("cell")).toPandas()
    owner = dict(zip(ring.cell, zip(ring.arc, ring.home)))
    held, over = collections.Counter(), collections.Counter()
    for arc, home in sorted((owner[c] for c in cell.cell for _ in range(3)), key=lambda x: x[0]):
        if held[home] < cap[home]:
            held[home] += 1
        else:
            over[arc] += 1
    assert out[out.home == out.shard].groupby("shard").size().to_dict() == {s: v for s, v in held.items() if v}
    arcs, carry = sorted(set(owner.values())), 0
    for lap in (1, 2):
        for arc, home in arcs:
            carry += over[arc] if lap == 1 else 0
            take = min(carry, cap[home] - held[home])
            held[home] += take
            carry -= take
    assert carry == 0 and out.groupby("shard").size().to_dict() == {s: v for s, v in held.items() if v}


def test_groups_of_a_hot_class_are_small(spark):
    rows = spark.range(3000).select(F.col("id").alias("u"), F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 50).alias("c"))
    sizes = spread_groups(rows, "c", "u", 3000, groups=100).groupBy("c", "sub").count().toPandas()
    assert sizes["count"].max() < 100 and sizes["count"].sum() == 3000


# --------------------------------------------------------------------------- 3
def test_packing_is_exact(docs, empty):
    whole = tokenizer("word_bpe_49k.json")
    out = packing.pack(docs).select("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids").toPandas()
    seen = collections.Counter()
    for (_, n), g in out.groupby([out.doc_id.fillna(-1), "doc_tokens"]):
        seen[n] += round(g.length.sum() / n)
    texts = [whole.encode(t or "", add_special_tokens=False).ids + [1] for _, t in TEXTS]
    assert seen == collections.Counter(map(len, texts))
    pieces = {(len(ids), s, n): np.array(ids[s : s + n], "<u4").tobytes() for ids in texts for s, n in zip(out.start, out.length)}
    known = collections.defaultdict(set)
    for ids in texts:
        known[len(ids)].add(tuple(ids))
    for r in out.itertuples():
        assert any(np.array(ids[r.start : r.start + r.length], "<u4").tobytes() == bytes(r.ids) for ids in known[r.doc_tokens]), pieces
    for _, g in out.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == (g.length.cumsum() - g.length).tolist() and g.length.sum() <= 2048
    assert packing.pack(empty).count() == 0


def test_new_words_have_the_library_s_ids():
    import public_tokenizers

    memo = packing.WordMemo(public_tokenizers.path("word_bpe_49k.json"))
    for _, t in TEXTS:
        assert np.frombuffer(memo.encode((t or "").encode()), "<u2").tolist() == memo.tokenizer.encode(t or "", add_special_tokens=False).ids


def test_least_squares_meets_the_histogram():
    rng = np.random.default_rng(1)
    histogram = {b: int(c) for b, c in zip(range(1, 65), rng.integers(0, 400, 64))}
    patterns = packing.plan(histogram, full=64)
    used = collections.Counter()
    for bins, times in patterns:
        assert sum(bins) == 64 and times > 0
        for b in bins:
            used[b] += times
    assert all(used[b] <= c for b, c in histogram.items())
    assert sum(b * n for b, n in used.items()) > 0.75 * sum(b * c for b, c in histogram.items())
    assert packing.plan({}) == [] and packing.plan({200: 10}) == []


# --------------------------------------------------------------------------- 4
def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORDS.findall(text)
    if not w:
        return 0
    s = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)]
    h = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(values, max_bits):
    group = {v: v for v in values}

    def find(v):
        while group[v] != v:
            v = group[v]
        return v

    ordered = sorted(group)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if (a ^ b).bit_count() <= max_bits:
                x, y = sorted((find(a), find(b)))
                group[y] = x
    return {v: find(v) for v in ordered}


def test_simhash_on_the_awkward_table(docs, empty):
    rows = simhash.near_duplicates(docs).collect()
    fps = [brute_fingerprint(t) for _, t in TEXTS]
    assert sorted(r["fp"] % (1 << 64) for r in rows) == sorted(fps)
    root = brute_components(fps, 4)
    least = {}
    for (i, _), f in zip(TEXTS, fps):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    assert all(r["component"] == least.get(root[r["fp"] % (1 << 64)]) for r in rows)
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("hot,max_bits", [(128, 4), (2, 4), (128, 0), (3, 7)])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, hot, max_bits):
    """Dense clusters, chains and far values; small HOT and BLOCK take the block path."""
    monkeypatch.setattr(simhash, "HOT", hot)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    if max_bits > 4:
        monkeypatch.setattr(simhash, "_chain_length", lambda n, m: 1)
    rng = np.random.default_rng(hot + max_bits)
    values = set(rng.integers(0, 1 << 63, 40).tolist())
    centre = int(rng.integers(0, 1 << 63))
    for _ in range(120):
        centre_now = centre
        for b in rng.choice(64, rng.integers(0, 6), replace=False):
            centre_now ^= 1 << int(b)
        values.add(centre_now)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    from textguard.llm.common import pin
    from textguard.llm.graph import components

    edges = pin(simhash.links(pin(spark.createDataFrame([(v,) for v in signed], "fp long"), "t"), max_bits), "t")
    for a, b in edges.toPandas().itertuples(index=False):
        assert a < b and ((int(a) ^ int(b)) % (1 << 64)).bit_count() <= max_bits
    got = {r["node"] % (1 << 64): r["root"] for r in components(edges).collect()}
    want = brute_components(values, max_bits)
    groups = collections.defaultdict(set)
    for v in values:
        groups[want[v]].add(v)
    for members in groups.values():
        assert len({got.get(v, v) for v in members}) == 1
    assert len({got.get(v, v) for v in values}) == len(groups)


def test_prefix_conditions_miss_no_pair():
    """Any difference of at most t bits is within the budgets from some start."""
    rng = np.random.default_rng(3)
    for _ in range(2000):
        d = sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False))
        assert any(all((d & p).bit_count() <= k for p, k in zip(simhash.prefix_masks(4, i), simhash.budgets(4))) for i in range(5))


# --------------------------------------------------------------------------- 5
def test_rule_counts(docs, empty, labels):
    rows = quality_rules.measure(docs.select("doc_id", "text", "lang")).collect()

    def brute(t):
        t = t or ""
        w = WORDS.findall(t)
        at = collections.defaultdict(list)
        for i in range(len(w) - 2):
            at[tuple(w[i : i + 3])].append(i)
        lines = [x for x in t.split("\n") if WORDS.search(x)]
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len({j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 3)})

    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(tuple(r[c] for c in names) for r in rows) == sorted(brute(t) for _, t in TEXTS)
    judged = quality_rules.apply_rules(docs, labels)
    assert judged.count() == len(TEXTS) and judged.filter("kept AND base_failed").count() == 0
    assert quality_rules.apply_rules(empty, labels).count() == 0


def test_binomial_tail_is_exact(spark):
    from math import comb

    rows = [(k, n) for n in (1, 7, 60, 900, 4000) for k in range(0, 40, 3) if k <= n]
    got = spark.createDataFrame(rows, "k long, n long").select("k", "n", quality_rules.binomial_tail(F.col("k"), F.col("n"), 0.02).alias("p")).collect()
    for r in got:
        want = float(sum(comb(r["n"], j) * 0.02**j * 0.98 ** (r["n"] - j) for j in range(r["k"] + 1)))
        assert abs(r["p"] - want) < 1e-9 or (r["p"] == 1.0 and r["k"] >= r["n"] * 0.02)


def test_certified_cutoffs(spark):
    """A stratum with enough clean rows gets the cutoff; a small one gets none."""
    rows = [(i, "a", 100, 400, 0 if i < 2000 else 200, 0, 0, 0, 10) for i in range(2200)] + [(5000 + i, "b", 100, 400, 200 * (i % 2), 0, 0, 0, 10) for i in range(20)]
    m = spark.createDataFrame(rows, "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_upper long, n_lines long")
    truth = spark.createDataFrame([(r[0], int(r[4] == 0)) for r in rows], "doc_id long, quality int")
    got = {r["stratum"]: r["steps"] for r in quality_rules.calibrate(m, truth, "lang").collect()}
    assert set(got) == {"a"} and set(got["a"]) == {"symbols"}
    judged = quality_rules.judge(m, quality_rules.calibrate(m, truth, "lang"), "lang")
    assert judged.filter("lang = 'a' AND kept").count() == 2000 and judged.filter("lang = 'b' AND kept").count() == 20


# --------------------------------------------------------------------------- 6
def test_bpe_equals_the_library_and_comes_back(docs, empty):
    whole = tokenizer("byte_bpe_50k.json")
    out = bpe.decode(bpe.encode(docs, out="_ids"), ids="_ids", out="_decoded").collect()
    want = [np.array(whole.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for _, t in TEXTS]
    assert sorted(bytes(r["_ids"]) for r in out) == sorted(want)
    assert {r["ids"] for r in out} == {"x"}  # a column of the input
    assert sorted(r["_decoded"] for r in out) == sorted(t or "" for _, t in TEXTS)
    assert bpe.encode(empty.select("doc_id", "text")).count() == 0


def test_any_shared_chunks_give_the_same_ids():
    """Whatever subset of a text's chunks is reused, the ids are the whole text's."""
    codec = bpe.ByteBpe("byte_bpe_50k.json")
    rng = np.random.default_rng(5)
    for _, t in TEXTS:
        data = (t or "").encode()
        want = codec.whole.encode(t or "", add_special_tokens=False).ids
        found = bpe.chunks(data)
        for _ in range(4):
            some = [(s, a, b, codec.encode(data[s + a : s + b].decode()).astype("<u4").tobytes()) for s, a, b, _ in found if rng.random() < 0.6]
            assert bpe.assemble(data, some, codec).tolist() == want


# --------------------------------------------------------------------------- 7, 8
def test_classifier_learns_and_scores_all(spark, docs, empty, labels):
    out = quality_model.score(docs, quality_model.train(docs, labels), out="_p").collect()
    assert len(out) == len(TEXTS) and all(0 <= r["_p"] <= 1 for r in out) and out[0].asDict().keys() >= {"fp", "ids", "_p"}
    assert quality_model.score(empty, quality_model.train(empty, labels), out="_p").count() == 0
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    forest = quality_model.fit(x[:2000], y[:2000])
    assert ((forest.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.97
    one = forest.score(x[:1])
    flat = forest.base
    for f, t, v in zip(forest.feature, forest.threshold, forest.value):
        node = 0
        for _ in range(forest.depth):
            node = 2 * node + 1 + int(x[0, f[node]] > t[node])
        flat += v[node - (2**forest.depth - 1)]
    assert abs(one[0] - 1 / (1 + np.exp(-flat))) < 1e-12
    assert quality_model.fit(x[:5], np.ones(5)).score(x[:2]).min() > 0.99 and quality_model.fit(x[:0], y[:0]).score(x[:1])[0] == 0.5


def test_quality_held_out_accuracy(spark):
    from textguard.llm.queries import QUERIES

    got = QUERIES["op7_quality_classifier"](spark, "/root/testdata/sf0.01").toPandas().merge(spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.95


def test_toxicity_finds_planted_words(spark, empty, labels):
    rng = np.random.default_rng(4)
    vocabulary = ["".join(rng.choice(list("abcdefghilmnoprstu"), rng.integers(2, 8))) for _ in range(400)]
    rows = []
    for i in range(1200):
        words = list(rng.choice(vocabulary, 60))
        if i % 6 == 0:
            words[int(rng.integers(60))] = "zwork" + str(rng.choice(vocabulary))  # a compound that is rarely seen twice
        rows.append((i, " ".join(words), int(i % 6 == 0)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    out = toxicity.score(frame.drop("toxic"), frame.select("doc_id", "toxic")).join(frame.select("doc_id", "toxic"), "doc_id").withColumn("held", toxicity.held_out("doc_id")).toPandas()
    held = out[out.held]
    assert ((held.score >= 0.5) == (held.toxic == 1)).mean() > 0.95
    assert toxicity.score(empty, labels, out="_p").count() == 0


def test_toxicity_on_the_awkward_table(docs, labels):
    out = toxicity.score(docs, labels, out="_p").collect()
    assert len(out) == len(TEXTS) and all(0 <= r["_p"] <= 1 for r in out)
    none = toxicity.score(docs, labels.limit(0), out="_p").select("_p").distinct().collect()
    assert [round(r[0], 9) for r in none] == [0.5]
