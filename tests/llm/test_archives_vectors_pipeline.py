"""WARC archives, nearest neighbours, the pipeline against brute force."""

import base64
import hashlib

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textguard.llm import ann, warc


def test_warc_round_trip(spark):
    pages = [(1, "http://a", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (3, None, None), (4, "http://d", ""), (5, "u\r\nv", "é" * 50_000), (5, "u\r\nv", "é" * 50_000), (None, "n", "only"), (6, "http://f", "<p>x</p>\r\n\r\n")]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, uid string").repartition(3)
    index = warc.write(df)
    assert index.count() == len(pages)
    got = warc.resolved(warc.read(index)).collect()
    assert len(got) == len(pages)
    for r in got:
        html = next(h for i, _, h in pages if i == r["page_id"]) or ""
        assert r["payload_bytes"] == len(html.encode()) and r["digest"] == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
    kinds = {(r["page_id"], r["record_type"], r["refers_to"]) for r in got}
    assert {(2, "response", None), (1, "revisit", 2), (4, "response", None), (3, "revisit", 4), (5, "response", None), (5, "revisit", 5), (None, "response", None), (6, "response", None)} == kinds
    some = warc.read(index.filter("page_id IN (2, 6)")).collect()  # only the selected records
    assert sorted(r["payload"].decode() for r in some) == ["<p>x</p>", "<p>x</p>\r\n\r\n"]
    assert {r["record_type"] for r in warc.read(warc.write(df, least_bytes=9)).filter("page_id IN (1, 2)").collect()} == {"response"}
    assert warc.read(warc.write(df.limit(0))).count() == 0


def test_neighbouring_ranges_are_joined():
    assert warc.spans([(0, 10), (10, 5), (20, 5), (200, 1)], gap=5) == [[0, 25], [200, 201]]


def brute(rows, k=10):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and len(v) == 8 and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for q, v in ok:
        if q % 100 == 0:
            s = sorted({(float(np.sqrt(((x - v) ** 2).sum())), i) for i, x in ok if i != q})
            out[q] = s[:k]
    return out


def test_neighbours_of_awkward_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(700)]
    rows += [(1000 + i, [1.0] * 8) for i in range(60)] + [(300, rows[300][1]), (2000, None), (2001, [0.0] * 8), (2002, [float("nan")] + [1.0] * 7), (2003, [None] + [1.0] * 7), (2004, [1.0] * 3), (None, [2.0] * 8), (2005, [float("inf")] * 8)]
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("list", T.StringType())])
    df = spark.createDataFrame([(*r, "x") for r in rows], schema).repartition(4)
    got = {}
    for r in ann.search(df, "id % 100 = 0", list_rows=64).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    want = brute(rows)
    assert set(got) == set(want)
    hit = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hit >= 0.9 * sum(map(len, want.values()))
    assert [i for _, i in got[1000]] == [1001 + i for i in range(10)]  # equal vectors: smallest ids first
    assert ann.search(df.limit(0), "id % 100 = 0").count() == 0


def _found(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = {}
    for r in ann.search(df, "id % 100 = 0", list_rows=64).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    return got


def test_repeated_rows_of_equal_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(1, 90)] + [(1000 + i, [1.0] * 8) for i in range(20) for _ in range(3)]
    assert _found(spark, rows)[1000] == [(0.0, 1001 + i) for i in range(10)]


def test_an_id_with_many_vectors_counts_once(spark):
    rng = np.random.default_rng(2)
    near = [(7, (np.ones(8) + rng.normal(size=8) / 1000).tolist()) for _ in range(30)]
    rows = [(100, [1.0] * 8), *near, *((200 + i, (np.ones(8) + rng.normal(size=8) / 10).tolist()) for i in range(1, 40))]
    got = _found(spark, rows)[100]
    v = {}
    for i, x in rows[1:]:
        v[i] = min(v.get(i, np.inf), float(np.sqrt(((np.array(x) - 1) ** 2).sum())))
    assert [i for _, i in got] == sorted(v, key=v.get)[:10]


def test_tight_groups_away_from_the_rest(spark):
    """Groups of near-equal rows, each with lists of its own: their rows find each other."""
    rng = np.random.default_rng(6)
    rows = [(i, (v / np.linalg.norm(v)).tolist()) for i, v in enumerate(rng.normal(size=(4000, 24)), start=1)]
    for g in range(3):
        v = rng.normal(size=24) * 3
        rows += [(10_000 * (g + 1) + i * 25, (v + rng.normal(size=24) / 200).tolist()) for i in range(200)]
    got = {}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    for r in ann.search(df, "id % 100 = 0", list_rows=16).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    x, ids = np.array([v for _, v in rows]), np.array([i for i, _ in rows])
    for q in ids[(ids % 100 == 0) & (ids >= 10_000)]:
        d = ((x - x[ids == q][0]) ** 2).sum(axis=1)
        d[ids == q] = np.inf
        assert len(got[q]) == 10 and len(set(got[q]) & set(ids[np.argsort(d)[:10]])) >= 8


def test_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = ann.search(table, "id % 100 = 0", list_rows=64).toPandas().groupby("query_id").vec_id.apply(set)
    rows = table.toPandas()
    x, ids = np.array(rows.embedding.to_list(), float), rows.vec_id.to_numpy()
    hit = 0
    for q in got.index:
        s = ((x - x[ids == q][0]) ** 2).sum(axis=1)
        s[ids == q] = np.inf
        hit += len(got[q] & set(ids[np.argsort(s)[:10]]))
    assert hit >= 9 * len(got)


def test_pipeline_stages(spark):
    import corpus_pipeline
    from textguard.llm import quality_rules, simhash

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        before, kept = kept, stage(spark, kept, sf).cache()
        assert kept.columns == docs.columns and kept.join(before, docs.columns).count() == kept.count() < before.count()
        if name == "quality_rules":
            want = quality_rules.apply_rules(before, spark.read.parquet(f"{sf}/labels.parquet")).filter("kept").select("doc_id")
            assert {r[0] for r in kept.select("doc_id").collect()} == {r[0] for r in want.collect()}
        if name == "simhash_near_dedup":
            from .test_small_tables import brute_components, brute_fingerprint

            rows = {r["doc_id"]: brute_fingerprint(r["text"]) for r in before.select("doc_id", "text").collect()}
            root, least = brute_components(rows.values(), 4), {}
            for i in sorted(rows):
                least.setdefault(root[rows[i]], i)
            assert {r[0] for r in kept.select("doc_id").collect()} == set(least.values())
            assert simhash.near_duplicates(kept).filter(F.col("doc_id") != F.col("component")).count() == 0
    pieces = corpus_pipeline.STAGES[3][1](spark, kept, sf)
    assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == {r[0] for r in kept.select("doc_id").collect()}


def test_registered_queries(spark):
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10 and "pipeline" in entry.queries()
