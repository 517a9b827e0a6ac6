"""Replies, few-shot, null classes, lexicons and gaps in cases that tables seldom hold."""

import pytest
from pyspark.sql import functions as F

from textguard.functions import lexicon as lx
from textguard.operators import policy, requests, split


def test_repeated_replies_do_not_multiply_rows(spark):
    rows = spark.createDataFrame([(1,), (2,), (3,)], "row_id long")
    parsed = spark.createDataFrame([(1, "PASS", 2, "b"), (1, "PASS", 1, "a"), (2, "BLOCK", 5, "c")], "id long, decision string, score int, target string")
    out = {r["row_id"]: (r["reply"], r["n_replies"], r["has_reply"]) for r in requests.attach_responses(rows, parsed).collect()}
    assert out == {1: ("a", 2, True), 2: ("c", 1, True), 3: (None, 0, False)}


def test_few_shot_has_k_pairs_of_every_key(spark):
    df = spark.range(20).select(F.col("id").alias("row_id"), F.when(F.col("id") < 15, "a").otherwise("b").alias("lang"), F.lit("s").alias("source"), F.lit("t").alias("target"))
    out = requests.fewshot_block(df, 3, "row_id", ctx_key="lang").collect()
    assert {r["lang"]: r["n_examples"] for r in out} == {"a": 3, "b": 3}


def test_null_class_is_refused(spark):
    df = spark.range(40).select(F.col("id").alias("row_id"), F.when(F.col("id") % 4 != 0, F.col("id") % 2).alias("action"))
    with pytest.raises(Exception, match="no class for row"):
        split.stratified_split(df, "row_id", "action").collect()


def test_lexicon_words_are_literal(spark):
    lexicon = (lx.Entry("a.b", "x$1", "SLUR"), lx.Entry("Idiot", "person", "SLUR"))
    df = spark.createDataFrame([(1, "a.b axb idiot")], "id long, text string")
    r = df.select(lx.purify(F.col("text"), lexicon).alias("p"), lx.categories_of(lx.keywords(F.col("text"), lexicon), lexicon).alias("c")).first()
    assert r["p"] == "x$1 axb person" and r["c"] == "SLUR"


def test_lexicon_join_takes_a_word_once(spark):
    df = spark.createDataFrame([(1, "you IDIOT"), (2, "fine")], "id long, text string")
    twice = spark.createDataFrame([("Idiot", "person"), ("idiot", "person")], "word string, stem string")
    assert [r["purified"] for r in policy.purify_by_join(df, "id", "text", twice).orderBy("id").collect()] == ["you person", "fine"]
    conflict = spark.createDataFrame([("Idiot", "person"), ("idiot", "fool")], "word string, stem string")
    with pytest.raises(Exception, match="conflicting stems"):
        policy.purify_by_join(df, "id", "text", conflict).collect()


def test_all_gaps_are_exactly_the_lost_rows(spark):
    from textguard.operators import diff

    raw = spark.createDataFrame([(i, f"row {i}" if i != 30 else None) for i in range(60)], "id long, text string")
    lost = {5, 6, 20, 30, 41, 42, 43}
    proc = raw.filter(~F.col("id").isin(*lost)).withColumn("text", F.when(F.col("id") == 10, "changed").otherwise(F.col("text")))
    out = diff.find_gaps(raw, proc, ["id"], first_only=False).collect()
    assert {r["missing_line"] - 1 for r in out} == lost and len(out) == len(lost)
    assert {(r["gap_line"], r["n_missing"]) for r in out} == {(6, 2), (19, 1), (28, 1), (38, 3)}
    assert [r["missing_line"] for r in diff.find_gaps(raw, proc, ["id"]).orderBy("missing_line").collect()] == [6, 7]
    kinds = diff.positional_diff(raw.limit(0).union(raw.filter("id IN (29, 30)")), raw.filter("id = 29"), ["id"]).collect()
    assert [(r["line"], r["kind"], r["raw_text"]) for r in kinds] == [(2, "missing_in_proc", None)]


def test_samples_per_key(spark, monkeypatch):
    """The least digests of every key, however the rows are cut and sketches passed on."""
    import hashlib

    from textguard.operators import requests

    rows = [(i, None if i % 7 == 0 else f"k{i % 5 if i % 3 else 0}", f"t{i}") for i in range(400)] + [(None, "k1", "no id"), (3, "k1", "again")]
    frame = lambda n: spark.createDataFrame(rows, "id long, key string, _row string").repartition(n)
    rank = lambda r: hashlib.md5(f"5:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    by_key = {}
    for r in sorted(rows, key=rank):
        by_key.setdefault(r[1], []).append(r[0])
    draw = lambda df, k=4, seed=5: df.collect() and sorted(((r["key"], r["id"]) for r in requests.sample_per_key(df, "key", k, "id", seed).collect()), key=repr)
    want = sorted(((k, i) for k, ids in by_key.items() for i in ids[:4]), key=repr)
    assert draw(frame(1)) == draw(frame(5)) == want != draw(frame(3), seed=6)
    assert len(draw(frame(2), k=10_000)) == len(rows)
    monkeypatch.setattr(requests, "SKETCH_ROWS", 3)
    assert draw(frame(3)) == want
    assert requests.sample_per_key(frame(3), None, 9, "id").count() == 9 and requests.sample_per_key(frame(3).limit(0), "key", 9, "id").count() == 0
    assert requests.sample_per_key(frame(3), "key", 2, "id").columns == ["id", "key", "_row"]


def test_policies_with_separators_are_refused(spark, tmp_path):
    from textguard.sources import readers, sinks

    rows = spark.createDataFrame([(1, "a\nb\r\n"), (2, ""), (3, None)], "id long, text string")
    sinks.write_policies(rows.repartition(2), str(tmp_path / "p"), "id", "text")
    assert sorted(tuple(r) for r in readers.read_policies(spark, str(tmp_path / "p")).collect()) == [("1", "a\nb\r\n"), ("2", ""), ("3", "")]
    with pytest.raises(Exception, match="separator"):
        sinks.write_policies(spark.createDataFrame([(1, "a\u001eb")], "id long, text string"), str(tmp_path / "q"), "id", "text")
