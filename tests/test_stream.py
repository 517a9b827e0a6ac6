"""Streaming forms (T1-T3) agree with their batch twins."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
from conftest import SF_SMALL
from textguard.functions import lexicon as lx
from textguard.plans import fixtures as fx
from textguard.schemas import BLOCK_TARGET
from textguard.sources.readers import table
from textguard.streaming import stream


def test_stream_labeller_equals_batch(spark):
    got = se.queries()["t1_moderate_stream"](spark, SF_SMALL)
    want = fx.labelled(spark, SF_SMALL)
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_manner_score_closed_windows_equal_batch(spark):
    s = se.queries()["t3_manner_score_stream"](spark, SF_SMALL)
    b = se.queries()["t3_manner_score_batch"](spark, SF_SMALL)
    assert s.count() > 0
    assert s.exceptAll(b.select(*s.columns)).count() == 0  # every emitted window is final and equal
    assert b.count() - s.count() <= b.select("window_start").distinct().orderBy(F.desc("window_start")).limit(1).join(b, "window_start").count()


def _greedy(rows, gap=600):
    last, kept = {}, []
    for i, t, key in sorted(rows, key=lambda r: (r[1], r[0])):
        if key not in last or t - last[key] > gap:
            last[key] = t
            kept.append(i)
    return sorted(kept)


def test_stream_dedup_one_file_and_ten(spark, tmp_path):
    """The kept rows are those of the 10-minute rule, however the input is cut."""
    import random

    random.seed(3)
    rows = [(i, 1_700_000_000 + random.randrange(200_000), f"u{i % 7}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, s long, k string").select("id", F.timestamp_seconds("s").alias("ts"), "k")
    one, ten = str(tmp_path / "one"), str(tmp_path / "ten")
    df.repartition(1).write.parquet(one)
    for i in range(10):  # slices of event time, in order; rows inside a slice in any order
        lo = 1_700_000_000 + i * 20_000
        df.filter(F.unix_seconds("ts").between(lo, lo + 19_999)).repartition(1).write.mode("append").parquet(ten)
    want = _greedy(rows)
    for path, per in ((one, None), (ten, 1)):
        out = stream.run_available_now(stream.stream_dedup(stream.read_stream(spark, path, df.schema, max_files_per_trigger=per), ["k"]), "dedup")
        assert sorted(r[0] for r in out.select("id").collect()) == want


def test_stream_dedup_query_follows_the_rule(spark):
    out = se.queries()["t2_stream_dedup"](spark, SF_SMALL)
    ev = table(spark, SF_SMALL, "events").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), "user_id", "event_type").collect()
    assert sorted(r[0] for r in out.select("event_id").collect()) == _greedy([(r[0], r[1], (r[2], r[3])) for r in ev], 600_000_000)


def test_stream_dedup_in_small_batches(spark, tmp_path):
    """A key with most of the rows, null keys, equal times, rows without a time, and
    rows of a key that reach Python a few at a time. The state is the engine's."""
    import random

    random.seed(4)
    rows = [(i, 1_700_000_000 + random.randrange(90_000), "hot" if i % 3 else random.choice([None, "a", "b"])) for i in range(6000)]
    df = spark.createDataFrame([*rows, (6000, None, "a")], "id long, s long, k string").select("id", F.timestamp_seconds("s").alias("ts"), "k")
    path = str(tmp_path / "one")
    df.repartition(1).write.parquet(path)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        dedup = stream.stream_dedup(stream.read_stream(spark, path, df.schema), ["k"])
        assert dedup.isStreaming and dedup.columns == df.columns and "FlatMapGroupsInPandasWithState" in dedup._jdf.queryExecution().analyzed().toString()
        got = sorted(r[0] for r in stream.run_available_now(dedup, "dedup").select("id").collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == _greedy([(i, t, k) for i, t, k in rows])


def test_stream_dedup_late_events_and_ended_state(spark, tmp_path):
    """One event a micro-batch: a late one is dropped, a key that was silent begins anew."""
    t0 = 1_700_000_000
    events = [(0, t0, "a"), (1, t0 + 500, "a"), (2, t0 + 700, "a"), (3, t0 + 50_000, "b"), (4, t0 + 800, "a"), (5, t0 + 50_100, "a"), (6, t0 + 50_601, "b"), (7, t0 + 90_000, "a")]
    path = str(tmp_path / "in")
    for e in events:
        spark.createDataFrame([e], "id long, s long, k string").select("id", F.timestamp_seconds("s").alias("ts"), "k").coalesce(1).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    out = stream.run_available_now(stream.stream_dedup(stream.read_stream(spark, path, schema, max_files_per_trigger=1), ["k"]), "late")
    assert sorted(r[0] for r in out.select("id").collect()) == [0, 2, 3, 5, 6, 7]


def test_stream_dedup_of_many_keys_makes_few_calls(spark, tmp_path):
    """Many keys with few events each: the state has a row for a bucket, not for a
    key; keys are told apart by all their digits, null keys are one of their own."""
    import random

    random.seed(5)
    keys = [None, *(2**60 + i for i in range(400))]
    rows = [(2**61 + i if i % 50 else None, 1_700_000_000 + random.randrange(20_000), random.choice(keys), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, s long, k long, n int").select("id", F.timestamp_seconds("s").alias("ts"), "k", "n")
    path = str(tmp_path / "in")
    for i in range(3):
        df.filter(F.unix_seconds("ts").between(1_700_000_000 + i * 7_000, 1_700_006_999 + i * 7_000)).coalesce(1).write.mode("append").parquet(path)
    dedup = stream.stream_dedup(stream.read_stream(spark, path, df.schema, max_files_per_trigger=1), ["k"], buckets=7)
    q = dedup.writeStream.format("memory").queryName("many_keys").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r["n"]: (r["id"], r["k"]) for r in spark.table("many_keys").collect()}
    states = [op["numRowsTotal"] for p in q.recentProgress for op in p["stateOperators"]]
    # equal times of a key: the smaller id first, a null one last
    ranked = sorted(range(3000), key=lambda i: (rows[i][1], rows[i][0] is None, rows[i][0] or 0, i))
    place = {i: p for p, i in enumerate(ranked)}
    want = {ranked[p] for p in _greedy([(place[i], rows[i][1], rows[i][2]) for i in range(3000)])}
    assert got == {i: (rows[i][0], rows[i][2]) for i in want}
    assert 0 < max(states) <= 7


def _messages(spark, folder, texts):
    """One file a text, so that each is a micro-batch."""
    schema = spark.createDataFrame([], "doc_id long, text string").schema
    for i, t in texts:
        spark.createDataFrame([(i, t)], schema).coalesce(1).write.mode("append").parquet(folder)
    return stream.moderate_stream(stream.read_stream(spark, folder, schema, max_files_per_trigger=1))


def _routed(spark, path):
    from textguard.sources.snapshots import Dataset

    schema = spark.createDataFrame([], "row_id long, output string, route string").schema
    return sorted(tuple(r) for r in Dataset(spark, path).read(schema).collect())


def test_routes_of_messages(spark, tmp_path):
    words = [e.word for e in lx.DEFAULT_LEXICON][:6]
    texts = [(0, "fine words"), (1, f"you {words[0]}"), (2, f"{words[0]} and {words[1]}"), (3, " ".join(words)), (4, ""), (5, None)]
    done = stream.run_routed(_messages(spark, str(tmp_path / "in"), texts), "t1", str(tmp_path / "out"))
    got = {i: (route, out) for i, out, route in _routed(spark, done.path)}
    assert got[0] == ("passed", "fine words") and got[1] == ("passed", texts[1][1])  # 1/2 is below the threshold
    assert got[2][0] == "rewritten" and words[0] not in got[2][1] and got[3] == ("blocked", BLOCK_TARGET)
    assert got[4] == ("passed", "") and got[5] == ("passed", None)
    assert done.version() == len(texts) - 1  # a commit for each micro-batch


def test_a_batch_run_again_counts_once(spark, tmp_path, monkeypatch):
    """The driver is lost after the commit of a batch and before Spark notes its end."""
    from textguard.sources.snapshots import Dataset

    texts = [(i, f"message {i}") for i in range(4)]
    messages = lambda t: _messages(spark, str(tmp_path / "in"), t)
    commit, path, seen = Dataset.append, str(tmp_path / "out"), []

    def lost(self, df, token=None):
        seen.append((token, commit(self, df, token)))
        if len(seen) == 3:
            raise RuntimeError("driver lost")
        return seen[-1][1]

    monkeypatch.setattr(Dataset, "append", lost)
    with pytest.raises(Exception, match="driver lost"):
        stream.run_routed(messages(texts), "t1", path)
    assert len(_routed(spark, path)) == 3
    stream.run_routed(messages([(9, "a later one")]), "t1", path)
    assert seen[3] == (seen[2][0], False)  # the same batch again: refused
    assert [i for i, *_ in _routed(spark, path)] == [0, 1, 2, 3, 9]
