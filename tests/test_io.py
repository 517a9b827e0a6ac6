"""Scans and sinks (S1-S6, K1-K6) on crafted files shaped like the reference's TSVs."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from textguard.schemas import LABELLED_RAW, PAIRS
from textguard.sources import readers, sinks

HEADER = "source\ttarget\taction\tseverity\tcategory\treason\torigin_tags\n"


def _write(path, text, bom=False):
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8") as f:
        f.write(text)


def test_read_tsv_bom_multiline_and_short_rows(spark, tmp_path):
    p = tmp_path / "labelled.tsv"
    body = (
        HEADER
        + '오늘 날씨 정말 좋네요.\t오늘 날씨 정말 좋네요.\t0\t0\tNORMAL\t[무해] -> keep\tclean\n'
        + '"두 줄\n문장"\t"두 줄 문장"\t2\t2\tSLUR\t[x] -> purify\t"악플/욕설, 기타 혐오"\n'
        + "short\trow\t0\n"
        + '"a ""quoted"" word"\tq\t1\t4\tSLUR\t[q] -> block\tclean\n'
    )
    _write(p, body, bom=True)
    keep = readers.read_tsv(spark, str(p), LABELLED_RAW, malformed="keep")
    rows = keep.orderBy("source").collect()
    assert len(rows) == 4
    assert "source" in keep.columns and keep.columns[0] == "source"  # BOM stripped from the header
    two_line = [r for r in rows if r.source.startswith("두")][0]
    assert two_line.source == "두 줄\n문장" and two_line.origin_tags == "악플/욕설, 기타 혐오"
    assert [r for r in rows if r.source == 'a "quoted" word'][0].action == "1"
    short = [r for r in rows if r.source == "short"][0]
    assert short.n_fields == 3
    skip = readers.read_tsv(spark, str(p), LABELLED_RAW, malformed="skip")
    assert skip.count() == 3


def test_read_policy_and_read_or_empty(spark, tmp_path):
    p = tmp_path / "policy.md"
    _write(p, "# 지침\n한 줄\n둘째 줄\n")
    pol = readers.read_policy(spark, str(p)).first()
    assert pol.policy == "# 지침\n한 줄\n둘째 줄\n"
    empty = readers.read_or_empty(spark, str(tmp_path / "missing"), PAIRS)
    assert empty.count() == 0 and empty.schema == PAIRS


def test_literal_rows(spark):
    df = readers.literal_rows(spark, [("a", "b")], PAIRS)
    assert df.collect()[0].asDict() == {"source": "a", "target": "b"}


def test_write_tsv_roundtrip_and_append(spark, tmp_path):
    df = spark.createDataFrame([("줄\n바꿈", 't"q'), ("x\ty", "z")], PAIRS)
    out = str(tmp_path / "pairs")
    sinks.write_tsv(df, out)
    back = readers.read_tsv(spark, out, PAIRS)
    assert sorted(tuple(r)[:2] for r in back.collect()) == sorted(tuple(r) for r in df.collect())
    app = str(tmp_path / "app")
    sinks.append_rows(df, app)
    sinks.append_rows(df, app)
    assert spark.read.parquet(app).count() == 4


def test_parallel_export_line_aligned(spark, tmp_path):
    rows = [(("train" if i % 5 else "test"), i, f"src {i}\nline", f"tgt {i}") for i in range(200)]
    df = spark.createDataFrame(rows, "split string, row_id long, source string, target string")
    pairs = sinks.parallel_pairs(df, "split", "row_id")
    out = str(tmp_path / "nmt")
    sinks.write_parallel(pairs, out, lines_per_part=37)  # unequal parts, the last one short
    for split in ("train", "test"):
        def lines(side):
            d = os.path.join(out, side, f"split={split}")
            parts = sorted((f for f in os.listdir(d) if f.startswith("part=")), key=lambda f: int(f.split("=")[1]))
            files = [os.path.join(d, p, f) for p in parts for f in os.listdir(os.path.join(d, p)) if f.startswith("part-")]
            assert len(files) == len(parts) > 1
            return [ln for f in files for ln in open(f, encoding="utf-8").read().splitlines()]

        src, tgt = lines("src"), lines("tgt")
        assert len(src) == len(tgt) > 0
        assert all(s.split()[1] == t.split()[1] for s, t in zip(src, tgt))
        assert [int(s.split()[1]) for s in src] == sorted(i for _, i, *_ in rows if (i % 5 != 0) == (split == "train"))  # line order


def test_write_splits_and_routes(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "test"), (3, "valid")], "row_id long, split string")
    out = str(tmp_path / "splits")
    sinks.write_splits(df, out)
    assert sorted(f for f in os.listdir(out) if f.startswith("split=")) == ["split=test", "split=train", "split=valid"]
    assert spark.read.parquet(out).filter("split = 'test'").count() == 1
    r = str(tmp_path / "routes")
    sinks.route_write(df.withColumn("route", F.when(F.col("row_id") > 1, "blocked").otherwise("passed")), "route", r)
    assert spark.read.parquet(r).filter("route = 'blocked'").count() == 2


def test_replace_dataset_in_place(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(10).write.parquet(path)
    current = spark.read.parquet(path)
    sinks.replace_dataset(current.withColumn("id", F.col("id") * 2), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [i * 2 for i in range(10)]
    assert [f for f in os.listdir(tmp_path) if "staging" in f or ".old-" in f] == []


def test_ingest_dataset(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "train"), ("b", 0, "test")], "text string, label int, split string")
    out = str(tmp_path / "landed")
    readers.ingest_dataset(df, out)
    assert spark.read.parquet(out).filter("split = 'train'").count() == 1


def test_bucketed_landing_joins_without_shuffle(spark, tmp_path):
    from conftest import SF_SMALL

    docs = readers.table(spark, SF_SMALL, "documents").select("doc_id", "text")
    labels = readers.table(spark, SF_SMALL, "labels")
    sinks.write_bucketed(docs, "tg_docs_b", "doc_id", 4, str(tmp_path / "docs_b"))
    sinks.write_bucketed(labels, "tg_labels_b", "doc_id", 4, str(tmp_path / "labels_b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("tg_docs_b").join(spark.table("tg_labels_b"), "doc_id", "left")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == docs.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS tg_docs_b")
        spark.sql("DROP TABLE IF EXISTS tg_labels_b")


def test_short_rows_pass_through_the_fixer(spark, tmp_path):
    from textguard.operators import curate, overrides

    p = tmp_path / "fix.tsv"
    _write(p, HEADER + "a\tb\t0\t0\tNORMAL\t[none] -> keep\tclean\nshort\trow\n" + "c\tc\t1\t4\tSLUR\t[x] -> block\tabuse\n")
    rows = readers.read_tsv(spark, str(p), LABELLED_RAW, malformed="keep")
    fixed = overrides.repair_block(overrides.repair_normal(curate.typed(rows, {"action": "int", "severity": "int"})))
    got = {r.source: (r.target, r.n_fields) for r in fixed.collect()}
    assert got["a"] == ("a", 7)  # NORMAL keeps its source
    assert got["short"] == ("row", 2)  # short row kept as read
    assert got["c"][0] == "(차단된 문장입니다)"
    audit_rows = readers.read_tsv(spark, str(p), LABELLED_RAW, malformed="skip")
    assert sorted(r.source for r in audit_rows.collect()) == ["a", "c"]


def test_second_run_keeps_the_routes_of_the_first(spark, tmp_path):
    path = str(tmp_path / "routes")
    for i in (1, 2):
        sinks.route_write(spark.createDataFrame([(i, "passed")], "row_id long, route string"), "route", path)
    assert sorted(r[0] for r in spark.read.parquet(path).select("row_id").collect()) == [1, 2]
