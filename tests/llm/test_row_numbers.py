"""Row numbers used as join keys are the same in jobs that cut the files otherwise."""

from pyspark.sql import functions as F

import corpus_pipeline
from textguard.llm.common import numbered


def _rows(df):
    return sorted((r["u"], r["id"]) for r in df.select("u", "id").collect())


def _twice(spark, df):
    """Rows of ``df`` read with one split a file, and with as many as there can be."""
    out = []
    try:
        for least in ("1", "64"):
            spark.conf.set("spark.sql.files.minPartitionNum", least)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            out.append(_rows(df))
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    return out


def test_numbers_do_not_depend_on_splits(spark, tmp_path):
    one, many = str(tmp_path / "one"), str(tmp_path / "many é")
    rows = spark.range(0, 20_000, 1, 3).select("id", F.sha2(F.col("id").cast("string"), 256).alias("path"), F.lit("x").alias("file"))
    rows.repartition(1).write.option("parquet.block.size", 64 << 10).parquet(one)
    rows.write.option("parquet.block.size", 64 << 10).parquet(many)
    read = spark.read.parquet
    cases = [read(one), read(many), read(many).filter("id % 3 = 0").select("id", F.struct("path").alias("row")), read(one, one), read(many).repartition(5), read(many).limit(0)]
    for df in cases:
        first, second = _twice(spark, numbered(df, "u"))
        assert first == second and len({u for u, _ in first}) == len(first) == df.count()


def test_kept_rows_when_jobs_split_otherwise(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.range(0, 20_000, 1, 2).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).write.option("parquet.block.size", 64 << 10).parquet(path)
    docs = numbered(spark.read.parquet(path), "row")
    spark.conf.set("spark.sql.files.minPartitionNum", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        kept = docs.filter("id % 7 = 0").select("row").collect()
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got = docs.join(spark.createDataFrame(kept, "row binary"), "row", "left_semi")
    assert sorted(r["id"] for r in got.select("id").collect()) == list(range(0, 20_000, 7))


def test_texts_are_sent_once_over_several_files(spark, tmp_path):
    from textguard.llm import bpe

    path = str(tmp_path / "docs")
    spark.range(0, 400, 1, 4).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("some words again "), F.col("id") % 3), 90).alias("text")).write.parquet(path)
    out = bpe.encode(spark.read.parquet(path))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert final.count("squeeze(") == 1, final


def test_one_row_of_every_group_stays(spark, tmp_path):
    """One id as the least of two groups, near copies without an id."""
    a, b, c = ("alpha beta gamma delta epsilon zeta eta theta " * 6, "one two three four five six seven eight nine ten " * 6, "lorem ipsum dolor sit amet consectetur adipiscing elit " * 6)
    rows = [(1, a), (1, b), (2, a), (3, b), (None, c), (None, c), (None, c), (4, "unlike any of the others it stands alone here")]
    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(2).write.parquet(path)
    kept = corpus_pipeline.near_dedup(spark, spark.read.parquet(path), "").select("doc_id", "text").collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted([(1, a), (1, b), (0, c), (4, rows[-1][1])])
