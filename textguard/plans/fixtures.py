"""Derived relations every operator is exercised on (see FIXTURES.md).

All of them are computed by Spark from the driver tables, so their size grows
with the tables; none is a fixed literal input. The literal pieces (nine benign
Korean sentences, three tones) are joined to table rows, never used alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textguard.functions import text as tx
from textguard.operators import policy, split
from textguard.operators.index import batch_id
from textguard.session import materialize
from textguard.sources.readers import table, text_table

# ---------------------------------------------------------------------------
# Benign Korean sentences of the labelling policy and the label
# each must get from the ending rule (R4), in policy order.
# ---------------------------------------------------------------------------
KOREAN_SENTENCES = [
    ("오늘 날씨 정말 좋네요.", "NORMAL"),
    ("와 이리 덥노?", "NORMAL"),
    ("기분 딱 좋노", "COMMUNITY"),
    ("뭐 하노?", "NORMAL"),
    ("어데 가노?", "NORMAL"),
    ("맞노", "COMMUNITY"),
    ("잠이 오노?", "COMMUNITY"),
    ("밥 묵었노?", "COMMUNITY"),
    ("우짜면 좋노?", "NORMAL"),
]

# Batch size of the request/reply fixtures.
BATCH = 20


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R11 over documents LEFT JOIN labels: the seven-column table plus row_id.

    Labels grow with the corpus, so no broadcast hint: AQE broadcasts it at run
    time when its measured size is under the threshold and sort-merges otherwise.
    """
    docs = text_table(spark, sf_dir, "documents", "doc_id", "doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic", "quality")
    return policy.label(docs.join(labels, "doc_id", "left"))


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit input: labelled with injected contract breaks (FIXTURES 3.2)."""
    lab = labelled(spark, sf_dir)
    rid = F.col("row_id")
    target = (
        F.when((F.col("action") == 1) & (rid % 5 == 0), F.col("source"))
        .when((F.col("action") == 0) & (rid % 50 == 3), F.concat(F.col("source"), F.lit(".")))
        .otherwise(F.col("target"))
    )
    tags = F.when(rid % 7 == 0, F.lit("clean")).otherwise(F.col("origin_tags"))
    return lab.select("row_id", "source", target.alias("target"), "action", "severity", "category", "reason", tags.alias("origin_tags"))


def contract_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 input: dirty rows with broken domains and formats injected."""
    d = dirty(spark, sf_dir)
    rid = F.col("row_id")
    return d.select(
        "row_id",
        F.when(rid % 59 == 0, F.lit(" ")).otherwise(F.col("source")).alias("source"),
        "target",
        F.when(rid % 37 == 0, F.lit(3)).otherwise(F.col("action")).cast("int").alias("action"),
        F.when(rid % 41 == 0, F.lit(7)).otherwise(F.col("severity")).cast("int").alias("severity"),
        F.when(rid % 43 == 0, F.lit("GENDER, SLUR"))
        .when(rid % 47 == 0, F.lit("POLITICAL/SLUR"))
        .otherwise(F.col("category"))
        .alias("category"),
        F.when(rid % 53 == 0, F.lit("no keywords given")).otherwise(F.col("reason")).alias("reason"),
        "origin_tags",
    )


def string_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F11 input: the seven columns as strings, some actions not integers."""
    d = dirty(spark, sf_dir)
    rid = F.col("row_id")
    act = (
        F.when(rid % 97 == 0, F.lit("x"))
        .when(rid % 89 == 0, F.lit(" 2 "))
        .when(rid % 83 == 0, F.lit("1.0"))
        .otherwise(F.col("action").cast("string"))
    )
    return d.select("row_id", "source", "target", act.alias("action"), F.col("severity").cast("string").alias("severity"), "category", "reason", "origin_tags")


def splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 stratified split of labelled by action (FIXTURES 3.3).

    The split reads its input a few times (bucket counts, boundary buckets,
    then the in-place labelling), so the labelled relation is written once to
    the checkpoint folder first - as a pipeline would keep it as a table - and
    the first two passes read two narrow columns of it."""
    return split.stratified_split(materialize(labelled(spark, sf_dir), "labelled"), "row_id", "action")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One screening reply per document (FIXTURES 3.4)."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    m = F.col("doc_id") % 6
    raw = (
        F.when(m == 0, F.lit("PASS | 1 | ok"))
        .when(m == 1, F.lit("PASS|5|high"))
        .when(m == 2, F.lit(" BLOCK | 4 | bad | extra"))
        .when(m == 3, F.lit("PASS | x | nan"))
        .when(m == 4, F.lit("PASS | 2"))
        .otherwise(F.lit("garbage"))
    )
    return d.select("doc_id", raw.alias("raw"))


def scored_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 input: responses where some calls failed (null) or returned nothing ('')."""
    r = responses(spark, sf_dir)
    m = F.col("doc_id") % 25
    return r.select("doc_id", F.when(m == 0, F.lit(None).cast("string")).when(m == 1, F.lit("")).otherwise(F.col("raw")).alias("raw"))


def batch_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One multi-line reply per batch of 20 rows (FIXTURES 3.5)."""
    lab = labelled(spark, sf_dir).select("row_id", "target")
    b = batch_id(lab, ["row_id"], BATCH)
    line = F.when(
        F.col("row_id") % 17 != 3,
        F.concat(F.lit("ID:"), F.col("row_id").cast("string"), F.lit(" | PASS | 2 | "), tx.one_line(F.col("target"))),
    )
    body = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col("row_id").alias("o"), line.alias("v")))), lambda s: s["v"]), "\n"
    )
    return b.groupBy("batch").agg(body.alias("_body")).select(
        "batch",
        F.concat(F.col("_body"), F.lit("\nnote: batch finished\nID:x | PASS | 2")).alias("raw"),
    )


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5-J8 'raw' side: every document in doc_id order."""
    return text_table(spark, sf_dir, "documents", "doc_id", "doc_id", "text")


def proc_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5-J8 'processed' side: the same rows with two consecutive rows lost."""
    return raw_rows(spark, sf_dir).filter(~F.col("doc_id").isin(120, 121))


def lossy_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 'processed' side of all gaps: of every 300 documents a run of 1 to 6 is
    lost (about one in a hundred), and one other document is edited."""
    of, block = F.col("doc_id") % 300, F.expr("doc_id div 300")
    start = 20 + (block * 83) % 200
    lost = (of >= start) & (of < start + 1 + block % 6)
    edited = F.when(of == 250, F.concat("text", F.lit(" [edited]"))).otherwise(F.col("text"))
    return raw_rows(spark, sf_dir).filter(~lost).withColumn("text", edited)


def policy_of(spark: SparkSession, sf_dir: str, key: str):
    """The benchmark item that serves as the policy of a key: all are used in turn."""
    n = table(spark, sf_dir, "benchmark").agg(F.count(F.lit(1)).alias("n"))
    return F.pmod(F.col(key), n.scalar())


def source_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 map: PURIFY sources -> 'fixed: <min row_id>' (FIXTURES 3.7)."""
    lab = labelled(spark, sf_dir).filter(F.col("action") == 2)
    return lab.groupBy(F.col("source").alias("key")).agg(
        F.concat(F.lit("fixed: "), F.min("row_id").cast("string")).alias("new_target")
    )


def target_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 map: PURIFY targets -> 'fixed: <min row_id>'."""
    lab = labelled(spark, sf_dir).filter(F.col("action") == 2)
    return lab.groupBy(F.col("target").alias("key")).agg(
        F.concat(F.lit("fixed: "), F.min("row_id").cast("string")).alias("new_target")
    )


def done_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Already processed: documents that have a label row (resume input)."""
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_id"))


def korean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns carrying one of the benign policy sentences each
    (sentence chosen by (conv_id * 31 + turn) mod 9; equi-join on the index)."""
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    schema = T.StructType(
        [T.StructField("k", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("expected", T.StringType())]
    )
    sent = spark.createDataFrame([(i, s, e) for i, (s, e) in enumerate(KOREAN_SENTENCES)], schema)
    k = ((F.col("conv_id") * 31 + F.col("turn")) % len(KOREAN_SENTENCES)).cast("int")
    return conv.withColumn("k", k).join(F.broadcast(sent), "k").drop("k")


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per labelled row a 3-class logit array and the action as label (FIXTURES 3.10)."""
    lab = labelled(spark, sf_dir).select("row_id", "action", "source", "target")
    rid = F.col("row_id")
    logits = F.array((rid % 7).cast("double"), (rid % 5).cast("double"), (rid % 3).cast("double"))
    return lab.select("row_id", F.col("action").alias("label"), logits.alias("logits"), "source", "target")
