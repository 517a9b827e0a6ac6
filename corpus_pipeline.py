"""Corpus pipeline: quality classifier, quality rules, SimHash near-dedup, packing.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns a DataFrame; it is written as Parquet and read back as the
next stage's ``docs``. All stages but the last return the columns of
``documents``, unchanged; the last returns the packed pieces.

The rules write their counts beside the document, so what they keep is a filter
of that table. Near-dedup decides on a narrow table of row keys and then keeps
those rows; a row's key is made of its file and its place there, however the
files are split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textguard.llm import packing, quality_model, quality_rules, simhash
from textguard.llm.common import fresh, numbered, pin, table

#: SQL can't express the classifier, XXH64 fingerprints or tokenizers: see tests/llm.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose score is below one half."""
    forest = quality_model.train(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "score")
    return quality_model.score(docs, forest, out=score).filter(F.col(score) >= 0.5).drop(score)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the base rules or a certified cutoff reject."""
    whole = docs.select("doc_id", "lang", "text", F.struct(*(F.col(c) for c in docs.columns)).alias("document"))
    judged = quality_rules.apply_rules(whole, table(spark, sf_dir, "labels"), carry=["document"])
    return judged.filter("kept").select("document.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of every group of near-duplicates the document with the smallest
    doc_id (null ids last; of repeated rows of that document, any one)."""
    row = fresh(docs, "row")
    rows = numbered(docs, row)
    found = simhash.near_duplicates(rows, max_bits=4, shingle=4, carry=[row])
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", row)).alias("first"))
    kept = pin(first.select(F.col("first")[row].alias(row)), "near-dedup-kept")
    # The same join at every size: the rows kept grow with the documents.
    return rows.join(kept.hint("merge"), row, "left_semi").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents left, in sequences of 2048 tokens."""
    out = packing.pack(docs)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality_classifier", quality_classifier), ("quality_rules", rules), ("simhash_near_dedup", near_dedup), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
