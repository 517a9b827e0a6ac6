"""Registered queries of the training-data operators: opN_<name>.

Each applies its operator, with production parameters, to its whole table and
returns the columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textguard.llm import alignment, ann, bpe, hard_negatives, language, packing, quality_model, quality_rules, sharding, simhash, token_counts, toxicity, warc
from textguard.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op2_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 40 shards on the ring; no spare room, so counts are
    at most one apart (law ``rows``)."""
    out = sharding.ring_shards(table(spark, sf_dir, "documents"), shards=40)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home")


@_query
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: 4-word shingles, links at 4 differing bits or fewer."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), max_bits=4, shingle=4)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


@_query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents; learnt from rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    forest = quality_model.train(docs, table(spark, sf_dir, "labels"))
    out = quality_model.score(docs, forest, keep=["doc_id"])
    return out.select("doc_id", quality_model.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of certified cutoffs per language."""
    out = quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by")


@_query
def op3_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    out = packing.pack(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline at the repository's top, all its stages."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


@_query
def op9_warc_index_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back over the index."""
    index = warc.write(table(spark, sf_dir, "pages"))
    out = warc.resolved(warc.read(index))
    return out.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


ORACLE["op9_warc_index_first"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     d AS (SELECT page_id, strlen(html) AS n, CAST(CAST(unhex(sha1(html)) AS BIT) AS VARCHAR) AS bits,
                  max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(list_sum(list_transform(range(5), lambda j: CAST(substr(bits, CAST(i * 5 + j + 1 AS BIGINT), 1) AS INTEGER) * (16 >> CAST(j AS INTEGER)))) AS INTEGER) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM d
"""


@_query
def op10_balanced_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of all embeddings for every hundredth one."""
    return ann.search(table(spark, sf_dir, "embeddings"), queries="id % 100 = 0")


@_query
def op6_chunk_reuse_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded with shared chunks, and decoded again."""
    out = bpe.decode(bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return out.select("doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@_query
def op8_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of all documents; learnt from rows that are not held out."""
    out = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"])
    return out.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query
def op1_offset_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of all documents, boundary tokens to where they start."""
    out = token_counts.count_tokens(table(spark, sf_dir, "documents"), rule="start")
    return out.withColumn("n_tokens", F.col("n_tokens").cast("long"))


@_query
def op11_arrow_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents aligned between the byte-level and the piece vocabulary."""
    out = alignment.alignment(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


@_query
def op12_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents; learnt from rows that are not held out."""
    out = language.identify(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score")


@_query
def op13_slot_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for every fiftieth embedding, labels of every seventh moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label")), anchors="id % 50 = 0")


ORACLE["op13_slot_hard_negatives"] = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
           FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
     p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
           QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
       n.id AS negative_id, p.positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
               AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
