"""Contract audit over the seven-column table.

Every audit is a single scan: rules are conditional aggregates or an array of
per-row violations exploded once, never a union of one scan per rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textguard.functions import parse, rules
from textguard.functions import text as tx
from textguard.schemas import AUDIT_CAPS, AUDIT_PREVIEW_CHARS, BLOCK, BLOCK_TARGET, CATEGORY_SETS, NORMAL


def _rule_flags() -> dict[str, Column]:
    action, tags = F.col("action"), F.col("origin_tags")
    return {
        "clean": (action != NORMAL) & (parse.strip(tags) == "clean"),
        "block": (action == BLOCK) & ~F.col("target").eqNullSafe(F.lit(BLOCK_TARGET)),
        "normal": (action == NORMAL) & ~F.col("target").eqNullSafe(F.col("source")),
    }


def audit_counts(df: DataFrame) -> DataFrame:
    """A3: toxic rows tagged exactly 'clean'; BLOCK target not the block message;
    NORMAL target differing from source. One aggregate, three counters."""
    f = _rule_flags()
    return df.agg(
        F.count_if(F.coalesce(f["clean"], F.lit(False))).alias("n_toxic_clean"),
        F.count_if(F.coalesce(f["block"], F.lit(False))).alias("n_block_mismatch"),
        F.count_if(F.coalesce(f["normal"], F.lit(False))).alias("n_normal_mismatch"),
    )


def audit_samples(df: DataFrame, order_col: str = "row_id", caps: dict[str, int] = AUDIT_CAPS) -> DataFrame:
    """The first ``cap`` violating rows per rule with a 40-character preview.

    ``row_number() <= cap`` over a partition per rule lets Spark insert a
    partial per-partition limit before the shuffle, so at most cap rows per map
    partition and rule are ever exchanged.
    """
    f = _rule_flags()
    rule = F.explode(
        F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in f.items()]), lambda x: x.isNotNull())
    )
    v = df.select(F.col(order_col), F.col("source"), rule.alias("rule"))
    cap = F.element_at(F.create_map(*[x for k, n in caps.items() for x in (F.lit(k), F.lit(n))]), F.col("rule"))
    rn = F.row_number().over(Window.partitionBy("rule").orderBy(order_col))
    return (
        v.withColumn("rn", rn)
        .filter(F.col("rn") <= max(caps.values()))  # literal bound: enables the pre-shuffle group limit
        .filter(F.col("rn") <= cap)
        .select("rule", F.col(order_col), F.substring("source", 1, AUDIT_PREVIEW_CHARS).alias("preview"), F.col("rn").cast("int").alias("rn"))
    )


def contract_violations(df: DataFrame, version: str = "v0.5", extra_categories=(), order_col: str = "row_id") -> DataFrame:
    """R1 (+R2 as a warning): one row per (row, broken rule) from one scan.

    Rules: action in {0,1,2}; severity in 0..5; category tokens within the
    version's set; reason shaped '[...] -> ...'; non-empty source; NORMAL keeps
    source (warn - older policy versions allowed grammar fixes).
    """
    allowed = F.array(*[F.lit(c) for c in list(CATEGORY_SETS[version]) + list(extra_categories)])
    toks = tx.category_tokens(F.coalesce(F.col("category"), F.lit("")))
    unknown = F.array_except(toks, allowed)
    checks = [
        ("action_domain", "error", ~F.col("action").isin(0, 1, 2) | F.col("action").isNull(), F.col("action").cast("string")),
        ("severity_domain", "error", ~F.col("severity").between(0, 5) | F.col("severity").isNull(), F.col("severity").cast("string")),
        ("category_domain", "error", (F.size(toks) == 0) | (F.size(unknown) > 0), F.array_join(unknown, "/")),
        ("reason_format", "error", ~F.coalesce(F.col("reason").rlike(parse.REASON_RX), F.lit(False)), F.substring("reason", 1, 40)),
        ("empty_source", "error", F.length(F.coalesce(parse.strip(F.col("source")), F.lit(""))) == 0, F.lit("")),
        ("normal_changed", "warn", (F.col("action") == NORMAL) & ~F.col("target").eqNullSafe(F.col("source")), F.lit("")),
    ]
    viol = F.filter(
        F.array(
            *[
                F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(name).alias("rule"), F.lit(sev).alias("severity"), detail.alias("detail")))
                for name, sev, cond, detail in checks
            ]
        ),
        lambda x: x.isNotNull(),
    )
    return df.select(F.col(order_col), F.explode(viol).alias("v")).select(
        order_col, F.col("v.rule").alias("rule"), F.col("v.severity").alias("level"), F.col("v.detail").alias("detail")
    )


def normal_keeps_source(df: DataFrame, order_col: str = "row_id") -> DataFrame:
    """R2: NORMAL rows whose target differs from the source."""
    bad = (F.col("action") == NORMAL) & ~F.col("target").eqNullSafe(F.col("source"))
    return df.filter(bad).select(order_col, F.lit("warn").alias("level"))


def meta_commentary_rows(df: DataFrame, order_col: str = "row_id") -> DataFrame:
    """Targets with preachy third-person phrases absent from their source."""
    return df.filter(F.coalesce(rules.meta_commentary(F.col("source"), F.col("target")), F.lit(False))).select(
        order_col, F.regexp_extract("target", rules.META_RX, 1).alias("phrase")
    )


def structure_check(df: DataFrame, order_col: str = "row_id") -> DataFrame:
    """Sentence count and '?'/'!' counts preserved per (source, target) pair."""
    s, t = F.col("source"), F.col("target")
    return df.select(
        order_col,
        (rules.sentence_count(s) == rules.sentence_count(t)).alias("sentences_kept"),
        (rules.char_count(s, "?") == rules.char_count(t, "?")).alias("questions_kept"),
        (rules.char_count(s, "!") == rules.char_count(t, "!")).alias("exclaims_kept"),
    )


def formal_ending_check(df: DataFrame, order_col: str = "row_id", text: str = "target") -> DataFrame:
    """Whether each PURIFY target ends formally."""
    return df.filter(F.col("action") == 2).select(order_col, rules.formal_ending(F.col(text)).alias("formal"))


def tag_integrity(df: DataFrame, raw: DataFrame, on: str = "source", tags: str = "origin_tags") -> DataFrame:
    """Rows whose tags differ from every raw record with the same source.

    The raw side is first reduced to one row per source with its set of tags
    (partial aggregation; the set holds distinct tag strings only), so a source
    repeated many times never multiplies rows in the join.
    """
    digest = lambda c: F.unhex(F.md5(c.cast("string")))  # noqa: E731 - group and join key: no text is shuffled as one
    raw_tags = raw.groupBy(digest(F.col(on)).alias("_src")).agg(F.collect_set(tags).alias("_raw_tags"))
    j = df.join(raw_tags, digest(df[on]) == raw_tags["_src"], "inner")
    bad = ~F.array_contains(F.col("_raw_tags"), F.col(tags)) | F.col(tags).isNull()
    return j.filter(bad).select(*df.columns, F.array_join(F.array_sort("_raw_tags"), " | ").alias("raw_tags"))


def leakage(df: DataFrame, key: str = "source", split: str = "split") -> DataFrame:
    """Keys that occur in more than one split (empty = no leakage).

    The set of splits per key is a partial aggregate bounded by the number of
    splits, on 128-bit digests; only the keys found to leak are fetched as text."""
    digest = F.coalesce(F.unhex(F.md5(F.col(key).cast("string"))), F.lit(b""))
    per_key = df.groupBy(digest.alias("_d")).agg(F.size(F.collect_set(split)).cast("int").alias("n_splits"), F.count(F.lit(1)).alias("n_rows"))
    leaked = per_key.filter(F.col("n_splits") > 1)
    texts = df.select(digest.alias("_d"), key).join(leaked, "_d").groupBy("_d").agg(F.first(key).alias(key), F.first("n_splits").alias("n_splits"), F.first("n_rows").alias("n_rows"))
    return texts.select(key, "n_splits", "n_rows")


def split_counts(df: DataFrame, split: str = "split", by=()) -> DataFrame:
    """A5: rows per split (optionally per split and another column)."""
    return df.groupBy(split, *by).agg(F.count(F.lit(1)).alias("n"))


def label_distribution(df: DataFrame) -> DataFrame:
    """A10: counts by action, severity x action, category token and origin tag in one pass.

    Each row emits one (dimension, value) pair per dimension; a single grouped
    count with map-side partial aggregation gives all four distributions.
    """
    pairs = F.array(
        F.array(F.struct(F.lit("action").alias("dim"), F.col("action").cast("string").alias("value"))),
        F.array(
            F.struct(
                F.lit("severity_action").alias("dim"),
                F.concat(F.col("severity").cast("string"), F.lit(":"), F.col("action").cast("string")).alias("value"),
            )
        ),
        F.transform(tx.category_tokens(F.col("category")), lambda t: F.struct(F.lit("category").alias("dim"), t.alias("value"))),
        F.transform(tx.tag_tokens(F.col("origin_tags")), lambda t: F.struct(F.lit("tag").alias("dim"), t.alias("value"))),
    )
    return (
        df.select(F.explode(F.flatten(pairs)).alias("p"))
        .groupBy(F.col("p.dim").alias("dim"), F.col("p.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
