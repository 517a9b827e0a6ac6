"""Rule labeller (R11) and lexicon operators (R5, R6) over DataFrames.

``label`` turns free text into the seven-column labelled relation in one
narrow (map-only) pass: no shuffle is needed beyond whatever join produced the
input, so it scales with the number of input partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textguard.functions import lexicon as lx
from textguard.functions import rules
from textguard.schemas import ACTION_VERBS, BLOCK, BLOCK_TARGET, PURIFY, TOXICITY_THRESHOLD


def evaluate_once(c: Column) -> Column:
    """Wrap a costly expression in a no-op that depends on the partition id.

    The projection holding it becomes nondeterministic, so Catalyst neither
    pushes filters below it nor inlines it into several places; the
    expression is computed once per row where it is defined."""
    return F.when(F.spark_partition_id() >= 0, c)


def origin_tags(toxic: Column, quality: Column) -> Column:
    """Provenance tags from the toxic/quality flags of the source record."""
    return (
        F.when(toxic.isNull(), F.lit("unlabelled"))
        .when(toxic == 0, F.lit("clean"))
        .when(quality == 1, F.lit("abuse"))
        .otherwise(F.lit("abuse, low_quality"))
    )


def reason_text(kw: Column, action: Column) -> Column:
    """'[kw1, kw2] -> verb' (the policy's `[keywords] -> rationale` format)."""
    words = F.when(F.size(kw) == 0, F.lit("none")).otherwise(F.array_join(kw, ", "))
    verb = F.when(action == BLOCK, F.lit(ACTION_VERBS[1])).when(action == PURIFY, F.lit(ACTION_VERBS[2])).otherwise(
        F.lit(ACTION_VERBS[0])
    )
    return F.concat(F.lit("["), words, F.lit("] -> "), verb)


def lexicon_features(df: DataFrame, text_col: str = "text", lexicon=lx.DEFAULT_LEXICON) -> DataFrame:
    """Keyword array, distinct hit count, total hit count and categories."""
    kw = lx.keywords(F.col(text_col), lexicon)
    return (
        df.withColumn("kw", kw)
        .withColumn("n_distinct", F.size("kw").cast("int"))
        .withColumn("n_hits", lx.hit_count(F.col(text_col), lexicon).cast("int"))
        .withColumn("categories", lx.categories_of(F.col("kw"), lexicon))
    )


def label(
    df: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    toxic_col: str | None = "toxic",
    quality_col: str | None = "quality",
    lexicon=lx.DEFAULT_LEXICON,
    squeeze_first: bool = False,
) -> DataFrame:
    """Text -> (row_id, source, target, action, severity, category, reason, origin_tags).

    severity = number of distinct lexicon hits capped at 5; action by R3; target
    is the BLOCK constant, the purified text (R5) or the text unchanged.
    ``squeeze_first`` matches on the R7-squeezed text (obfuscation resistant).
    """
    text = F.col(text_col)
    match_on = lx.squeeze(text) if squeeze_first else text
    # Evaluate the keyword array once per row. Without the barrier, a later
    # filter on action/target/category would be pushed below this projection
    # with the regex inlined once per reference (filters get no common
    # subexpression elimination), multiplying the costliest work of the job.
    # A null text has no words.
    kw = evaluate_once(F.coalesce(lx.keywords(match_on, lexicon), F.array().cast("array<string>")))
    toxic = F.col(toxic_col) if toxic_col else F.lit(None).cast("int")
    quality = F.col(quality_col) if quality_col else F.lit(None).cast("int")
    base = df.select(
        F.col(id_col).alias("row_id"),
        text.alias("source"),
        kw.alias("_kw"),
        toxic.alias("_toxic"),
        quality.alias("_quality"),
    )
    sev = F.least(F.lit(5), F.size("_kw")).cast("int")
    base = base.withColumn("severity", sev).withColumn("action", rules.action_from_severity(F.col("severity")))
    target = (
        F.when(F.col("action") == BLOCK, F.lit(BLOCK_TARGET))
        .when(F.col("action") == PURIFY, lx.purify(F.col("source"), lexicon))
        .otherwise(F.col("source"))
    )
    return base.select(
        "row_id",
        "source",
        target.alias("target"),
        "action",
        "severity",
        lx.categories_of(F.col("_kw"), lexicon).alias("category"),
        reason_text(F.col("_kw"), F.col("action")).alias("reason"),
        origin_tags(F.col("_toxic"), F.col("_quality")).alias("origin_tags"),
    )


def route(labelled: DataFrame, theta: float = TOXICITY_THRESHOLD, toxicity: Column | None = None) -> DataFrame:
    """F12 on R11: add toxicity, route and output to labelled rows.

    ``toxicity`` is a probability (a classifier's, say); by default that of the
    rules, s / (s + 1) for severity s. A message whose action is BLOCK is
    ``blocked`` and gives the blocking sentence; from ``theta`` on it is
    ``rewritten`` and gives its target; below, it is ``passed`` as it came,
    whatever words it holds."""
    score = F.col("severity") / (F.col("severity") + F.lit(1.0)) if toxicity is None else toxicity
    out = labelled.withColumn("toxicity", evaluate_once(score.cast("double")))
    name = F.when(F.col("action") == BLOCK, F.lit("blocked")).otherwise(rules.threshold_route(F.col("toxicity"), F.lit("rewritten"), F.lit("passed"), theta))
    text = F.when(F.col("action") == BLOCK, F.col("target")).otherwise(rules.threshold_route(F.col("toxicity"), F.col("target"), F.col("source"), theta))
    return out.withColumns({"route": name, "output": text})


def purify_text(df: DataFrame, text_col: str, out_col: str = "purified", lexicon=lx.DEFAULT_LEXICON) -> DataFrame:
    """R5 as a column-adding operator."""
    return df.withColumn(out_col, lx.purify(F.col(text_col), lexicon))


def purify_by_join(df: DataFrame, id_col: str, text_col: str, lexicon_df: DataFrame, out_col: str = "purified") -> DataFrame:
    """R5 for a lexicon too large to fold into the plan (millions of entries).

    Tokens (words and separators, positions kept) are matched against the
    lexicon ``(word, stem)`` with an equi-join - AQE broadcasts the lexicon when
    it is small enough and splits skewed token partitions otherwise. Only the
    hits travel further: per document a small ``position -> stem`` map, joined
    back by id and applied to the same token array. Documents without a hit
    keep their text; no document's tokens are ever gathered in a shuffle.
    """
    toks = lx.token_runs(F.col(text_col))
    tokens = df.select(F.col(id_col).alias("_id"), F.posexplode(toks).alias("_pos", "_tok"))
    # One stem for a word however it is capitalised; words with two stems are refused.
    # No hint: the planner broadcasts the lexicon if its bytes allow it.
    conflict = F.raise_error(F.concat(F.lit("conflicting stems for "), F.col("_w"))).cast("string")
    lex = lexicon_df.groupBy(F.lower("word").alias("_w")).agg(F.min("stem").alias("_stem"), F.max("stem").alias("_other"))
    lex = lex.select("_w", F.when(F.col("_stem") == F.col("_other"), F.col("_stem")).otherwise(conflict).alias("_stem"))
    hits = tokens.join(lex, F.lower(F.col("_tok")) == F.col("_w"), "inner")
    fixes = hits.groupBy("_id").agg(F.map_from_entries(F.collect_list(F.struct("_pos", "_stem"))).alias("_fix"))
    rebuilt = F.array_join(F.transform(toks, lambda t, i: F.coalesce(F.element_at(F.col("_fix"), i), t)), "")
    out = df.join(fixes, F.col(id_col) == F.col("_id"), "left")
    return out.withColumn(out_col, F.when(F.col("_fix").isNull(), F.col(text_col)).otherwise(rebuilt)).drop("_id", "_fix")
