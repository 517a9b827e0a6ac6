"""Quality rules with risk-controlled thresholds (native).

``measure`` computes word and line statistics of whole texts with SQL functions
only. ``calibrate`` finds, for every stratum and statistic, the cutoffs above
which a document may be rejected: going from the most lenient cutoff of a fixed
grid to stricter ones, a cutoff is certified while the exact binomial bound
says that more than ``risk / rules`` of the stratum's good documents would be
rejected by it with probability at most ``error / (strata * rules)`` - fixed
sequence testing along the grid, Bonferroni over strata and rules, so with
probability 1 - error no stratum loses more than ``risk`` of its good documents
(the rules' shares add up to it). Of the certified cutoffs the one with the best
balance of bad over good rejections is applied; a rule whose rejections are no
better than chance has none.

Scale: texts are read once and never shuffled; a text's windows are found
inside its row. The labelled holdout covers all labelled documents: counts per
(stratum, rule, grid step) are summed before the shuffle, and all that is
sequential runs on that table, whose size depends on the number of strata only.

Defined results: null and wordless texts have zero counts and fail the base
rules; a null stratum is one of its own; a stratum without enough labelled rows
certifies nothing and rejects by the base rules alone; label rows repeated for
one id count by their mean; repeated rows are judged one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textguard.llm.common import pin

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
#: Base rules: documents with fewer words, or a larger share (in percent) of repeated words, fail.
LEAST_WORDS, MOST_REPEATED = 50, 50

#: Rule -> value per document; larger is worse, null counts as 0.
RULES = {
    "symbols": "try_divide(n_symbols, word_chars)",
    "upper": "try_divide(n_upper, word_chars)",
    "repeated_words": "try_divide(n_repeat_words, n_words)",
    "repeated_lines": "try_divide(n_dup_lines, n_lines)",
}
#: Grid of cutoffs for every rule, the most lenient first.
STEPS = 40
GRID = [round(1 - i / STEPS, 4) for i in range(STEPS)]


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace the text by its counts: n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, n_upper, n_lines (all long)."""
    carried = [c for c in docs.columns if c != text]
    body = docs.select(*carried, F.coalesce(F.col(text), F.lit("")).alias("_t"))
    split = body.select("*", F.filter(F.split("_t", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("_w"), F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD)).alias("_l"))
    # Windows that occur again, by sorting (window, place) and looking at the neighbours; a
    # word is counted once however many such windows hold it: the places are passed in order.
    windows = "transform(sequence(0, size(_w) - 3), i -> struct(concat_ws(' ', _w[i], _w[i + 1], _w[i + 2]) as g, i as i))"
    repeated = F.expr(
        f"""CASE WHEN size(_w) < 4 THEN 0L ELSE
          transform(array(array_sort({windows})), s ->
            aggregate(
              array_sort(transform(filter(s, (x, k) -> x.g = get(s, k - 1).g OR x.g = get(s, k + 1).g), x -> x.i)),
              named_struct('n', 0L, 'end', 0),
              (a, p) -> named_struct('n', a.n + (p + 3 - greatest(a.end, p)), 'end', p + 3),
              a -> a.n))[0] END"""
    )
    return split.select(
        *carried,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"),
        F.regexp_count("_t", F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.size("_l").cast("long").alias("n_lines"),
    )


def base_failed() -> Column:
    """The base rules, on the columns of ``measure``."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _step(rule: str) -> Column:
    """Grid steps whose cutoff the document exceeds: 0 (none) .. STEPS (all).

    A document exceeds cutoff 1 - i/STEPS if its value is larger, so it is
    rejected by every step from the first such i on."""
    value = F.coalesce(F.expr(RULES[rule]).cast("double"), F.lit(0.0))
    return sum((value > c).cast("int") for c in GRID)


def _log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series of n + 8 (error below 1e-12), for any size of n."""
    z = n + 9.0
    series = (z - 0.5) * F.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * F.pow(z, F.lit(3))) + 1 / (1260 * F.pow(z, F.lit(5))) - 1 / (1680 * F.pow(z, F.lit(7)))
    product = n + 1.0
    for i in range(2, 9):
        product = product * (n + float(i))
    return series - F.log(product)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), exact to rounding.

    The largest term is taken in logarithms; the others follow by their ratio
    downwards from k, as far as they count (past 40 standard deviations below
    the mean the terms vanish in a double)."""
    q = 1 - p
    k, n = k.cast("double"), n.cast("double")
    top = F.exp(_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(q)))
    terms = F.least(k, F.ceil(40 * F.sqrt(n * p * q)) + 40).cast("int")
    ratios = F.aggregate(
        F.sequence(F.lit(0), terms),
        F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s")),
        lambda a, i: F.struct((a["t"] * F.greatest(k - i, F.lit(0.0)) / (n - k + i + 1.0) * (q / p)).alias("t"), (a["s"] + a["t"]).alias("s")),
        lambda a: a["s"],
    )
    # Above the mean the ratios grow without need: the tail is over one half there.
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(top * ratios, F.lit(1.0)))


def calibrate(measured: DataFrame, labels: DataFrame, strata: str, risk: float = 0.05, error: float = 0.05, key: str = "doc_id", label: str = "quality", cost: float = 20.0) -> DataFrame:
    """(stratum, steps map<rule, int>): the applied grid step of each rule.

    Documents that pass the base rules and have a label are the holdout. A rule
    of a stratum has an entry only if a cutoff is certified and rejects more
    than ``cost`` bad documents for every good one.
    """
    truth = labels.filter(F.col(label).isNotNull()).groupBy(key).agg((F.avg(label) >= 0.5).alias("good"))
    held = measured.filter(~base_failed()).join(truth, key)
    per_rule = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), _step(r).alias("step")) for r in RULES)))
    counts = (
        held.select(F.col(strata).alias("stratum"), "good", per_rule.alias("r")).groupBy("stratum", "r.rule", "r.step")
        .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    )
    # Everything below is on strata * rules * STEPS rows at most.
    grid = counts.groupBy("stratum", "rule").agg(F.sum("good").alias("n"), F.collect_list(F.struct("step", "good", "bad")).alias("c"))
    above = lambda side: F.expr(f"aggregate(filter(c, x -> x.step >= {STEPS} - i), 0L, (a, x) -> a + x.{side})")
    tested = grid.select("stratum", "rule", "n", "c", F.explode(F.sequence(F.lit(0), F.lit(STEPS - 1))).alias("i")).select("stratum", "rule", "n", "i", above("good").alias("k"), above("bad").alias("b"))
    tests = F.size(F.collect_set(F.struct("stratum")).over(Window.partitionBy(F.lit(1)))) * len(RULES)
    sure = tested.withColumn("ok", binomial_tail(F.col("k"), F.col("n"), risk / len(RULES)) <= F.lit(error) / tests)
    # Fixed sequence: all steps before must be certified too, ranked from the lenient end.
    chain = Window.partitionBy("stratum", "rule").orderBy("i")
    kept = sure.withColumn("all_ok", F.min("ok").over(chain)).filter("all_ok")
    best = kept.withColumn("gain", F.col("b") - cost * F.col("k")).groupBy("stratum", "rule").agg(F.max_by("i", F.struct("gain", -F.col("i"))).alias("i"), F.max("gain").alias("gain"))
    best = best.filter(F.col("gain") > 0)
    return best.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "i"))).alias("steps"))


def judge(measured: DataFrame, cutoffs: DataFrame, strata: str) -> DataFrame:
    """Add base_failed, rejected_by (rules whose certified cutoff is exceeded) and kept."""
    joined = measured.join(cutoffs.withColumnRenamed("stratum", "_s"), F.col(strata).eqNullSafe(F.col("_s")), "left")
    hits = F.array_compact(F.array(*(F.when(_step(r) >= STEPS - F.col("steps")[r], F.lit(r)) for r in RULES)))
    return (
        joined.withColumn("base_failed", base_failed()).withColumn("rejected_by", hits)
        .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).drop("_s", "steps")
    )


def apply_rules(docs: DataFrame, labels: DataFrame, strata: str = "lang", risk: float = 0.05, error: float = 0.05, key: str = "doc_id", carry=(), text: str = "text") -> DataFrame:
    """Measure, calibrate on the labelled rows among ``docs`` and judge all:
    (key, strata, *carry, counts, base_failed, rejected_by, kept)."""
    measured = pin(measure(docs.select(key, strata, *carry, text), text), "rules-measured")
    cutoffs = pin(calibrate(measured, labels, strata, risk, error, key), "rules-cutoffs")
    return judge(measured, cutoffs, strata)
