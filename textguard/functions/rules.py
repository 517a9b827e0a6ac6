"""Labelling-policy rules as column expressions.

Regexes use only constructs that Java and RE2 treat alike (classes, anchors,
alternation, no look-around) so the same pattern runs in Spark and in SQL checks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textguard.schemas import BLOCK, NORMAL, PURIFY

# ---------------------------------------------------------------------------
# Fixed values (policy text; keep verbatim)
# ---------------------------------------------------------------------------
# Interrogatives that make a sentence-final '노' a dialect question (union of
# the v0.3-v0.5 lists and the words used in the policy examples).
INTERROGATIVES = ["뭐", "와", "왜", "언제", "어디", "어데", "누구", "누가", "어떻게", "우짜", "무슨"]
# Community meme endings.
COMMUNITY_ENDINGS = ["이기", "노데스웅"]
# Third-person / preachy phrases that must not appear in a target unless the
# source already has them.
META_PHRASES = ["안타깝습니다", "예의가 없군요", "반성하십시오", "응원합니다", "적절하지 않습니다", "분석됩니다"]
# Formal sentence endings expected on PURIFY targets.
FORMAL_ENDINGS = ["니다", "니까", "십시오", "요"]
# Severity bands.
SEVERITY_BANDS = [(0, 1, "harmless"), (2, 3, "abusive"), (4, 5, "extreme")]

ENDS_WITH_NO = r"노[?.! ]*$"
INTERROGATIVE_RX = r"(^|[ ])(" + "|".join(INTERROGATIVES) + ")"
COMMUNITY_END_RX = "(" + "|".join(COMMUNITY_ENDINGS) + r")[?.! ]*$"
META_RX = "(" + "|".join(META_PHRASES) + ")"
FORMAL_RX = "(" + "|".join(FORMAL_ENDINGS) + r")[.?!]*$"


def action_from_severity(severity: Column) -> Column:
    """>=4 BLOCK, >0 PURIFY, else NORMAL (INT)."""
    return (
        F.when(severity >= 4, F.lit(BLOCK))
        .when(severity >= 1, F.lit(PURIFY))
        .otherwise(F.lit(NORMAL))
        .cast("int")
    )


def ending_rule(text: Column) -> Column:
    """Label of a sentence by its ending.

    'NORMAL' for a dialect question (final 노 with an interrogative), 'COMMUNITY'
    for final 노 without one or a community meme ending, null when no rule applies.
    """
    t = F.btrim(text, F.lit(" \t\r\n"))
    no_end = t.rlike(ENDS_WITH_NO)
    has_q = t.rlike(INTERROGATIVE_RX)
    return (
        F.when(no_end & has_q, F.lit("NORMAL"))
        .when(no_end, F.lit("COMMUNITY"))
        .when(t.rlike(COMMUNITY_END_RX), F.lit("COMMUNITY"))
    )


def ending_action(text: Column) -> Column:
    """R4 as an action code: COMMUNITY -> PURIFY, otherwise NORMAL."""
    return F.when(ending_rule(text) == "COMMUNITY", F.lit(PURIFY)).otherwise(F.lit(NORMAL)).cast("int")


def meta_commentary(source: Column, target: Column) -> Column:
    """Target carries a preachy phrase the source does not."""
    return target.rlike(META_RX) & ~F.coalesce(source.rlike(META_RX), F.lit(False))


def formal_ending(text: Column) -> Column:
    """Text ends in a formal ending."""
    return F.btrim(text, F.lit(" \t\r\n")).rlike(FORMAL_RX)


def char_count(text: Column, ch: str) -> Column:
    """Occurrences of a single character, as INT."""
    return (F.length(text) - F.length(F.replace(text, F.lit(ch), F.lit("")))).cast("int")


def sentence_count(text: Column) -> Column:
    """Runs of terminal punctuation, as INT."""
    return F.size(F.regexp_extract_all(text, F.lit(r"[.?!]+"), F.lit(0))).cast("int")


def severity_band(severity: Column) -> Column:
    """X13."""
    expr = None
    for lo, hi, name in SEVERITY_BANDS:
        cond = severity.between(lo, hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def threshold_route(score: Column, rewritten: Column, original: Column, theta: float) -> Column:
    """rewrite only when the toxicity score reaches the threshold."""
    return F.when(score >= F.lit(theta), rewritten).otherwise(original)
