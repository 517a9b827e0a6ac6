"""Scalar text and array helpers (X1, X8-X11), built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textguard.schemas import LABEL_NAMES, MAX_TOKENS

# X1 comparison key: keep Hangul syllables, Latin letters and digits.
SANITIZE_RX = "[^가-힣a-zA-Z0-9]+"
KEEP_RX = "[가-힣a-zA-Z0-9]+"
# The historical class '0-0' keeps only the digit 0 (drops 1-9); opt-in compatibility.
SANITIZE_RX_STRICT_REFERENCE = "[^가-힣a-zA-Z0-0]+"
KEEP_RX_STRICT_REFERENCE = "[가-힣a-zA-Z0-0]+"

PAD = "[PAD]"


def sanitize(text: Column, strict_reference: bool = False) -> Column:
    """Comparison key that ignores punctuation, emoji and spacing.

    Same result as deleting every character outside the class; concatenating
    the runs inside it is about three times faster on the JVM."""
    keep = KEEP_RX_STRICT_REFERENCE if strict_reference else KEEP_RX
    return F.array_join(F.regexp_extract_all(text, F.lit(keep), F.lit(0)), "")


def one_line(text: Column) -> Column:
    """Line-safe text for line-aligned exports: CR/LF runs become one space."""
    return F.regexp_replace(text, r"[\r\n]+", " ")


def category_tokens(category: Column) -> Column:
    """X10: 'A/B', 'A, B' (older versions) -> sorted distinct token array."""
    toks = F.filter(F.split(F.btrim(category, F.lit(" ")), r"\s*[/,]\s*"), lambda t: F.length(t) > 0)
    return F.array_sort(F.array_distinct(toks))


def normalise_category(category: Column) -> Column:
    """Canonical '/'-joined category string."""
    return F.array_join(category_tokens(category), "/")


def tag_tokens(tags: Column) -> Column:
    """X11: origin tags split on ', ' only ('/' occurs inside tags)."""
    return F.split(tags, r",\s*")


def tokens(text: Column) -> Column:
    """Whitespace tokens of the trimmed text."""
    return F.split(F.btrim(text, F.lit(" \t\r\n")), r"\s+")


def pad_tokens(toks: Column, n: int = MAX_TOKENS, pad: str = PAD) -> Column:
    """Truncate to n, then right-pad with ``pad`` to exactly n."""
    head = F.slice(toks, 1, n)
    return F.concat(head, F.array_repeat(F.lit(pad), F.lit(n) - F.size(head)))


def attention_mask(toks: Column, n: int = MAX_TOKENS) -> Column:
    """1 for real tokens, 0 for padding."""
    real = F.least(F.size(toks), F.lit(n))
    return F.concat(F.array_repeat(F.lit(1), real), F.array_repeat(F.lit(0), F.lit(n) - real))


# ---------------------------------------------------------------------------
# Class scores
# ---------------------------------------------------------------------------
def softmax(logits: Column) -> Column:
    """Numerically stable softmax over an ARRAY<DOUBLE>."""
    m = F.array_max(logits)
    ex = F.transform(logits, lambda x: F.exp(x - m))
    total = F.aggregate(ex, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(ex, lambda x: x / total)


def argmax(values: Column) -> Column:
    """0-based index of the maximum (lowest index on ties), INT."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def confidence(probs: Column) -> Column:
    return F.array_max(probs)


def label_of(idx: Column) -> Column:
    names = F.array(*[F.lit(n) for n in LABEL_NAMES])
    return F.element_at(names, idx + 1)
