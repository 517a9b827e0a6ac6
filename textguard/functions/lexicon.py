"""Lexicon matching and purification as JVM-side column expressions.

A small lexicon is folded into the plan: one alternation for matching and one
``regexp_replace`` per entry for rewriting, all inside whole-stage codegen.
Large lexicons (hundreds of entries and more) go through the token-join form in
``operators.policy.purify_by_join`` instead, which broadcasts only the lexicon.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Entry:
    word: str
    stem: str
    category: str


# ---------------------------------------------------------------------------
# The English insult lexicon of the test tables, in matching
# order (word -> neutral stem -> category). Keep verbatim and in this order.
# ---------------------------------------------------------------------------
DEFAULT_LEXICON = (
    Entry("idiot", "person", "SLUR"),
    Entry("moron", "person", "SLUR"),
    Entry("clown", "person", "COMMUNITY"),
    Entry("loser", "person", "COMMUNITY"),
    Entry("trash", "material", "SLUR"),
    Entry("scum", "group", "SLUR"),
    Entry("worthless", "limited", "SLUR"),
    Entry("pathetic", "weak", "COMMUNITY"),
    Entry("stupid", "unwise", "SLUR"),
    Entry("disgusting", "unpleasant", "SLUR"),
)


# Word boundaries are ASCII: a lexicon word glued to a letter outside [A-Za-z0-9_]
# (an accented letter, Hangul, CJK) still counts as a separate word. Java's \b
# (JDK 17) is Unicode-aware, so the JVM patterns spell the ASCII boundary out
# with look-arounds; the SQL twins use RE2's \b, which is ASCII. Same matches.
WB_LEFT = r"(?<![A-Za-z0-9_])"
WB_RIGHT = r"(?![A-Za-z0-9_])"


def quoted(word: str) -> str:
    """``word`` as a pattern for itself, for Java's and RE2's syntax."""
    return re.sub(r"([^\w\s])", r"\\\1", word)


def quoted_stem(stem: str) -> str:
    """``stem`` as a literal replacement of Java's regexp_replace."""
    return stem.replace("\\", "\\\\").replace("$", "\\$")


def lexicon_pattern(lexicon=DEFAULT_LEXICON) -> str:
    """Whole-word alternation over lower-cased text; group 1 is the hit.

    Callers lower-case first, so the pattern needs no case-insensitive flag
    (which makes the JVM matcher markedly slower on long texts).
    """
    return WB_LEFT + "(" + "|".join(quoted(e.word.lower()) for e in lexicon) + ")" + WB_RIGHT


def word_pattern(word: str) -> str:
    return r"(?i)" + WB_LEFT + quoted(word) + WB_RIGHT


def sql_lexicon_pattern(lexicon=DEFAULT_LEXICON) -> str:
    """RE2 twin of ``lexicon_pattern`` (ASCII \b)."""
    return r"\b(" + "|".join(e.word.lower() for e in lexicon) + r")\b"


def sql_word_pattern(word: str) -> str:
    return r"(?i)\b" + word + r"\b"


def _hits(text: Column, lexicon) -> Column:
    """All lexicon hits in order. A substring pre-check skips the regex for the
    (usual) text that contains no lexicon word at all; it cannot change results."""
    low = F.lower(text)
    maybe = None
    for e in lexicon:
        c = low.contains(e.word.lower())
        maybe = c if maybe is None else (maybe | c)
    hits = F.regexp_extract_all(low, F.lit(lexicon_pattern(lexicon)), F.lit(1))
    return F.when(maybe, hits).when(text.isNotNull(), F.array().cast("array<string>"))


def keywords(text: Column, lexicon=DEFAULT_LEXICON) -> Column:
    """Sorted distinct lexicon hits (lower case) in ``text``."""
    return F.sort_array(F.array_distinct(_hits(text, lexicon)))


def hit_count(text: Column, lexicon=DEFAULT_LEXICON) -> Column:
    """Number of (non-distinct) lexicon hits, as INT."""
    return F.size(_hits(text, lexicon))


def categories_of(kw: Column, lexicon=DEFAULT_LEXICON) -> Column:
    """Category string from a keyword array: sorted distinct tokens joined by '/', or NORMAL."""
    cat_map = F.create_map(*[x for w, e in {e.word.lower(): e for e in lexicon}.items() for x in (F.lit(w), F.lit(e.category))])
    cats = F.array_sort(F.array_distinct(F.transform(kw, lambda w: F.element_at(cat_map, w))))
    return F.when(F.size(kw) == 0, F.lit("NORMAL")).otherwise(F.array_join(cats, "/"))


def purify(text: Column, lexicon=DEFAULT_LEXICON) -> Column:
    """Replace each lexicon word by its neutral stem, whole words, any case."""
    out = text
    for e in lexicon:
        out = F.regexp_replace(out, word_pattern(e.word), quoted_stem(e.stem))
    return out


# Maximal runs of ASCII word characters and of everything else: concatenating
# the runs gives the text back, and a word run equals a lexicon word exactly when
# the word occurs with ASCII word boundaries.
TOKENS_RX = r"[A-Za-z0-9_]+|[^A-Za-z0-9_]+"


def token_runs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKENS_RX), F.lit(0))


def purify_by_map(text: Column, lexicon=DEFAULT_LEXICON) -> Column:
    """R5 for lexicons of thousands of entries: split into word / separator
    tokens, look each word up in a literal map (hash lookup, no regex per
    entry) and glue the tokens back. Still one map-side pass, no shuffle."""
    lex = F.create_map(*[x for w, e in {e.word.lower(): e for e in lexicon}.items() for x in (F.lit(w), F.lit(e.stem))])
    toks = token_runs(text)
    return F.array_join(F.transform(toks, lambda t: F.coalesce(F.element_at(lex, F.lower(t)), t)), "")


def squeeze(text: Column) -> Column:
    """Remove characters inserted inside words to dodge a filter (R7): keeps letters,
    digits and spaces, so 'i.d.i.o.t' and 'id-iot' become 'idiot'."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}\s]", "")
