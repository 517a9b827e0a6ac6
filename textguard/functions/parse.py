"""Parsers for scorer replies and encoded columns (X3-X7, X12), all JVM-side.

Python's ``str.strip()`` is modelled as ``btrim`` with an explicit whitespace
set; ``int()`` as ``try_cast`` (ANSI casts would raise); list indexing as
``try_element_at`` (a missing field is null, not an error).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textguard.schemas import PARSE_FAILED

WS = " \t\r\n"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WS))


def field(parts: Column, i: int) -> Column:
    """1-based field of a split array, null when absent."""
    return F.try_element_at(parts, F.lit(i))


def parse_verdict(raw: Column) -> Column:
    """X3: 'DECISION | score | reason' -> struct(decision, score, reason).

    Fields are trimmed; score must be an integer; a missing reason is 'N/A';
    any failure (no second field, non-integer score) gives ERROR / 5 / 'Parsing Failed'.
    """
    parts = F.split(raw, r"\|")
    score = strip(field(parts, 2)).try_cast("int")
    ok = score.isNotNull()
    err_d, err_s, err_r = PARSE_FAILED
    return F.struct(
        F.when(ok, strip(field(parts, 1))).otherwise(F.lit(err_d)).alias("decision"),
        F.when(ok, score).otherwise(F.lit(err_s)).alias("score"),
        F.when(ok, F.coalesce(strip(field(parts, 3)), F.lit("N/A"))).otherwise(F.lit(err_r)).alias("reason"),
    )


def reply_lines(raw: Column) -> Column:
    """X4 (first half): the lines of a batch reply that can carry a record."""
    return F.filter(F.split(raw, "\n"), lambda line: line.contains("|") & (F.size(F.split(line, r"\|")) >= 4))


def line_fields(line: Column) -> Column:
    """X4 (second half): first four '|' fields trimmed, extras dropped."""
    parts = F.split(line, r"\|")
    return F.struct(
        strip(field(parts, 1)).alias("id_info"),
        strip(field(parts, 2)).alias("decision"),
        strip(field(parts, 3)).alias("score"),
        strip(field(parts, 4)).alias("target"),
    )


def parse_id(id_info: Column) -> Column:
    """X5: 'ID:n' -> n (BIGINT), null when malformed."""
    return strip(field(F.split(id_info, ":"), 2)).try_cast("bigint")


def clean_reply(text: Column) -> Column:
    """Drop the '[순화된 문장]' label and brackets, then strip."""
    t = F.replace(text, F.lit("[순화된 문장]"), F.lit(""))
    t = F.replace(t, F.lit("["), F.lit(""))
    t = F.replace(t, F.lit("]"), F.lit(""))
    return strip(t)


def request_line(row_id: Column, text: Column) -> Column:
    """X7: 'ID:{i} | TEXT:{t}'."""
    return F.concat(F.lit("ID:"), row_id.cast("string"), F.lit(" | TEXT:"), text)


REASON_RX = r"^\[(.+?)\] -> (.+)$"


def reason_keywords(reason: Column) -> Column:
    """Keyword part of '[k1, k2] -> rationale' ('' when malformed)."""
    return F.regexp_extract(reason, REASON_RX, 1)


def reason_rationale(reason: Column) -> Column:
    return F.regexp_extract(reason, REASON_RX, 2)
