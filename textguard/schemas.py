"""Schemas and fixed policy values.

Everything under "Fixed values" must stay exactly as written: results are only
comparable with the labelling policy when these strings match it.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (policy constants; keep verbatim)
# ---------------------------------------------------------------------------
# Target written for every BLOCK row.
BLOCK_TARGET = "(차단된 문장입니다)"
# Action codes.
NORMAL, BLOCK, PURIFY = 0, 1, 2
ACTION_NAMES = {0: "NORMAL", 1: "BLOCK", 2: "PURIFY"}
# Verb used in the generated ``reason`` per action.
ACTION_VERBS = {0: "keep", 1: "block", 2: "purify"}
# Allowed category tokens per labelling-policy version.
CATEGORY_SETS = {
    "v0.1": ["GENDER", "RACISM", "SLUR", "RELIGION", "LGBTQ", "REGIONAL", "VIOLENCE", "AGE", "NORMAL"],
    "v0.2": ["GENDER", "LGBTQ", "RACISM", "REGIONAL", "AGE", "RELIGION", "INDIVIDUAL", "SLUR", "OTHERS", "NORMAL"],
    "v0.4": ["GENDER", "LGBTQ", "RACISM", "REGIONAL", "COMMUNITY", "AGE", "RELIGION", "SLUR", "NORMAL"],
    "v0.5": ["GENDER", "LGBTQ", "RACISM", "REGIONAL", "COMMUNITY", "AGE", "RELIGION", "SLUR", "NORMAL"],
}
# Tokens that occur in labelled data although no policy version lists them.
CATEGORY_SEEN_EXTRA = ["VIOLENCE", "POLITICAL", "OTHERS"]
# Request line and response formats of the batch scorer.
REQUEST_LINE = "ID:{id} | TEXT:{text}"
RESPONSE_FIELDS = ["id_info", "decision", "score", "target"]
# Verdict used when a screening reply cannot be parsed.
PARSE_FAILED = ("ERROR", 5, "Parsing Failed")
# Screening pass limit: PASS with score below this passes.
SAFETY_SCORE_LIMIT = 4
# Toxicity threshold for rewrite routing.
TOXICITY_THRESHOLD = 0.6
# Classifier label names by id.
LABEL_NAMES = ["NORMAL", "BLOCK", "PURIFY"]
# Classifier input length.
MAX_TOKENS = 128
# Audit evidence caps and preview length.
AUDIT_CAPS = {"clean": 10, "block": 5, "normal": 10}
AUDIT_PREVIEW_CHARS = 40

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------
LABELLED_COLUMNS = ["source", "target", "action", "severity", "category", "reason", "origin_tags"]

LABELLED = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("action", T.IntegerType()),
        T.StructField("severity", T.IntegerType()),
        T.StructField("category", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("origin_tags", T.StringType()),
    ]
)

# The same seven columns as read from a TSV before typing (all strings).
LABELLED_RAW = T.StructType([T.StructField(c, T.StringType()) for c in LABELLED_COLUMNS])

PAIRS = T.StructType([T.StructField("source", T.StringType()), T.StructField("target", T.StringType())])

VERDICT = T.StructType(
    [
        T.StructField("decision", T.StringType()),
        T.StructField("score", T.IntegerType()),
        T.StructField("reason", T.StringType()),
    ]
)

BATCH_RESULT = T.StructType([T.StructField(c, T.StringType()) for c in RESPONSE_FIELDS])

REFINE_RESULT = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("decision", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)
