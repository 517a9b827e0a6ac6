"""Edge rows for the reply parsers and policy rules."""

import pytest
from pyspark.sql import functions as F

from textguard.functions import parse, rules
from textguard.operators import audit, requests
from textguard.plans.fixtures import KOREAN_SENTENCES


def _verdict(spark, raw):
    df = spark.createDataFrame([(raw,)], "raw string")
    return tuple(df.select(parse.parse_verdict(F.col("raw")).alias("v")).select("v.*").first())


@pytest.mark.parametrize(
    "raw,want",
    [
        ("PASS | 1 | ok", ("PASS", 1, "ok")),
        ("PASS|2", ("PASS", 2, "N/A")),
        (" BLOCK | 4 | bad | extra", ("BLOCK", 4, "bad")),
        ("PASS | x | nan", ("ERROR", 5, "Parsing Failed")),
        ("PASS | 3.0 | float", ("ERROR", 5, "Parsing Failed")),
        ("garbage", ("ERROR", 5, "Parsing Failed")),
        ("", ("ERROR", 5, "Parsing Failed")),
        ("[PASS] | 1 | bracketed", ("[PASS]", 1, "bracketed")),
        ("PASS |\t2\t| tabbed \n", ("PASS", 2, "tabbed")),
    ],
)
def test_parse_verdict(spark, raw, want):
    assert _verdict(spark, raw) == want


def test_bracketed_pass_is_blocked(spark):
    from textguard.operators import curate

    df = spark.createDataFrame([("[PASS]", 1), ("PASS", 3), ("PASS", 4)], "decision string, score int")
    routes = [r.route for r in curate.safety_gate(df).collect()]
    assert routes == ["blocked", "passed", "blocked"]


def test_parse_batch_lines(spark):
    raw = "\n".join(
        [
            "ID:1 | PASS | 2 | ok text",
            "ID:2 | BLOCK | 5 | reason | extra | more",
            "note without pipes",
            "ID:3 | PASS | 2",
            "",
            "ID:x | PASS | 1 | bad id",
            "  ID:4|PASS|1|  spaced  ",
        ]
    )
    df = spark.createDataFrame([(0, raw)], "batch long, raw string")
    rows = [tuple(r) for r in requests.parse_batch(df, keep=("batch",)).select("id", "decision", "score", "target").collect()]
    assert rows == [(1, "PASS", "2", "ok text"), (2, "BLOCK", "5", "reason"), (None, "PASS", "1", "bad id"), (4, "PASS", "1", "spaced")]


def test_clean_reply_and_reason(spark):
    df = spark.createDataFrame([("[순화된 문장] [좋은 말입니다.] ", "[idiot, moron] -> purify")], "t string, r string")
    r = df.select(parse.clean_reply(F.col("t")).alias("c"), parse.reason_keywords(F.col("r")).alias("k"), parse.reason_rationale(F.col("r")).alias("w")).first()
    assert (r.c, r.k, r.w) == ("좋은 말입니다.", "idiot, moron", "purify")


def test_ending_rule_on_policy_sentences(spark):
    df = spark.createDataFrame([(s, e) for s, e in KOREAN_SENTENCES], "text string, expected string")
    got = df.select("expected", F.coalesce(rules.ending_rule(F.col("text")), F.lit("NORMAL")).alias("label")).collect()
    assert all(r.expected == r.label for r in got)
    assert len(got) == 9


def test_community_meme_ending(spark):
    df = spark.createDataFrame([("오늘은 좋은 날이기",), ("어디 가요?",)], "text string")
    assert [r.l for r in df.select(rules.ending_rule(F.col("text")).alias("l")).collect()] == ["COMMUNITY", None]


def test_structure_and_formal_ending(spark):
    df = spark.createDataFrame(
        [(1, "왜요?? 진짜!", "왜입니까?? 정말입니다!", 2), (2, "하나. 둘.", "하나 둘", 2)], "row_id long, source string, target string, action int"
    )
    s = {r.row_id: (r.sentences_kept, r.questions_kept, r.exclaims_kept) for r in audit.structure_check(df).collect()}
    assert s == {1: (True, True, True), 2: (False, True, True)}
    f = {r.row_id: r.formal for r in audit.formal_ending_check(df).collect()}
    assert f == {1: True, 2: False}


def test_meta_commentary_only_when_new(spark):
    df = spark.createDataFrame(
        [(1, "너 왜 그래", "왜 그러십니까? 안타깝습니다."), (2, "정말 안타깝습니다", "정말 안타깝습니다")], "row_id long, source string, target string"
    )
    assert [r.row_id for r in audit.meta_commentary_rows(df).collect()] == [1]


def test_lexicon_word_boundaries_are_ascii(spark):
    from textguard.functions import lexicon as lx

    df = spark.createDataFrame([("éidiot",), ("x_idiot",), ("日idiot",), ("Idiot IDIOT moron, idiotic",)], "t string")
    got = [(r.k, r.p) for r in df.select(lx.keywords(F.col("t")).alias("k"), lx.purify(F.col("t")).alias("p")).collect()]
    assert got == [(["idiot"], "éperson"), ([], "x_idiot"), (["idiot"], "日person"), (["idiot", "moron"], "person person person, idiotic")]
