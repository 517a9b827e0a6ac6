"""Automata against regular expressions, on large lexicons and on Hangul."""

import random
import re
import time

import numpy as np
import pytest

from conftest import SF_SMALL
from textguard.functions import automaton as ac
from textguard.functions import lexicon as lx
from textguard.operators import lexicons, policy

LEFT, RIGHT = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"
HANGUL = ["바보", "바보야", "멍청이", "쓰레기", "없다", "과자"]


def _lexicon(spark, words):
    return spark.createDataFrame([(w, f"<{i}>", f"C{i % 3}") for i, w in enumerate(words)], "word string, stem string, category string")


def _regex(words):
    """The whole-word alternation, longest words first."""
    return re.compile(f"{LEFT}({'|'.join(re.escape(w) for w in sorted(set(words), key=lambda w: (-len(w), w)))}){RIGHT}", re.ASCII | re.IGNORECASE)


def _words(rng, n):
    alphabet = "abcdefgh"
    made = {"".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 7))) for _ in range(n)}
    made |= {f"{a} {b}" for a, b in zip(sorted(made)[::7], sorted(made)[3::7])} | set(HANGUL) | {"".join(rng.choice("가나다라바보") for _ in range(rng.randrange(1, 5))) for _ in range(60)} | {"b-c", "d.e", "_f", "été"}
    return sorted(made)


def _texts(rng, words, n):
    glue = [" ", " ", ", ", "", "x", "_", "é", "한", "\n", "!", ".", " "]
    return ["".join(rng.choice([rng.choice(words), rng.choice(words).upper(), "none"]) + rng.choice(glue) for _ in range(rng.randrange(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("lane", [ac.LANE, 3])
def test_hits_of_a_large_lexicon_are_the_regular_expressions(spark, monkeypatch, lane):
    monkeypatch.setattr(ac, "LANE", lane)
    rng = random.Random(lane)
    words = _words(rng, 400)
    rx, stem = _regex(words), {w: f"<{i}>" for i, w in enumerate(words)}
    machine = ac.Automaton.build([np.frombuffer(w.encode(), np.uint8) for w in words], 256)
    for text in [*_texts(rng, words, 60), "", "바보", "바보야바보"]:
        data = np.frombuffer(text.encode(), np.uint8)
        got = ac.whole_words(machine, lexicons._lower_bytes(data), np.array([0, len(data)]), ac.is_word_symbol())
        ascii_lower = "".join(c.lower() if c.isascii() else c for c in text)
        want = [(m.start(1), m.group(1)) for m in rx.finditer(ascii_lower)]
        assert [(len(data[:s].tobytes().decode()), words[w]) for s, e, w in got] == want


def test_search_equals_regular_expressions(spark):
    rng = random.Random(9)
    words = _words(rng, 300)
    rx, stem = _regex(words), {w: f"<{i}>" for i, w in enumerate(words)}
    texts = [*_texts(rng, words, 120), None, "", "x" * 3000]
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "id long, text string, n_hits_before string").repartition(3)
    got = {r["id"]: r for r in lexicons.search(df, _lexicon(spark, words)).collect()}
    for i, t in enumerate(texts):
        low = "".join(c.lower() if c.isascii() else c for c in t or "")
        hits = [m.group(1) for m in rx.finditer(low)]
        assert got[i]["keywords"] == sorted(set(hits)) and got[i]["n_hits"] == len(hits) and got[i]["n_hits_before"] == "kept"
        spans = [(m.start(1), m.end(1), stem[m.group(1)]) for m in rx.finditer(low)]
        want, at = "", 0
        for s, e, x in spans:
            want, at = want + (t or "")[at:s] + x, e
        assert got[i]["purified"] == (None if t is None else want + t[at:])


def test_equals_the_other_paths_on_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    lex = spark.createDataFrame([(e.word, e.stem, e.category) for e in lx.DEFAULT_LEXICON], "word string, stem string, category string")
    got = lexicons.search(docs, lex)
    want = policy.lexicon_features(policy.purify_text(docs, "text"), "text").select("doc_id", "kw", "n_hits", "categories", "purified")
    assert got.select("doc_id", "keywords", "n_hits", "categories", "purified").exceptAll(want).count() == 0


def test_cost_does_not_grow_with_the_lexicon():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(4, 9)))
    text = np.frombuffer(" ".join(word() for _ in range(150_000)).encode(), np.uint8)
    took = []
    for n in (50, 20_000):
        machine = ac.Automaton.build([np.frombuffer(word().encode(), np.uint8) for _ in range(n)], 256)
        times = []
        for _ in range(3):
            began = time.perf_counter()
            machine.states_with_words(text)
            times.append(time.perf_counter() - began)
        took.append(min(times))
    assert took[1] < 8 * took[0]  # 400 times the words: only the table's place in the caches differs


# --------------------------------------------------------------------------- obfuscation
def _spelling(text):
    """(symbol, place) pairs of a text, character by character."""
    import unicodedata

    out = []
    for at, c in enumerate(text):
        if not (unicodedata.category(c)[0] in "LN" or c in " \t\n\x0b\x0c\r"):
            continue
        if "가" <= c <= "힣":
            i, rest = divmod(ord(c) - 0xAC00, 588)
            j, k = divmod(rest, 28)
            parts = ac.INITIALS[i] + ac.VOWELS[j] + (ac.FINALS[k - 1] if k else "")
        else:
            parts = dict(zip(ac.COMPOUNDS.split(), ac.PARTS.split())).get(c, c.lower() if c.isascii() else c)
        out += [(p, at) for p in parts]
    return out


def _brute(text, words):
    """Hits of obfuscated words: (first place, place past the last one, word)."""
    spelt = _spelling(text)
    symbols = [s for s, _ in spelt]
    out, i = [], 0
    while i < len(spelt):
        best = None
        for w in words:
            s = [x for x, _ in _spelling(w)]
            j = i + len(s)
            if s and symbols[i:j] == s:
                whole = (i == 0 or spelt[i - 1][1] != spelt[i][1]) and (j == len(spelt) or spelt[j][1] != spelt[j - 1][1])
                glued = (i > 0 and re.match("[A-Za-z0-9_]", symbols[i - 1])) or (j < len(spelt) and re.match("[A-Za-z0-9_]", symbols[j]))
                if whole and not glued and (best is None or j > best[0]):
                    best = (j, w)
        if best:
            out.append((spelt[i][1], spelt[best[0] - 1][1] + 1, best[1]))
            i = best[0]
        else:
            i += 1
    return out


def test_obfuscated_words_are_replaced_in_place(spark):
    words = ["idiot", "trash", "trash can", *HANGUL]
    cases = {
        "you i.d.i.o.t!": "you <0>!", "id-iot and TR*ASH": "<0> and <1>", "ㅂㅏㅂㅗ 아님": "<3> 아님", "바.보 밥ㅗ": "<3> <3>", "바봉 바보": "바봉 <3>",
        "ㅇㅓㅂㅅㄷㅏ 없~다": "<7> <7>", "ㄱㅗㅏ자 ㄱㅘㅈㅏ": "<8> <8>", "semi-idiot": "semi-idiot", "t.r.a.s.h c.a.n": "<2>", "": "", "...": "...", "바보야": "<4>", "멍-청_이": "<5>",
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*cases, None])], "id long, text string").repartition(2)
    got = {r["id"]: r for r in lexicons.search(df, _lexicon(spark, words), obfuscated=True).collect()}
    assert [got[i]["purified"] for i in range(len(cases))] == list(cases.values()) and got[len(cases)]["purified"] is None


def test_obfuscation_equals_brute_force(spark):
    rng = random.Random(3)
    words = ["idiot", "a b", "ab", "abc", *HANGUL, "가나", "나", "각"]
    pieces = [*words, "ㄱ", "ㅏ", "ㄴㅏ", "밥", "ㅗ", ".", "-", "!", " ", " ", "x", "é", "B", "_", "\U0001f600", "간", "ㅄ", "ㄷ"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(0, 25))) for _ in range(300)]
    stem = {w: f"<{i}>" for i, w in enumerate(words)}
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(2)
    got = {r["id"]: r for r in lexicons.search(df, _lexicon(spark, words), obfuscated=True).collect()}
    for i, t in enumerate(texts):
        hits = _brute(t, words)
        want, at = "", 0
        for s, e, w in hits:
            want, at = want + t[at:s] + stem[w], e
        assert (got[i]["purified"], got[i]["n_hits"]) == (want + t[at:], len(hits)), t


def test_lexicon_bounds(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a b")], "id long, text string")
    assert lexicons.search(df, _lexicon(spark, [])).first()["purified"] == "a b"
    assert lexicons.search(df, _lexicon(spark, ["", "b"])).first()["purified"] == "a <1>"
    monkeypatch.setattr(lexicons, "MOST_WORDS", 1)
    with pytest.raises(ValueError, match="more than 1 words"):
        lexicons.search(df, _lexicon(spark, ["a", "b"]))
    monkeypatch.setattr(ac, "MOST_CELLS", 3)
    with pytest.raises(ValueError, match="cells"):
        ac.Automaton.build([np.frombuffer(b"abc", np.uint8)], 256)


def test_obfuscated_texts_are_folded_a_little_at_a_time(spark, monkeypatch):
    """What a task holds for a batch doesn't follow the batch's bytes."""
    import tracemalloc

    from textguard.operators import lexicons

    df = spark.range(60).selectExpr("id", "case when id = 7 then null else concat(repeat('some words here ', 6000), 'i-d.i*o t', id) end as text")
    lex = spark.createDataFrame([("idiot", "person", "SLUR")], "word string, stem string, category string")
    kept, run_as = {}, type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, fn, schema: kept.update(fn=fn, read=self) or run_as(self, fn, schema))
    lexicons.search(df, lex, obfuscated=True)
    batches = kept["read"].toArrow().to_batches()
    list(kept["fn"](batches[:0]))  # the tables of a worker
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in kept["fn"](iter(batches)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 60 and peak < 200 << 20
