"""Every registered query of this subpackage on a driver table: its columns, its
rows, and what it says of every row, recomputed from the texts."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from textguard.llm import queries

from .test_small_tables import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"
BIG, INT, TEXT, REAL, FLAG = "bigint", "int", "string", "double", "boolean"
CONTRACTS = {
    "op2": dict(doc_id=BIG, size=BIG, text_crc32=BIG, law=TEXT, shard=INT, slot=BIG, grown_shard=INT),
    "op3": dict(doc_id=BIG, start=BIG, length=BIG, ids_crc32=BIG, doc_tokens=BIG, sequence_id=BIG, offset=BIG),
    "op4": dict(doc_id=BIG, fingerprint=TEXT, component_id=BIG),
    "op5": dict(doc_id=BIG, n_words=BIG, word_chars=BIG, n_symbols=BIG, n_dup_lines=BIG, n_repeat_words=BIG, base_failed=FLAG, kept=FLAG),
    "op6": dict(doc_id=BIG, n_tokens=BIG, ids_sha256=TEXT, decoded_sha256=TEXT),
    "op7": dict(doc_id=BIG, held_out=FLAG, score=REAL, predicted=INT),
    "op8": dict(doc_id=BIG, held_out=FLAG, score=REAL, predicted=INT),
    "op9": dict(page_id=BIG, payload_bytes=BIG, payload_digest=TEXT, record_type=TEXT, refers_to=BIG),
    "op10": dict(query_id=BIG, rank=INT, vec_id=BIG, score=REAL),
    "op11": dict(doc_id=BIG, n_a=BIG, n_b=BIG, n_groups=BIG, n_links=BIG, n_best=BIG, count_sum=BIG, groups_sha256=TEXT),
    "op12": dict(doc_id=BIG, held_out=FLAG, lang_pred=TEXT, score=REAL),
    "op13": dict(anchor_id=BIG, positive_id=BIG, rank=INT, negative_id=BIG, positive_score=BIG, negative_score=BIG),
}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def rows(spark):
    done = {}

    def of(number):
        if number not in done:
            name = next(n for n in queries.QUERIES if n.startswith(f"{number}_"))
            df = queries.QUERIES[name](spark, SF)
            done[number] = (dict(df.dtypes), df.collect())
        return done[number]

    return of


def test_queries_without_a_twin_are_declared():
    ops = {n.split("_")[0] for n in queries.QUERIES}
    assert ops == {f"op{i}" for i in range(1, 14)} | {"pipeline"} and set(queries.QUERIES) <= set(entry.queries())
    assert set(queries.ORACLE) == {"op9_warc_index_first", "op13_slot_hard_negatives"}


@pytest.mark.parametrize("number", CONTRACTS)
def test_columns(rows, number):
    kinds, _ = rows(number)
    assert {c: kinds.get(c) for c in CONTRACTS[number]} == CONTRACTS[number] and list(kinds)[: len(CONTRACTS[number])] == list(CONTRACTS[number])


def _once(got, texts):
    assert collections.Counter(r["doc_id"] for r in got) == collections.Counter(list(texts))


def test_token_counts_are_the_librarys_offsets(spark, texts):
    """op1: a token counts for the line that its first character lies in."""
    df = queries.QUERIES["op1_offset_token_counts"](spark, SF)
    got = collections.defaultdict(dict)
    for r in df.collect():
        got[r["doc_id"]][r["section"]] = r["n_tokens"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.no_truncation()
    for i, text in texts.items():
        text = text or ""
        starts = np.cumsum([0, *(len(line) + 1 for line in text.split("\n"))])
        spans = tokenizer.encode(text, add_special_tokens=False).offsets
        want = collections.Counter(int(np.searchsorted(starts, s, "right")) - 1 for s, _ in spans)
        assert sum(got[i].values()) == len(spans), i
        assert {k: v for k, v in got[i].items() if v} == dict(want), i


def test_shards(rows, texts):
    _, got = rows("op2")
    _once(got, texts)
    for r in got:
        data = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(data) + 16 and r["text_crc32"] == zlib.crc32(data) and 0 <= r["shard"] < 40 and r["law"] == "rows" and r["grown_shard"] is None
    shards = collections.defaultdict(list)
    for r in got:
        shards[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in shards.values()) and max(map(len, shards.values())) - min(map(len, shards.values())) <= 1


def test_packing(rows, texts):
    _, got = rows("op3")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.no_truncation()
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    used = 0
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
        used += at
    assert used >= 0.95 * 2048 * (len(sequences) - 1)


def test_near_duplicates(rows, texts):
    _, got = rows("op4")
    _once(got, texts)
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    root, least = brute_components(prints.values(), 4), {}
    for i in sorted(prints):
        least.setdefault(root[prints[i]], i)
    for r in got:
        assert r["fingerprint"] == f"{prints[r['doc_id']] & (1 << 64) - 1:016x}" and r["component_id"] == least[root[prints[r["doc_id"]]]]


def test_quality_counts(rows, texts):
    _, got = rows("op5")
    _once(got, texts)
    for r in got:
        text = texts[r["doc_id"]] or ""
        words = WORD.findall(text)
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        often = collections.Counter(windows)
        repeated = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        counts = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts
        assert r["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0]) and not (r["base_failed"] and r["kept"])


def test_bytes_encoded_and_decoded(rows, texts):
    _, got = rows("op6")
    _once(got, texts)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.no_truncation()
    for r in got:
        ids = tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        told = tokenizer.decode(ids, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(told.encode()).hexdigest())


@pytest.mark.parametrize("number, parts, part", [("op7", 3, 1), ("op8", 5, 0), ("op12", 5, 0)])
def test_learnt_scores(rows, texts, number, parts, part):
    _, got = rows(number)
    _once(got, texts)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % parts == part) and 0 <= r["score"] <= 1
        if number != "op12":
            assert r["predicted"] == int(r["score"] >= 0.5)


def test_neighbours(rows, spark):
    _, got = rows("op10")
    table = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    by, hit, total = collections.defaultdict(list), 0, 0
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        assert r["score"] == pytest.approx(np.sqrt(((table[r["query_id"]] - table[r["vec_id"]]) ** 2).sum()), rel=1e-12)
        by[r["query_id"]].append((r["score"], r["vec_id"]))
    assert set(by) == {i for i in table if i % 100 == 0}
    for q, found in by.items():
        assert found == sorted(found) and len(found) == 10
        near = sorted((float(np.sqrt(((v - table[q]) ** 2).sum())), i) for i, v in table.items() if i != q)[:10]
        hit, total = hit + len({i for _, i in near} & {i for _, i in found}), total + 10
    assert hit >= 0.9 * total
