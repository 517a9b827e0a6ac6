"""Cross-tokenizer alignment against a token-by-token brute force."""

from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textguard.llm import alignment

from .conftest import CLASHES, TEXTS


def _byte_level():
    """Characters of the byte-level alphabet -> bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def brute(texts):
    """Per text the contract's columns, but groups for their digest."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.no_truncation()
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    level, out, held = _byte_level(), [], Counter()
    for text in texts:
        whole, ids, spans = f" {text or ''}".encode(), [[], []], [[], []]
        if text:
            ids = [a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)]
            spelt = [[bytes(level[c] for c in a.id_to_token(i)) for i in ids[0]]]
            spelt.append([bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]])
            if b"".join(spelt[0]) != whole or b"".join(spelt[1]) != whole:
                ids = [[], []]
            else:
                for s in (0, 1):
                    at = 0
                    for x in spelt[s]:
                        at += len(x)
                        spans[s].append(at)
        common = sorted(set(spans[0]) & set(spans[1]))
        groups = [([], []) for _ in common]
        for s in (0, 1):
            g = 0
            for i, end in zip(ids[s], spans[s]):
                while common[g] < end:
                    g += 1
                groups[g][s].append(i)
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        held.update(links.keys())
        out.append([len(ids[0]), len(ids[1]), len(groups), sum(links.values()), links, ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)])
    top = Counter()
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    return [(na, nb, ng, nl, sum(t for (x, y), t in links.items() if held[x, y] == top[x]), sum(t * held[p] for p, t in links.items()), told) for na, nb, ng, nl, links, told in out]


MORE = ["a▁b", "<s> </s> <unk> <0x41> <|endoftext|>", "ﬁ ａ \x00 x", "word" * 3000, "é" * 4000, "зд" * 900 + " \U0001f600" * 60, " lead", "tail  ", "\n\n\n", "xX" * 700]


def _rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_equals_brute_force(spark):
    texts = [t for _, t in TEXTS] + MORE
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string").repartition(3)
    got = _rows(alignment.alignment(df), "i", *alignment.RESULTS.names)
    assert got == [(i, *r) for i, r in enumerate(brute(texts))]


def test_pieces_and_packs_change_nothing(spark, monkeypatch):
    """Documents cut at common ends, links made a few at a time, packs of one text.

    The bounds are read where the module is loaded, so the task-side functions
    are tested here, without Spark."""
    both = alignment.Pair("byte_bpe_50k.json", "piece_bpe_32k.model")
    texts = [t or "" for _, t in TEXTS if t is None or len(t) < 10_000] + MORE
    ids = [(x.values.to_numpy(), y.values.to_numpy()) for x, y in zip(*both.encode(texts))]

    def told(piece, pairs):
        monkeypatch.setattr(alignment, "PIECE", piece)
        monkeypatch.setattr(alignment, "PAIRS", pairs)
        linked, *rest = alignment.align(ids, both.sizes, both.names)
        return sorted(zip(*(linked[c].to_pylist() for c in ("doc", "pair", "times")))), [list(r) for r in rest]

    assert told(1 << 19, 1 << 22) == told(7, 3) == told(100, 1) == told(1, 1000)
    for side in zip(*ids):
        back = both.unpack(both.pack(list(side)), [len(x) for x in side])
        assert len(back) == len(side) and all(len(x) == len(y) and (x == y).all() for x, y in zip(back, side))


def test_texts_are_aligned_once(spark, tmp_path, monkeypatch):
    """The links' counts are looked up by places that were written, in packs of
    several runs, without a second alignment."""
    texts = [f"{w} the cat sat on the {w}\n{i % 7}" for i, w in enumerate(["mat", "Zürich", "", "x y  z", "한국어"] * 40)]
    align, seen = alignment.align, str(tmp_path)

    def counted(ids, *args):
        import os
        import tempfile

        os.close(tempfile.mkstemp(prefix=f"{len(ids)}-", dir=seen)[0])
        return align(ids, *args)

    monkeypatch.setattr(alignment, "align", counted)
    monkeypatch.setattr(alignment, "SLICE", 1 << 10)
    monkeypatch.setattr(alignment, "PACK", 1 << 11)
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string").repartition(2)
    got = _rows(alignment.alignment(df), "i", *alignment.RESULTS.names)
    assert got == [(i, *r) for i, r in enumerate(brute(texts))]
    calls = [int(p.name.split("-")[0]) for p in tmp_path.iterdir()]
    assert sum(calls) == len(texts) and len(calls) > 4


def test_links_are_kept_as_written():
    import numpy as np

    for columns in ([[], [], []], [[0, 0, 5], [1, 1 << 40, 2], [3, 1, 1 << 33]]):
        back = alignment.unpacked(alignment.packed(*(np.array(c, np.int64) for c in columns)), 3)
        assert [c.tolist() for c in back] == columns


def test_edges(spark, docs, empty):
    out = alignment.alignment(docs)
    assert out.columns[: len(CLASHES) + 2] == ["doc_id", "lang", *CLASHES] and out.count() == len(TEXTS)
    copies = out.filter("doc_id IN (0, 1)").select(*alignment.RESULTS.names).distinct()
    assert copies.count() == 1 and copies.first()["count_sum"] >= 3 * copies.first()["n_links"]
    none = out.filter("doc_id IN (2, 3)").select("n_a", "n_links", "count_sum", "groups").collect()
    assert [tuple(r) for r in none] == [(0, 0, 0, "")] * 2
    assert alignment.alignment(empty).count() == 0
    clash = alignment.alignment(docs.select("text", F.col("doc_id").alias("n_a"), F.col("lang").alias("groups")))
    assert clash.columns == ["_n_a", "_groups", *alignment.RESULTS.names] and clash.count() == len(TEXTS)
    alone = alignment.alignment(docs.select("text"))
    assert alone.columns == alignment.RESULTS.names and alone.count() == len(TEXTS)


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query(spark, sf):
    import hashlib

    import __spark_entry__ as entry

    rows = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()
    got = _rows(entry.queries()["op11_arrow_alignment"](spark, f"/root/testdata/{sf}"), "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    want = [(r["doc_id"], *w[:6], hashlib.sha256(w[6].encode()).hexdigest() if w[0] else "") for r, w in zip(rows, brute([r["text"] for r in rows]))]
    assert got == sorted(want)
