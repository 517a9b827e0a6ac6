"""R5-R7 for lexicons of tens of thousands of words, and for obfuscated texts.

The lexicon (word, stem, category) becomes one automaton of flat arrays
(``functions.automaton``), sent once; texts are read in Arrow batches, and no
row is shuffled. The cost of a text doesn't depend on the size of the lexicon.

A word matches whole, in any ASCII case: not next to an ASCII letter, digit or
underscore, so words of other scripts are found inside longer ones. From left to
right the longest word that begins somewhere is taken, and hits don't overlap.
A word that stands twice counts as its first row, in the order of (word, stem).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textguard.functions import automaton as ac

#: Words that a lexicon may have here; beyond, ``policy.purify_by_join``.
MOST_WORDS = 1_000_000
#: Bytes of text that are searched at a time, as they are and as symbols of
#: obfuscated texts, which take over a hundred bytes of arrays each.
SLICE, FOLDED_SLICE = 4 << 20, 1 << 19


def entries(lexicon: DataFrame) -> list[tuple[str, str, str]]:
    """(word, stem, category) in the order of their words; refused if too many."""
    rows = lexicon.select(F.lower("word").alias("word"), "stem", "category").filter(F.col("word") != "").orderBy("word", "stem", "category").limit(MOST_WORDS + 1).collect()
    if len(rows) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} words")
    return [tuple(r) for r in rows]


def _folded(words: list[str]) -> list[np.ndarray]:
    """Words as symbols of ``Folding``."""
    return [ac.Folding.of(*_points([w])).symbols for w in words]


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts one after the other, and where each begins."""
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64), np.cumsum([0, *map(len, texts)])


def _lower_bytes(data: np.ndarray) -> np.ndarray:
    """Bytes with ASCII capitals as small letters."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def search(df: DataFrame, lexicon: DataFrame, text: str = "text", obfuscated: bool = False) -> DataFrame:
    """Add keywords (sorted, distinct), n_hits, categories (joined by '/', or
    NORMAL) and purified (hits replaced by their stems) to ``df``. A null text
    has no hits and stays null.

    ``obfuscated``: characters other than letters, numbers and white space are
    passed over, and Hangul syllables and letters are one spelling, so ``i.d.i.o.t``
    or a syllable taken apart is found, and replaced from its first character to
    its last one."""
    known = entries(lexicon)
    words, stems, categories = ([r[i] for r in known] for i in range(3))
    if obfuscated:
        machine = ac.Automaton.build(_folded(words), 0x110000)
    else:
        machine = ac.Automaton.build([np.frombuffer(w.encode(), np.uint8) for w in words], 256)
    sent = df.sparkSession.sparkContext.broadcast((vars(machine), words, stems, categories, ac.is_word_symbol()))  # arrays and lists only
    row, out = [F.col(c).alias(f"c{i}") for i, c in enumerate(df.columns)], T._parse_datatype_string("keywords array<string>, n_hits int, categories string, purified string")
    read = df.select(F.struct(*row).alias("row"))  # the text among its fields, sent once
    at_field, most = df.columns.index(text), FOLDED_SLICE if obfuscated else SLICE
    schema = T.StructType([read.schema["row"], *out.fields])

    def of_bytes(texts, machine, word_symbol):
        """Hits by text, as places in its bytes, and the bytes."""
        whole = texts.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(whole.buffers()[1], np.int64, len(whole) + 1, whole.offset * 8)
        data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        hits = ac.whole_words(machine, _lower_bytes(data), offsets, word_symbol)
        return hits, offsets, lambda i, j: data[i:j].tobytes().decode()

    def of_points(texts, machine, word_symbol):
        strings = [t or "" for t in texts.to_pylist()]
        points, offsets = _points(strings)
        joined = "".join(strings)
        return ac.Folding.of(points, offsets).found(machine, word_symbol), offsets, lambda i, j: joined[i:j]

    def run(batches):
        parts, words, stems, categories, word_symbol = sent.value
        machine = ac.Automaton(**parts)
        for batch in batches:
            every = batch.column(0).field(at_field)
            sizes = pc.fill_null(pc.binary_length(every), 0).to_numpy()
            for i, j in _runs(sizes, most):
                texts = every.slice(i, j - i)
                hits, offsets, cut = (of_points if obfuscated else of_bytes)(texts, machine, word_symbol)
                by_text: dict[int, list] = {}
                for s, e, w in hits:
                    by_text.setdefault(int(np.searchsorted(offsets, e, "left")) - 1, []).append((s, e, w))
                keywords, counts, kinds, purified = [[]] * (j - i), [0] * (j - i), ["NORMAL"] * (j - i), texts.to_pylist()
                for t, found in by_text.items():
                    keywords[t] = sorted({words[w] for _, _, w in found})
                    counts[t] = len(found)
                    kinds[t] = "/".join(sorted({categories[w] for _, _, w in found}))
                    parts, at = [], int(offsets[t])
                    for s, e, w in found:
                        parts += [cut(at, s), stems[w]]
                        at = e
                    purified[t] = "".join([*parts, cut(at, int(offsets[t + 1]))])
                columns = [pa.array(keywords, pa.list_(pa.string())), pa.array(counts, pa.int32()), pa.array(kinds, pa.string()), pa.array(purified, pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *columns], names=schema.names)

    done = read.mapInArrow(run, schema)
    return done.select(*(F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(df.columns)), *out.names)


def _runs(sizes, most: int) -> list[tuple[int, int]]:
    """[i, j) of rows of about ``most`` bytes."""
    out, i, total = [], 0, 0
    for j, n in enumerate(sizes.tolist()):
        if total and total + n > most:
            out.append((i, j))
            i, total = j, 0
        total += n + 1
    return [*out, (i, len(sizes))] if i < len(sizes) else out
