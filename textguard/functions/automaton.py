"""Aho-Corasick automata as flat arrays, run over many texts at once.

``Automaton`` is one table of transitions (state x symbol class) with the words
that end in a state. It is run over the bytes of a whole Arrow buffer, which is
cut into lanes that all move on by one symbol a step: a lane first reads as many
symbols before it as the longest word has, after which its state is that of a
run from the very beginning. The work a byte is one look-up, however many words
there are.

``Folding`` is the alphabet of obfuscated texts: code points without what is
put between letters, Hangul syllables spelt as their letters, and for every
symbol its place in the text, so a hit can be replaced where it stands.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Symbols of a lane, and cells that a table may have.
LANE, MOST_CELLS = 1 << 10, 1 << 26


@dataclass
class Automaton:
    classes: np.ndarray  # symbol -> class, 0 for symbols of no word
    table: np.ndarray  # state * classes + class -> state
    ends: np.ndarray  # state -> the longest word that ends there, or -1
    shorter: np.ndarray  # state -> the next state on its chain of suffixes where a word ends, or -1
    lengths: np.ndarray  # word -> symbols
    n_classes: int

    @staticmethod
    def build(words: list[np.ndarray], symbols: int) -> "Automaton":
        """From words as arrays of symbols below ``symbols``; empty ones never match."""
        used = np.unique(np.concatenate([np.zeros(0, np.int64), *words]).astype(np.int64))
        classes = np.zeros(symbols, np.uint16)
        classes[used] = np.arange(1, len(used) + 1)
        n = len(used) + 1
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for w, word in enumerate(words):
            state = 0
            for c in classes[word].tolist():
                if c not in children[state]:
                    children[state][c] = len(children)
                    children.append({})
                    ends.append(-1)
                state = children[state][c]
            if len(word) and ends[state] < 0:
                ends[state] = w  # of equal words the first counts
        if len(children) * n > MOST_CELLS:
            raise ValueError(f"{len(children)} states of {n} symbols: more than {MOST_CELLS} cells")
        table = np.zeros((len(children), n), np.int32)
        shorter = np.full(len(children), -1, np.int32)
        for c, s in children[0].items():
            table[0, c] = s
        fail, level = [0] * len(children), list(children[0].values())
        while level:  # by depth: a state's suffix lies less deep
            following = []
            for s in level:
                f = fail[s]
                shorter[s] = f if ends[f] >= 0 else shorter[f]
                table[s] = table[f]
                for c, t in children[s].items():
                    fail[t] = int(table[f, c])
                    table[s, c] = t
                    following.append(t)
            level = following
        return Automaton(classes, table.reshape(-1), np.array(ends, np.int32), shorter, np.array([len(w) for w in words], np.int64), n)

    def states_with_words(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(end, state) wherever a word ends, in no order; ``end`` is past its last symbol."""
        warm = int(self.lengths.max(initial=0))
        if not warm or not len(text):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lanes = -(-len(text) // LANE)
        padded = np.zeros(warm + lanes * LANE, np.uint16)
        padded[warm : warm + len(text)] = self.classes[text]
        starts = np.arange(lanes) * LANE
        state, step, accepts = np.zeros(lanes, np.int32), self.n_classes, self.ends >= 0
        accepts |= self.shorter >= 0
        ends, states = [], []
        for i in range(warm + LANE):
            state = self.table[state * np.int64(step) + padded[starts + i]]
            if i >= warm:
                hit = np.flatnonzero(accepts[state])
                if len(hit):
                    ends.append(starts[hit] + (i - warm + 1))
                    states.append(state[hit])
        if not ends:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(ends), np.concatenate(states).astype(np.int64)

    def words_at(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, word) of every occurrence of every word."""
        end, state = self.states_with_words(text)
        starts, ends, words = [], [], []
        while len(state):
            word = self.ends[state]
            found = word >= 0
            starts.append(end[found] - self.lengths[word[found]])
            ends.append(end[found])
            words.append(word[found])
            state = self.shorter[state].astype(np.int64)
            end, state = end[state >= 0], state[state >= 0]
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return join(starts), join(ends), join(words)


def is_word_symbol() -> np.ndarray:
    """Of all code points: ASCII letters, digits and the underscore."""
    out = np.zeros(0x110000, bool)
    out[[*range(48, 58), *range(65, 91), 95, *range(97, 123)]] = True
    return out


def leftmost_longest(start: np.ndarray, end: np.ndarray, word: np.ndarray) -> list[tuple[int, int, int]]:
    """The hits that a scan from left to right takes, the longest one where several begin."""
    order = np.lexsort((-end, start))
    out, at = [], -1
    for s, e, w in zip(start[order].tolist(), end[order].tolist(), word[order].tolist()):
        if s >= at:
            out.append((s, e, w))
            at = e
    return out


def whole_words(automaton: Automaton, text: np.ndarray, offsets: np.ndarray, word_symbol: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, word) of the words in texts that stand one after the other in
    ``text`` (``offsets``: where they begin, and the last one's end), not glued
    to an ASCII letter, digit or underscore on either side."""
    start, end, word = automaton.words_at(text)
    if not len(start):
        return []
    glued = word_symbol[text]
    at = np.searchsorted(offsets, end, "left") - 1  # the text that the last symbol lies in
    left, right = offsets[at], offsets[at + 1]
    fits = start >= left
    before = (start > left) & glued[np.maximum(start - 1, 0)]
    after = (end < right) & glued[np.minimum(end, len(text) - 1)]
    fits &= ~before & ~after
    return leftmost_longest(start[fits], end[fits], word[fits])


# --------------------------------------------------------------------------- obfuscation
# The letters of Hangul in the order of the syllable formula
# (19 initials, 21 vowels, 27 finals), compound letters spelt as their parts.
INITIALS = "ㄱ ㄲ ㄴ ㄷ ㄸ ㄹ ㅁ ㅂ ㅃ ㅅ ㅆ ㅇ ㅈ ㅉ ㅊ ㅋ ㅌ ㅍ ㅎ".split()
VOWELS = "ㅏ ㅐ ㅑ ㅒ ㅓ ㅔ ㅕ ㅖ ㅗ ㅗㅏ ㅗㅐ ㅗㅣ ㅛ ㅜ ㅜㅓ ㅜㅔ ㅜㅣ ㅠ ㅡ ㅡㅣ ㅣ".split()
FINALS = "ㄱ ㄲ ㄱㅅ ㄴ ㄴㅈ ㄴㅎ ㄷ ㄹ ㄹㄱ ㄹㅁ ㄹㅂ ㄹㅅ ㄹㅌ ㄹㅍ ㄹㅎ ㅁ ㅂ ㅂㅅ ㅅ ㅆ ㅇ ㅈ ㅊ ㅋ ㅌ ㅍ ㅎ".split()
COMPOUNDS = "ㄳ ㄵ ㄶ ㄺ ㄻ ㄼ ㄽ ㄾ ㄿ ㅀ ㅄ ㅘ ㅙ ㅚ ㅝ ㅞ ㅟ ㅢ"
PARTS = "ㄱㅅ ㄴㅈ ㄴㅎ ㄹㄱ ㄹㅁ ㄹㅂ ㄹㅅ ㄹㅌ ㄹㅍ ㄹㅎ ㅂㅅ ㅗㅏ ㅗㅐ ㅗㅣ ㅜㅓ ㅜㅔ ㅜㅣ ㅡㅣ"


def _once(name: str, make):
    """``make()``, kept as long as the Python worker lives."""
    import sys
    import types

    held = sys.modules.setdefault("_textguard_tables", types.ModuleType("_textguard_tables")).__dict__
    if name not in held:
        held[name] = make()
    return held[name]


def _kept() -> np.ndarray:
    """Of all code points: letters, numbers and ASCII white space (what R7 keeps)."""
    import unicodedata

    out = np.array([unicodedata.category(chr(i))[0] in "LN" for i in range(0x110000)])
    out[[9, 10, 11, 12, 13, 32]] = True
    return out


def _spelt() -> dict[int, tuple[int, ...]]:
    """Code points that are spelt as others: Hangul syllables, compound letters,
    conjoining letters, capital ASCII letters."""
    points = lambda text: tuple(map(ord, text))
    out = {ord(c): points(p) for c, p in zip(COMPOUNDS.split(), PARTS.split())}
    for i, a in enumerate(INITIALS):
        out[0x1100 + i] = points(a)
        for j, b in enumerate(VOWELS):
            out[0xAC00 + 588 * i + 28 * j] = points(a + b)
            for k, c in enumerate(FINALS):
                out[0xAC00 + 588 * i + 28 * j + k + 1] = points(a + b + c)
    out |= {0x1161 + j: points(b) for j, b in enumerate(VOWELS)} | {0x11A8 + k: points(c) for k, c in enumerate(FINALS)}
    return out | {c: (c + 32,) for c in range(65, 91)}


def _spelt_table() -> np.ndarray:
    """Up to six symbols for every code point of the basic plane, 0 for none."""
    out = np.zeros((0x10000, 6), np.int32)
    out[:, 0] = np.arange(0x10000)
    for c, parts in _spelt().items():
        out[c, : len(parts)] = parts
    return out


@dataclass
class Folding:
    """Symbols of texts without what dodges a filter, and where they come from."""

    symbols: np.ndarray
    place: np.ndarray  # symbol -> code point that it is spelt from
    offsets: np.ndarray  # text -> its first symbol, and the last one's end

    @staticmethod
    def of(points: np.ndarray, offsets: np.ndarray) -> "Folding":
        """Of code points of texts one after the other."""
        kept = np.flatnonzero(_once("kept", _kept)[points])
        p = points[kept]
        parts = np.zeros((len(p), 6), np.int32)
        basic = p < 0x10000
        parts[basic] = _once("spelt", _spelt_table)[p[basic]]
        parts[~basic, 0] = p[~basic]
        there = parts != 0
        there[:, 0] = True
        sizes = there.sum(axis=1)
        first = np.concatenate(([0], np.cumsum(sizes)))
        return Folding(parts[there], np.repeat(kept, sizes), first[np.searchsorted(kept, offsets)])

    def found(self, automaton: Automaton, word_symbol: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, end, word) in code points of the texts: hits that begin and
        end with a whole character, whatever was put in between."""
        start, end, word = automaton.words_at(self.symbols)
        if not len(start):
            return []
        first = np.append(True, self.place[1:] != self.place[:-1])
        last = np.append(first[1:], True)
        at = np.searchsorted(self.offsets, end, "left") - 1
        left, right = self.offsets[at], self.offsets[at + 1]
        glued = word_symbol[self.symbols]
        fits = (start >= left) & first[start] & last[end - 1]
        fits &= ~((start > left) & glued[np.maximum(start - 1, 0)]) & ~((end < right) & glued[np.minimum(end, len(glued) - 1)])
        return [(int(self.place[s]), int(self.place[e - 1]) + 1, w) for s, e, w in leftmost_longest(start[fits], end[fits], word[fits])]
