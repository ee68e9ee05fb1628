"""Pre-splitting of texts for a word-end BPE vocabulary, vectorised over code points.

The rules are those of the vocabulary file: NFC, white space as one blank, lower case, then
contractions, letter runs, single digits and runs of anything else. A text all of whose code points
lie below U+0300 is split in numpy; any other text, or one that holds a special token, goes through
the library's own normaliser and splitter, so both give the library's words.
"""

from __future__ import annotations

import unicodedata
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from tokenizers import Tokenizer

from strataframe.llm.textblocks import Texts, Words, ragged_take, word_hashes

#: Texts of this size are taken together: more share their words, fewer need less memory.
ENCODE_BYTES = 2 << 20
_LATIN = 0x300
_SPACE, _LETTER, _DIGIT, _OTHER = 0, 1, 2, 3
_POINT_CODES = np.random.default_rng(7).integers(1, 1 << 63, _LATIN, dtype=np.uint64)
_SPACES = {*range(9, 14), 0x20, 0x85, 0xA0}


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kinds, lower, odd = np.zeros(_LATIN, np.uint8), np.zeros(_LATIN, np.uint32), np.zeros(_LATIN, bool)
    for code in range(_LATIN):
        low = chr(code).lower()
        odd[code] = len(low) != 1 or ord(low) >= _LATIN or unicodedata.normalize("NFC", chr(code)) != chr(code)
        lower[code] = code if odd[code] else ord(low)
        kind = unicodedata.category(chr(lower[code]))
        kinds[code] = _SPACE if code in _SPACES else {"L": _LETTER, "N": _DIGIT}.get(kind[0], _OTHER)
    return kinds, lower, odd


_KINDS, _LOWERED, _ODD = _tables()


class Splitter:
    """Splits texts into words by the rules of one vocabulary file."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self._cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

    def slow_words(self, text: str) -> list[str | int]:
        """Words of one text, with the ids of special tokens between them."""
        found: list[str | int] = []
        at = 0
        for match in self._cut.finditer(text) if self._cut else ():
            found += self._piece(text[at : match.start()])
            found.append(self.special[match.group()])
            at = match.end()
        return found + self._piece(text[at:])

    def _piece(self, text: str) -> list[str]:
        if not text:
            return []
        return [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text))]


@lru_cache(maxsize=4)
def splitter(path: str) -> Splitter:
    return Splitter(path)


_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: The printable stand-in of each byte in byte-level vocabularies: the byte itself where it prints,
#: otherwise the next unused character from U+0100 on.
BYTE_CHARS = [""] * 256
for _b in _BYTES:
    BYTE_CHARS[_b] = chr(_b)
for _k, _b in enumerate(b for b in range(256) if b not in set(_BYTES)):
    BYTE_CHARS[_b] = chr(256 + _k)


def byte_level(word: bytes) -> str:
    return "".join([BYTE_CHARS[b] for b in word])


class WordEncoder:
    """Encodes texts word by word; each distinct word of a block goes through ``encode`` once.

    ``encode`` maps a list of byte-level words to a list of id lists. Words seen before are kept up
    to ``keep`` entries, so memory does not grow with the text.
    """

    def __init__(self, path: str, encode: Callable[[list[str]], list[list[int]]], keep: int = 250_000):
        self.splitter, self.encode, self.keep = splitter(path), encode, keep
        self.known: dict[str | bytes, bytes] = {}

    def ids(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (uint32), and where each text's ids begin."""
        points = np.frombuffer(texts.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        heads = (texts.data & 0xC0) != 0x80
        offsets = np.concatenate([[0], np.cumsum(heads)])[texts.offsets]
        wide = points >= _LATIN
        low = np.where(wide, 0, points)
        odd = wide | _ODD[low]
        # A "<|" may open a special token.
        odd[:-1] |= (points[:-1] == 0x3C) & (points[1:] == 0x7C)
        sums = np.concatenate([[0], np.cumsum(odd)])
        slow = (sums[offsets[1:]] - sums[offsets[:-1]]) > 0
        values, first = self._fast(low, offsets)
        if not slow.any():
            return values, first
        pieces, begin = [], [0]
        for i in range(len(texts)):
            part = self._slow(texts.text(i).decode("utf-8")) if slow[i] else values[first[i] : first[i + 1]]
            pieces.append(part)
            begin.append(begin[-1] + len(part))
        return np.concatenate(pieces), np.asarray(begin)

    def _slow(self, text: str) -> np.ndarray:
        parts = []
        words = self.splitter.slow_words(text)
        self._learn({w.encode(): None for w in words if isinstance(w, str)}, lambda w: w.decode())
        for word in words:
            parts.append(np.uint32(word).tobytes() if isinstance(word, int) else self.known[word.encode()])
        return np.frombuffer(b"".join(parts), np.uint32)

    def _learn(self, wanted, spell: Callable[[bytes], str]) -> None:
        known = self.known
        new = [w for w in wanted if w not in known]
        if len(self.known) + len(new) > self.keep:
            self.known = {w: self.known[w] for w in wanted if w in self.known}
        for word, ids in zip(new, self.encode([spell(w) for w in new]) if new else ()):
            self.known[word] = array("I", ids).tobytes()

    def _fast(self, points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lower = _LOWERED[points]
        words = _latin_words(lower, _KINDS[points], offsets)
        if not len(words.starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        codes = lower.astype(np.uint16)
        which, values = pd.factorize(word_hashes(codes, words, _POINT_CODES))
        head = np.empty(len(values), np.int64)
        head[which[::-1]] = np.arange(len(which) - 1, -1, -1)
        # Words of one hash must also agree in length and in their first and last letter.
        check = ((words.ends - words.starts) << 32) | (codes[words.starts].astype(np.int64) << 16) | codes[words.ends - 1]
        odd = check != check[head][which]
        if odd.any():  # two words with one hash: every such word gets an entry of its own
            which = which.copy()
            which[odd] = len(head) + np.arange(odd.sum())
            head = np.concatenate([head, np.flatnonzero(odd)])
        line = codes.tobytes().decode("utf-16-le")
        spelled = [line[s:e] for s, e in zip(words.starts[head].tolist(), words.ends[head].tolist())]
        # These words are kept under their own letters (str), those of the slow way as byte-level text (bytes).
        self._learn(spelled, lambda w: w if w.isascii() and w.isprintable() else byte_level(w.encode()))
        table = [self.known[w] for w in spelled]
        sizes = np.fromiter(map(len, table), np.int64, len(table)) // 4
        values, begin = ragged_take(np.frombuffer(b"".join(table), np.uint32), np.concatenate([[0], np.cumsum(sizes)]), which)
        return values, begin[words.first]


def _latin_words(lower: np.ndarray, kinds: np.ndarray, offsets: np.ndarray) -> Words:
    n = len(lower)
    if not n:
        return Words(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64))
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = np.ones(n, bool)
    start[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT)
    start |= edge[:-1]
    marks = np.flatnonzero((lower == 0x27) & start)
    if len(marks):
        padded = np.append(lower, [0, 0])
        ends = np.searchsorted(offsets, marks, "right")
        room = offsets[ends] - marks
        one, two = padded[marks + 1], padded[marks + 2]
        short = (room >= 2) & np.isin(one, [0x73, 0x74, 0x6D, 0x64])
        long = (room >= 3) & (((two == 0x65) & ((one == 0x72) | (one == 0x76))) | ((one == 0x6C) & (two == 0x6C)))
        for chosen, size in ((short, 2), (long, 3)):
            at = marks[chosen]
            start[at + 1] = False
            after = at + size
            after = after[after < n]
            start[after] = True
    start &= kinds != _SPACE
    begin = np.flatnonzero(start)
    # A word ends where the next one or white space or the next text begins.
    stop = start | (kinds == _SPACE) | edge[:-1]
    where = np.flatnonzero(stop)
    nxt = np.searchsorted(where, begin, "right")
    ends = np.append(where, n)[nxt]
    return Words(begin, ends, np.searchsorted(begin, offsets))
