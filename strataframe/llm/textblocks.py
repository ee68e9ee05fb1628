"""Words and shingle hashes of many texts at once, straight from Arrow's UTF-8 buffers.

Texts come as one byte array with offsets. Every function works on all texts of a block in numpy, so
there is no Python object per word. Blocks hold whole texts: a text longer than the block size is a
block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_RNG = np.random.default_rng(20240229)
_BYTE_CODES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE_CODES = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_RADIX = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values (the splitmix finaliser)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(length: int) -> np.ndarray:
    global _powers
    if len(_powers) < length:
        table = np.full(max(length, 256), _RADIX, np.uint64)
        table[0] = 1
        _powers = np.multiply.accumulate(table)
    return _powers


@dataclass
class Texts:
    """Texts ``i`` at ``data[offsets[i]:offsets[i + 1]]``; ``first`` is the row number of text 0."""

    data: np.ndarray
    offsets: np.ndarray
    first: int = 0

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def texts_of(column: pa.Array) -> Texts:
    """The buffers of a string column; a null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return Texts(data, offsets)


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[Texts]:
    """Cut a column into blocks of whole texts of about ``size`` bytes."""
    if not len(column):
        return
    whole = texts_of(column)
    start = 0
    while start < len(whole):
        stop = int(np.searchsorted(whole.offsets, whole.offsets[start] + size, "right")) - 1
        stop = min(max(stop, start + 1), len(whole))
        low, high = whole.offsets[start], whole.offsets[stop]
        yield Texts(whole.data[low:high], whole.offsets[start : stop + 1] - low, start)
        start = stop


@dataclass
class Words:
    """Words of a block: byte ranges, and per text ``i`` the words ``first[i]:first[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1, dtype=np.int64), self.counts)


def words_of(texts: Texts, separator: np.ndarray = _SPACE) -> Words:
    """Maximal runs of bytes that are no separators; runs end at the text's end."""
    data, offsets = texts.data, texts.offsets
    inside = ~separator[data]
    edges = np.zeros(len(data) + 1, bool)
    edges[offsets] = True
    before = np.empty(len(data), bool)
    starts = inside.copy()
    if len(data):
        before[0] = False
        before[1:] = inside[:-1]
        starts &= ~before | edges[:-1]
        after = np.empty(len(data), bool)
        after[-1] = False
        after[:-1] = inside[1:]
        ends = inside & (~after | edges[1:])
    else:
        ends = starts
    begin = np.flatnonzero(starts)
    return Words(begin, np.flatnonzero(ends) + 1, np.searchsorted(begin, offsets))


def lower_ascii(texts: Texts) -> Texts:
    return Texts(_LOWER[texts.data], texts.offsets, texts.first)


def word_hashes(data: np.ndarray, words: Words, *tables: np.ndarray) -> np.ndarray | list[np.ndarray]:
    """A 64-bit hash of each word's symbols; one per table of symbol codes (default: bytes)."""
    tables = tables or (_BYTE_CODES,)
    if not len(words.starts):
        found = [np.zeros(0, np.uint64) for _ in tables]
        return found if len(tables) > 1 else found[0]
    lengths = words.ends - words.starts
    low = int(words.starts[0])
    span = data[low : int(words.ends[-1])]
    begin = words.starts - low
    gaps = np.append(begin[1:], len(span)) - begin
    place = np.arange(len(span), dtype=np.int32) - np.repeat(begin.astype(np.int32), gaps)
    powers = _power_table(int(gaps.max()) + 1)[place]
    # What lies between words counts as zero.
    gap = place >= np.repeat(lengths.astype(np.int32), gaps)
    powers[gap] = 0
    salt = lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    found = [mix(np.add.reduceat(codes[span] * powers, begin) + salt) for codes in tables]
    return found if len(tables) > 1 else found[0]


def shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, and the text each belongs to.

    A text with fewer words has one shingle, its whole sequence; one without words has none.
    """
    counts = np.diff(first)
    total = len(hashes)
    owner = np.repeat(np.arange(len(counts), dtype=np.int64), counts)
    room = total - width + 1
    if room > 0:
        sums = np.zeros(room, np.uint64)
        for k in range(width):
            sums += hashes[k : k + room] * _PLACE_CODES[k]
        left = first[1:][owner[:room]] - np.arange(room)
        keep = left >= width
        found, texts = mix(sums[keep] + np.uint64(width)), owner[:room][keep]
    else:
        found, texts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        sums = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            has = counts[short] > k
            sums[has] += hashes[first[short[has]] + k] * _PLACE_CODES[k]
        found = np.concatenate([found, mix(sums + counts[short].astype(np.uint64))])
        texts = np.concatenate([texts, short])
        order = np.argsort(texts, kind="stable")
        found, texts = found[order], texts[order]
    return found, texts


def run_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` neighbours, by doubling; runs may cross texts."""
    total = len(hashes) - width + 1
    if total <= 0:
        return np.zeros(0, np.uint64)
    result, done, power, size = None, 0, hashes, 1
    while True:
        if width & size:
            part = power[done : done + total]
            result = mix(part + np.uint64(size)) if result is None else mix(result * _RADIX + part)
            done += size
        if size * 2 > width:
            return result
        power = mix(power[: len(power) - size] * _RADIX + power[size:])
        size *= 2


def distinct_per_text(found: np.ndarray, texts: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text and where each text's begin (``n_texts + 1`` values)."""
    first = np.searchsorted(texts, np.arange(n_texts + 1))
    found = found.copy()
    for i in np.flatnonzero(np.diff(first) > 1):
        found[first[i] : first[i + 1]].sort()
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (texts[1:] != texts[:-1])
    kept = np.concatenate([[0], np.cumsum(new)])
    return found[new], kept[first]


def ragged_take(values: np.ndarray, first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate ``values[first[w]:first[w + 1]]`` over ``which``; also where each piece begins."""
    sizes = (first[1:] - first[:-1])[which]
    begin = np.concatenate([[0], np.cumsum(sizes)])
    index = np.arange(begin[-1], dtype=np.int64) + np.repeat(first[:-1][which] - begin[:-1], sizes)
    return values[index], begin
