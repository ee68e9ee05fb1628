"""Runs of repeated words, found with a dictionary of basic factors.

The factors of length 1, 2, 4, ... that start at each word are named, equal factors of one text alike:
a factor's name is that of the pair of its halves. A position whose factor occurs once in its text has no
name, and only named ones go on, so ordinary prose is done after a few lengths.

For a length L, the occurrences of a factor that follow each other at L/2 or less form arithmetic
progressions, whose difference is the factor's own period. Take a run of period q, L <= q < 2L, that starts
at s, and the occurrences of s's factor within 2L, at most four progressions. Either the last occurrence
of s's progression and the last of another are q apart, or s itself and the first of another are. So these
few distances propose the period of every run. Proposals for neighbouring words are one; each is extended
both ways by comparing names of ever shorter factors, and stretches found under several periods
keep the smallest.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from strataframe.llm.tables import documents, over_batches
from strataframe.llm.textblocks import Texts, blocks, word_hashes, words_of

LEAST_WORDS = 12
LEAST_PERIODS = 2


@dataclass
class Factors:
    """``names[k][i]``: the name of the factor of ``2**k`` words at ``i``; -1 if it occurs once in its text."""

    names: list[np.ndarray]

    def alike(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the factors at ``a`` and ``b`` are equal; places outside the text are unlike any other."""
        names = self.names[level]
        inside = (np.minimum(a, b) >= 0) & (np.maximum(a, b) < len(names))
        x, y = names[np.where(inside, a, 0)], names[np.where(inside, b, 0)]
        return inside & (x == y) & (x >= 0)

    def reach(self, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
        """How many words from ``a`` and ``b`` on agree, or in front of them."""
        length = np.zeros(len(a), np.int64)
        for level in range(len(self.names) - 1, -1, -1):
            step = length if forward else -length - (1 << level)
            length += self.alike(level, a + step, b + step).astype(np.int64) << level
        return length


def _named(keys: np.ndarray) -> np.ndarray:
    """Numbers that are equal where keys are; -1 for keys that occur once."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    group = np.cumsum(new) - 1
    names = np.empty(len(keys), np.int64)
    names[order] = np.where((np.bincount(group) > 1)[group], group, -1)
    return names


def basic_factors(words: np.ndarray, owner: np.ndarray) -> Factors:
    """Name the factors of texts that stand one behind the other; ``owner`` is each word's text (ascending)."""
    if not len(words):
        return Factors([np.zeros(0, np.int64)])
    word = np.unique(words, return_inverse=True)[1].astype(np.int64)
    names = [_named(word * (int(owner[-1]) + 1) + owner)]
    while True:
        last, length = names[-1], 1 << (len(names) - 1)
        at = np.flatnonzero(last[:-length] >= 0) if length < len(last) else np.zeros(0, np.int64)
        # Names of one text are no other text's, so a factor that runs over a text's end is found by its owner.
        at = at[(last[at + length] >= 0) & (owner[at] == owner[at + length])]
        if not len(at):
            return Factors(names)
        # Names are numbers below the number of words, so a pair fits 64 bits.
        pair = _named(last[at] * len(last) + last[at + length])
        if not (pair >= 0).any():
            return Factors(names)
        names.append(np.full(len(last), -1, np.int64))
        names[-1][at] = pair


def proposals(factors: Factors) -> tuple[np.ndarray, np.ndarray]:
    """``(place, period)`` pairs that hold the period of every run at some place within it."""
    found_at, found_by = [], []
    for level, names in enumerate(factors.names):
        length = 1 << level
        place = np.flatnonzero(names >= 0)
        place = place[np.argsort(names[place], kind="stable")]
        name = names[place]
        if not len(place):
            continue
        # Progressions: runs of occurrences at half the length or less from each other.
        new = np.ones(len(place), bool)
        new[1:] = (name[1:] != name[:-1]) | (2 * (place[1:] - place[:-1]) > length)
        group = np.cumsum(new) - 1
        begin = np.flatnonzero(new)
        first, last, of = place[begin], place[np.append(begin[1:], len(place)) - 1], name[begin]
        for ahead in range(1, 4):
            for source, mine, target in ((place, group, first), (last, np.arange(len(begin)), last)):
                other = mine + ahead
                ok = np.flatnonzero(other < len(begin))
                ok = ok[of[other[ok]] == of[mine[ok]]]
                period = target[other[ok]] - source[ok]
                fits = (period >= length) & (period < 2 * length)
                found_at.append(source[ok][fits])
                found_by.append(period[fits])
    if not found_at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, by = np.concatenate(found_at), np.concatenate(found_by)
    order = np.lexsort((at, by))
    at, by = at[order], by[order]
    # Places that follow each other under one period are in one stretch.
    head = np.ones(len(at), bool)
    head[1:] = (by[1:] != by[:-1]) | (at[1:] - at[:-1] > 1)
    return at[head], by[head]


def runs_of(words: np.ndarray, owner: np.ndarray, least: int = LEAST_WORDS) -> np.ndarray:
    """Rows ``(start, length, period)`` of all runs, by start and period; words count over all texts."""
    factors = basic_factors(words, owner)
    at, period = proposals(factors)
    ahead = factors.reach(at, at + period, forward=True)
    behind = factors.reach(at, at + period, forward=False)
    start, length = at - behind, behind + ahead + period
    keep = length >= np.maximum(least, LEAST_PERIODS * period)
    found = np.stack([start[keep], length[keep], period[keep]], axis=1)
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    one = np.ones(len(found), bool)  # of the periods of one stretch the smallest
    one[1:] = (found[1:, :2] != found[:-1, :2]).any(1)
    found = found[one]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def repeated_words(runs: np.ndarray, n_words: int) -> np.ndarray:
    """Whether a word lies in any run behind its first period."""
    edges = np.zeros(n_words + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edges)[:n_words] > 0


def planted(n_words: int, doc_id: int | None) -> np.ndarray | None:
    """Which of its words stands at each place once a document has got its planted run; None if it gets none."""
    if doc_id is None or not n_words:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n_words
    p = 1 + (n_words - a) // (3 + g % 8)
    place = np.arange(n_words)
    place[a:] = a + (place[a:] - a) % p
    return place


@dataclass
class Found:
    """The runs of one text (places count within it) and which of its words repeat others of a run."""

    runs: np.ndarray
    repeated: np.ndarray
    order: np.ndarray | None  # the word at each place, where words were moved


def find_runs(texts: Texts, moved: list[np.ndarray | None] | None = None, least: int = LEAST_WORDS) -> list[Found]:
    """The runs of each text of a block. ``moved`` puts other words of the text in each place."""
    words = words_of(texts)
    hashes, owner, first = word_hashes(texts.data, words), words.owner(), words.first
    moved = moved or [None] * len(texts)
    for i, order in enumerate(moved):
        if order is not None:
            hashes[first[i] : first[i + 1]] = hashes[first[i] : first[i + 1]][order]
    runs = runs_of(hashes, owner, least)
    repeated = repeated_words(runs, len(hashes))
    cut = np.searchsorted(runs[:, 0], first)
    return [
        Found(runs[cut[i] : cut[i + 1]] - [first[i], 0, 0], repeated[first[i] : first[i + 1]], moved[i])
        for i in range(len(texts))
    ]


def collapsed(text: bytes, found: Found) -> bytes:
    """The text's words without those that repeat others of a run, with one space between them."""
    words = text.split()  # bytes are split at ASCII white space only
    if found.order is not None:
        words = [words[i] for i in found.order.tolist()]
    if found.repeated.any():
        words = [words[i] for i in np.flatnonzero(~found.repeated).tolist()]
    return b" ".join(words)


def without_repeats(docs: DataFrame, text: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with each run in ``text`` cut down to its first period, and ``n_dropped``, how many words that took.

    White space between kept words becomes one space in a text that loses words; other texts stay as they are.
    Nulls stay null with 0 dropped, repeated rows each have their result. Other columns pass through; one named ``n_dropped`` is replaced.
    """
    kept = docs.drop("n_dropped")
    at = kept.columns.index(text)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields) + ", n_dropped bigint"

    def run(batch: pa.RecordBatch):
        for block in blocks(batch.column(at)):
            part = batch.slice(block.first, len(block))
            found = find_runs(block, least=least)
            old = part.column(at).to_pylist()
            new = [collapsed(block.text(i), f).decode() if f.repeated.any() else t for i, (t, f) in enumerate(zip(old, found))]
            columns = [pa.array(new, batch.schema.field(at).type) if i == at else part.column(i) for i in range(part.num_columns)]
            dropped = pa.array([int(f.repeated.sum()) for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, dropped], names=[*batch.schema.names, "n_dropped"])

    return over_batches(kept, run, schema)


RESULT = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint,"
    " runs_sha256 string, collapsed_sha256 string"
)


def _digest(found: Found, text: bytes) -> tuple:
    best = (None,) * 4
    if len(found.runs):
        start, length, period = min(found.runs.tolist(), key=lambda r: (-r[1], r[0], r[2]))
        best = (start, length, period, 1000 * length // period)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in found.runs.tolist())
    return (len(found.runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(text, found)).hexdigest())


def run_report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): its runs, after every tenth document, by its id's checksum, got one planted.

    A null or empty text has no words and no runs. A row without doc_id is judged as it stands. Repeated rows each
    have their row, of ties for the longest run the first counts, other columns are ignored, no rows give none.
    A long text is a block of its own: memory grows with its words times the lengths at which its factors repeat.
    """

    def run(batch: pa.RecordBatch):
        for block in blocks(batch.column(1)):
            ids = batch.column(0).slice(block.first, len(block)).to_pylist()
            counts = words_of(block).counts.tolist()
            found = find_runs(block, [planted(n, i) for n, i in zip(counts, ids)])
            rows = zip(*[(i, *_digest(f, block.text(k))) for k, (i, f) in enumerate(zip(ids, found))])
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds)], names=[f.split()[0] for f in RESULT.split(", ")])

    return over_batches(docs.select("doc_id", "text"), run, RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(documents(spark, sf_dir))
