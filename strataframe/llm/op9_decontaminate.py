"""Benchmark decontamination by SimHash of item-sized windows.

Items of like size form a class, whose windows have the words of its shortest item. Three such windows of
each item, at its beginning, middle and end, have a 64-bit SimHash, and so has every window of that many words
of every document, from running sums of its words' bits. Fingerprints are cut into four blocks of 16 bits. The
radius of a class follows from the bits that edits down to the threshold are expected to flip in windows of its
length, up to ``MOST_RADIUS`` = 11; two prints that differ in at most 11 bits differ in at most two bits
of some block, and each block's table holds every print under all values that near its own, so no pair within the
radius is missed.

A passage at the threshold may lie outside the radius, as flips scatter. So that none is missed, the index is
completed by seeds: so many of an item's shingles that the rest weighs less than the threshold's share, one of
which such a passage holds unchanged. ``by_simhash`` says of each match whether a fingerprint found it.

Around both kinds of candidates every window of the item's size is verified by the likeness of the item's and the
window's shingles, weighted and plain: the greater of the two counts. A shingle weighs 1/n if n different item texts of
the whole table have it, and one that the item has not weighs the mean of the item's, so shingles that all items share
weigh alike on either side; the plain likeness keeps items with common text from hiding near copies.

Words are runs of letters and digits in lower case, so copies in capitals or with signs put between
words are found. Items are a query set: they are taken in blocks of ``ITEMS_AT_ONCE``, and each block
is run against all documents.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.llm.tables import cut_lineage, documents, over_batches, table
from strataframe.llm.textblocks import Texts, blocks, mix, run_hashes, texts_of, word_hashes, words_of

MOST_RADIUS = 11
CLASS_SPAN = 1.6  # the longest item of a class, in sizes of its shortest
SHINGLE_WORDS = 5
THRESHOLD = 0.8
ITEMS_AT_ONCE = 2_000
PIECE = 1 << 12  # words whose windows are looked up at a time
GATHERED = 1 << 16  # shingles of candidate regions that are looked up at a time

_BETWEEN = np.zeros(256, bool)
_BETWEEN[:0x80] = True
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    _BETWEEN[_a:_b] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BITS = 1 << np.arange(16)
_SEED_BITS = 20  # of a shingle's hash, by which most of those that are no seeds are told at once


def radius_of(length: int, threshold: float = THRESHOLD) -> int:
    """Bits that differ between windows of ``length`` words at the threshold: their mean and one deviation.

    Likeness t leaves (1 - t) / (1 + t) of an item's shingles changed, by edits at the ends as many words. Each bit of a
    SimHash is the sign of a sum over the words, which flips with probability arccos(share of words kept) / pi.
    """
    shingles = max(1, length - SHINGLE_WORDS + 1)
    changed = min(1.0, (1 - threshold) / (1 + threshold) * shingles / length)
    flip = np.arccos(1 - changed) / np.pi
    return min(MOST_RADIUS, int(np.ceil(64 * flip + np.sqrt(64 * flip * (1 - flip)))))


def _near_values(flips: int) -> np.ndarray:
    """What to xor 16 bits with to change at most ``flips`` of them."""
    near = {0}
    for _ in range(flips):
        near |= {x ^ int(b) for x in near for b in _BITS}
    return np.array(sorted(near), np.int64)


def plain_words(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, in lower case, and where each text's begin."""
    data = _LOWER[texts.data]
    if len(data) > 1:
        # Capital letters U+00C0 to U+00DE, but for the sign in their midst, in UTF-8.
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        data[1:][capital] += 0x20
    words = words_of(Texts(data, texts.offsets), _BETWEEN)
    return word_hashes(data, words), words.first


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)


def window_prints(ones: np.ndarray, length: int) -> np.ndarray:
    """SimHash of every run of ``length`` words, from running sums of their bits (one row more)."""
    above = (ones[length:] - ones[:-length]) > length // 2
    return np.packbits(above, axis=1).view(np.uint64).ravel()


def running_ones(hashes: np.ndarray) -> np.ndarray:
    # Sums may wrap round; differences over a window shorter than 32768 words are right all the same.
    ones = np.zeros((len(hashes) + 1, 64), np.int16)
    np.cumsum(_bits(hashes), axis=0, dtype=np.int16, out=ones[1:])
    return ones


@dataclass
class Item:
    """An item's distinct shingles in ascending order, how often it has each, and what each weighs."""

    size: int
    width: int
    grams: np.ndarray
    times: np.ndarray
    weights: np.ndarray

    @property
    def scales(self) -> tuple[np.ndarray, np.ndarray]:
        """The two sets of weights of the item's shingles, each with a mean of 1, which a shingle it has not weighs."""
        return np.ones(len(self.times)), self.weights * (self.times.sum() / (self.times * self.weights).sum())


@dataclass
class SizeClass:
    length: int
    radius: int
    items: np.ndarray  # the item of each entry
    prints: np.ndarray
    first: list = field(default_factory=list)  # per block: where the entries of a value begin
    held: list = field(default_factory=list)  # per block: how many entries a value has
    entries: list = field(default_factory=list)


@dataclass
class Seeds:
    """Shingles of ``width`` words in ascending order, with the item each belongs to."""

    width: int
    grams: np.ndarray
    items: np.ndarray
    may: np.ndarray  # by a hash's upper bits: whether any seed has them


@dataclass
class Index:
    ids: list[int]
    items: list[Item]
    classes: list[SizeClass]
    seeds: list[Seeds]
    threshold: float
    keys: np.ndarray  # every shingle of every item, scrambled by the item's number, in ascending order
    scales: np.ndarray  # their weights on either scale


def item_shingles(words: np.ndarray) -> np.ndarray:
    return run_hashes(words, min(SHINGLE_WORDS, len(words))) if len(words) else np.zeros(0, np.uint64)


def needed_shingles(item: Item, threshold: float) -> np.ndarray:
    """The heaviest shingles, so many that on either scale the others weigh less than ``threshold`` of the item."""
    if not item.size:
        return np.zeros(0, np.int64)
    order = np.argsort(-item.weights, kind="stable")
    total = item.times.sum()
    sums = [np.cumsum((item.times * scale)[order]) for scale in item.scales]
    return order[: max(np.searchsorted(x, (1 - threshold + 1e-9) * total, "right") for x in sums) + 1]


def size_classes(sizes: list[int]) -> list[tuple[int, list[int]]]:
    """Length and items of each class of items of ``SHINGLE_WORDS`` words or more."""
    found: list[tuple[int, list[int]]] = []
    for i in sorted(range(len(sizes)), key=lambda i: sizes[i]):
        if sizes[i] < SHINGLE_WORDS:
            continue
        if not found or sizes[i] > CLASS_SPAN * found[-1][0]:
            found.append((sizes[i], []))
        found[-1][1].append(i)
    return found


def _class(length: int, members: list[int], words: list[np.ndarray], radius: int) -> SizeClass:
    entries = [(i, at) for i in members for at in sorted({0, (len(words[i]) - length) // 2, len(words[i]) - length})]
    ones = running_ones(np.concatenate([words[i][at : at + length] for i, at in entries]))
    prints = np.packbits(ones[length::length] - ones[:-length:length] > length // 2, axis=1).view(np.uint64).ravel()
    found = SizeClass(length, radius, np.array([i for i, _ in entries]), prints)
    near = _near_values(radius // 4)
    for block in range(4):
        value = ((prints >> np.uint64(16 * block)) & np.uint64(0xFFFF)).astype(np.int64)
        values = (value[:, None] ^ near).ravel()
        order = np.argsort(values, kind="stable")
        found.first.append(np.searchsorted(values[order], np.arange(65536)))
        found.held.append(np.bincount(values, minlength=65536).astype(np.int32))
        found.entries.append((order // len(near)).astype(np.int32))
    return found


def build_index(ids: list[int], texts: list[str], threshold: float = THRESHOLD, shared: dict[int, int] | None = None,
                complete: bool = True, radius: int | None = None) -> Index:
    """``shared``: how many texts of the whole table have a shingle, where more than one; else these are all.
    Without ``complete`` there are no seeds; ``radius`` replaces that of all classes."""
    hashes, first = plain_words(texts_of(pa.array(texts, pa.large_string())))
    words = [hashes[first[i] : first[i + 1]] for i in range(len(texts))]
    runs = [item_shingles(w) for w in words]
    if shared is None:
        different = {w.tobytes(): r for w, r in zip(words, runs)}.values()
        grams, held = np.unique(np.concatenate([np.unique(r) for r in different]), return_counts=True)
        shared = dict(zip(grams.tolist(), held.tolist()))
    items, seeds = [], {}
    for i, (w, run) in enumerate(zip(words, runs)):
        own, times = np.unique(run, return_counts=True)
        width = min(SHINGLE_WORDS, len(w))
        items.append(Item(len(w), width, own, times, np.array([1 / shared.get(g, 1) for g in own.tolist()])))
        if complete or len(w) < SHINGLE_WORDS:
            seeds.setdefault(width, []).extend((int(own[k]), i) for k in needed_shingles(items[-1], threshold))
    sizes = [len(w) for w in words]
    classes = [_class(n, members, words, radius_of(n, threshold) if radius is None else radius) for n, members in size_classes(sizes)]
    found = []
    for width, pairs in sorted(seeds.items()):
        if pairs:
            pairs.sort()
            grams = np.array([g for g, _ in pairs], np.uint64)
            may = np.zeros(1 << _SEED_BITS, bool)
            may[grams >> np.uint64(64 - _SEED_BITS)] = True
            found.append(Seeds(width, grams, np.array([i for _, i in pairs]), may))
    keys = np.concatenate([_keyed(x.grams, np.full(len(x.grams), i)) for i, x in enumerate(items)] or [np.zeros(0, np.uint64)])
    scales = np.concatenate([np.stack(x.scales) if x.size else np.zeros((2, 0)) for x in items] or [np.zeros((2, 0))], axis=1)
    order = np.argsort(keys, kind="stable")
    return Index(ids, items, classes, found, threshold, keys[order], scales[:, order])


def _keyed(grams: np.ndarray, item: np.ndarray) -> np.ndarray:
    return grams ^ mix(item.astype(np.uint64) + np.uint64(1))


def within_radius(entry: SizeClass, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (window, entry) whose fingerprints differ in at most the class's radius."""
    found_w, found_e = [], []
    values = prints.astype("<u8").view("<u2").reshape(-1, 4)
    for block in range(4):
        value = values[:, block]
        size = entry.held[block][value]
        hit = np.flatnonzero(size)
        size = size[hit]
        stop = np.cumsum(size)
        window = np.repeat(hit, size)
        at = np.arange(len(window)) + np.repeat(entry.first[block][value[hit]] - stop + size, size)
        which = entry.entries[block][at]
        near = np.bitwise_count(prints[window] ^ entry.prints[which]) <= entry.radius
        found_w.append(window[near])
        found_e.append(which[near])
    pairs = np.unique(np.concatenate(found_w) * len(entry.items) + np.concatenate(found_e))
    return pairs // len(entry.items), pairs % len(entry.items)


def at_seeds(seeds: Seeds, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (place, item) where a place's shingle is a seed of the item."""
    place = np.flatnonzero(seeds.may[grams >> np.uint64(64 - _SEED_BITS)])
    low, high = (np.searchsorted(seeds.grams, grams[place], side) for side in ("left", "right"))
    size = high - low
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
    return np.repeat(place, size), seeds.items[at]


def best_window(item: Item, grams: np.ndarray, low: int, high: int, end: int, threshold: float) -> tuple[float, int]:
    """Likeness and beginning of the most similar window that begins in ``low..high``; a text ends at ``end``.

    ``grams`` are the shingles that begin at each word. A window has the item's size, less at the end.
    """
    begin = np.arange(low, high + 1)
    stop = np.minimum(begin + item.size, end) - item.width + 1
    part = grams[low : stop[-1]]
    at = np.minimum(np.searchsorted(item.grams, part), len(item.grams) - 1)
    has = item.grams[at] == part
    begin, stop = begin - low, stop - low
    total, size, bound = int(item.times.sum()), [], []
    for scale in item.scales:
        weight = np.where(has, scale[at], 1.0)
        sums = np.concatenate([[0], np.cumsum(weight)])
        held = np.concatenate([[0], np.cumsum(weight * has)])
        size.append(sums[stop] - sums[begin])
        both = np.minimum(held[stop] - held[begin], total)
        bound.append(both / (total + size[-1] - both))  # a shingle's repeats may count too often
    bound = np.maximum(*bound)
    best, where = 0.0, low
    for k in np.argsort(-bound, kind="stable").tolist():
        if bound[k] < max(best, threshold) - 1e-9:
            break
        s, e = begin[k], stop[k]
        counts = np.minimum(item.times, np.bincount(at[s:e][has[s:e]], minlength=len(item.grams)))
        both = [float((counts * scale).sum()) for scale in item.scales]
        value = max(x / (total + float(n[k]) - x) for x, n in zip(both, size))
        if value >= threshold and (value, -k) > (best, low - where):
            best, where = value, low + k
    return best, where


def candidates(index: Index, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns text, item, word of all candidates in that order, and which of them a fingerprint gave."""
    found, kinds = [], []

    def add(window, item, length, by_print):
        text = np.searchsorted(first, window, "right") - 1
        inside = window + length <= first[text + 1]  # else the window runs into the next text
        found.append(np.stack([text[inside], item[inside], window[inside]]))
        kinds.append(np.full(int(inside.sum()), by_print))

    longest = max((c.length for c in index.classes), default=0)
    for at in range(0, len(hashes) if index.classes else 0, PIECE):
        part = hashes[at : at + PIECE + longest - 1]
        ones = running_ones(part)
        for entry in index.classes:
            count = min(PIECE, len(part) - entry.length + 1)
            if count > 0:
                window, which = within_radius(entry, window_prints(ones[: count + entry.length], entry.length))
                add(window + at, entry.items[which], entry.length, True)
    for seeds in index.seeds:
        place, item = at_seeds(seeds, run_hashes(hashes, seeds.width))
        add(place, item, seeds.width, False)
    if not found:
        return np.zeros((3, 0), np.int64), np.zeros(0, bool)
    columns, by_print = np.concatenate(found, axis=1), np.concatenate(kinds)
    order = np.lexsort(columns[::-1])
    return columns[:, order], by_print[order]


def hopeful(index: Index, grams: np.ndarray, item: np.ndarray, low: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Which regions of shingles ``low..stop`` hold so many of an item's that a window may reach the threshold."""
    parts = np.cumsum(stop - low) // GATHERED  # regions are looked at in parts, so that memory stays bounded
    cut = np.searchsorted(parts, np.arange(parts[-1] + 2)) if len(parts) else np.zeros(0, np.int64)
    found = [_hopeful(index, grams, item[a:b], low[a:b], stop[a:b]) for a, b in zip(cut[:-1], cut[1:]) if a < b]
    return np.concatenate(found) if found else np.zeros(0, bool)


def _hopeful(index: Index, grams: np.ndarray, item: np.ndarray, low: np.ndarray, stop: np.ndarray) -> np.ndarray:
    size = stop - low
    begin = np.cumsum(size) - size
    at = np.arange(size.sum()) - np.repeat(begin - low, size)
    keys = _keyed(grams[at], np.repeat(item, size))
    place = np.minimum(np.searchsorted(index.keys, keys), len(index.keys) - 1)
    held = np.where(index.keys[place] == keys, index.scales[:, place], 0.0)
    totals = np.array([i.times.sum() for i in index.items])
    return (np.add.reduceat(held, begin, axis=1) >= index.threshold * totals[item] - 1e-9).any(0)


def matches(index: Index, hashes: np.ndarray, first: np.ndarray):
    """``(text, item, first word, similarity, by SimHash)`` of the best window of each contained item."""
    (text, item, window), by_print = candidates(index, hashes, first)
    if not len(text):
        return []
    # Windows of one item that may hold it together are one run.
    sizes, widths = np.array([i.size for i in index.items]), np.array([i.width for i in index.items])
    new = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (window[1:] - window[:-1] > sizes[item[1:]])
    begin = np.concatenate([[0], np.flatnonzero(new) + 1])
    last = np.append(begin[1:], len(text)) - 1
    by_print = np.logical_or.reduceat(by_print, begin)
    t, i, size, width = text[begin], item[begin], sizes[item[begin]], widths[item[begin]]
    low = np.maximum(window[begin] - size + width, first[t])
    high = np.minimum(window[last], first[t + 1] - width)
    best: dict[tuple[int, int], tuple[float, int]] = {}
    found_by: set[tuple[int, int]] = set()
    for w in np.unique(width).tolist():
        grams, of = run_hashes(hashes, w), np.flatnonzero(width == w)
        stop = np.minimum(high[of] + size[of], first[t[of] + 1]) - w + 1
        of = of[hopeful(index, grams, i[of], low[of], stop)]
        for k in of.tolist():
            pair = int(t[k]), int(i[k])
            value, at = best_window(index.items[pair[1]], grams, int(low[k]), int(high[k]), int(first[pair[0] + 1]), index.threshold)
            if value >= index.threshold:
                if by_print[k]:
                    found_by.add(pair)
                if (value, -at) > best.get(pair, (0.0, 0)):
                    best[pair] = (value, -at)
    return [(a, b, -at - int(first[a]), v, (a, b) in found_by) for (a, b), (v, at) in sorted(best.items())]


def _item_shingles(items: DataFrame) -> DataFrame:
    """Each distinct shingle of each text, with a hash of the text's words."""

    def run(batch: pa.RecordBatch):
        for block in blocks(batch.column(0)):
            hashes, first = plain_words(block)
            words = [hashes[a:b] for a, b in zip(first[:-1], first[1:])]
            grams = [np.unique(item_shingles(w)) for w in words]
            names = [run_hashes(w, len(w))[0] if len(w) else np.uint64(0) for w in words]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(names, np.uint64), [len(g) for g in grams]).view(np.int64)),
                 pa.array(np.concatenate(grams).view(np.int64))], names=["words", "gram"])

    return over_batches(items.select("text"), run, "words bigint, gram bigint")


def _indexes(spark: SparkSession, items: DataFrame, threshold: float):
    """Item indexes, one after the other, each of about ``ITEMS_AT_ONCE`` items at most."""
    items = items.select("item_id", "text").where("item_id is not null and text is not null").distinct()
    parts = max(1, -(-items.count() // ITEMS_AT_ONCE))
    held = _item_shingles(items).distinct().groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    if parts > 1:
        held = cut_lineage(held)
    for k in range(parts):
        block = items.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == k)
        rows = block.orderBy("item_id", "text").collect()
        if rows:
            here = held if parts == 1 else held.join(_item_shingles(block).select("gram").distinct(), "gram")
            shared = {r.gram % (1 << 64): r.n for r in here.select("gram", "n").collect()}
            yield spark.sparkContext.broadcast(build_index([r.item_id for r in rows], [r.text for r in rows], threshold, shared))


_RESULT = "doc_id bigint, item_id bigint, first_word bigint, similarity double, by_simhash boolean"


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, item_id, first_word, similarity, by_simhash)`` of every item (item_id, text) found in a document.

    One row per row of ``docs`` and item, for its most similar window. Null and empty texts hold
    nothing, items without words are found nowhere, an item of fewer than five words is one shingle.
    Rows of one item_id with several texts each count. Repeated documents each have their rows; other
    columns are ignored. Without documents or items there are no rows.
    """
    spark = docs.sparkSession
    result = spark.createDataFrame([], _RESULT)
    for shared in _indexes(spark, items, threshold):

        def run(batch: pa.RecordBatch, shared=shared):
            for block in blocks(batch.column(1)):
                found = matches(shared.value, *plain_words(block))
                if found:
                    ids = batch.column(0).slice(block.first, len(block)).to_pylist()
                    columns = zip(*[(ids[t], shared.value.ids[i], w, v, b) for t, i, w, v, b in found])
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in _RESULT.split(", ")])

        result = result.union(over_batches(docs.select("doc_id", "text"), run, _RESULT))
    return result


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that hold an item; all columns and all other rows stay as they are."""
    at = docs.columns.index("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    for shared in _indexes(docs.sparkSession, items, threshold):

        def run(batch: pa.RecordBatch, shared=shared):
            for block in blocks(batch.column(at)):
                keep = np.ones(len(block), bool)
                keep[[t for t, *_ in matches(shared.value, *plain_words(block))]] = False
                yield batch.slice(block.first, len(block)).filter(pa.array(keep))

        docs = over_batches(docs, run, schema)
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
