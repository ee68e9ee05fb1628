"""Substring dedup by seed and extend.

Seeds are winnowed anchors: of the 25-word grams inside every window of ``min_words`` words, the one
with the smallest hash. Copies of a window choose the same anchor, so documents are joined on anchors
alone. Where an anchor occurs in more than one document, its occurrences are extended both ways, by the
hashes of all windows that chose it; runs of windows that a smaller doc_id also holds are joined to
maximal repeats, whose words are removed.

Occurrences travel in packed arrays, by the bucket of their anchor. Before that, each chunk of
documents settles what repeats inside it and sends every window once, so a passage in a third of all
documents costs a bucket one entry per chunk.

Equality of anchors and windows is that of hashes: 64 bits of the anchor and 48 more of the window. Rows are
named by their doc_id and 128 bits of their text, so that rows without doc_id, or with one, are kept apart.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.llm.tables import cut_lineage, documents, unused
from strataframe.llm.textblocks import Texts, Words, blocks, mix, ragged_take, run_hashes, word_hashes, words_of

MIN_WORDS = 50
CHUNK_WORDS = 1 << 20
BUCKET_WORDS = 1 << 20
LAST = (1 << 63) - 1  # stands for a missing doc_id
LOW_BITS = np.uint64((1 << 48) - 1)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    power, size = values, 1
    while size * 2 <= width:
        power = np.minimum(power[:-size], power[size:])
        size *= 2
    total = len(values) - width + 1
    return np.minimum(power[:total], power[width - size : width - size + total])


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, anchor, text and place in the text of every window of ``width`` words."""
    total = len(hashes) - width + 1
    if total <= 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), none, none
    gram = width // 2
    whole = run_hashes(hashes, width)
    anchor = _sliding_min(run_hashes(hashes, gram), width - gram + 1)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[:total]
    place = np.arange(total) - first[:-1][text]
    inside = first[1:][text] - np.arange(total) >= width
    return whole[inside], anchor[inside], text[inside], place[inside]


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal values in all columns begin."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _repeated(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries have the key of a smaller doc, and which have the smallest doc of their key."""
    order = np.argsort(key, kind="stable")
    begin = _runs(key[order])
    if not len(begin):
        return np.zeros(0, bool), np.zeros(0, bool)
    least = np.minimum.reduceat(doc[order], begin)
    lowest = np.empty(len(key), np.int64)
    lowest[order] = np.repeat(least, np.diff(np.append(begin, len(key))))
    return doc > lowest, doc == lowest


_DEALT = "bucket int, settled boolean, anchor binary, doc binary, mark binary, other binary, place binary, size binary, low binary, high binary"
_DEALT_NAMES = [f.split()[0] for f in _DEALT.split(", ")]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.bool_()] + [pa.binary()] * 8
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_DEALT_NAMES)


def _stretches(doc, mark, other, place):
    """Runs of neighbouring windows of one row: where they begin in the arrays. Rows that share a doc_id, or have
    none, are told apart by two hashes of their text."""
    step = place - np.arange(len(place))
    return _runs(doc, mark, other, step)


def _deal(docs: DataFrame, width: int, bits: int) -> DataFrame:
    def run(batches):
        held: list[tuple] = []
        size = number = 0
        task = TaskContext.get().partitionId()

        def chunk():
            columns = [list(c) for c in zip(*held)]
            held.clear()  # so that only one copy of each column stays in memory
            for i, c in enumerate(columns):
                columns[i] = np.concatenate(c)
            whole, anchor, doc, mark, other, place = columns
            columns.clear()
            again, lowest = _repeated(whole, doc)
            rows = []
            # The first chunks of all tasks must not meet in one bucket, so the task counts as well.
            settled = int(mix(np.uint64(task << 24 | number)) >> np.uint64(64 - bits))
            if again.any():
                d, m, o, p = doc[again], mark[again], other[again], place[again]
                at = _stretches(d, m, o, p)
                sizes = np.diff(np.append(at, len(d)))
                rows.append((settled, True, b"", d[at].tobytes(), m[at].tobytes(), o[at].tobytes(),
                             p[at].astype("<i4").tobytes(), sizes.astype("<i4").tobytes(), b"", b""))
            whole, anchor, doc, mark, other, place = (x[lowest] for x in (whole, anchor, doc, mark, other, place))
            del again, lowest
            begin = _runs(anchor, doc, mark, other, place - np.arange(len(place)))
            sizes = np.diff(np.append(begin, len(place)))
            # An anchor is the smallest of many hashes, so its own upper bits are mostly zero.
            bucket = (mix(anchor[begin]) >> np.uint64(64 - bits)).astype(np.uint32)
            order = np.argsort(bucket, kind="stable")
            begin_all = np.append(begin, len(place))
            windows_in, _ = ragged_take(whole, begin_all, order)
            begin, sizes, bucket = begin[order], sizes[order], bucket[order]
            inner = np.concatenate([[0], np.cumsum(sizes)])
            low, high = windows_in.astype("<u4"), ((windows_in & LOW_BITS) >> np.uint64(32)).astype("<u2")
            heads = _runs(bucket)
            for s, e in zip(heads, [*heads[1:], len(bucket)]):
                at, a, b = begin[s:e], inner[s], inner[e]
                rows.append((int(bucket[s]), False, anchor[at].tobytes(), doc[at].tobytes(), mark[at].tobytes(),
                             other[at].tobytes(), place[at].astype("<i4").tobytes(), sizes[s:e].astype("<i4").tobytes(),
                             low[a:b].tobytes(), high[a:b].tobytes()))
            for at in range(0, len(rows), 2048):
                yield _rows(rows[at : at + 2048])

        for batch in batches:
            ids = batch.column(0).to_numpy()
            marks, others = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for block in blocks(batch.column(3)):
                words = words_of(block)
                whole, anchor, text, place = windows(word_hashes(block.data, words), words.first, width)
                if held and size + len(whole) > CHUNK_WORDS:
                    yield from chunk()
                    held, size, number = [], 0, number + 1
                held.append((whole, anchor, ids[block.first + text], marks[block.first + text], others[block.first + text], place))
                size += len(whole)
        if held:
            yield from chunk()

    return docs.select("at", "mark", "other", "text").mapInArrow(run, _DEALT)


_FOUND = "at bigint, mark bigint, other bigint, places binary, sizes binary"


def _found(doc, mark, other, place, size) -> pa.Table:
    """One row per document: the stretches of windows to remove."""
    order = np.lexsort((place, other, mark, doc))
    doc, mark, other, place, size = doc[order], mark[order], other[order], place[order].astype("<i4"), size[order].astype("<i4")
    begin = _runs(doc, mark, other)
    ends = [*begin[1:], len(doc)]
    return pa.table({
        "at": pa.array(doc[begin], pa.int64()), "mark": pa.array(mark[begin], pa.int64()), "other": pa.array(other[begin], pa.int64()),
        "places": pa.array([place[s:e].tobytes() for s, e in zip(begin, ends)], pa.binary()),
        "sizes": pa.array([size[s:e].tobytes() for s, e in zip(begin, ends)], pa.binary()),
    })


def _extend(width: int):
    def extend(table: pa.Table) -> pa.Table:
        parts = []
        rows = table.to_pylist()
        get = lambda name, kind, chosen: np.concatenate([np.frombuffer(r[name], kind) for r in chosen])
        settled = [r for r in rows if r["settled"]]
        if settled:
            parts.append((get("doc", np.int64, settled), get("mark", np.int64, settled), get("other", np.int64, settled),
                          get("place", "<i4", settled), get("size", "<i4", settled)))
        rows = [r for r in rows if not r["settled"]]
        if rows:
            anchor, doc = get("anchor", np.uint64, rows), get("doc", np.int64, rows)
            mark, other = get("mark", np.int64, rows), get("other", np.int64, rows)
            place = get("place", "<i4", rows).astype(np.int64)
            size = get("size", "<i4", rows).astype(np.int64)
            whole = get("high", "<u2", rows).astype(np.uint64) << np.uint64(32) | get("low", "<u4", rows)
            # Seeds: anchors that a smaller document also has, or that also occur in a larger one.
            order = np.argsort(anchor, kind="stable")
            begin = _runs(anchor[order])
            counts = np.diff(np.append(begin, len(order)))
            low, high = np.minimum.reduceat(doc[order], begin), np.maximum.reduceat(doc[order], begin)
            seeds = np.sort(order[np.repeat(low != high, counts)])
            if len(seeds):
                first = np.concatenate([[0], np.cumsum(size)])
                values, _ = ragged_take(whole, first, seeds)
                owner = np.repeat(seeds, size[seeds])
                shift = np.arange(len(owner)) - np.repeat(np.concatenate([[0], np.cumsum(size[seeds])[:-1]]), size[seeds])
                # Extension: the windows around a seed that a smaller document has around the same seed.
                key = values ^ (anchor[owner] * np.uint64(0x9E3779B97F4A7C15))
                again, _ = _repeated(key, doc[owner])
                if again.any():
                    row = owner[again]
                    d, m, o, p = doc[row], mark[row], other[row], place[row] + shift[again]
                    order = np.lexsort((p, o, m, d))
                    d, m, o, p = d[order], m[order], o[order], p[order]
                    at = _stretches(d, m, o, p)
                    parts.append((d[at], m[at], o[at], p[at], np.diff(np.append(at, len(p)))))
        if not parts:
            return _found(*(np.zeros(0, k) for k in [np.int64] * 5))
        return _found(*(np.concatenate(c) for c in zip(*parts)))

    return extend


def covered_words(words: Words, places: list, sizes: list, width: int) -> np.ndarray:
    """Which words lie in a window to remove."""
    change = np.zeros(len(words.starts) + 1, np.int64)
    for i, (p, s) in enumerate(zip(places, sizes)):
        if p:
            begin = words.first[i] + np.frombuffer(b"".join(p), "<i4").astype(np.int64)
            np.add.at(change, begin, 1)
            np.add.at(change, begin + np.frombuffer(b"".join(s), "<i4") + width - 1, -1)
    return np.cumsum(change)[:-1] > 0


def joined_words(texts: Texts, words: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kept words of each text with one blank between them: bytes, and where each text begins."""
    starts, lengths = words.starts[keep], (words.ends - words.starts)[keep]
    begin = np.concatenate([[0], np.cumsum(lengths + 1)])
    index = np.arange(begin[-1]) + np.repeat(starts - begin[:-1], lengths + 1)
    data = np.append(texts.data, np.uint8(0x20))[index]
    blank = begin[1:] - 1
    data[blank] = 0x20
    first = np.concatenate([[0], np.cumsum(keep)])[words.first]
    # The blank behind a text's last word goes.
    out = np.ones(len(data), bool)
    last = first[1:][first[1:] > first[:-1]] - 1
    out[blank[last]] = False
    return data[out], np.concatenate([[0], np.cumsum(out)])[begin[first]]


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept``, the words that stay, one blank apart.

    A word goes if a window of ``min_words`` words that covers it also begins in a document with a
    smaller doc_id; windows are those of the input. Repeats inside one document, or among rows that
    share a doc_id, stay. A row without doc_id counts as larger than all others. A null text has no
    words. Other columns pass through (``n_words``, ``n_removed`` and ``kept`` are replaced); an empty
    table gives no rows.
    """
    width = min_words
    others = [c for c in docs.columns if c not in ("text", "n_words", "n_removed", "kept")]
    at, mark, other, spots, lengths = (unused(docs.columns, n) for n in ("_at", "_mark", "_other", "_places", "_sizes"))
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(
        *others, "text", F.coalesce("doc_id", F.lit(LAST)).cast("long").alias(at), F.xxhash64(text).alias(mark),
        F.xxhash64(F.lit("other"), text).alias(other),
    )
    # Bytes are counted to size the buckets; a word has two at least, with what follows it.
    volume = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(4, math.ceil(math.log2(max(1, volume / 6 / BUCKET_WORDS))))
    dealt = _deal(keyed.select(F.col(at).alias("at"), F.col(mark).alias("mark"), F.col(other).alias("other"), "text"), width, bits)
    found = cut_lineage(dealt.groupBy("bucket").applyInArrow(_extend(width), _FOUND))
    per_doc = found.groupBy(F.col("at").alias(at), F.col("mark").alias(mark), F.col("other").alias(other)).agg(
        F.collect_list("places").alias(spots), F.collect_list("sizes").alias(lengths)
    )
    joined = keyed.join(per_doc, [at, mark, other], "left").select(*others, "text", spots, lengths)
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields[:-3]] + ["n_words bigint", "n_removed bigint", "kept string"]
    )

    def finish(batches):
        n = len(others)
        for batch in batches:
            for block in blocks(batch.column(n)):
                words = words_of(block)
                part = batch.slice(block.first, len(block))
                gone = covered_words(words, part.column(n + 1).to_pylist(), part.column(n + 2).to_pylist(), width)
                data, first = joined_words(block, words, ~gone)
                sums = np.concatenate([[0], np.cumsum(gone)])
                removed = sums[words.first[1:]] - sums[words.first[:-1]]
                kept = pa.Array.from_buffers(
                    pa.string(), len(block), [None, pa.py_buffer(first.astype("<i4").tobytes()), pa.py_buffer(data.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(n)] + [pa.array(words.counts), pa.array(removed), kept],
                    names=others + ["n_words", "n_removed", "kept"])

    return joined.mapInArrow(finish, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
