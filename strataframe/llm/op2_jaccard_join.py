"""N-gram Jaccard join by adaptive multi-match prefixes, and the groups its links form.

Documents with one shingle set are one class. Shingles are ordered by how many classes hold them, so a
class's rarest come first. Two sets that reach the threshold share at least ``k`` of the first
``s - ceil(t s) + k`` shingles of either, for any ``k``. Each class chooses its own ``k`` by the
estimated cost of scanning and verifying what its prefix would meet, so a class with frequent shingles
takes a longer prefix and demands more matches of a partner.

Counting is a shuffle of packed arrays: shingle hashes of a chunk of documents go to the bucket of
their upper bits, which counts them and returns those held more than once to the chunk. Whatever two
sets share is among these, so they also suffice to verify a pair, and texts are not shuffled. Classes
that may meet are brought together as components of "has this shingle in its prefix". A component is
joined in memory; a large one by parts of its prefix shingles, so that a class goes to as many parts as it
has such shingles, however large the component is, and the part of the first prefix shingle that two classes
share decides on the pair. Only a part that a single shingle overfills is joined as pairs of blocks.
``links_of`` gives every link, ``linked_documents`` how
many each document has; ``classes_of`` needs components only, and skips pairs that connect nothing new.

Equality of shingles is equality of 64-bit hashes of word hashes, of which at least 52 bits are
compared; sets are told apart by 128 bits.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.llm.components import components
from strataframe.llm.tables import cut_lineage, documents, over_batches, text_hash
from strataframe.llm.textblocks import (
    Texts, blocks, distinct_per_text, lower_ascii, mix, ragged_take, shingles, word_hashes, words_of,
)

CHUNK_SHINGLES = 1 << 20
CHUNK_TEXTS = 1 << 16
BUCKET_SHINGLES = 1 << 20
HOT_SHARE = 1 << 16  # a shingle is hot if it makes up more than one in so many; so at most twice as many are
HOT_LEAST = 16
MAX_MATCHES = 4
BLOCK_CLASSES = 4096
BUNDLE_CLASSES = 2048
CONNECT, COUNT, EVERY = "connect", "count", "every"
LOW_BITS = np.uint64((1 << 48) - 1)


def shingle_sets(texts: Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and where each text's begin."""
    lower = lower_ascii(texts)
    words = words_of(lower)
    found, owner = shingles(word_hashes(lower.data, words), words.first, width)
    return distinct_per_text(found, owner, len(texts))


def _digests(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """128 bits that depend on a set's members only (texts x 2)."""
    sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(values ^ np.uint64(salt)))]) for salt in (0, 0x5DEECE66D)]
    return np.stack([mix(s[first[1:]] - s[first[:-1]]) for s in sums], axis=1)


_PROFILE_NAMES = ["doc_id", "text_hash", "n_shingles", "class", "shingle", "times"]


def _profiles(docs: DataFrame, width: int) -> DataFrame:
    """Rows of two kinds: documents with their set's size and class, and shingles frequent in a chunk."""

    def run(batches):
        held, size = [], 0

        def frequent():
            values = np.sort(np.concatenate(held))
            new = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
            counts = np.diff(np.append(new, len(values)))
            often = counts >= max(HOT_LEAST, len(values) // HOT_SHARE)
            n = int(often.sum())
            return pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()),
                 pa.array(values[new][often].view(np.int64)), pa.array(counts[often])],
                names=_PROFILE_NAMES)

        for batch in batches:
            for block in blocks(batch.column(1)):
                values, first = shingle_sets(block, width)
                n = len(block)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, n), batch.column(2).slice(block.first, n), pa.array(np.diff(first)),
                     pa.array([d.tobytes() for d in _digests(values, first)], pa.binary()),
                     pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())],
                    names=_PROFILE_NAMES)
                held.append(values)
                size += len(values)
                if size >= CHUNK_SHINGLES:
                    yield frequent()
                    held, size = [], 0
        if size:
            yield frequent()

    named = docs.select("doc_id", "text", text_hash().alias("text_hash"))
    return named.mapInArrow(run, "doc_id bigint, text_hash bigint, n_shingles bigint, class binary, shingle bigint, times bigint")


_CHUNKED = "bucket int, chunk bigint, docs boolean, a binary, b binary, c binary, d binary"
_CHUNKED_NAMES = ["bucket", "chunk", "docs", "a", "b", "c", "d"]


def _chunk_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.bool_()] + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_CHUNKED_NAMES)


def _deal(docs: DataFrame, width: int, bucket_bits: int, hot) -> DataFrame:
    """Shingles by bucket (a, b: their low bits, c: text in chunk), and one row per chunk of its texts."""

    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        sets, firsts, texts, size = [], [], 0, 0

        def chunk():
            values = np.concatenate(sets)
            counts = np.concatenate([np.diff(f) for f in firsts])
            first = np.concatenate([[0], np.cumsum(counts)])
            digests = _digests(values, first)
            # Of equal sets in the chunk one stays.
            _, keep = np.unique(digests.view("V16").ravel(), return_index=True)
            keep = np.sort(keep[counts[keep] > 0])
            if not len(keep):
                return
            values, first = ragged_take(values, first, keep)
            counts = np.diff(first)
            owner = np.repeat(np.arange(len(keep)), counts).astype(np.uint16)
            frequent = hot.value
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)
                is_hot = frequent[at] == values
            else:
                is_hot = np.zeros(len(values), bool)
            name = task << 24 | number
            # The first chunks of all tasks must not meet in one bucket.
            dealt_to = int(mix(np.uint64(name)) >> np.uint64(64 - bucket_bits))
            rows = [(dealt_to, name, True, digests[keep].tobytes(), counts.astype("<i4").tobytes(),
                     values[is_hot].tobytes(), owner[is_hot].tobytes())]
            values, owner = values[~is_hot], owner[~is_hot]
            bucket = (values >> np.uint64(64 - bucket_bits)).astype(np.uint32)
            order = np.argsort(bucket.astype(np.uint16) if bucket_bits <= 16 else bucket, kind="stable")
            values, owner, bucket = values[order], owner[order], bucket[order]
            begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else []
            low, high = values.astype("<u4"), ((values & LOW_BITS) >> np.uint64(32)).astype("<u2")
            for s, e in zip(begin, [*begin[1:], len(bucket)]):
                rows.append((int(bucket[s]), name, False, low[s:e].tobytes(), high[s:e].tobytes(), owner[s:e].tobytes(), b""))
            for at in range(0, len(rows), 4096):
                yield _chunk_rows(rows[at : at + 4096])

        for batch in batches:
            for block in blocks(batch.column(0)):
                values, first = shingle_sets(block, width)
                if texts and (size + len(values) > CHUNK_SHINGLES or texts + len(block) > CHUNK_TEXTS):
                    yield from chunk()
                    sets, firsts, texts, size, number = [], [], 0, 0, number + 1
                for at in range(0, len(block), CHUNK_TEXTS):
                    stop = min(at + CHUNK_TEXTS, len(block))
                    sets.append(values[first[at] : first[stop]])
                    firsts.append(first[at : stop + 1])
                    texts, size = texts + stop - at, size + len(sets[-1])
                    if stop < len(block):
                        yield from chunk()
                        sets, firsts, texts, size, number = [], [], 0, 0, number + 1
        if texts:
            yield from chunk()

    return docs.select("text").mapInArrow(run, _CHUNKED)


def _count_bucket(bucket_bits: int):
    def count(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        through = [r for r in rows if r["docs"]]
        rows = [r for r in rows if not r["docs"]]
        out = [tuple(r[n] for n in _CHUNKED_NAMES) for r in through]
        if rows:
            low = np.concatenate([np.frombuffer(r["a"], "<u4") for r in rows]).astype(np.uint64)
            high = np.concatenate([np.frombuffer(r["b"], "<u2") for r in rows]).astype(np.uint64)
            text = np.concatenate([np.frombuffer(r["c"], np.uint16) for r in rows])
            row = np.repeat(np.arange(len(rows)), [len(r["a"]) // 4 for r in rows])
            values = high << np.uint64(32) | low
            order = np.argsort(values, kind="stable")
            ordered = values[order]
            begin = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            times = np.diff(np.append(begin, len(ordered)))
            held = np.empty(len(values), np.uint32)
            held[order] = np.repeat(times, times)
            bucket = rows[0]["bucket"]
            again = held > 1
            top = np.uint64(bucket << (64 - bucket_bits))
            values, text, held, row = values[again] | top, text[again], held[again], row[again]
            cut = np.searchsorted(row, np.arange(len(rows) + 1))
            for k, r in enumerate(rows):
                s, e = cut[k], cut[k + 1]
                if e > s:
                    out.append((bucket, r["chunk"], False, values[s:e].tobytes(), held[s:e].tobytes(), text[s:e].tobytes(), b""))
        return pa.Table.from_batches([_chunk_rows(out)]) if out else table.slice(0, 0)

    return count


def _choose_prefixes(numerator: int, denominator: int, hot_times: int):
    """Of one chunk: the classes whose prefix holds a shingle that another class may hold."""

    def choose(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        head = next(r for r in rows if r["docs"])
        rows = [r for r in rows if not r["docs"]]
        size = np.frombuffer(head["b"], "<i4").astype(np.int64)
        n = len(size)
        hot = np.frombuffer(head["c"], np.uint64)
        value = np.concatenate([np.frombuffer(r["a"], np.uint64) for r in rows] + [hot])
        times = np.concatenate([np.frombuffer(r["b"], np.uint32) for r in rows] + [np.full(len(hot), hot_times)]).astype(np.int64)
        text = np.concatenate([np.frombuffer(r["c"], np.uint16) for r in rows] + [np.frombuffer(head["d"], np.uint16)])
        is_hot = np.arange(len(value)) >= len(value) - len(hot)
        order = np.lexsort((value, times, is_hot, text))
        value, times, text = value[order], times[order], text[order]
        first = np.searchsorted(text, np.arange(n + 1))
        shared = np.diff(first)
        single = size - shared
        needed = -(-size * numerator // denominator)
        meets = np.concatenate([[0], np.cumsum(times - 1)])
        best = np.full(n, np.inf)
        matches = np.ones(n, np.int64)
        reach = np.zeros(n, np.int64)
        for k in range(1, MAX_MATCHES + 1):
            prefix = np.minimum(size - needed + k, size)
            length = np.clip(prefix - single, 0, shared)
            scanned = meets[first[:-1] + length] - meets[first[:-1]]
            # At most scanned / k classes meet it k times; each is verified against the whole set.
            cost = scanned + (scanned / k) * size / 8
            better = (cost < best) & (needed >= k)
            best, matches, reach = np.where(better, cost, best), np.where(better, k, matches), np.where(better, length, reach)
        keep = np.flatnonzero(reach > 0)
        digests = np.frombuffer(head["a"], "V16")
        return pa.table({
            "class": pa.array([digests[i].tobytes() for i in keep], pa.binary()),
            "size": pa.array(size[keep], pa.int32()), "matches": pa.array(matches[keep], pa.int32()),
            "reach": pa.array(reach[keep], pa.int32()),
            "shingles": pa.array([value[first[i] : first[i + 1]].tobytes() for i in keep], pa.binary()),
        })

    return choose


def _short():
    """Eight bytes for a class; two classes that agree in them are only compared needlessly."""
    return F.xxhash64("class")


def _part(shingles: np.ndarray, parts) -> np.ndarray:
    """Which of a component's parts a prefix shingle belongs to."""
    return (_dealt(shingles) % parts).astype(np.int64)


def _dealt(shingles: np.ndarray) -> np.ndarray:
    return (mix(shingles) >> np.uint64(1)).astype(np.int64)


def _joined(numerator: int, denominator: int, mode: str):
    """Joins components, or parts of them, in memory: rows of one bundle to links ``(a, b)`` and counts of links ``(a, n_links)``.

    By ``mode``: ``CONNECT`` gives only links that connect something new, ``COUNT`` gives these and the
    number of all links of each class, ``EVERY`` gives all links.
    """

    def join(table: pa.Table) -> pa.Table:
        comp, part = (table.column(c).to_numpy() for c in ("component", "part"))
        order = np.lexsort((part, comp))
        comp, part = comp[order], part[order]
        begin = np.flatnonzero(np.concatenate([[True], (comp[1:] != comp[:-1]) | (part[1:] != part[:-1])]))
        names, packed = table.column("class").to_pylist(), table.column("shingles").to_pylist()
        size, matches, reach, side, parts = (table.column(c).to_numpy() for c in ("size", "matches", "reach", "side", "parts"))
        links: list[tuple[bytes, bytes | None, int | None]] = []
        across = table.column("low")[0].as_py() != table.column("high")[0].as_py()
        if across and side.min() == side.max():
            begin = begin[:0]  # the other block is empty
        for s, e in zip(begin, [*begin[1:], len(comp)]):
            seen: dict[bytes, int] = {}
            for i in order[s:e]:
                seen.setdefault(names[i], i)
            if len(seen) > 1:
                rows = np.fromiter(seen.values(), np.int64)
                rows = rows[np.argsort(size[rows], kind="stable")]
                sets = [np.frombuffer(packed[i], np.uint64) for i in rows]
                found, times = join_sets(
                    sets, size[rows], matches[rows], reach[rows], side[rows], numerator, denominator, mode, int(part[s]), int(parts[rows[0]]))
                links += [(names[rows[a]], names[rows[b]], None) for a, b in found]
                if mode == COUNT:
                    links += [(names[rows[i]], None, int(times[i])) for i in np.flatnonzero(times)]
        columns = list(zip(*links)) or [(), (), ()]
        kinds = {"a": pa.binary(), "b": pa.binary(), "n_links": pa.int64()}
        return pa.table({n: pa.array(c, k) for (n, k), c in zip(kinds.items(), columns)})

    return join


def join_sets(
    sets, size, matches, reach, side, numerator: int, denominator: int, mode: str, part: int = 0, parts: int = 1,
) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links among sets in ascending order of size (if not ``EVERY``: as far as they connect something new), and counts.

    The counts, of all links of each set, are whole unless ``mode`` is ``CONNECT``.

    ``sets`` hold the shingles that others may hold, in the common order; ``reach`` of them belong to
    the prefix. If both sides occur, only pairs between the sides count. Of several ``parts`` only pairs
    count whose first common prefix shingle is in this ``part``.
    """
    n = len(sets)
    counts = np.fromiter(map(len, sets), np.int64, n)
    first = np.concatenate([[0], np.cumsum(counts)])
    shingle, local = np.unique(np.concatenate(sets), return_inverse=True)
    mine_to_join = (_part(shingle, parts) == part).tolist() if parts > 1 else None
    two_sides = side.min() != side.max()
    size = size.astype(np.int64)
    index: dict[int, list[int]] = {}
    root = np.arange(n)
    mark = np.zeros(int(local.max()) + 1, np.int8)
    links, times = [], np.zeros(n, np.int64)
    for d in range(n):
        prefix = local[first[d] : first[d] + reach[d]].tolist()
        shared = [t for t in prefix if t in index]
        if mine_to_join and not any(mine_to_join[t] for t in shared):
            shared = []
        near = [np.asarray(index[t]) for t in shared]
        if near:
            met = np.bincount(np.concatenate(near), minlength=d)[:d]
            may = np.flatnonzero(met)
            ok = (met[may] >= np.minimum(matches[may], matches[d])) & (size[may] * denominator >= numerator * size[d])
            if mode == CONNECT:
                ok &= root[may] != root[d]
            if two_sides:
                ok &= side[may] != side[d]
            if mine_to_join:
                ours = np.zeros(d, bool)
                for t, x in zip(reversed(shared), reversed(near)):
                    ours[x] = mine_to_join[t]  # the first in the common order is set last
                ok &= ours[may]
            may = may[ok]
            if len(may):
                mine = local[first[d] : first[d + 1]]
                mark[mine] = 1
                values, begin = ragged_take(local, first, may)
                sums = np.concatenate([[0], np.cumsum(mark[values], dtype=np.int64)])
                both = sums[begin[1:]] - sums[begin[:-1]]
                mark[mine] = 0
                partners = may[both * denominator >= numerator * (size[may] + size[d] - both)]
                times[partners] += 1
                times[d] += len(partners)
                for c in (partners if mode == EVERY else partners[root[partners] != root[d]]).tolist():
                    if mode == EVERY:
                        links.append((c, d))
                    elif root[c] != root[d]:
                        root[root == root[c]] = root[d]
                        links.append((c, d))
        for t in prefix:
            index.setdefault(t, []).append(d)
    return links, times


def _placed(near: DataFrame, posted: DataFrame, hubs: DataFrame) -> DataFrame:
    """``(node, component, parts, part)``: where each node of ``near`` (node, component) is joined with others.

    A component of up to ``BLOCK_CLASSES`` nodes is one part. A larger one is cut into parts by the shingles that prefixes
    share (``posted``: node, shingle, dealt; ``hubs``: shingle), as many as blocks of its postings; a node is in the parts
    of its own shingles, so rows grow with postings, not with the size of the component.
    """
    counts = near.groupBy("component").agg(F.count("*").alias("n"))
    single = near.join(counts.where(F.col("n") <= BLOCK_CLASSES), "component").select(
        "node", "component", F.lit(1).alias("parts"), F.lit(0).alias("part"))
    large = near.join(counts.where(F.col("n") > BLOCK_CLASSES).select("component"), "component")
    held = cut_lineage(
        posted.join(hubs.select("shingle"), "shingle").join(large, "node").select("node", "component", "dealt").distinct())
    parts = held.groupBy("component").agg(F.ceil(F.count("*") / BLOCK_CLASSES).cast("int").alias("parts"))
    part = (F.col("dealt") % F.col("parts")).cast("int").alias("part")
    return single.unionByName(held.join(parts, "component").select("node", "component", "parts", part).distinct())


def _join(docs: DataFrame, width: int, numerator: int, denominator: int, mode: str) -> tuple[DataFrame, DataFrame]:
    """Rows of documents with their size and class, and the links and counts of ``mode``."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    profile = cut_lineage(_profiles(docs, width))
    rows = profile.where("class is not null").select("doc_id", "text_hash", "n_shingles", "class")
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    least = max(total // HOT_SHARE, HOT_LEAST)
    frequent = (
        profile.where("times is not null").groupBy("shingle").agg(F.sum("times").alias("times"))
        .where(F.col("times") >= max(least // 2, HOT_LEAST)).select("shingle").collect()
    )
    hot = spark.sparkContext.broadcast(np.sort(np.array([r.shingle for r in frequent], np.int64).view(np.uint64)))
    bits = max(4, math.ceil(math.log2(max(1, total / BUCKET_SHINGLES))))

    dealt = _deal(docs, width, bits, hot)
    counted = dealt.groupBy("bucket").applyInArrow(_count_bucket(bits), _CHUNKED)
    chosen = cut_lineage(counted.groupBy("chunk").applyInArrow(
        _choose_prefixes(numerator, denominator, least), "class binary, size int, matches int, reach int, shingles binary"
    ))

    def postings(batch):
        reach = batch.column(1).to_numpy()
        values = [np.frombuffer(s, np.int64)[:r] for s, r in zip(batch.column(2).to_pylist(), reach)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(batch.column(0).to_numpy(), reach)), pa.array(np.concatenate(values)),
             pa.array(_dealt(np.concatenate(values).view(np.uint64)))], names=["node", "shingle", "dealt"])

    posted = over_batches(chosen.select(_short().alias("node"), "reach", "shingles"), postings, "node bigint, shingle bigint, dealt bigint")
    posted = cut_lineage(posted)
    hubs = posted.groupBy("shingle").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z").select("shingle", "a")
    edges = posted.join(hubs, "shingle").where("a <> node").select("a", F.col("node").alias("b")).distinct()
    near = components(edges)

    placed = cut_lineage(_placed(near, posted, hubs))
    sizes = placed.groupBy("component", "part").agg(F.ceil(F.count("*") / BLOCK_CLASSES).cast("int").alias("k"))
    bundles = max(1, placed.count() // BUNDLE_CLASSES)
    block = F.pmod(F.xxhash64("class"), F.col("k")).cast("int")
    # A class meets every block of its part, its own included; the smaller block number is side 0.
    tasks = (
        chosen.withColumn("node", _short()).join(placed.join(sizes, ["component", "part"]), "node").withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        .select(
            "component", "part", "parts", "class", "size", "matches", "reach", "shingles",
            F.when(F.col("k") == 1, F.pmod(F.xxhash64("component", "part"), F.lit(bundles))).otherwise(F.xxhash64("component", "part")).alias("bundle"),
            F.when(F.col("k") == 1, -1).otherwise(F.least("block", "other")).alias("low"),
            F.when(F.col("k") == 1, -1).otherwise(F.greatest("block", "other")).alias("high"),
            (F.col("block") > F.col("other")).cast("int").alias("side"),
        )
    )
    links = cut_lineage(tasks.groupBy("bundle", "low", "high").applyInArrow(
        _joined(numerator, denominator, mode), "a binary, b binary, n_links bigint"))
    return rows, links


def links_of(docs: DataFrame, width: int, numerator: int, denominator: int) -> tuple[DataFrame, DataFrame]:
    """Every link between different classes, once, as ``(class_a, class_b)``, and ``(doc_id, n_shingles, class)`` of each row.

    A class is 128 bits of a shingle set; documents with one set are one class and are not linked by a row.
    """
    rows, links = _join(docs, width, numerator, denominator, EVERY)
    return links.select(F.least("a", "b").alias("class_a"), F.greatest("a", "b").alias("class_b")), rows.drop("text_hash")


# Documents in the order in which one of a component is kept: rows without doc_id last.
_ORDER = "struct(doc_id is null as none, doc_id, text_hash)"


def _components(rows: DataFrame, links: DataFrame) -> DataFrame:
    linked = components(links.where("b is not null"))
    classes = rows.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("first_id"), F.min(F.expr(_ORDER)).alias("first_row"))
    classes = classes.join(linked.withColumnRenamed("node", "class"), "class", "left")
    lowest = classes.groupBy(F.coalesce("component", "class").alias("root")).agg(F.min("first_id").alias("component_id"), F.min("first_row").alias("kept"))
    return classes.select("class", F.coalesce("component", "class").alias("root")).join(lowest, "root").select("class", "component_id", "kept")


_COMPONENT = "case when n_shingles > 0 then component_id else doc_id end as component_id"


def classes_of(docs: DataFrame, width: int, numerator: int, denominator: int) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of each row of ``docs`` (doc_id, text).

    Two documents link when ``denominator * |A and B| >= numerator * |A or B|`` of their sets of
    ``width``-word shingles; a text with fewer words has one shingle, its whole sequence. A document
    without words (null and empty texts too) is linked with nothing. ``component_id`` is the smallest
    doc_id reachable by links, itself included. Rows that repeat a text or a doc_id each have a result;
    a row without doc_id takes part and is never a component's name, unless no row of it has one
    (NULL). Other columns are ignored; an empty table gives no rows.
    """
    rows, links = _join(docs, width, numerator, denominator, CONNECT)
    return rows.join(_components(rows, links), "class", "left").selectExpr("doc_id", "n_shingles", _COMPONENT)


def near_copies(docs: DataFrame, width: int, numerator: int, denominator: int) -> DataFrame:
    """``(doc_id, text_hash)``, distinct, of all documents but one of each component.

    That one has the component's smallest doc_id (any before NULL), and of its texts the smallest hash.
    """
    rows, links = _join(docs, width, numerator, denominator, CONNECT)
    named = rows.where("n_shingles > 0").join(_components(rows, links), "class")
    return named.where(F.expr(f"{_ORDER} <> kept")).select("doc_id", "text_hash").distinct()


def linked_documents(docs: DataFrame, width: int, numerator: int, denominator: int) -> DataFrame:
    """``classes_of`` with ``n_links``: to how many other shingle sets a document's set is linked."""
    rows, links = _join(docs, width, numerator, denominator, COUNT)
    counts = links.where("n_links is not null").groupBy(F.col("a").alias("class")).agg(F.sum("n_links").alias("n_links"))
    named = _components(rows, links).join(counts, "class", "left")
    return rows.join(named, "class", "left").selectExpr("doc_id", "n_shingles", _COMPONENT, "coalesce(n_links, 0) as n_links")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_documents(documents(spark, sf_dir), 4, 85, 100)
