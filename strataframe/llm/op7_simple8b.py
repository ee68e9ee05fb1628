"""Token-ID files in Simple-8b words.

Every 64-bit word has a 4-bit selector and a payload of 60 bits, which holds ``count`` ids of ``width``
bits each. Ids are coded in blocks of ``BLOCK_IDS``; a block starts with a new word, and the offsets of
all blocks are stored beside the words, so any block can be decoded without those before it. An id of
60 bits or more is an escape: selector 15 with the top payload bit set, whose other payload bits are
its place among the block's raw ids.

A file is a Parquet file; each of its rows is a section of whole documents::

    shard, section      place in the order of documents
    start, n_ids        ids before the section in its shard, ids in the section
    doc_ids, sizes      documents and their numbers of ids (a document without doc_id: NULL)
    words               Simple-8b words, little-endian uint64
    word_offsets        first word of each block, little-endian int64, one more than blocks
    escapes             raw ids of all blocks, little-endian uint64
    escape_offsets      first raw id of each block, as above

so the files inherit Spark's commit protocol, and a lost executor leaves no half-written file.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.llm.pretokens import WordEncoder, splitter
from strataframe.llm.tables import documents, partitions, scratch_dir, vocabulary
from strataframe.llm.textblocks import blocks

BLOCK_IDS = 1024
SECTION_IDS = 1 << 20
END_ID = 2
#: Texts taken together, and words whose ids are kept: the fewer, the more often the library is asked.
TEXT_BYTES = 4 << 20
KEPT_WORDS = 500_000

# Fixed values of the Simple-8b scheme: ids per word and bits per id, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
ONE_BIG = 15  # one id of up to 60 bits, or an escape: told apart by the top payload bit
_ESCAPE = np.uint64(1 << 59)


_SHORT_BITS = np.zeros(1 << 16, np.uint8)
for _b in range(16):
    _SHORT_BITS[1 << _b : 2 << _b] = _b + 1


def _bits(ids: np.ndarray) -> np.ndarray:
    """The bits of each id."""
    if ids.max() < 1 << 16:
        return _SHORT_BITS[ids.astype(np.uint16)]
    bits = np.zeros(len(ids), np.uint8)
    for b in range(64):
        bits += (ids >> np.uint64(b)) != 0
    return bits


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, first word of each block, raw ids, first raw id of each block."""
    ids = np.asarray(ids, np.uint64)
    total = len(ids)
    n_blocks = -(-total // BLOCK_IDS)
    if not total:
        none = np.zeros(1, np.int64)
        return np.zeros(0, np.uint64), none, np.zeros(0, np.uint64), none
    ends = np.minimum((np.arange(total) // BLOCK_IDS + 1) * BLOCK_IDS, total).astype(np.int32)
    # The selector a word would have if it began here: the first whose ids all fit and end in the block.
    selector = np.full(total, ONE_BIG, np.uint8)
    bits = _bits(ids)
    for s in range(ONE_BIG - 1, -1, -1):
        count, width = int(COUNTS[s]), int(WIDTHS[s])
        # The places of the ids that fit: ``count`` of them in a row lie that far apart.
        fits = np.flatnonzero((ids == 1) if s == 0 else bits <= width)
        if count > len(fits):
            continue
        at = fits[: len(fits) - count + 1]
        at = at[fits[count - 1 :] - at == count - 1]
        at = at[at + count <= ends[at]]
        selector[at] = s
    # Follow the chain of words in all blocks at once.
    step = COUNTS[selector]
    place = np.arange(n_blocks, dtype=np.int64) * BLOCK_IDS
    limit = ends[place]
    starts = []
    while len(place):
        starts.append(place)
        place = place + step[place]
        alive = place < limit
        place, limit = place[alive], limit[alive]
    starts = np.sort(np.concatenate(starts))
    owners = starts // BLOCK_IDS
    chosen = selector[starts]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen):
        count, width = int(COUNTS[s]), int(WIDTHS[s])
        at = np.flatnonzero(chosen == s)
        if not width:
            continue
        if s == ONE_BIG:
            continue
        for k in range(count):
            words[at] |= ids[starts[at] + k] << np.uint64(width * k)
    big = np.flatnonzero(chosen == ONE_BIG)
    values = ids[starts[big]]
    raw = values >= _ESCAPE
    words[big[~raw]] |= values[~raw]
    escaped = big[raw]
    escape_first = np.searchsorted(owners[escaped], np.arange(n_blocks + 1))
    words[escaped] |= _ESCAPE | (np.arange(len(escaped)) - escape_first[owners[escaped]]).astype(np.uint64)
    return words, np.searchsorted(owners, np.arange(n_blocks + 1)), values[raw], escape_first


def unpack(words: np.ndarray, word_first: np.ndarray, raw: np.ndarray, raw_first: np.ndarray) -> np.ndarray:
    """The ids (uint64) of whole blocks; any run of blocks may be given with its part of the arrays."""
    if not len(words):
        return np.zeros(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    payload = words & np.uint64((1 << 60) - 1)
    begin = np.concatenate([[0], np.cumsum(COUNTS[selector])])
    ids = np.empty(begin[-1], np.uint64)
    for s in np.unique(selector):
        count, width = int(COUNTS[s]), int(WIDTHS[s])
        at = np.flatnonzero(selector == s)
        mask = np.uint64((1 << width) - 1)
        for k in range(count):
            ids[begin[at] + k] = np.uint64(s == 0) if not width else (payload[at] >> np.uint64(width * k)) & mask
    escaped = np.flatnonzero((selector == ONE_BIG) & (payload >= _ESCAPE))
    if len(escaped):
        block = np.searchsorted(word_first, escaped, "right") - 1
        place = (payload[escaped] & (_ESCAPE - np.uint64(1))).astype(np.int64)
        ids[begin[escaped]] = raw[raw_first[block] + place]
    return ids


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    model = splitter(path).tokenizer.model
    return WordEncoder(path, lambda words: [[token.id for token in model.tokenize(word)] for word in words], KEPT_WORDS)


FILE_SCHEMA = (
    "shard int, section int, start long, n_ids long, doc_ids array<bigint>, sizes array<bigint>,"
    " words binary, word_offsets binary, escapes binary, escape_offsets binary"
)


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int = END_ID, shards: int | None = None) -> None:
    """Encode ``docs`` (doc_id, text) and write them in ascending order of doc_id.

    A null or empty text is the end id alone. Rows without doc_id come first; rows that repeat a
    doc_id follow each other in the order of their texts. Other columns are not stored. An empty table
    gives files without rows.
    """
    shards = shards or partitions(docs.sparkSession)
    ordered = (
        docs.select("doc_id", "text").repartitionByRange(shards, F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    )

    def sections(batches):
        encoder, shard = _encoder(path), TaskContext.get().partitionId()
        section = start = 0
        names: list = []
        sizes: list[np.ndarray] = []
        parts: list[np.ndarray] = []
        held = 0

        def row():
            ids = np.concatenate(parts)
            words, first, raw, raw_first = pack(ids)
            data = [[shard], [section], [start], [len(ids)], [names], [np.concatenate(sizes)]]
            data += [[words.astype("<u8").tobytes()], [first.astype("<i8").tobytes()]]
            data += [[raw.astype("<u8").tobytes()], [raw_first.astype("<i8").tobytes()]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            kinds += [pa.binary()] * 4
            labels = ["shard", "section", "start", "n_ids", "doc_ids", "sizes", "words", "word_offsets", "escapes", "escape_offsets"]
            return pa.RecordBatch.from_arrays([pa.array(d, k) for d, k in zip(data, kinds)], names=labels)

        for batch in batches:
            for block in blocks(batch.column(1), TEXT_BYTES):
                ids, first = encoder.ids(block)
                # The end id goes behind each document.
                ended = np.full(len(ids) + len(block), end_id, np.uint32)
                ended[np.arange(len(ids)) + np.repeat(np.arange(len(block)), np.diff(first))] = ids
                names += batch.column(0).slice(block.first, len(block)).to_pylist()
                sizes.append(np.diff(first) + 1)
                parts.append(ended)
                held += len(ended)
                if held >= SECTION_IDS:
                    yield row()
                    section, start = section + 1, start + held
                    names, sizes, parts, held = [], [], [], 0
        if parts:
            yield row()

    ordered.mapInArrow(sections, FILE_SCHEMA).write.parquet(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids (binary, little-endian uint32)."""
    return _decoded(spark, folder, "ids binary", pa.binary(), lambda ids: ids)


def read_token_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """As ``read_token_files``, with the crc32 of the ids instead of the ids."""
    return _decoded(spark, folder, "ids_crc32 bigint", pa.int64(), zlib.crc32)


def _decoded(spark, folder: str, field: str, kind: pa.DataType, finish) -> DataFrame:
    files = spark.read.schema(FILE_SCHEMA).parquet(folder)
    # One number per shard, whose count is that of the write tasks.
    totals = {r.shard: r.ids for r in files.groupBy("shard").agg(F.sum("n_ids").alias("ids")).collect()}
    base, before = {}, 0
    for shard in sorted(totals):
        base[shard] = before
        before += totals[shard]

    def decode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                arrays = [np.frombuffer(row[c], t) for c, t in
                          (("words", "<u8"), ("word_offsets", "<i8"), ("escapes", "<u8"), ("escape_offsets", "<i8"))]
                ids = unpack(*arrays).astype("<u4")
                sizes = np.asarray(row["sizes"], np.int64)
                first = np.concatenate([[0], np.cumsum(sizes)])
                data = memoryview(ids).cast("B")
                values = [finish(data[4 * a : 4 * b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(first[:-1] + row["start"] + base[row["shard"]]),
                     pa.array(sizes), pa.array(values, kind)],
                    names=["doc_id", "start", "n_tokens", field.split()[0]],
                )

    return files.mapInArrow(decode, f"doc_id bigint, start bigint, n_tokens bigint, {field}")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "token-files")
    write_token_files(documents(spark, sf_dir), folder, vocabulary())
    return read_token_checksums(spark, folder)
