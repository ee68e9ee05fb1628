"""Document fingerprints by one-permutation MinHash.

Every word shingle is hashed once. The hash's upper bits choose one of ``BINS`` bins, which keeps its
smallest hash. An empty bin is filled by optimal densification: it tries other bins in an order drawn
from its own number, the same for all documents, until one is not empty. The low ``BITS`` bits of each
bin's hash, packed and written in base 64, are the fingerprint.

Two fingerprints agree in a bin by chance with probability ``2 ** -BITS``, so the likeness of two
documents is estimated as ``(agreeing - chance) / (1 - chance)``, held within 0 and 1.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from strataframe.llm.ordering import descending_blocks
from strataframe.llm.tables import documents, over_batches
from strataframe.llm.textblocks import Texts, blocks, lower_ascii, mix, shingles, word_hashes, words_of

BINS = 512
BITS = 4
SHINGLE_WORDS = 5
ROWS_AT_ONCE = 512
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def signatures(texts: Texts, width: int = SHINGLE_WORDS, bins: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """Densified bin minima (texts x bins), and whether each text has any word.

    Words are runs of bytes between ASCII white space, with A-Z as a-z. A text with fewer words than a
    shingle has one shingle, all its words.
    """
    lower = lower_ascii(texts)
    words = words_of(lower)
    found, owner = shingles(word_hashes(lower.data, words), words.first, width)
    table = np.full(len(texts) * bins, _EMPTY)
    slot = owner * bins + ((found >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    np.minimum.at(table, slot, mix(found))
    table = table.reshape(len(texts), bins)
    return _densify(table), words.counts > 0


def _densify(table: np.ndarray) -> np.ndarray:
    empty = table == _EMPTY
    single = (~empty).sum(1) == 1
    if single.any():  # every bin would end at the only full one
        table[single] = table[single].min(1, keepdims=True)
    todo = empty & ~single[:, None] & ~empty.all(1)[:, None]
    row, bin_ = np.nonzero(todo)
    full = ~empty
    attempt, bins = 0, np.uint64(table.shape[1])
    while len(row):
        attempt += 1
        draw = mix(bin_.astype(np.uint64) * np.uint64(0x100000001) + np.uint64(attempt))
        other = ((draw >> np.uint64(32)) * bins >> np.uint64(32)).astype(np.int64)
        hit = full[row, other]
        table[row[hit], bin_[hit]] = table[row[hit], other[hit]]
        row, bin_ = row[~hit], bin_[~hit]
    return table


def pack(table: np.ndarray, has_words: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The low bits of each bin, packed to bytes; a text without words is all zero bytes."""
    # Bins filled from one bin must not agree by chance all together, so the bin's number goes in.
    own = mix(np.arange(1, table.shape[1] + 1, dtype=np.uint64))
    low = (mix(table ^ own) & np.uint64((1 << bits) - 1)).astype(np.uint8)
    low[~has_words] = 0
    planes = (low[:, :, None] >> np.arange(bits - 1, -1, -1, dtype=np.uint8)) & 1
    return np.packbits(planes.reshape(len(low), -1), axis=1)


def likeness(a: np.ndarray, b: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Estimated Jaccard likeness of packed fingerprints, row by row."""
    differ = np.unpackbits(a ^ b, axis=1).reshape(len(a), -1, bits).any(2)
    chance = 2.0**-bits
    return np.clip((1 - differ.mean(1) - chance) / (1 - chance), 0, 1)


def compare(a: np.ndarray, b: np.ndarray, a_words: np.ndarray, b_words: np.ndarray) -> np.ndarray:
    """Likeness; two texts without words are alike, one of them is unlike any other text."""
    return np.where(a_words & b_words, likeness(a, b), (a_words == b_words).astype(float))


def text_form(packed: np.ndarray, has_words: np.ndarray) -> list[str]:
    return [base64.b64encode(row.tobytes()).decode() if some else "" for row, some in zip(packed, has_words)]


def fingerprints(docs: DataFrame, text: str = "text", column: str = "fingerprint") -> DataFrame:
    """``docs`` without ``text``, with its fingerprint (string).

    A null text, an empty one and one of white space only have the empty fingerprint. Other columns,
    nulls in them and repeated rows pass through; a column of the result's name is replaced.
    """
    others = [c for c in docs.columns if c not in (text, column)]
    kept = docs.select(*others, text)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]] + [f"`{column}` string"])

    def run(batch: pa.RecordBatch):
        for block in blocks(batch.column(len(others))):
            table, some = signatures(block)
            rest = [batch.column(i).slice(block.first, len(block)) for i in range(len(others))]
            yield pa.RecordBatch.from_arrays(rest + [pa.array(text_form(pack(table, some), some))], names=others + [column])

    return over_batches(kept, run, schema)


RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def _answer(pairs: list[tuple]) -> pa.RecordBatch:
    ids, texts, nexts = [a[2] for a, _ in pairs], [a[3] for a, _ in pairs], [b[3] for _, b in pairs]
    cuts = [len(t) // 3 for t in texts]
    edited = [t[: len(t) - k] + n[:k] for t, n, k in zip(texts, nexts, cuts)]
    # A row's successor is mostly the next row; where it is not, its text comes behind all rows.
    other = [i for i in range(len(pairs)) if i + 1 == len(pairs) or pairs[i][1] is not pairs[i + 1][0]]
    follows = np.arange(1, len(pairs) + 1)
    follows[other] = len(pairs) + np.arange(len(other))
    (own, has), (new, new_has) = _packed(texts + [nexts[i] for i in other]), _packed(edited)
    n = len(pairs)
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array(list(map(len, texts)), pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
        pa.array(text_form(own[:n], has[:n])), pa.array(text_form(new, new_has)),
        pa.array(compare(own[:n], new, has[:n], new_has)),
        pa.array(compare(own[:n], own[follows], has[:n], has[follows])),
    ], names=[f.split()[0] for f in RESULT.split(", ")])


def _packed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    packed, some = [], []
    for block in blocks(pa.array(texts, pa.large_string())):
        table, words = signatures(block)
        packed.append(pack(table, words))
        some.append(words)
    return np.concatenate(packed), np.concatenate(some)


def with_successors(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of the text edited with its successor's beginning, and their likeness.

    The successor is the next document by descending doc_id, the first after the last; a single
    document succeeds itself. A null text counts as empty. Documents without doc_id come last; those
    that repeat one follow each other by ascending text. Other columns are ignored; an empty table
    gives no rows.
    """

    def run(batches):
        last = None  # the row whose successor has not been seen
        for batch in batches:
            for block in blocks(batch.column(3)):
                part = batch.slice(block.first, len(block))
                texts = [t or "" for t in part.column(3).to_pylist()]
                rows = list(zip(*(part.column(i).to_pylist() for i in range(3)), texts))
                chain = ([last] if last else []) + rows
                last = chain[-1]
                # Of a block's guests only the first is a successor; no guest has a result of its own.
                pairs = [(a, b) for a, b in zip(chain, chain[1:]) if a[1] == 0 and a[0] == b[0]]
                for at in range(0, len(pairs), ROWS_AT_ONCE):
                    yield _answer(pairs[at : at + ROWS_AT_ONCE])

    placed = descending_blocks(docs.select("doc_id", "text"), "doc_id")
    return placed.mapInArrow(run, RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_successors(documents(spark, sf_dir))
