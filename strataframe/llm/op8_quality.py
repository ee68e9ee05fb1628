"""Quality classifier: random-indexing word vectors, pooled per document, into a small network.

Tokens are runs of letters, of digits and of signs, with their case, hashed to ``ROWS`` rows. Each row
has a sparse random index vector; a row's context vector is the sum of the index vectors of all tokens
that stand next to its tokens anywhere in the corpus. A document is the weighted mean and spread of its
tokens' vectors, frequent rows counting less. A network of two layers, trained in numpy on a bounded
sample of labelled documents, gives a logit; its temperature is fitted on a part of the sample that
training did not see.

Only counting the contexts and scoring read all texts; both stay in their partition. What is gathered
has a fixed size: the ``ROWS x DIMS`` sums, one table per task, and the sample's pooled vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.llm.tables import documents, over_batches, table
from strataframe.llm.textblocks import Texts, Words, blocks, word_hashes

ROWS = 1 << 14
DIMS = 64
NONZEROS = 2
SLICES = 32  # parts of the table that are added up apart
TRAIN_ROWS = 12_000  # bound of the labelled sample
HIDDEN = 32
EPOCHS = 60
BLOCK = 1 << 20
PIECE = 1 << 12  # tokens pooled at a time; their vectors stay in the processor's cache

_KINDS = np.full(256, 3, np.uint8)
_KINDS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
_KINDS[0x30:0x3A] = 2
_KINDS[0x41:0x5B] = _KINDS[0x61:0x7B] = _KINDS[0x80:] = 1
_rng = np.random.default_rng(11)
_PLACES = _rng.integers(0, DIMS, (ROWS, NONZEROS))
_SIGNS = _rng.choice([-1.0, 1.0], (ROWS, NONZEROS))


def tokens(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Rows of all tokens, and where each text's begin."""
    kinds = _KINDS[texts.data]
    n = len(kinds)
    start = np.zeros(n, bool)
    start[texts.offsets[:-1][texts.offsets[:-1] < n]] = True
    start[1:] |= kinds[1:] != kinds[:-1]
    edge = np.append(np.flatnonzero(start), n)
    keep = kinds[edge[:-1]] != 0 if n else np.zeros(0, bool)
    words = Words(edge[:-1][keep], edge[1:][keep], np.searchsorted(edge[:-1][keep], texts.offsets))
    return (word_hashes(texts.data, words) >> np.uint64(64 - 14)).astype(np.int64), words.first


def context_sums(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Context vectors (ROWS x DIMS) and token counts of all rows over all texts."""

    def run(batches):
        sums, counts = np.zeros(ROWS * DIMS), np.zeros(ROWS, np.int64)
        for batch in batches:
            for block in blocks(batch.column(0)):
                rows, first = tokens(block)
                counts += np.bincount(rows, minlength=ROWS)
                same = np.ones(max(len(rows) - 1, 0), bool)
                inner = first[1:-1]
                same[inner[(inner > 0) & (inner < len(rows))] - 1] = False
                left, right = rows[:-1][same], rows[1:][same]
                for a, b in ((left, right), (right, left)):
                    for k in range(NONZEROS):
                        sums += np.bincount(a * DIMS + _PLACES[b, k], _SIGNS[b, k], ROWS * DIMS)
        if counts.any():
            packed = np.concatenate([sums.reshape(ROWS, DIMS), counts[:, None]], axis=1).reshape(SLICES, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(SLICES), pa.int32()), pa.array([p.astype("<f8").tobytes() if abs(p).max() >= 1 << 31 else p.astype("<i4").tobytes() for p in packed])],
                names=["slice", "sums"])

    def add(part: pa.Table) -> pa.Table:
        size = ROWS // SLICES * (DIMS + 1)
        total = np.zeros(size)
        for sums in part.column("sums"):
            data = sums.as_buffer()
            total += np.frombuffer(data, "<i4" if data.size == 4 * size else "<f8")
        return pa.table({"slice": part.column("slice").slice(0, 1), "sums": pa.array([total.astype("<f8").tobytes()])})

    parts = docs.select("text").mapInArrow(run, "slice int, sums binary").groupBy("slice").applyInArrow(add, "slice int, sums binary")
    whole = np.zeros((SLICES, ROWS // SLICES * (DIMS + 1)))
    for row in parts.collect():  # SLICES rows
        whole[row.slice] = np.frombuffer(row.sums, "<f8")
    whole = whole.reshape(ROWS, DIMS + 1)
    return whole[:, :DIMS], whole[:, DIMS]


@dataclass
class Model:
    vectors: np.ndarray  # ROWS x DIMS, with the row's weight in the last column
    mean: np.ndarray
    scale: np.ndarray
    layers: tuple
    temperature: float

    def scores(self, pooled: np.ndarray) -> np.ndarray:
        logits = _forward(self.layers, (pooled - self.mean) / self.scale)[1] / self.temperature
        return 1 / (1 + np.exp(-np.clip(logits, -40, 40)))


def word_vectors(sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    weight = 1e-3 / (1e-3 + counts / max(counts.sum(), 1))
    return np.concatenate([sums / np.maximum(norm, 1e-9), weight[:, None]], axis=1).astype(np.float32)


def pool(texts: Texts, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of each text's token vectors; zeros for a text without tokens."""
    rows, first = tokens(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    sums = np.zeros((len(texts), 2 * DIMS + 1))
    for at in range(0, len(rows), PIECE):
        own = owner[at : at + PIECE]
        taken = vectors[rows[at : at + PIECE]]
        weighted = taken[:, :DIMS] * taken[:, DIMS:]
        begin = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        part = [np.add.reduceat(x, begin, axis=0) for x in (weighted, weighted * taken[:, :DIMS], taken[:, DIMS:])]
        sums[own[begin]] += np.concatenate(part, axis=1)
    total = np.maximum(sums[:, -1:], 1e-12)
    mean = sums[:, :DIMS] / total
    spread = np.sqrt(np.maximum(sums[:, DIMS : 2 * DIMS] / total - mean**2, 0))
    return np.concatenate([mean, spread], axis=1)


def _forward(layers, x):
    w1, b1, w2, b2 = layers
    hidden = np.maximum(x @ w1 + b1, 0)
    return hidden, hidden @ w2 + b2


def train(x: np.ndarray, y: np.ndarray, seed: int = 5):
    """Two layers by Adam on the logistic loss."""
    rng = np.random.default_rng(seed)
    width = x.shape[1]
    params = [rng.normal(0, (2 / width) ** 0.5, (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, (2 / HIDDEN) ** 0.5, HIDDEN), np.zeros(())]
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 128):
            part = order[at : at + 128]
            hidden, logit = _forward(params, x[part])
            error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y[part]) / len(part)
            back = np.outer(error, params[2]) * (hidden > 0)
            grads = [x[part].T @ back + 1e-4 * params[0], back.sum(0), hidden.T @ error + 1e-4 * params[2], error.sum()]
            t += 1
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                params[k] = params[k] - 2e-3 * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return tuple(params)


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least logistic loss."""
    tries = np.geomspace(0.25, 10, 80)
    loss = [np.mean(np.logaddexp(0, -(2 * y - 1) * logits / t)) for t in tries]
    return float(tries[int(np.argmin(loss))])


def held_out(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Word vectors over all ``docs`` (text), and a network for ``labels`` (doc_id, quality).

    Learns from at most ``train_rows`` labelled documents, those with the smallest hash of doc_id;
    documents held out, labels that are NULL and labels without document are never used. With fewer
    than two labels of either kind the network stays at the share of label 1.
    """
    spark = docs.sparkSession
    vectors = word_vectors(*context_sums(docs))
    wanted = labels.where(~held_out() & F.col("quality").isNotNull()).select("doc_id", F.col("quality").cast("int").alias("quality"))
    wanted = wanted.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(train_rows)
    shared = spark.sparkContext.broadcast(vectors)

    def run(batch: pa.RecordBatch):
        for block in blocks(batch.column(2), BLOCK):
            part = batch.slice(block.first, len(block))
            data = pool(block, shared.value).astype("<f4")
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([d.tobytes() for d in data], pa.binary())], names=["doc_id", "quality", "pooled"])

    sample = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id").select("doc_id", "quality", "text")
    rows = over_batches(sample, run, "doc_id bigint, quality int, pooled binary").collect()
    rows.sort(key=lambda r: (r.doc_id, r.quality, bytes(r.pooled)))
    width = 2 * DIMS
    x = np.array([np.frombuffer(r.pooled, "<f4") for r in rows], np.float64).reshape(-1, width)
    y = np.array([r.quality for r in rows], np.float64)
    mean, scale = (x.mean(0), x.std(0) + 1e-6) if len(x) else (np.zeros(width), np.ones(width))
    if len(y) and 2 <= y.sum() <= len(y) - 2:
        x = (x - mean) / scale
        check = np.random.default_rng(3).random(len(x)) < 0.2
        layers = train(x[~check], y[~check])
        temperature = fit_temperature(_forward(layers, x[check])[1], y[check]) if check.any() else 1.0
    else:
        share = (y.sum() + 1) / (len(y) + 2)
        layers = (np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.asarray(np.log(share / (1 - share))))
        temperature = 1.0
    return Model(vectors, mean, scale, layers, temperature)


def score(docs: DataFrame, model: Model, column: str = "score", with_text: bool = True) -> DataFrame:
    """``docs``, with or without ``text``, and a score from 0 to 1, higher where quality 1 is likelier.

    Null, empty and wordless texts have the score of a document without tokens. Other columns and
    repeated rows pass through; a column of the result's name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*[c for c in docs.columns if c != column])
    at = kept.columns.index("text")
    given = [i for i in range(len(kept.columns)) if with_text or i != at]
    names = [kept.columns[i] for i in given] + [column]
    schema = ", ".join([f"`{kept.columns[i]}` {kept.schema[i].dataType.simpleString()}" for i in given] + [f"`{column}` double"])

    def run(batch: pa.RecordBatch):
        for block in blocks(batch.column(at), BLOCK):
            values = shared.value.scores(pool(block, shared.value.vectors))
            part = batch.slice(block.first, len(block))
            yield pa.RecordBatch.from_arrays([part.column(i) for i in given] + [pa.array(values)], names=names)

    return over_batches(kept, run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = score(docs, model, with_text=False)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
