"""BPE encoding and decoding by a tokenization automaton.

The automaton reads token labels. It begins as one state with a loop for every base symbol. The merge
``u v -> w`` adds one gadget: wherever an arc ``u`` leads to a state with an arc ``v``, an arc ``w`` is
added that leads to a copy of what followed ``v``, and the ``v`` after ``u`` is cut. After all merges,
every text has exactly one accepted label sequence, and that is its BPE encoding; every prefix of a
text too, so reading from left to right never backtracks over more than the longest label.

All arcs with one label lead to one state, so a state is named by its label. A state is stored as its
difference from the state it was copied from (a parent and a time), and an arc as the arc it was laid
beside (its left part and a time). The walk along these differences decides an arc once; the result
goes into the transition table, which serves all later words.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.llm.pretokens import ENCODE_BYTES, WordEncoder
from strataframe.llm.tables import documents, over_batches, vocabulary
from strataframe.llm.textblocks import blocks, ragged_take

WORD_END = "</w>"
TABLE_ARCS = 500_000


class MergeAutomaton:
    """The automaton of one merge list; ``encode`` takes byte-level words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.labels = dict(model["vocab"])
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        size = max(max(self.labels.values()), *special.values(), -1) + 1
        self.left, self.right = [-1] * size, [-1] * size
        self.born = [-1] * size
        self.cut: dict[tuple[int, int], int] = {}
        self.dead: set[int] = set()
        self.table: dict[int, bool] = {}
        for time, pair in enumerate(model["merges"]):
            first, second = pair if not isinstance(pair, str) else pair.split(" ")
            u, v, w = self.labels[first], self.labels[second], self.labels[first + second]
            if u in self.dead or v in self.dead or not self._walk(u, v, time):
                self.dead.add(w)  # no text reaches this gadget
                continue
            self.left[w], self.right[w], self.born[w] = u, v, time
            self.cut[u, v] = time
        inner = {t: i for t, i in self.labels.items() if not t.endswith(WORD_END) and i not in self.dead}
        final = {t.removesuffix(WORD_END): i for t, i in self.labels.items() if t.endswith(WORD_END) and i not in self.dead}
        self.inner, self.final = inner, final
        self.longest_inner, self.longest_final = max(map(len, inner)), max(map(len, final))
        texts = [b""] * size
        for text, label in (self.labels | special).items():
            texts[label] = text.encode() + b" "
        self.texts = np.frombuffer(b"".join(texts), np.uint8)
        self.text_first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)

    def _walk(self, state: int, label: int, time: float) -> bool:
        """Whether the state has an arc with this label after the gadgets before ``time``."""
        left, right, born, cut = self.left, self.right, self.born, self.cut
        while True:
            when = cut.get((state, label))
            if when is not None and when < time:
                return False
            made, copied = born[label], born[state]
            if made < 0 and copied < 0:
                return True
            if label == state:
                # The copy was made before the cut, and the new arc then laid beside the left part.
                time, state, label = made, right[state], left[label]
            elif made > copied:
                # The arc was laid beside its left part, unless that part repeats itself here.
                if left[label] == right[label] == state:
                    return False
                time, label = made, left[label]
            else:
                time, state = copied, right[state]

    def arc(self, state: int, label: int) -> bool:
        key = state << 20 | label
        known = self.table.get(key)
        if known is None:
            if len(self.table) >= TABLE_ARCS:
                self.table.clear()
            known = self.table[key] = self._walk(state, label, float("inf"))
        return known

    def encode_word(self, word: str) -> list[int]:
        size = len(word)
        whole = self.final.get(word)
        if whole is not None:
            return [whole]
        states, back = [0] * (size + 1), [0] * (size + 1)
        inner, arc = self.inner.get, self.arc
        for end in range(1, size + 1):
            labels, longest = (inner, self.longest_inner) if end < size else (self.final.get, self.longest_final)
            for begin in range(max(0, end - longest), end):
                label = labels(word[begin:end])
                if label is not None and (begin == 0 or arc(states[begin], label)):
                    states[end], back[end] = label, begin
                    break
            else:
                raise ValueError(f"no path for {word!r}")
        found, end = [], size
        while end:
            found.append(states[end])
            end = back[end]
        return found[::-1]

    def encode(self, words: list[str]) -> list[list[int]]:
        return [self.encode_word(word) for word in words]

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 text of each id sequence: its arc labels, with one blank between two."""
        emitted, begin = ragged_take(self.texts, self.text_first, ids)
        bounds = begin[first]
        keep = np.ones(len(emitted), bool)
        keep[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = False
        return emitted[keep], np.concatenate([[0], np.cumsum(keep)])[bounds]


@lru_cache(maxsize=2)
def automaton(path: str) -> MergeAutomaton:
    return MergeAutomaton(path)


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path, automaton(path).encode)


def _binary(data: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    bits = 4 if kind in (pa.binary(), pa.string()) else 8
    offsets = pa.py_buffer(first.astype(f"<i{bits}").tobytes())
    return pa.Array.from_buffers(kind, len(first) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(data).tobytes())])


def encode_decode(docs: DataFrame, path: str, text: str = "text", decode: bool = True) -> DataFrame:
    """``docs`` without ``text``, with ``ids`` (binary, little-endian uint32) and ``decoded`` (string).

    A null or empty text has no ids and decodes to the empty text. Any other columns, nulls in them,
    repeated rows and ties pass through unchanged; columns named ``ids`` or ``decoded`` are replaced.
    An empty table gives an empty one. One block of texts is in memory at a time.
    """
    others = [c for c in docs.columns if c not in (text, "ids", "decoded")]
    kept = docs.select(*others, F.col(text).alias("ids"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]]
    fields += ["ids binary"] + ["decoded string"] * decode

    def run(batch: pa.RecordBatch):
        column = batch.column(len(others))
        for block in blocks(column, ENCODE_BYTES):
            ids, first = _encoder(path).ids(block)
            rest = [batch.column(i).slice(block.first, len(block)) for i in range(len(others))]
            new = [_binary(ids, first * 4, pa.binary())]
            if decode:
                new.append(_binary(*automaton(path).decode(ids, first), pa.string()))
            yield pa.RecordBatch.from_arrays(rest + new, names=others + ["ids", "decoded"][: len(new)])

    return over_batches(kept, run, ", ".join(fields))


def query(spark, sf_dir: str) -> DataFrame:
    coded = encode_decode(documents(spark, sf_dir), vocabulary())
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
