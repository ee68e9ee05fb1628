"""Fingerprints, Jaccard join, substring dedup, encoding and token files against plain code."""

from __future__ import annotations

import array
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strataframe.llm import op1_minhash, op2_jaccard_join, op3_substring_dedup, op6_bpe_automaton, op7_simple8b
from strataframe.llm.components import components
from strataframe.llm.tables import vocabulary
from strataframe.llm.textblocks import blocks, run_hashes, shingles, texts_of, word_hashes, words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string"


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def shingle_set(text, width):
    words = WORD.findall(lower(text or ""))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def prose(rng, n, words=40):
    return " ".join(f"w{rng.randrange(words)}{'abc'[rng.randrange(3)]}" for _ in range(n))


def copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = base.split()
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    base, passage = prose(rng, 300, 4000), prose(rng, 80, 4000)
    texts = [prose(rng, rng.randrange(1, 120), 3000) for _ in range(150)]
    texts += copies(rng, base, 60, 14) + [base] * 20
    texts += [f"{prose(rng, 30, 3000)} {passage} {prose(rng, 20, 3000)}" for _ in range(15)]
    texts += ["", None, " \n\t", "one", "One", "one two", "the " * 400, "the " * 300, "É é\u0085x \x1c y", prose(rng, 20_000, 9000)]
    rng.shuffle(texts)
    return list(enumerate(texts))


def table(spark, rows):
    """Rows with columns whose names an operator uses itself."""
    return spark.createDataFrame(rows, SCHEMA).withColumn("component_id", F.lit("mine")).withColumn("bucket", F.lit(None).cast("int"))


# ---------------------------------------------------------------- hashes


def test_words_and_shingles_follow_the_texts():
    texts = ["a b  c", "", " d\te ", "f"]
    block = texts_of(pa.array(texts))
    words = words_of(block)
    spelled = [block.data[s:e].tobytes().decode() for s, e in zip(words.starts, words.ends)]
    assert spelled == ["a", "b", "c", "d", "e", "f"] and list(words.counts) == [3, 0, 2, 1]
    found, owner = shingles(word_hashes(block.data, words), words.first, 2)
    assert list(owner) == [0, 0, 2, 3] and len(set(found.tolist())) == 4


def test_hashes_do_not_depend_on_what_stands_around():
    a = texts_of(pa.array(["xx alpha beta"]))
    b = texts_of(pa.array(["alpha\n\nbeta yy", "q"]))
    ha, hb = word_hashes(a.data, words_of(a)), word_hashes(b.data, words_of(b))
    assert ha[1] == hb[0] and ha[2] == hb[1]


@pytest.mark.parametrize("width", [1, 2, 3, 7, 25, 50])
def test_run_hashes_are_equal_for_equal_runs_only(width):
    values = np.array(([1, 2, 3, 4, 5] * 30)[:120], np.uint64)
    runs = run_hashes(values, width)
    assert len(runs) == 121 - width
    assert all((runs[i] == runs[j]) == (i % 5 == j % 5) for i in range(20) for j in range(20) if width >= 1)


def test_blocks_hold_whole_texts():
    texts = ["x" * 10, "y" * 100, "", "z" * 5]
    parts = list(blocks(pa.array(texts), 20))
    assert [b.text(i).decode() for b in parts for i in range(len(b))] == texts
    assert [b.first for b in parts] == [0, 1, 2]


# ---------------------------------------------------------------- op1


def test_fingerprints_and_successors(spark, corpus):
    rows = op1_minhash.with_successors(table(spark, corpus)).collect()
    docs = {i: t or "" for i, t in corpus}
    order = sorted(docs, reverse=True)
    got = {r.doc_id: r for r in rows}
    assert sorted(got) == sorted(docs)
    errors, by_text = [], {}
    for a, b in zip(order, order[1:] + order[:1]):
        text, after, r = docs[a], docs[b], got[a]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        for value, other in ((r.near_edited, edited), (r.near_next, after)):
            x, y = shingle_set(text, 5), shingle_set(other, 5)
            exact = len(x & y) / len(x | y) if x | y else 1.0
            assert 0 <= value <= 1
            errors.append(value - exact)
    assert abs(np.mean(errors)) < 0.01 and np.max(np.abs(errors)) < 0.12


def test_successors_of_odd_tables(spark):
    one = op1_minhash.with_successors(spark.createDataFrame([(5, "a b c d e f")], SCHEMA)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert op1_minhash.with_successors(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = op1_minhash.with_successors(spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, None), (7, "d")], SCHEMA)).collect()
    assert sorted(r.n_chars for r in rows) == [0, 1, 1, 1, 1]


def test_fingerprints_keep_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "old", None), (1, None, "old", 3)], "doc_id bigint, text string, fingerprint string, bins int")
    rows = sorted(op1_minhash.fingerprints(docs).collect(), key=lambda r: r.fingerprint)
    assert rows[0].fingerprint == "" and rows[0].bins == 3 and len(rows[1].fingerprint) == 344


# ---------------------------------------------------------------- op2


def brute_components(rows, width, numerator, denominator):
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and denominator * len(x & y) >= numerator * len(x | y):
                root[find(a)] = find(b)
    groups = {}
    for k, (i, _) in enumerate(sets):
        groups.setdefault(find(k), []).append(i)
    return sorted((i, len(s), min(groups[find(k)])) for k, (i, s) in enumerate(sets))


@pytest.mark.parametrize(("width", "numerator", "denominator"), [(4, 85, 100), (5, 4, 5), (1, 1, 2)])
def test_components_match_brute_force(spark, corpus, width, numerator, denominator):
    found = op2_jaccard_join.classes_of(table(spark, corpus), width, numerator, denominator)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in found.collect())
    assert got == brute_components(corpus, width, numerator, denominator)


def test_blocks_chunks_and_hot_shingles_do_not_matter(spark, corpus, monkeypatch):
    for name, value in (("BLOCK_CLASSES", 7), ("CHUNK_SHINGLES", 2000), ("BUCKET_SHINGLES", 1500), ("BUNDLE_CLASSES", 5), ("HOT_LEAST", 8)):
        monkeypatch.setattr(op2_jaccard_join, name, value)
    found = op2_jaccard_join.classes_of(table(spark, corpus), 4, 85, 100)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()) == brute_components(corpus, 4, 85, 100)


def brute_links(rows, width, numerator, denominator):
    sets = {frozenset(shingle_set(t, width)) for _, t in rows} - {frozenset()}
    return [{x, y} for x, y in itertools.combinations(sets, 2) if denominator * len(x & y) >= numerator * len(x | y)]


@pytest.mark.parametrize("small", [False, True])
def test_every_link_is_given_and_counted(spark, corpus, monkeypatch, small):
    for name, value in (("BLOCK_CLASSES", 7), ("CHUNK_SHINGLES", 2000), ("BUCKET_SHINGLES", 1500), ("BUNDLE_CLASSES", 5), ("HOT_LEAST", 8)) * small:
        monkeypatch.setattr(op2_jaccard_join, name, value)
    truth = brute_links(corpus, 4, 85, 100)
    sets = {i: frozenset(shingle_set(t, 4)) for i, t in corpus}
    assert len(truth) > 60  # more than connect the copies
    links, rows = op2_jaccard_join.links_of(table(spark, corpus), 4, 85, 100)
    by_class = {bytes(r["class"]): sets[r.doc_id] for r in rows.collect()}
    got = [{by_class[bytes(r.class_a)], by_class[bytes(r.class_b)]} for r in links.collect()]
    assert len(got) == len(truth) and set(map(frozenset, got)) == set(map(frozenset, truth))
    times = Counter(x for link in truth for x in link)
    found = op2_jaccard_join.linked_documents(table(spark, corpus), 4, 85, 100).collect()
    assert {r.doc_id: r.n_links for r in found} == {i: times[x] for i, x in sets.items()}
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_components(corpus, 4, 85, 100)


@pytest.mark.parametrize("n", [300, 1200])
def test_a_chained_component_is_placed_by_postings(spark, monkeypatch, n):
    """One component of any size: two parts at most for a node of two shingles, small parts, and neighbours meet."""
    monkeypatch.setattr(op2_jaccard_join, "BLOCK_CLASSES", 32)
    pairs = [(i, s) for i in range(n) for s in (i, i + 1)] * 2  # a class may come from two chunks
    dealt = op2_jaccard_join._dealt(np.array([s for _, s in pairs], np.uint64)).tolist()
    posted = spark.createDataFrame([(i, s, d) for (i, s), d in zip(pairs, dealt)], "node long, shingle long, dealt long")
    hubs = spark.range(1, n).select(F.col("id").alias("shingle"))
    near = spark.range(n + 20).select(F.col("id").alias("node"), F.when(F.col("id") < n, 7).otherwise(8).cast("long").alias("component"))
    rows = op2_jaccard_join._placed(near, posted, hubs).collect()
    assert [(r.parts, r.part) for r in rows if r.component == 8] == [(1, 0)] * 20
    rows = [r for r in rows if r.component == 7]
    assert n <= len(rows) <= 2 * n and len({(r.node, r.part) for r in rows}) == len(rows)
    assert max(Counter(r.part for r in rows).values()) <= 3 * 32
    at = {(r.node, r.part) for r in rows}
    for s in range(1, n):
        part = int(op2_jaccard_join._part(np.array([s], np.uint64), rows[0].parts)[0])
        assert {(s - 1, part), (s, part)} <= at


def test_join_of_odd_tables(spark):
    empty = op2_jaccard_join.classes_of(spark.createDataFrame([], SCHEMA), 4, 85, 100)
    assert empty.columns == ["doc_id", "n_shingles", "component_id"] and empty.count() == 0
    rows = [(3, "a b c d e"), (3, "a b c d e"), (None, "a b c d e"), (4, None), (5, ""), (None, "lone text")]
    got = sorted(op2_jaccard_join.classes_of(spark.createDataFrame(rows, SCHEMA), 4, 85, 100).collect(), key=str)
    assert sorted(str(tuple(r)) for r in got) == sorted(map(str, [
        (3, 2, 3), (3, 2, 3), (None, 2, 3), (4, 0, 4), (5, 0, 5), (None, 1, None)]))


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).selectExpr("(id * 37) % 201 as a", "((id + 1) * 37) % 201 as b")
    got = {r.node: r.component for r in components(edges).collect()}
    assert set(got.values()) == {0} and len(got) == 201
    assert components(edges.limit(0)).count() == 0


# ---------------------------------------------------------------- op3


def brute_removal(rows, width):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in sorted(words):
        for k in range(len(w) - width + 1):
            first.setdefault(tuple(w[k : k + width]), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out)


@pytest.mark.parametrize("width", [50, 6, 2])
def test_removal_matches_brute_force(spark, corpus, width):
    kept = op3_substring_dedup.remove_repeats(table(spark, corpus), width).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in kept) == brute_removal(corpus, width)
    assert {r.component_id for r in kept} == {"mine"}


def test_removal_in_many_chunks(spark, corpus, monkeypatch):
    monkeypatch.setattr(op3_substring_dedup, "CHUNK_WORDS", 500)
    monkeypatch.setattr(op3_substring_dedup, "BUCKET_WORDS", 300)
    kept = op3_substring_dedup.remove_repeats(table(spark, corpus), 20).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in kept) == brute_removal(corpus, 20)


def test_removal_of_odd_tables(spark):
    assert op3_substring_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(2, text), (2, text), (None, text + " end"), (1, None), (3, text)]
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in op3_substring_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(-1, 61, 60), (1, 0, 0), (2, 60, 0), (2, 60, 0), (3, 60, 60)]


def test_rows_without_doc_id_are_kept_apart(spark):
    """Two texts, far apart in length, that a 32-bit hash takes for one."""
    passage = " ".join(f"w{i}" for i in range(59))
    rows = [(None, f"{passage} n7177"), (None, "two m148604"), (5, f"start {passage} n7177")]
    hashed = spark.createDataFrame(rows[:2], SCHEMA).select(F.hash("text").alias("h")).distinct()
    assert hashed.count() == 1
    got = {(r.doc_id, r.n_words, r.n_removed) for r in op3_substring_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(None, 60, 60), (None, 2, 0), (5, 61, 0)}


def test_removal_with_missing_and_repeated_ids(spark, corpus, monkeypatch):
    monkeypatch.setattr(op3_substring_dedup, "CHUNK_WORDS", 700)
    rng = random.Random(9)
    rows = [(rng.choice([None, i, i % 40]), t) for i, t in corpus]
    kept = op3_substring_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA), 12).collect()
    last = 1 << 63
    want = brute_removal([(last if i is None else i, t) for i, t in rows], 12)
    assert sorted((last if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept) for r in kept) == want


# ---------------------------------------------------------------- op6, op7


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


@pytest.fixture(scope="module")
def odd_texts(corpus):
    rng = random.Random(5)
    alphabet = "abcXYZ  '''sstmdlrve019.,!?\n\t éÉÑßİΣσ日本é\u0085\x1c\x1f<|>µªº¼²ǅ ŉ"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(300)]
    texts += ["<|endoftext|>a<|startoftext|>", "a" * 3000, "it's we'll 'RE x'vey ''s '", "!?" * 500, "0" * 50]
    return corpus + [(10_000 + i, t) for i, t in enumerate(texts)]


def test_encoding_matches_the_library(spark, odd_texts, library):
    docs = table(spark, odd_texts).withColumn("ids", F.lit(1))
    got = {r.doc_id: r for r in op6_bpe_automaton.encode_decode(docs, vocabulary()).collect()}
    for i, text in odd_texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert list(np.frombuffer(got[i].ids, "<u4")) == ids, text
        assert got[i].decoded == library.decode(ids, skip_special_tokens=False)
    assert op6_bpe_automaton.encode_decode(docs.limit(0), vocabulary()).count() == 0


def test_automaton_on_repeated_symbols(library):
    machine = op6_bpe_automaton.automaton(vocabulary())
    for word in [c * n for c in "a!.=h" for n in range(1, 40)] + ["ha" * n for n in range(1, 20)]:
        assert machine.encode_word(word) == [t.id for t in library.model.tokenize(word)]


def test_packing_is_an_exact_round_trip():
    rng = np.random.default_rng(1)
    cases = [np.zeros(0), np.zeros(3000), np.ones(3000), rng.integers(0, 50_000, 5000), np.array([2**64 - 1, 0, 2**60 - 1, 2**60, 2**59, 2**59 - 1], np.uint64)]
    cases += [rng.integers(0, 2 ** int(b), 2500, dtype=np.uint64) for b in rng.integers(1, 64, 12)]
    for ids in cases:
        ids = np.asarray(ids).astype(np.uint64)
        words, first, raw, raw_first = op7_simple8b.pack(ids)
        assert np.array_equal(op7_simple8b.unpack(words, first, raw, raw_first), ids)
        for b in range(len(first) - 1):  # a block alone
            part = op7_simple8b.unpack(words[first[b] : first[b + 1]], first[b : b + 2] - first[b], raw[raw_first[b] :], np.zeros(1, np.int64))
            assert np.array_equal(part, ids[b * op7_simple8b.BLOCK_IDS : (b + 1) * op7_simple8b.BLOCK_IDS])


def test_token_files(spark, odd_texts, library, tmp_path):
    op7_simple8b.write_token_files(table(spark, odd_texts), str(tmp_path / "f"), vocabulary(), shards=5)
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in op7_simple8b.read_token_checksums(spark, str(tmp_path / "f")).collect())
    expected, at = [], 0
    for i, text in sorted(odd_texts, key=lambda x: x[0]):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((i, at, len(ids), zlib.crc32(array.array("I", ids).tobytes())))
        at += len(ids)
    assert got == expected
    some = op7_simple8b.read_token_files(spark, str(tmp_path / "f")).where("doc_id = 10300").first()
    assert list(np.frombuffer(some.ids, "<u4"))[-1] == 2


def test_token_files_of_odd_tables(spark, tmp_path):
    op7_simple8b.write_token_files(spark.createDataFrame([], SCHEMA), str(tmp_path / "a"), vocabulary())
    assert op7_simple8b.read_token_checksums(spark, str(tmp_path / "a")).count() == 0
    op7_simple8b.write_token_files(spark.createDataFrame([(1, "b"), (None, None), (1, "a")], SCHEMA), str(tmp_path / "b"), vocabulary())
    rows = op7_simple8b.read_token_files(spark, str(tmp_path / "b")).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in rows] == [(None, 0, 1), (1, 1, 2), (1, 3, 2)]
