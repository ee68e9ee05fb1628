"""Byte ranges, wide encodings, indexes that do not fit, folder listing, caches by group, closures and mined keys."""

from __future__ import annotations

import gzip

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.conftest import MINI, REDECLARED

from strataframe import Delivery, build_section_index, read_group, read_group_indexed
from strataframe.errors import DeliveryError
from strataframe.plans import deliveries as dl
from strataframe.operators import dedup, key_mining, relate
from strataframe.sources import byte_ranges, section_index
from strataframe.sources.audit import ingest_audit
from strataframe.sources.pieces import RangedFiles

LONG = MINI.replace('"DATA","BH02","TP","98.00"', '"DATA","BH02","TP","98.00"\n' + "\n".join(f'"DATA","B{i}","é","{i}.50"' for i in range(300)))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ------------------------------------------------------------------------------ one group's bytes


def test_a_group_of_large_files_reads_its_own_bytes_only(spark, tmp_path, tiny_splits):
    (tmp_path / "a.ags").write_bytes(LONG.encode())
    (tmp_path / "b.ags").write_bytes(REDECLARED.encode())
    (tmp_path / "c.ags").write_bytes(b"\xef\xbb\xbf" + MINI.encode())
    (tmp_path / "d.ags.gz").write_bytes(gzip.compress(MINI.replace("BH", "GZ").encode()))
    tiny_splits(500)
    opened = Delivery.from_files(spark, str(tmp_path), section_file_bytes=0)
    ranges = opened._split_files.group_ranges("SAMP").collect()
    samples = MINI[MINI.index('"GROUP","SAMP"'):].encode()
    assert sorted(r.body for r in ranges) == [samples] * 2 and sum(r.n_read for r in ranges) == 2 * len(samples)
    whole = Delivery.from_files(spark, str(tmp_path), section_file_bytes=1 << 40)
    for group in ("SAMP", "LOCA", "PROJ"):
        assert rows_of(opened.group(group)) == rows_of(whole.group(group))
    assert opened.group("LOCA").where("LOCA_ID like 'GZ%'").count() == 2


@pytest.mark.parametrize("chunk", [7, 64, 1 << 20])
def test_lines_of_chunks_are_the_lines_of_the_file(monkeypatch, tmp_path, chunk):
    for codec, charset in (("utf-8", "UTF-8"), ("utf-16-le", "UTF-16LE"), ("utf-16-be", "UTF-16BE")):
        feed = byte_ranges.WIDE.get(charset, (None, b"\n"))[1]
        text = "a\n\nĊ𝒳਀é" * 9 + "\n" + "x" * 40 + "\n" * 3 + "end"
        file = tmp_path / "lines"
        file.write_bytes(text.encode(codec))
        size, step, found = file.stat().st_size, chunk + chunk % 2, b""
        with open(file, "rb") as opened:
            for at in range(0, size, step):
                found += byte_ranges.read_lines_of(opened, 0, size, at, min(at + step, size), feed)
        assert found == text.encode(codec)


@pytest.mark.parametrize("chunk, mark", [(66, ""), (1 << 20, ""), (66, "﻿")])
def test_wide_files_are_read_in_chunks(spark, tmp_path, monkeypatch, chunk, mark):
    monkeypatch.setattr(byte_ranges, "CHUNK_BYTES", chunk)
    wide, plain = tmp_path / "wide", tmp_path / "plain"
    wide.mkdir(), plain.mkdir()
    text = LONG.replace("CP", "Ċ𝒳")
    for name, content in (("a", text), ("b", REDECLARED)):
        (wide / f"{name}.ags").write_bytes((mark + content).encode("utf-16-be"))
        (plain / f"{name}.ags").write_text(content, newline="")
    opened, narrow = (Delivery.from_files(spark, str(p), encoding=e) for p, e in ((wide, "utf-16be"), (plain, None)))
    for group in ("LOCA", "SAMP", "PROJ"):
        assert rows_of(opened.group(group)) == rows_of(narrow.group(group))
    assert rows_of(opened.row_counts()) == rows_of(narrow.row_counts())
    audit = {r.path.rsplit("/", 1)[1]: (r.status, r.reason) for r in ingest_audit(spark, str(wide), "utf-16be").collect()}
    assert audit == {"a.ags": ("ok", None), "b.ags": ("ok", None)}
    spans = opened._split_files.byte_spans().where("path like '%a.ags'").collect()
    raw = (wide / "a.ags").read_bytes()
    assert {raw[r.start : r.end].decode("utf-16-be").lstrip("﻿")[:13] for r in spans} == {f'"GROUP","{g}"'[:13] for g in ("PROJ", "LOCA", "SAMP")}


def test_wide_audit_finds_what_is_wrong(spark, tmp_path):
    broken = {"odd": '"GROUP","A"\n"HEADING","H"\n"DATA","1"x\n', "tag": '"GROUP","A"\n"WHAT","H"\n', "none": "text\n", "empty": ""}
    for name, text in broken.items():
        (tmp_path / name).write_bytes(text.encode("utf-16-le"))
    found = {r.path.rsplit("/", 1)[1]: r.reason for r in ingest_audit(spark, str(tmp_path), "utf-16").collect()}
    assert found == {"odd": "malformed line", "tag": "unknown record tag", "none": "no GROUP record", "empty": "empty file"}


# ------------------------------------------------------------------------------ an index that does not fit


def test_a_misfit_span_is_read_whole(spark, tmp_path):
    for name in ("good", "shifted", "short", "gone"):
        (tmp_path / f"{name}.ags").write_text(LONG.replace("BH", name))
    (tmp_path / "late.ags").write_text(REDECLARED)
    built = build_section_index(spark, str(tmp_path))
    file = F.regexp_extract("path", "([a-z]+).ags$", 1)
    index = built.where(file != "gone").withColumn("start", F.when(file == "shifted", F.col("start") + 5).otherwise(F.col("start"))).withColumn(
        "end", F.when(file == "short", F.col("end") - 9).otherwise(F.col("end")))
    index.write.parquet(str(tmp_path / "_index"))
    index = spark.read.parquet(str(tmp_path / "_index"))
    listing = section_index.file_listing(spark, [str(tmp_path)])
    spans, whole = section_index.spans_to_read(listing, index, "LOCA")
    names = [sorted(r.path.rsplit("/", 1)[1][:-4] for r in df.collect()) for df in (spans, whole)]
    assert names == [["good"], ["gone", "late", "shifted", "short"]]
    assert rows_of(read_group_indexed(spark, str(tmp_path), "LOCA", index)) == rows_of(read_group(spark, str(tmp_path), "LOCA"))
    assert rows_of(read_group_indexed(spark, str(tmp_path), "SAMP", index)) == rows_of(read_group(spark, str(tmp_path), "SAMP"))


def test_a_file_cut_short_after_it_was_listed_is_an_error(spark, tmp_path):
    file = tmp_path / "site.ags"
    file.write_text(LONG)
    files = spark.createDataFrame([(str(file), len(LONG.encode()) + 50, str(file))], "path string, size long, location string")
    with pytest.raises(Exception, match="ShortRead"):
        RangedFiles(spark, files, "UTF-8").heads().collect()


# ------------------------------------------------------------------------------ listing


def test_listing_follows_folders_and_globs(spark, tmp_path):
    names = ["a/x.ags", "a/empty.ags", "a/_hidden.ags", "a/k=1/y.ags", "a/plain/z.ags", "b1/x.ags", "b2/x.txt", "c,d/[q].ags", "sp ace/é.ags"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("" if "empty" in name else "x")

    def listed(*paths):
        return sorted(r.location.removeprefix(f"{tmp_path}/") for r in byte_ranges.listed_files(spark, [f"{tmp_path}/{p}" for p in paths]).collect())

    assert listed("a") == ["a/empty.ags", "a/k=1/y.ags", "a/x.ags"]
    assert listed("b?/*.{ags,txt}") == ["b1/x.ags", "b2/x.txt"] and listed("b[12]/x.ags", "b1") == ["b1/x.ags"]
    assert listed("sp*/*") == ["sp ace/é.ags"] and listed("a/x.ags", "a/x.ags") == ["a/x.ags"] and listed("none*") == []
    empty = byte_ranges.listed_files(spark, [f"file://{tmp_path}/a"]).where("size = 0").collect()
    assert [r.location for r in empty] == [f"file://{tmp_path}/a/empty.ags"]


# ------------------------------------------------------------------------------ a cache by group


@pytest.mark.parametrize("limit", [0, 1 << 40])
def test_a_kept_group_is_read_alone(spark, tmp_path, limit):
    groups = "\n".join(f'"GROUP","G{i:02}"\n"HEADING","H"\n"UNIT",""\n"TYPE","X"\n"DATA","{i}"\n' for i in range(40))
    for name in "abc":
        (tmp_path / f"{name}.ags").write_text(groups)
    spark.conf.set("spark.sql.inMemoryColumnarStorage.batchSize", "4")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan that ran is then the plan itself
    try:
        kept = Delivery.from_files(spark, str(tmp_path), section_file_bytes=limit).persist()
        assert kept.bodies("G07").count() == 3
        wanted = kept.bodies("G31")
        assert len(wanted.collect()) == 3
        leaves = wanted._jdf.queryExecution().executedPlan().collectLeaves()
        read = sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))
        assert read <= 12, read  # of 120
        kept.unpersist()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.inMemoryColumnarStorage.batchSize")


# ------------------------------------------------------------------------------ revisions and identity


def test_dedup_reads_its_input_once_and_hashes_no_content(spark, mini):
    table = read_group(spark, mini, "LOCA").withColumn("ver", F.lit(1))
    for df in (dedup.dedup_identity(table, ["LOCA_GL"]), dedup.latest_revision(table, ["LOCA_ID"], "ver")):
        plan = df.select("LOCA_ID", "LOCA_GL")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1 and plan.count("sha2(") <= 1
        assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()


def test_rows_without_key_all_stay(spark):
    rows = [(None, "a", 1), (None, "a", 1), ("k", "a", 1), ("k", "a", 2), ("k", "b", 2)]
    df = spark.createDataFrame(rows, "_id string, _content_hash string, v int")
    assert dedup.dedup_identity(df).count() == 3 and dedup.dedup_identity(df, [F.desc("v")]).count() == 3
    assert sorted(map(repr, map(tuple, dedup.latest_revision(df, ["_id"], "v", ["_content_hash"]).collect()))) == sorted(
        map(repr, [(None, "a", 1), (None, "a", 1), ("k", "a", 2)]))


# ------------------------------------------------------------------------------ closure


EDGE = "`group` string, _id string, parent_group string, _parent_id string"


def test_ancestors_of_any_depth(spark):
    chain = [("G", f"n{i}", "G", f"n{i + 1}") for i in range(21)] + [("G", "n21", None, None)]
    extra = [("H", "x", "G", "n20"), ("H", "x", "G", "n20"), ("H", "lost", "G", "nowhere"), ("H", None, "G", "n1")]
    found = {(r["group"], r._id, r.distance, r.ancestor_id) for r in relate.ancestors(spark.createDataFrame(chain + extra, EDGE)).collect()}
    want = {("G", f"n{i}", j - i, f"n{j}") for i in range(22) for j in range(i + 1, 22)} | {("H", "x", 1, "n20"), ("H", "x", 2, "n21")}
    assert found == want


def test_a_cycle_is_an_error(spark):
    rows = [("G", str(i), "G", str((i + 1) % 5)) for i in range(5)] + [("G", "in", "G", "0")]
    with pytest.raises(DeliveryError, match="its own ancestor"):
        relate.ancestors(spark.createDataFrame(rows, EDGE))
    assert relate.ancestors(spark.createDataFrame([], EDGE)).count() == 0


def test_rows_without_children_are_joined_once(spark, monkeypatch):
    stored = []
    cut = relate.cut_lineage
    monkeypatch.setattr(relate, "cut_lineage", lambda df: stored.append(cut(df)) or stored[-1])
    top = [("T", "t", None, None)] + [("M", f"m{i}", "T", "t") for i in range(2)]
    # One leaf of two parents, some repeated, most with one link.
    low = [("L", "both", "M", "m0"), ("L", "both", "M", "m1")] + [("L", f"l{i // 2}", "M", "m1") for i in range(40)] + [("L", f"s{i}", "M", "m0") for i in range(40)]
    found = relate.ancestors(spark.createDataFrame(top + low, EDGE))
    rows = [tuple(r) for r in found.collect()]
    want = {("M", f"m{i}", 1, "T", "t") for i in range(2)}
    for _, leaf, group, parent in low:
        want |= {("L", leaf, 1, group, parent), ("L", leaf, 2, "T", "t")}
    assert len(rows) == len(want) and set(rows) == want
    assert sum(df.count() for df in stored[1:]) < len(set(low)), "rows that are nobody's parents are stored"


def test_packed_ids_come_back(spark):
    ids = ["", "a", "0123456789abcde", "0123456789abcdef", "01234567-89ab-8def-89ab-0123456789ab", "01234567-89AB-8def-89ab-0123456789ab",
           "01234567-89ab-8def-89ab-0123456789ab\n", "\0" * 15, "\1" * 14, "\1" * 13, "é𝒳"]
    made = spark.createDataFrame([(i, i) for i in ids], "i string, _id string").select("i", relate.packed("_id"))
    assert made.select("_id").distinct().count() == len(ids)
    assert all(r.i == r._id for r in made.select("i", relate.unpacked("_id")).collect())


# ------------------------------------------------------------------------------ mined keys


def headings_of(spark, **groups):
    rows = [(g, h, code, i) for g, heads in groups.items() for i, (h, code) in enumerate(heads)]
    return spark.createDataFrame(rows, "`group` string, heading string, ags_type string, ordinal int")


def test_mined_keys_and_parents(spark):
    top = spark.createDataFrame([(f"t{i}", f"name {i}", 1.5 * i) for i in range(40)], "T_ID string, T_NAME string, T_VAL double")
    low = spark.createDataFrame([(f"t{i % 39}", i // 39, "same", 0.1 * i) for i in range(390)] + [("t0", 0, "same", 0.0)] * 3,
                                "T_ID string, L_NO long, L_TEXT string, L_VAL double")
    blank = spark.createDataFrame([(None, "x"), ("b", "y")], "B_ID string, T_ID string")
    listed = headings_of(spark, TOP=[("T_NAME", "X"), ("T_ID", "ID"), ("T_VAL", "2DP")],
                         LOW=[("T_ID", "ID"), ("L_NO", "0DP"), ("L_TEXT", "X"), ("L_VAL", "2DP")], BLNK=[("B_ID", "ID"), ("T_ID", "ID")])
    mined = key_mining.mine_keys({"TOP": top, "LOW": low, "BLNK": blank}, listed).collect()
    keys = {g: [r.heading for r in mined if r["group"] == g and r.status == "KEY"] for g in ("TOP", "LOW", "BLNK")}
    assert keys == {"TOP": ["T_ID"], "LOW": ["T_ID", "L_NO"], "BLNK": ["T_ID"]}
    # A blank identifier is no key; x and y are no values of TOP.
    assert {r["group"]: r.parent for r in mined} == {"TOP": None, "LOW": "TOP", "BLNK": None}


def test_no_rows_give_no_key(spark):
    empty = spark.createDataFrame([], "A string")
    mined = key_mining.mine_keys({"E": empty}, headings_of(spark, E=[("A", "ID")])).collect()
    assert [(r.heading, r.status, r.parent) for r in mined] == [("A", "OTHER", None)]


def test_only_repeated_rows_are_compared_whole(spark):
    once = spark.range(100).selectExpr("cast(id as string) as a", "if(id = 3, null, id) as b")
    assert key_mining.distinct_rows(once) is once
    twice = once.unionAll(once.where("a < '3'")).unionAll(once.where("b is null"))
    assert sorted(map(repr, key_mining.distinct_rows(twice).collect())) == sorted(map(repr, once.collect()))


def test_sets_are_counted_one_by_one(spark, monkeypatch):
    rows = spark.range(300).selectExpr("id as a", "id div 2 as b", "id % 2 as c")
    asked = []
    real = key_mining._is_unique
    monkeypatch.setattr(key_mining, "_is_unique", lambda df, names: asked.append(names) or real(df, names))
    heads = [key_mining.Heading(n, "ID" if n != "a" else "X", i) for i, n in enumerate("abc")]
    assert key_mining.mine_key(rows.select("b", "c"), heads[1:]) == ("b", "c") and real(rows, ["a"]) and not real(rows, ["b"])
    asked.clear()
    doubled = rows.withColumn("d", F.col("a"))
    assert key_mining.mine_key(doubled, [*heads, key_mining.Heading("d", "ID", 3)]) == ("d",) and asked == [("d",)]


# ------------------------------------------------------------------------------ what a task holds


def test_lines_are_taken_apart_a_few_at_a_time(tmp_path):
    text = "".join(f'"DATA","{i}","é𝒳 {"x" * 300}"\n' for i in range(9000)) + '"DATA","open"'
    (tmp_path / "f").write_bytes(text.encode("utf-16-le"))
    size = (tmp_path / "f").stat().st_size
    chunk = pa.RecordBatch.from_pylist([{"path": "f", "location": str(tmp_path / "f"), "end": size, "at": 0, "to": size}])
    batches = list(byte_ranges.lines_reader("UTF-16LE")(iter([chunk])))
    assert [line for b in batches for line in b.column("line").to_pylist()] == [line.encode() for line in text.split("\n")]
    assert max(b.column("line").nbytes for b in batches) < 1 << 20, "a chunk is held as lines whole"
    assert sum(sum(b.column("nb").to_pylist()) for b in batches) == size + 2


def test_texts_are_joined_without_a_shuffle(spark):
    rows = spark.range(0, 25_700, 1, 3).withColumnRenamed("id", "c_custkey").selectExpr(
        "c_custkey", "concat('n', c_custkey) as c_name", "1.5 as c_acctbal", "'s' as c_mktsegment", "0 as c_nationkey")
    texts = dl.delivery_texts(rows, dl.customer_section(), dl.Section("X", [("X_ID", "", "ID", dl.text("c_custkey"))]), spread=False)
    assert "Exchange" not in texts._jdf.queryExecution().executedPlan().toString()
    held = texts.collect()
    assert len({r.doc_id for r in held}) == len(held)
    for code, n in (("CUST", 0), ("X", 1)):
        sections = [r.content.split("\n\n")[n].split("\n") for r in held]
        assert all(s[0] == f'"GROUP","{code}"' and len(s) <= 4 + dl.ROWS_PER_TEXT for s in sections)
        keys = [int(line.split('"')[3]) for s in sections for line in s[4:]]
        assert sorted(keys) == list(range(25_700)) and all(s[4:] == sorted(s[4:], key=lambda x: int(x.split('"')[3])) for s in sections)
