"""Typed cells, keys, encodings, custom groups, dictionaries, catalogues."""

import json
import random

import pytest
from conftest import MINI
from pyspark.sql import functions as F

from strataframe import Delivery, DeliveryError, Layout, read_dictionary, read_group, read_group_text, relationships
from strataframe.functions import keys, typing
from strataframe.operators.aggregates import arg_max, is_unique
from strataframe.operators.catalogue import invalid_rules, rules_table
from strataframe.operators.dedup import dedup_identity, latest_revision, union_all, union_by_name
from strataframe.operators.dictionary import DICTIONARY_SCHEMA, mine_dictionary
from strataframe.operators.relate import hierarchy_path, orphan_counts, orphans
from strataframe.operators.route import near_route, route_segments
from strataframe.sources.encoding import resolve_encoding


def section(group, *records):
    return "\n".join([f'"GROUP","{group}"', *records])


def test_column_types():
    codes = {"2DP": "double", "0DP": "bigint", "3SF": "double", "2SCI": "double", "YN": "boolean",
             "ID": "string", "X": "string", "PA": "string", "DT": "string", "": "string", "XDP": "string"}
    assert {code: typing.column_type(code) for code in codes} == codes


def test_merged_types():
    assert typing.merged_type(["bigint", "double"]) == "double"
    assert typing.merged_type(["boolean", "double"]) == "string"
    assert typing.merged_type(["boolean", "boolean"]) == "boolean"


def test_lenient_cells(spark):
    text = section(
        "LOCA", '"HEADING","LOCA_ID","LOCA_GL","LOCA_N","LOCA_OK","LOCA_T"', '"TYPE","ID","2DP","0DP","YN"',
        '"DATA","a","n/a","1.5","t","x"', '"DATA","b","","","",""', '"DATA","c","1d","007","Y","with ""quote"", and comma"',
        '"DATA","d","NaN","1e3","N"', '"DATA","e","+1.50","-3","yes","x","beyond"', '"DATA"',
    )
    rows = read_group_text(spark, text, "LOCA").select("LOCA_ID", "LOCA_GL", "LOCA_N", "LOCA_OK", "LOCA_T").collect()
    assert sorted(map(tuple, rows), key=repr) == sorted([
        ("a", None, None, None, "x"), ("b", None, None, None, None), ("c", None, 7, True, 'with "quote", and comma'),
        ("d", None, None, False, None), ("e", 1.5, -3, None, "x"), (None, None, None, None, None),
    ], key=repr)


def test_type_row_is_not_inherited(spark):
    text = section("LOCA", '"HEADING","LOCA_ID","LOCA_GL"', '"TYPE","ID","2DP"', '"DATA","a","1.0"') + "\n" + section(
        "SAMP", '"HEADING","SAMP_TOP"', '"DATA","1.0"')
    assert dict(read_group_text(spark, text, "SAMP", allow_custom=True).dtypes)["SAMP_TOP"] == "string"


def test_temporal_option(spark):
    text = section("TRAN", '"HEADING","TRAN_ISNO","TRAN_DATE"', '"TYPE","X","DT"', '"DATA","1","2020-08-18"', '"DATA","2","soon"')
    assert dict(read_group_text(spark, text, "TRAN").dtypes)["TRAN_DATE"] == "string"
    parsed = read_group_text(spark, text, "TRAN", temporal=True).orderBy("TRAN_ISNO")
    assert [r[0] and r[0].year for r in parsed.select("TRAN_DATE").collect()] == [2020, None]


def test_canonical_numbers(spark):
    cases = {"100.50": "100.5", "007": "7", "0": "0", "-0.00": "0", ".5": "0.5", "5.": "5", "+7": "7", "-012.340": "-12.34",
             "1e3": "1e3", "abc": "abc", "-": "-", "+-5": "+-5", "000.100": "0.1", "-.5": "-0.5", " 7.0 ": "7", "100": "100",
             "12345678901234567890.123456789012345": "12345678901234567890.123456789012345"}
    df = spark.createDataFrame([(c,) for c in cases], "v string")
    assert {r.v: r.c for r in df.select("v", F.expr(keys.canonical_number("v")).alias("c")).collect()} == cases


def content_of(spark, unit, code, value):
    text = section("LOCA", '"HEADING","LOCA_ID","LOCA_GL"', f'"UNIT","","{unit}"', f'"TYPE","ID","{code}"', f'"DATA","a","{value}"')
    return read_group_text(spark, text, "LOCA").first()["_content_hash"]


def test_content_is_typed_and_unit_aware(spark):
    base = content_of(spark, "m", "2DP", "100.50")
    assert content_of(spark, "m", "2DP", "100.5") == base
    assert content_of(spark, "mm", "2DP", "100.50") != base
    assert content_of(spark, "m", "X", "100.50") != base
    assert content_of(spark, "m", "2DP", "100.51") != base


def test_content_ignores_column_order_and_blanks(spark):
    first = section("LOCA", '"HEADING","LOCA_ID","LOCA_GL"', '"TYPE","ID","2DP"', '"DATA","a","1.0"')
    second = section("LOCA", '"HEADING","LOCA_GL","LOCA_X","LOCA_ID"', '"TYPE","2DP","X","ID"', '"DATA","1.00","","a"')
    one, two = (read_group_text(spark, t, "LOCA").first() for t in (first, second))
    assert (one["_id"], one["_content_hash"]) == (two["_id"], two["_content_hash"])


def test_identity_uses_raw_text(spark):
    def sample(top):
        text = section("SAMP", '"HEADING","LOCA_ID","SAMP_TOP"', '"TYPE","ID","2DP"', f'"DATA","a","{top}"')
        return read_group_text(spark, text, "SAMP").first()

    assert sample("1.0")["_id"] != sample("1.00")["_id"]
    assert sample("1.0")["_parent_id"] == sample("1.00")["_parent_id"]


def test_separator_in_value_cannot_imitate_another_row(spark):
    def ident(a, b):
        text = section("SAMP", '"HEADING","LOCA_ID","SAMP_REF"', '"TYPE","ID","X"', f'"DATA","{a}","{b}"')
        return read_group_text(spark, text, "SAMP").first()["_id"]

    assert ident("1:a,1:b", "c") != ident("1:a", "1:b,c")


def test_parent_is_null_without_its_key_heading(spark, mini):
    delivery = Delivery.from_files(spark, mini)
    assert delivery.group("LOCA").where("_parent_id is not null").count() == 0
    text = MINI.replace('"LOCA_ID","SAMP_TOP"', '"HOLE","SAMP_TOP"')
    samples = read_group_text(spark, text, "SAMP")
    assert samples.where("_parent_id is not null").count() == 0
    assert orphans(samples, delivery.group("LOCA")).count() == 3


def test_custom_group_policy(spark):
    text = section("ZZZZ", '"HEADING","ZZZZ_ID"', '"TYPE","ID"', '"DATA","a"')
    with pytest.raises(DeliveryError, match="not in the dictionary"):
        read_group_text(spark, text, "ZZZZ")
    row = read_group_text(spark, text, "ZZZZ", allow_custom=True).first()
    assert (row["_id"], row["_parent_id"], row.ZZZZ_ID) == (None, None, "a") and row["_content_hash"]


def test_given_layout_saves_discovery(spark):
    text = section("LOCA", '"HEADING","LOCA_ID","LOCA_GL"', '"TYPE","ID","X"', '"DATA","a","1.5"')
    row = read_group_text(spark, text, "LOCA", layout=Layout.of(LOCA_ID="ID", LOCA_GL="2DP", LOCA_NEW="0DP")).first()
    assert (row.LOCA_ID, row.LOCA_GL, row.LOCA_NEW) == ("a", 1.5, None)


def test_encodings(spark, tmp_path):
    text = MINI.replace("Demo project", "Café €5 – façade")
    (tmp_path / "w.ags").write_bytes(text.encode("cp1252"))
    (tmp_path / "u.txt").write_bytes(text.encode("utf-16-le"))
    for label in ("windows-1252", "latin1", " CP1252 "):
        assert read_group(spark, str(tmp_path / "w.ags"), "PROJ", encoding=label).first().PROJ_NAME == "Café €5 – façade"
    assert read_group(spark, str(tmp_path / "u.txt"), "PROJ", encoding="utf-16le").first().PROJ_NAME == "Café €5 – façade"
    assert "�" in read_group(spark, str(tmp_path / "w.ags"), "PROJ").first().PROJ_NAME
    split = Delivery.from_files(spark, str(tmp_path / "w.ags"), encoding="windows-1252", section_file_bytes=0)
    assert split.group("PROJ").first().PROJ_NAME == "Café €5 – façade"


def test_encoding_labels():
    assert resolve_encoding(None) == resolve_encoding(" ") == "UTF-8"
    assert resolve_encoding("ISO-8859-2") == "ISO-8859-2"
    with pytest.raises(DeliveryError, match="unknown encoding label 'klingon'"):
        resolve_encoding("klingon")


def test_source_file_and_orphans_per_file(spark, tmp_path):
    (tmp_path / "a.ags").write_text(MINI)
    (tmp_path / "b.ags").write_text(MINI.replace('"DATA","BH02","2.00"', '"DATA","BH99","2.00"'))
    delivery = Delivery.from_files(spark, str(tmp_path))
    counts = orphan_counts(delivery.group("SAMP", with_source=True), delivery.group("LOCA")).collect()
    assert [(r["_source_file"].rsplit("/", 1)[1], r.n_orphans) for r in counts] == [("b.ags", 1)]


def test_revision_and_identity_dedup(spark):
    old = read_group_text(spark, MINI, "LOCA")
    new = read_group_text(spark, MINI.replace("100.50", "101.00"), "LOCA")
    both = union_all(old.withColumn("ver", F.lit(1)), new.withColumn("ver", F.lit(2)))
    latest = latest_revision(both, ["LOCA_ID"], "ver").collect()
    assert {r.LOCA_ID: (r.LOCA_GL, r.ver) for r in latest} == {"BH01": (101.0, 2), "BH02": (98.0, 2)}
    assert dedup_identity(union_all(old, new)).count() == 2
    assert union_by_name(old, new, old).count() == 3


def test_latest_revision_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as ver", "cast(id as string) as _content_hash")
    plan = latest_revision(df, ["k"], "ver")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_arg_max_skips_missing_values(spark):
    df = spark.createDataFrame([("a", 1.0, "x", 1), ("a", 9.0, None, 2), ("a", 5.0, "y", 3), ("a", 5.0, "z", 4), ("b", 1.0, None, 5)],
                               "k string, o double, v string, n int")
    found = df.groupBy("k").agg(arg_max(F.col("v"), F.col("o"), F.col("n")).alias("v")).collect()
    assert {r.k: r.v for r in found} == {"a": "z", "b": None}


def test_is_unique(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "a int, b int")
    assert is_unique(df, ["a", "b"]) and not is_unique(df, ["a"])


def test_near_route_against_brute_force(spark):
    rng = random.Random(5)
    points = [(i, rng.uniform(-60, 160), rng.uniform(-60, 160)) for i in range(1500)] + [(9001, 0.0, 0.0), (9002, 50.0, 10.0)]
    vertices = [(0, 0), (100, 0), (100, 0), (40, 130), (41, 131)]
    limit = 10.0

    def near(x, y):
        for (ax, ay), (bx, by) in zip(vertices, vertices[1:]):
            dx, dy = bx - ax, by - ay
            t = min(max(((x - ax) * dx + (y - ay) * dy) / (dx * dx + dy * dy), 0), 1) if (dx or dy) else 0
            if (x - ax - t * dx) ** 2 + (y - ay - t * dy) ** 2 <= limit * limit:
                return True
        return False

    want = sorted(i for i, x, y in points if near(x, y))
    df = spark.createDataFrame(points, "i int, x double, y double")
    segments = route_segments(spark, vertices)
    for cell in (None, 17.0, 500.0):
        found = near_route(df, "x", "y", segments, limit, cell)
        assert sorted(r.i for r in found.collect()) == want
    with pytest.raises(DeliveryError):
        near_route(df, "x", "y", segments, limit, 5.0)


def test_dictionary_union_prefers_the_newest_edition(spark):
    rows = [("4.0.3", "A", "", "A_ID", "KEY", "ID", "", "old", 0), ("4.1.1", "A", "", "A_ID", "KEY", "X", "", "new", 0),
            ("4.1", "B", "A", "A_ID", "KEY", "ID", "", "", 0), ("4.1", "B", "A", "B_X", "OTHER", "2DP", "m", "", 1)]
    dictionary = spark.createDataFrame(rows, DICTIONARY_SCHEMA)
    union = {(r["group"], r.heading): r for r in read_dictionary(dictionary).collect()}
    assert (union["A", "A_ID"].ags_type, union["A", "A_ID"].description, union["A", "A_ID"].parent) == ("X", "new", None)
    assert (union["B", "B_X"].sql_type, union["B", "B_X"].unit, union["B", "B_X"].description) == ("DOUBLE", "m", None)
    assert [tuple(r) for r in relationships(dictionary).collect()] == [("B", "A", "A_ID")]
    assert hierarchy_path(dictionary, "B", "A") == ["B", "A"]
    with pytest.raises(DeliveryError, match="not an ancestor"):
        hierarchy_path(dictionary, "A", "B")


def test_mining_with_declared_headings(spark):
    text = MINI + "\n" + section("DICT", '"HEADING","DICT_GRP","DICT_HDNG"', '"TYPE","X","X"', '"DATA","ZZZZ","ZZZZ_ID"')
    docs = spark.createDataFrame([("a", text), ("b", text.replace('"2DP"', '"3DP"')), ("c", text)], "doc_id string, content string")
    delivery = Delivery.from_texts(docs)
    mined = {(r["group"], r.heading): r for r in mine_dictionary(delivery.headings(), delivery.group("DICT")).collect()}
    assert (mined["LOCA", "LOCA_GL"].ags_type, mined["LOCA", "LOCA_GL"].unit, mined["LOCA", "LOCA_GL"].n_uses) == ("2DP", "m", 2)
    assert mined["ZZZZ", "ZZZZ_ID"].declared and not mined["LOCA", "LOCA_GL"].declared


def test_rules(spark):
    rules = [{"rule": "8", "title": "Numbers", "checks": "format", "severity": "error", "fixable": True, "observations": ["O-1", "O-2"]},
             {"rule": "9", "title": "", "severity": "fatal", "observations": []}]
    table = rules_table(spark.createDataFrame([(json.dumps({"rules": rules}),)], "content string"))
    assert [tuple(r) for r in table.orderBy("rule").collect()] == [
        ("8", "Numbers", "format", "error", True, "O-1,O-2"), ("9", None, None, "fatal", None, None)]
    assert invalid_rules(table).count() == 1


def test_views_for_sql(spark, mini):
    assert Delivery.from_files(spark, mini).create_views("v_") == ["v_proj", "v_loca", "v_samp"]
    found = spark.sql("select l.loca_id, s.samp_top, s.samp_ref from v_samp s join v_loca l on s._parent_id = l._id where samp_top > 1.75")
    assert sorted(map(tuple, found.collect())) == [("BH01", 3.0, "S2"), ("BH02", 2.0, "S3")]
