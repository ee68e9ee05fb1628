"""Groups called like record tags, lines that are not well-formed, one parent, rows without ids."""

from __future__ import annotations

import pytest

from strataframe import Delivery
from strataframe.errors import DeliveryError
from strataframe.operators.dedup import dedup_identity, latest_revision
from strataframe.operators.dictionary import DICTIONARY_SCHEMA, group_parents, group_spec, relationships
from strataframe.operators.relate import hierarchy_path, orphans
from strataframe.operators.route import near_route
from strataframe.sources.section_index import build_section_index

TAGS = """\
"GROUP","UNIT",""
"HEADING","UNIT_UNIT","UNIT_DESC"
"UNIT","u1","u2"
"TYPE","X","PA"
"DATA","m","metre"
"DATA","-","none"

"GROUP","TYPE"\r
"HEADING","TYPE_TYPE","TYPE_DESC"\r
"UNIT","",""\r
"TYPE","X","X"\r
"DATA","2DP","number"\r

"GROUP","DATA"
"HEADING","DATA_ID"
"UNIT","t"
"TYPE","ID"
"DATA","one"
"""


@pytest.fixture(params=["text", "sections", "splits"])
def opened(request, spark, tmp_path):
    def by(content: str) -> Delivery:
        if request.param == "text":
            return Delivery.from_text(spark, content)
        (tmp_path / "a.ags").write_text(content, newline="")
        return Delivery.from_files(spark, str(tmp_path), section_file_bytes=0 if request.param == "splits" else 1 << 40)

    return by


def test_groups_may_be_called_like_tags(spark, opened):
    site = opened(TAGS)
    headings = sorted((r["group"], r.heading, r.unit, r.ags_type) for r in site.headings().collect())
    assert headings == [("DATA", "DATA_ID", "t", "ID"), ("TYPE", "TYPE_DESC", None, "X"), ("TYPE", "TYPE_TYPE", None, "X"),
                        ("UNIT", "UNIT_DESC", "u2", "PA"), ("UNIT", "UNIT_UNIT", "u1", "X")]
    assert {r["group"]: r.n_rows for r in site.row_counts().collect()} == {"UNIT": 2, "TYPE": 1, "DATA": 1}
    hashes = {r.UNIT_UNIT: r._content_hash for r in site.group("UNIT", allow_custom=True).collect()}
    plain = {r.UNIT_UNIT: r._content_hash for r in Delivery.from_text(spark, TAGS).group("UNIT", allow_custom=True).collect()}
    assert hashes == plain and set(plain) == {"m", "-"}


@pytest.mark.parametrize("limit", [0, 1 << 40])
def test_the_index_has_the_same_headers(spark, tmp_path, limit):
    (tmp_path / "a.ags").write_text(TAGS, newline="")
    index = build_section_index(spark, str(tmp_path), section_file_bytes=limit).collect()
    assert sorted((r["group"], r.n_data, r.units, r.types) for r in index) == [
        ("DATA", 1, ["t"], ["ID"]), ("TYPE", 1, ["", ""], ["X", "X"]), ("UNIT", 2, ["u1", "u2"], ["X", "PA"])]
    data = TAGS.encode()
    assert all(data[r.start : r.end].startswith(b'"GROUP",') for r in index)


HEAD = '"GROUP","LOCA"\n"HEADING","LOCA_ID","LOCA_TYPE","LOCA_GL"\n"UNIT","","","m"\n"TYPE","ID","PA","2DP"\n'
BAD = [
    ('"DATA","BH02",TP,"98.00"', ("BH02", None, 98.0)), ('"DATA","BH03","TP","1.00', ("BH03", "TP", None)),
    ('"DATA","BH04","TP","2.00"x', ("BH04", "TP", None)), ('  "DATA","BH05","TP","3.00"', ("BH05", "TP", 3.0)),
    ('"DATA","a ""b"", c",TP,"4.00"', ('a "b", c', None, 4.0)),
]


@pytest.mark.parametrize(("line", "cells"), BAD)
def test_malformed_rows_raise_or_stay_in_place(opened, line, cells):
    site = opened(f'{HEAD}"DATA","BH01","TP","97.00"\n{line}\n\n')
    with pytest.raises(Exception, match="malformed line in"):
        site.group("LOCA").collect()
    with pytest.raises(Exception, match="malformed line in"):
        site.group("LOCA").count()
    rows = site.group("LOCA", malformed="null").collect()
    assert sorted((r._malformed, r.LOCA_ID, r.LOCA_TYPE, r.LOCA_GL) for r in rows) == [(False, "BH01", "TP", 97.0), (True, *cells)]


def test_an_indented_group_line_is_an_error(opened):
    site = opened(f'{HEAD}"DATA","BH01","TP","97.00"\n  "GROUP","PROJ"\n"DATA","P1"\n')
    with pytest.raises(Exception, match="malformed line in"):
        site.group("LOCA", malformed="null").collect()


@pytest.mark.parametrize("headings", ['"LOCA_ID","Loca_Id"', '"LOCA_ID","LOCA_ID"'])
def test_headings_equal_but_for_case_are_an_error(opened, headings):
    site = opened(f'"GROUP","LOCA"\n"HEADING",{headings}\n"UNIT","",""\n"TYPE","X","X"\n"DATA","a","b"\n')
    with pytest.raises(DeliveryError, match="occurs twice"):
        site.group("LOCA")


def test_rows_without_ids_stay(spark):
    site = Delivery.from_text(spark, '"GROUP","XTRA"\n"HEADING","XTRA_ID"\n"UNIT",""\n"TYPE","X"\n' + '"DATA","a"\n"DATA","a"\n"DATA","b"\n')
    rows = site.group("XTRA", allow_custom=True)
    assert dedup_identity(rows).count() == 3 and orphans(rows, rows).count() == 3
    versions = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 1, "z"), (None, 1, "z")], "k string, v int, _content_hash string")
    assert latest_revision(versions, ["k"], "v").count() == 3


def test_one_parent_per_group(spark):
    rows = [("4.0.3", "CCCC", "AAAA", "C1", "KEY", "", "", "", 0), ("4.2", "CCCC", "PPPP", "C1", "KEY", "", "", "", 0),
            ("4.2", "PPPP", None, "P1", "KEY", "", "", "", 0), ("4.0.3", "AAAA", None, "A1", None, "", "", "", None),
            (None, "NNNN", "PPPP", "N1", None, None, None, None, None)]
    dictionary = spark.createDataFrame(rows, DICTIONARY_SCHEMA)
    assert {r["group"]: r.parent for r in group_parents(dictionary).collect()} == {"CCCC": "PPPP", "NNNN": "PPPP"}
    assert sorted((r.child, r.parent) for r in relationships(dictionary).collect()) == [("CCCC", "PPPP"), ("NNNN", "PPPP")]
    assert group_spec(dictionary, "CCCC").parent == "PPPP" and group_spec(dictionary, "NNNN").keys == ()
    assert hierarchy_path(dictionary, "CCCC", "PPPP") == ["CCCC", "PPPP"]


@pytest.mark.parametrize("distance", [0.0, 1e-6, 5.0])
def test_routes_of_any_length(spark, distance):
    points = spark.createDataFrame([(1, 500.0, 0.0), (2, 500.0, 3.0), (3, -1.0, 0.0)], "id int, x double, y double")
    route = spark.createDataFrame([(0.0, 0.0, 1e6, 0.0)], "x1 double, y1 double, x2 double, y2 double")
    found = sorted(r.id for r in near_route(points, "x", "y", route, distance).collect())
    assert found == ([1, 2, 3] if distance == 5.0 else [1])


def test_absent_group_beyond_the_listed_ones(spark):
    text = "".join(f'"GROUP","G{i:03d}"\n"HEADING","A"\n"UNIT",""\n"TYPE","X"\n\n' for i in range(205)) + '"GROUP","ZZZZ"\n"DATA","a"\n'
    site = Delivery.from_text(spark, text)
    with pytest.raises(DeliveryError, match="has no HEADING record"):
        site.layout("ZZZZ")
    with pytest.raises(DeliveryError, match="not found.*and more"):
        site.layout("NONE")
