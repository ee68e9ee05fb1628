"""The behaviour the delivery readers promise, check by check, on the small sample delivery."""

import re

import pytest
from pyspark.sql import functions as F

from strataframe import Delivery, DeliveryError, materialise, read_dictionary, read_group, read_group_text, relationships, seed_dictionary
from strataframe.operators.dedup import dedup_content, union_all
from strataframe.operators.dictionary import edition_growth
from strataframe.operators.relate import join_parent, orphans

INLINE = "\n".join([
    '"GROUP","PROJ"', '"HEADING","PROJ_ID"', '"UNIT",""', '"TYPE","ID"', '"DATA","P1"', "",
    '"GROUP","LOCA"', '"HEADING","LOCA_ID","LOCA_GL"', '"UNIT","","m"', '"TYPE","ID","2DP"',
    '"DATA","BH01","55.20"', '"DATA","BH02","48.30"',
])


@pytest.fixture(params=["sections", "splits"])
def delivery(request, spark, mini):
    limit = 10**9 if request.param == "sections" else 0
    return Delivery.from_files(spark, mini, section_file_bytes=limit)


def test_row_count(delivery):
    assert delivery.group("LOCA").count() == 2


def test_born_typed(delivery):
    row = delivery.group("LOCA").select(F.typeof("loca_gl"), F.typeof("loca_id")).first()
    assert tuple(row) == ("double", "string")


def test_born_typed_value(delivery):
    row = delivery.group("LOCA").where("loca_id = 'BH01'").select((F.col("loca_gl") == 100.5).cast("int")).first()
    assert row[0] == 1


def test_filter_on_typed_column(delivery):
    assert [r[0] for r in delivery.group("LOCA").where("loca_gl > 99").select("loca_id").collect()] == ["BH01"]


def test_column_order(delivery):
    assert delivery.group("LOCA").columns == ["_id", "_parent_id", "LOCA_ID", "LOCA_TYPE", "LOCA_GL", "_content_hash"]


def test_keys_join_across_separate_reads(spark, mini, delivery):
    child, parent = delivery.group("SAMP"), read_group(spark, mini, "LOCA")
    joined = join_parent(child, parent, "SAMP", "LOCA")
    assert joined.count() == 3
    assert joined.where("SAMP.LOCA_ID <> LOCA.LOCA_ID").count() == 0
    assert orphans(child, parent).count() == 0


def test_content_hash_shape_and_distinctness(delivery):
    hashes = [r[0] for r in delivery.group("LOCA").select("_content_hash").collect()]
    assert len(set(hashes)) == 2
    assert all(re.fullmatch(r"[0-9a-f]{8}-[0-9a-f]{4}-8[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}", h) for h in hashes)


def test_value_dedup(delivery):
    loca = delivery.group("LOCA")
    assert dedup_content(union_all(loca, loca)).count() == 2


def test_groups(delivery):
    rows = [(r["group"], r.n_rows, r.n_headings, r.parent) for r in delivery.groups().collect()]
    assert rows == [("PROJ", 1, 2, None), ("LOCA", 2, 3, "PROJ"), ("SAMP", 3, 5, "LOCA")]


def test_headings(delivery):
    rows = {r.heading: r for r in delivery.headings().where("group = 'LOCA'").collect()}
    gl = rows["LOCA_GL"]
    assert (gl.unit, gl.ags_type, gl.sql_type, gl.status, gl.is_key, gl.ordinal) == ("m", "2DP", "DOUBLE", "OTHER", False, 2)
    assert (rows["LOCA_ID"].unit, rows["LOCA_ID"].is_key, rows["LOCA_ID"].ordinal) == (None, True, 0)


def test_relationships(spark):
    rows = {r.child: (r.parent, r.shared_keys) for r in relationships(seed_dictionary(spark)).collect()}
    assert rows["SAMP"] == ("LOCA", "LOCA_ID")
    assert rows["LOCA"] == ("PROJ", "")
    assert rows["LLPL"] == ("SAMP", "LOCA_ID,SAMP_TOP,SAMP_REF,SAMP_TYPE,SAMP_ID")


def test_edition_dictionary(spark):
    table = read_dictionary(seed_dictionary(spark), " 4.2 ")
    assert table.columns == ["group", "parent", "heading", "status", "ags_type", "sql_type", "unit", "description", "ordinal"]
    assert table.where("group = 'PROJ' and heading = 'PROJ_ID' and status = 'KEY+REQUIRED' and sql_type = 'VARCHAR'").count() == 1


def test_union_dictionary_spans_all_editions(spark):
    seed = seed_dictionary(spark)
    grown = seed.where("edition = '4.2' or group <> 'LLPL'")
    growth = {r.edition: r.n_groups for r in edition_growth(grown).collect()}
    union = read_dictionary(grown).select("group").distinct().count()
    assert growth["4.0.3"] < growth["4.2"] <= union


def test_unknown_edition(spark):
    with pytest.raises(DeliveryError, match="unknown edition '9.9'"):
        read_dictionary(seed_dictionary(spark), "9.9")


def test_inline_text(spark):
    row = read_group_text(spark, INLINE, "LOCA").agg(F.count("*"), F.max(F.typeof("loca_gl"))).first()
    assert tuple(row) == (2, "double")


def test_several_groups_from_one_persisted_parse(delivery):
    delivery.persist()
    assert {r["group"]: r.n_rows for r in delivery.row_counts().collect()} == {"PROJ": 1, "LOCA": 2, "SAMP": 3}
    assert [delivery.group(g).count() for g in ("PROJ", "LOCA", "SAMP")] == [1, 2, 3]
    delivery.unpersist()


def test_materialise_steps(spark, delivery):
    report = materialise(delivery, buckets=4).orderBy("seq").collect()
    assert [(r["group"], r.kind) for r in report] == [
        ("PROJ", "table"), ("PROJ", "id_index"),
        ("LOCA", "table"), ("LOCA", "id_index"), ("LOCA", "parent_index"),
        ("SAMP", "table"), ("SAMP", "id_index"), ("SAMP", "parent_index"),
    ]
    assert [r.n_rows for r in report] == [1, 1, 2, 2, 2, 3, 3, 3]
    assert report[0].table == "ags_proj"
    assert sorted(map(tuple, spark.table("ags_samp").collect())) == sorted(map(tuple, delivery.group("SAMP").collect()))


def test_group_argument_is_trimmed_and_upper_cased(delivery):
    assert delivery.group(" loca ").count() == 2


def test_absent_group_lists_those_present(delivery):
    with pytest.raises(DeliveryError, match="group 'GEOL' not found; the deliveries hold PROJ, LOCA, SAMP"):
        delivery.group("GEOL")
