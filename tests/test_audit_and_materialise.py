"""The ingest guard, and what is written when a delivery is materialised."""

import pytest
from conftest import MINI, REDECLARED

from strataframe import Delivery, accepted_files, export_group, ingest_audit, materialise, read_group
from strataframe.errors import DeliveryError
from strataframe.operators import materialise as writing

FAULTS = {
    "good.ags": (MINI, None),
    "crlf.ags": (REDECLARED, None),
    "empty.ags": ("", "empty file"),
    "prose.ags": ("just a letter\n", "no GROUP record"),
    "headless.ags": ('"HEADING","A"\n"DATA","1"\n', "no GROUP record"),
    "preface.ags": ("delivered by hand\n" + MINI, "text before the first GROUP record"),
    "open.ags": (MINI + '"DATA","BH01","half\n', "malformed line"),
    "newline.ags": (MINI.replace("Demo project", "Demo\nproject"), "malformed line"),
    "tag.ags": (MINI + '"DATUM","1"\n', "unknown record tag"),
    "early.ags": ('"GROUP","LOCA"\n"DATA","a"\n"HEADING","LOCA_ID"\n', "DATA before HEADING"),
    "bare.ags": ('"GROUP","LOCA"\n"DATA","a"\n', "DATA before HEADING"),
}


@pytest.mark.parametrize("limit", [0, 10**9])
def test_every_fault_is_named(spark, tmp_path, tiny_splits, limit):
    tiny_splits(300)
    for name, (text, _) in FAULTS.items():
        (tmp_path / name).write_bytes(text.encode())
    audit = ingest_audit(spark, str(tmp_path), section_file_bytes=limit)
    assert audit.columns == ["path", "size", "status", "reason"]
    found = {r.path.rsplit("/", 1)[1]: (r.size, r.status, r.reason) for r in audit.collect()}
    assert found == {
        name: (len(text.encode()), "rejected" if reason else "ok", reason) for name, (text, reason) in FAULTS.items()
    }
    assert accepted_files(audit).count() == 2


def test_oversized_file_is_neither_read_nor_accepted(spark, tmp_path):
    (tmp_path / "small.ags").write_text(MINI)
    (tmp_path / "big.ags").write_text(MINI + '"DATA","BH02","9.00","S9","D","SA9"\n' * 40)
    audit = {r.path.rsplit("/", 1)[1]: r.reason for r in ingest_audit(spark, str(tmp_path), max_file_bytes=1000).collect()}
    assert audit == {"small.ags": None, "big.ags": "over the 1000-byte limit"}
    with pytest.raises(DeliveryError, match=r"over the limit of 1000 bytes: .*big.ags"):
        Delivery.from_files(spark, str(tmp_path), max_file_bytes=1000)
    assert Delivery.from_files(spark, str(tmp_path)).group("SAMP").count() == 46


def test_materialised_join_needs_no_shuffle(spark, mini):
    materialise(Delivery.from_files(spark, mini), prefix="noshuffle_", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        child, parent = spark.table("noshuffle_samp_by_parent"), spark.table("noshuffle_loca")
        joined = child.join(parent, child["_parent_id"] == parent["_id"])
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_parent_lies_in_a_side_table(spark):
    """The other parents' rows still join bucket by bucket."""
    rows = "".join(f'"DATA","BH01","{i}.00","S{i}","U","SA{i}"\n' for i in range(200))
    more = "".join(f'"DATA","B{i}","CP","1.00"\n' for i in range(60))
    others = "".join(f'"DATA","B{i}","{i}.00","S{i}","U","SB{i}"\n' for i in range(60))
    text = MINI.replace('"DATA","BH02","TP","98.00"\n', f'"DATA","BH02","TP","98.00"\n{more}') + rows + others
    report = {r.table: r.layout for r in materialise(Delivery.from_text(spark, text), prefix="hot_", buckets=16).collect()}
    assert report["hot_samp_by_parent"] == "buckets+hot" and report["hot_samp"] == report["hot_loca"] == "buckets"
    assert spark.table("hot_samp_by_parent_hot").count() == 202 and spark.table("hot_samp_by_parent").count() == 61
    assert writing.read_materialised(spark, "samp", by_parent=True, prefix="hot_").count() == 263
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = writing.join_materialised(spark, "SAMP", "LOCA", prefix="hot_")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and plan.count("SelectedBucketsCount: 16 out of 16") >= 2
        found = joined.select("child.LOCA_ID", joined["parent.LOCA_ID"].alias("above")).collect()
        assert len(found) == 263 and all(r.LOCA_ID == r.above for r in found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_without_id_are_spread(spark):
    rows = "".join(f'"DATA","X{i}"\n' for i in range(1000))
    delivery = Delivery.from_text(spark, f'"GROUP","XTRA"\n"HEADING","XTRA_ID"\n"UNIT",""\n"TYPE","X"\n{rows}')
    report = materialise(delivery, prefix="spread_", buckets=8, allow_custom=True).collect()
    assert {(r.layout, r.n_rows) for r in report} == {("buckets+hot", 1000)}
    assert spark.table("spread_xtra_hot").count() == 1000 and len(spark.table("spread_xtra_hot").inputFiles()) == 8


def test_export(spark, mini, tmp_path):
    table = read_group(spark, mini, "LOCA")
    export_group(table, str(tmp_path / "loca.parquet"))
    back = spark.read.parquet(str(tmp_path / "loca.parquet"))
    assert back.dtypes == table.dtypes and sorted(map(tuple, back.collect())) == sorted(map(tuple, table.collect()))
