"""Queries on what deliveries get wrong, and on readers that must not differ."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions import text as tx
from strataframe.operators.dedup import dedup_identity
from strataframe.operators.dictionary import group_parents, relationships
from strataframe.plans import deliveries as dl
from strataframe.plans.registry import query
from strataframe.sources.audit import ingest_audit
from strataframe.sources.delivery import Delivery, read_group_text
from strataframe.sources.byte_ranges import file_listing

WHOLE_FILES = 1 << 62  # every file is read section by section


def _tag_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries whose groups are called like record tags, as the unit and type groups of every file are."""
    orders = dl.Section("UNIT", [
        ("UNIT_UNIT", "u1", "X", "o_orderpriority"), ("UNIT_NO", "", "0DP", dl.text("o_orderkey")), ("UNIT_REM", "", "PA", "o_orderstatus"),
    ])
    customer = dl.Section("TYPE", [("TYPE_TYPE", "t1", "PA", "c_mktsegment"), ("TYPE_VAL", "m", "2DP", dl.money("c_acctbal"))])
    # The code's own quotes close around a blank cell: "GROUP","DATA","".
    padded = dl.Section('DATA","', [("DATA_NAME", "", "X", "c_name")])
    texts = [dl.delivery_texts(dl.table(spark, sf_dir, "orders"), orders), dl.delivery_texts(dl.table(spark, sf_dir, "customer"), customer, padded)]
    return texts[0].unionByName(texts[1].withColumn("doc_id", F.col("doc_id") + (1 << 40)))


@query("unit_type_groups", """
    select 'UNIT' as "group", h as heading, u as unit, t as ags_type, (select count(*) from orders) as n_rows
    from (values ('UNIT_UNIT', 'u1', 'X'), ('UNIT_NO', null, '0DP'), ('UNIT_REM', null, 'PA')) v(h, u, t)
    union all
    select 'TYPE', h, u, t, (select count(*) from customer) from (values ('TYPE_TYPE', 't1', 'PA'), ('TYPE_VAL', 'm', '2DP')) v(h, u, t)
    union all
    select 'DATA', 'DATA_NAME', null, 'X', (select count(*) from customer)""")
def unit_type_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = dl.write_deliveries(_tag_groups(spark, sf_dir))
    opened = Delivery.from_files(spark, path, dl.fixture_dictionary(spark))
    headings = opened.headings().select("group", "heading", "unit", "ags_type").distinct()
    return headings.join(opened.row_counts(), "group").select("group", "heading", "unit", "ags_type", "n_rows")


@query("readers_agree", """
    select g as "group", case when g = 'UNIT' then (select count(*) from orders) else (select count(*) from customer) end as n_rows,
           0 as n_differences
    from (values ('UNIT'), ('TYPE'), ('DATA')) v(g)""")
def readers_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full rows and hashes of the text reader, the section reader and the split reader."""
    texts = _tag_groups(spark, sf_dir)
    path, dictionary = dl.write_deliveries(texts), dl.fixture_dictionary(spark)
    by_section = Delivery.from_files(spark, path, dictionary, section_file_bytes=WHOLE_FILES)
    by_split = Delivery.from_files(spark, path, dictionary, section_file_bytes=0)
    result = None
    for group in ("UNIT", "TYPE", "DATA"):
        first = by_section.group(group, allow_custom=True)
        others = [by_split.group(group, allow_custom=True), read_group_text(spark, texts, group, dictionary, allow_custom=True)]
        columns = [F.col(c).cast("string") for c in first.columns]
        sides = [first.select(*columns, F.lit(2).alias("_n")), *[o.select(*columns, F.lit(-1).alias("_n")) for o in others]]
        both = sides[0].unionAll(sides[1]).unionAll(sides[2])
        odd = both.groupBy(*first.columns).agg(F.sum("_n").alias("_n"), F.sum(F.when(F.col("_n") == 2, 1).otherwise(0)).alias("_rows"))
        row = odd.agg(F.sum("_rows").alias("n_rows"), F.sum(F.abs("_n")).cast("int").alias("n_differences"))
        row = row.select(F.lit(group).alias("group"), "n_rows", "n_differences")
        result = row if result is None else result.unionAll(row)
    return result


@query("size_limit", "select count(*) as n_rows, true as limit_names_the_larger from orders")
def size_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A read without limit gives all rows; an audit with one lists just the files over it."""
    path = dl.write_deliveries(dl.delivery_texts(dl.table(spark, sf_dir, "orders"), dl.order_section()))
    files = file_listing(spark, [path])
    limit = files.agg(F.floor(F.avg("size")).cast("long")).first()[0]
    listed = ingest_audit(spark, path, max_file_bytes=limit).where(F.col("reason").startswith("over the")).select("path")
    larger = files.where(F.col("size") > limit).select("path")
    differ = listed.exceptAll(larger).unionAll(larger.exceptAll(listed))
    rows = Delivery.from_files(spark, path, dl.fixture_dictionary(spark)).group("ORDR").agg(F.count("*").alias("n_rows"))
    return rows.crossJoin(F.broadcast(differ.agg((F.count("*") == 0).alias("limit_names_the_larger"))))


@query("malformed_lines", """
    select cast(c_custkey as varchar) as cust_id, case when c_mktsegment = 'AUTOMOBILE' then null else c_name end as cust_name,
           case when c_mktsegment in ('BUILDING', 'FURNITURE') then null
                else cast(cast(c_acctbal as decimal(18,2)) as double) end as cust_bal,
           c_mktsegment in ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD') as malformed
    from customer""")
def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By market segment: a cell without quotes, an open quote, text behind the last cell, an indented line."""
    number, name, balance = "c_custkey", "c_name", dl.money("c_acctbal")
    line = f"""case c_mktsegment
        when 'AUTOMOBILE' then concat('"DATA","', {number}, '",', {name}, ',"', {balance}, '"')
        when 'BUILDING' then concat('"DATA","', {number}, '","', {name}, '","', {balance})
        when 'FURNITURE' then concat('"DATA","', {number}, '","', {name}, '","', {balance}, '"x')
        when 'HOUSEHOLD' then concat('  "DATA","', {number}, '","', {name}, '","', {balance}, '"')
        else concat('"DATA","', {number}, '","', {name}, '","', {balance}, '"') end"""
    header = '"GROUP","CUST"\n"HEADING","CUST_ID","CUST_NAME","CUST_BAL"\n"UNIT","","",""\n"TYPE","ID","X","2DP"\n'
    texts = dl.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as doc_id", f"concat({tx.literal(header)}, {line}, '\\n') as content")
    group = read_group_text(spark, texts, "CUST", dl.fixture_dictionary(spark), malformed="null")
    return group.select(
        F.col("CUST_ID").alias("cust_id"), F.col("CUST_NAME").alias("cust_name"), F.col("CUST_BAL").alias("cust_bal"),
        F.col("_malformed").alias("malformed"))


@query("custom_group_dedup", "select count(*) as n_rows from supplier")
def custom_group_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a group outside the dictionary have no identity, so none is a repeat of another."""
    section = dl.Section("XTRA", [("XTRA_ID", "", "ID", dl.text("s_suppkey")), ("XTRA_NAME", "", "X", "s_name")])
    texts = dl.delivery_texts(dl.table(spark, sf_dir, "supplier"), section)
    group = read_group_text(spark, texts, "XTRA", dl.fixture_dictionary(spark), allow_custom=True)
    return dedup_identity(group).agg(F.count("*").alias("n_rows"))


@query("one_parent", """
    with d as (
      select p_brand as g, case when p_size % 5 + 1 in (1, 2) then 'P_OLD' else 'P_' || (p_size % 3) end as parent, p_size % 5 + 1 as e from part),
    n as (select g, max(e) as e from d group by g)
    select d.g as child, min(d.parent) as parent, true as relationship_agrees from d join n on d.g = n.g and d.e = n.e group by d.g""")
def one_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parent of a group is that of the newest edition with the group, in every table that names one."""
    edition = F.element_at(F.array(*[F.lit(e) for e in ("4.0.3", "4.0.4", "4.1", "4.1.1", "4.2")]), (F.col("p_size") % 5 + 1).cast("int"))
    moved = F.when(F.col("p_size") % 5 < 2, "P_OLD").otherwise(F.concat(F.lit("P_"), F.col("p_size") % 3))
    dictionary = dl.table(spark, sf_dir, "part").groupBy(
        edition.alias("edition"), F.col("p_brand").alias("group"), moved.alias("parent"), F.col("p_type").alias("heading")
    ).agg(F.min("p_partkey").alias("ordinal")).select(
        "edition", "group", "parent", "heading", F.lit("OTHER").alias("status"), F.lit("X").alias("ags_type"),
        F.lit("").alias("unit"), F.lit("").alias("description"), "ordinal")
    named = group_parents(dictionary).withColumnRenamed("group", "child")
    related = relationships(dictionary).groupBy("child").agg(F.min("parent").alias("low"), F.max("parent").alias("high"))
    return named.join(related, "child").select(
        "child", "parent", ((F.col("parent") == F.col("low")) & (F.col("parent") == F.col("high"))).alias("relationship_agrees"))


@query("repeat_reads", """
    select r as reader, count(*) as first_read, count(*) as second_read
    from orders, (values ('sections'), ('splits')) v(r) group by r""")
def repeat_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two reads of a kept delivery, for either kind of reader."""
    path = dl.write_deliveries(dl.delivery_texts(dl.table(spark, sf_dir, "orders"), dl.order_section()))
    result = None
    for reader, limit in (("sections", WHOLE_FILES), ("splits", 0)):
        kept = Delivery.from_files(spark, path, dl.fixture_dictionary(spark), section_file_bytes=limit).persist()
        first = kept.group("ORDR").count()
        row = kept.group("ORDR").agg(F.count("*").alias("second_read")).select(
            F.lit(reader).alias("reader"), F.lit(first).alias("first_read"), "second_read")
        result = row if result is None else result.unionAll(row)
    return result
