"""Reading queries: delivery text and files in, typed groups out."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataframe.functions import text as tx
from strataframe.functions.typing import SQL_NAMES
from strataframe.operators.group_table import Layout
from strataframe.operators.materialise import export_group, materialise
from strataframe.plans import deliveries as dl
from strataframe.plans.registry import query
from strataframe.session import scratch_dir
from strataframe.sources.audit import ingest_audit
from strataframe.sources.delivery import Delivery, read_group, read_group_text
from strataframe.sources.encoding import charset_rules
from strataframe.sources.section_index import build_section_index, read_group_indexed


def _lower(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[F.col(name).alias(name.lower()) for name in names])


@query("read_text_typed", """
    select cast(c_custkey as varchar) as cust_id, c_name as cust_name, cast(c_acctbal as double) as cust_bal,
           c_mktsegment as cust_seg, cast(c_nationkey as varchar) as natn_id
    from customer where c_acctbal > 50.0""")
def read_text_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = dl.delivery_texts(dl.table(spark, sf_dir, "customer"), dl.customer_section())
    group = read_group_text(spark, texts, "cust", dl.fixture_dictionary(spark))
    return _lower(group.where("cust_bal > 50.0"), "CUST_ID", "CUST_NAME", "CUST_BAL", "CUST_SEG", "NATN_ID")


ORDERS_TYPED = """
    select cast(o_orderkey as varchar) as ordr_id, o_orderstatus as ordr_stat, cast(o_totalprice as double) as ordr_tot,
           o_orderpriority as ordr_prio, strftime(o_orderdate, '%Y-%m-%d') as ordr_date,
           cast(o_custkey as varchar) as cust_id
    from orders"""
ORDER_COLUMNS = ["ORDR_ID", "ORDR_STAT", "ORDR_TOT", "ORDR_PRIO", "ORDR_DATE", "CUST_ID"]


def _order_files(spark: SparkSession, sf_dir: str) -> str:
    return dl.write_deliveries(dl.delivery_texts(dl.table(spark, sf_dir, "orders"), dl.order_section()))


@query("read_files_typed", ORDERS_TYPED)
def read_files_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = read_group(spark, _order_files(spark, sf_dir), "ORDR", dictionary=dl.fixture_dictionary(spark))
    return _lower(group, *ORDER_COLUMNS)


@query("read_large_files", ORDERS_TYPED)
def read_large_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the reader for files larger than a section may be."""
    opened = Delivery.from_files(
        spark, _order_files(spark, sf_dir), dl.fixture_dictionary(spark), section_file_bytes=0
    )
    return _lower(opened.group("ORDR"), *ORDER_COLUMNS)


@query("read_mixed_files", """
    select cast(o_orderkey as varchar) as ordr_id, cast(o_custkey as double) as ordr_no, o_orderstatus as ordr_mix,
           o_orderpriority as ordr_prio
    from orders where o_orderstatus = 'F'
    union all
    select cast(o_orderkey as varchar), cast(cast(o_totalprice as decimal(18,2)) as double),
           cast(o_custkey as varchar), null
    from orders where o_orderstatus <> 'F'""")
def read_mixed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two kinds of delivery that declare the same headings with different types."""
    orders = dl.table(spark, sf_dir, "orders")
    first = dl.Section("ORDR", [
        ("ORDR_ID", "", "ID", dl.text("o_orderkey")), ("ORDR_NO", "", "0DP", dl.text("o_custkey")),
        ("ORDR_MIX", "", "X", "o_orderstatus"), ("ORDR_PRIO", "", "X", "o_orderpriority"),
    ])
    second = dl.Section("ORDR", [
        ("ORDR_MIX", "", "0DP", dl.text("o_custkey")), ("ORDR_NO", "", "2DP", dl.money("o_totalprice")),
        ("ORDR_ID", "", "ID", dl.text("o_orderkey")),
    ])
    paths = [
        dl.write_deliveries(dl.delivery_texts(orders.where("o_orderstatus = 'F'"), first)),
        dl.write_deliveries(dl.delivery_texts(orders.where("o_orderstatus <> 'F'"), second)),
    ]
    group = read_group(spark, paths, "ORDR", dictionary=dl.fixture_dictionary(spark))
    return _lower(group, "ORDR_ID", "ORDR_NO", "ORDR_MIX", "ORDR_PRIO")


@query("lenient_cells", """
    select cast(event_id as varchar) as evnt_id,
           case event_type when 'click' then cast(cast(value as decimal(18,2)) as double)
                           when 'signup' then cast(cast(value as decimal(18,2)) as double) end as evnt_val,
           case when event_type <> 'signup' then user_id end as evnt_user,
           case event_type when 'click' then true when 'view' then false end as evnt_ok,
           case when event_type = 'click' then 'say "' || event_type || '", twice' end as evnt_kind
    from events""")
def lenient_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery per event: odd numbers, short rows, a TYPE record that ends early."""
    value = dl.money("value")
    number = (
        f"case event_type when 'click' then {value} when 'error' then 'n/a' when 'view' then '' "
        f"when 'purchase' then concat({value}, 'd') else concat('+', {value}) end"
    )
    user = "concat(user_id, if(event_type = 'signup', '.0', ''))"
    flag = "case event_type when 'click' then 'Y' when 'view' then 'N' when 'error' then 't' else '' end"
    cells = [dl.text("event_id"), number, user, flag]
    full = tx.record("DATA", *cells, """concat('say "', event_type, '", twice')""")
    short = tx.record("DATA", *cells)
    header = (
        '"GROUP","EVNT"\r\n"HEADING","EVNT_ID","EVNT_VAL","EVNT_USER","EVNT_OK","EVNT_KIND"\r\n'
        '"UNIT","","m"\r\n"TYPE","ID","2DP","0DP","YN"\r\n'
    )
    texts = dl.table(spark, sf_dir, "events").selectExpr(
        "event_id as doc_id",
        f"concat({tx.literal(header)}, if(event_type = 'click', {full}, {short}), '\\r\\n') as content",
    )
    group = read_group_text(spark, texts, "EVNT", dl.fixture_dictionary(spark))
    return _lower(group, "EVNT_ID", "EVNT_VAL", "EVNT_USER", "EVNT_OK", "EVNT_KIND")


@query("type_inspection", """
    select max(typeof(cast(l_orderkey as varchar))) as t_id, max(typeof(cast(l_linenumber as bigint))) as t_no,
           max(typeof(cast(l_quantity as double))) as t_qty,
           cast(sum(cast(l_quantity = 10.0 as integer)) as bigint) as n_ten, count(*) as n_rows
    from lineitem""")
def type_inspection(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = dl.delivery_texts(dl.table(spark, sf_dir, "lineitem"), dl.line_section())
    layout = Layout.of(**{name: code for name, _, code in dl.line_section().columns})
    group = read_group_text(spark, texts, "LINE", dl.fixture_dictionary(spark), layout=layout)
    names = F.create_map(*[F.lit(x) for pair in SQL_NAMES.items() for x in pair])
    return group.agg(
        names[F.max(F.typeof("ORDR_ID"))].alias("t_id"), names[F.max(F.typeof("LINE_NO"))].alias("t_no"),
        names[F.max(F.typeof("LINE_QTY"))].alias("t_qty"),
        F.sum((F.col("LINE_QTY") == 10.0).cast("int")).alias("n_ten"), F.count("*").alias("n_rows"),
    )


@query("custom_group", """
    select cast(null as varchar) as _id, cast(null as varchar) as _parent_id, p_partkey as zprt_no, p_name as zprt_name
    from part""")
def custom_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group outside the dictionary: readable on request, without keys."""
    section = dl.Section("ZPRT", [("ZPRT_NO", "", "0DP", dl.text("p_partkey")), ("ZPRT_NAME", "", "X", "p_name")])
    texts = dl.delivery_texts(dl.table(spark, sf_dir, "part"), section)
    group = read_group_text(spark, texts, "ZPRT", dl.fixture_dictionary(spark), allow_custom=True)
    return _lower(group, "_id", "_parent_id", "ZPRT_NO", "ZPRT_NAME")


@query("encoded_read", r"""
    select cast(doc_id as varchar) as docs_id, lang as docs_lang,
           replace(replace(text, chr(13), ' '), chr(10), ' ') || ' € ' || lang as docs_text
    from documents""")
def encoded_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in windows-1252: every document's whole text, line breaks as blanks."""
    section = dl.Section("DOCS", [
        ("DOCS_ID", "", "ID", dl.text("doc_id")), ("DOCS_LANG", "", "PA", "lang"), ("DOCS_TEXT", "", "X", "concat(translate(text, '\\r\\n', '  '), ' € ', lang)"),
    ])
    texts = dl.delivery_texts(dl.table(spark, sf_dir, "documents"), section)
    with charset_rules(spark, "windows-1252"):
        # The text sink writes the bytes of a string as they are.
        encoded = texts.select(F.encode("content", "windows-1252").cast("string").alias("content"))
    group = read_group(
        spark, dl.write_deliveries(encoded), "DOCS", encoding="windows-1252", dictionary=dl.fixture_dictionary(spark)
    )
    return _lower(group, "DOCS_ID", "DOCS_LANG", "DOCS_TEXT")


@query("quoted_text_read", r"""
    select cast(conv_id as varchar) as conv_id, turn as turn_no, role as turn_role,
           nullif(trim(replace(replace(text, chr(13), ' '), chr(10), ' ')), '') as turn_text
    from conversations""")
def quoted_text_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long free text in quoted cells: every turn's whole text, line breaks as blanks."""
    section = dl.Section("TURN", [
        ("CONV_ID", "", "ID", dl.text("conv_id")), ("TURN_NO", "", "0DP", dl.text("turn")), ("TURN_ROLE", "", "PA", "role"),
        ("TURN_TEXT", "", "X", "translate(text, '\\r\\n', '  ')"),
    ])
    texts = dl.delivery_texts(dl.table(spark, sf_dir, "conversations"), section)
    turns = read_group_text(spark, texts, "TURN", dl.fixture_dictionary(spark))
    return _lower(turns.withColumn("TURN_TEXT", F.trim("TURN_TEXT")), "CONV_ID", "TURN_NO", "TURN_ROLE", "TURN_TEXT")


# What is wrong with the deliveries of each decade of brands.
FAULTS = [
    (10, None),
    (15, "no GROUP record"),
    (19, "text before the first GROUP record"),
    (21, "malformed line"),
    (23, "unknown record tag"),
    (99, "DATA before HEADING"),
]
_FAULT_SQL = "case " + " ".join(
    f"when brand < {bound} then {'null' if reason is None else repr(reason)}" for bound, reason in FAULTS
) + " end"


@query("ingest_audit", f"""
    select brand, case when reason is null then 'ok' else 'rejected' end as status, reason
    from (select brand, cast({_FAULT_SQL} as varchar) as reason
          from (select distinct cast(substr(p_brand, 7) as integer) as brand from part))""")
def ingest_audit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries with known faults, one folder per brand."""
    data = tx.record("DATA", dl.text("p_partkey"), "p_name")
    group, heading, kind = '"GROUP","PART"\n', '"HEADING","PART_ID","PART_NAME"\n', '"TYPE","ID","X"\n'
    # What stands in front of and behind each DATA line.
    around = {
        None: (group + heading + kind, ""),
        "no GROUP record": (heading + kind, ""),
        "text before the first GROUP record": ("delivered by hand\n" + group + heading + kind, ""),
        "malformed line": (group + heading + kind, '\n"DATA","1","half'),
        "unknown record tag": (group + heading + kind, '\n"DATUM","1","x"'),
        "DATA before HEADING": (group, "\n" + heading + kind.rstrip("\n")),
    }
    branches = " ".join(
        f"when brand < {bound} then concat({tx.literal(around[reason][0])}, {data}, {tx.literal(around[reason][1])})"
        for bound, reason in FAULTS
    )
    parts = dl.table(spark, sf_dir, "part").selectExpr("*", "int(substring(p_brand, 7)) as brand")
    path = dl.write_deliveries(parts.selectExpr("brand", f"case {branches} end as content"), "brand")
    audit = ingest_audit(spark, path)
    return audit.select(
        F.regexp_extract("path", "brand=([0-9]+)", 1).cast("int").alias("brand"), "status", "reason"
    ).distinct()


@query("section_index", """
    select 'CUST' as "group", count(*) as n_rows, true as contiguous from customer
    union all select 'NAME', count(*), true from customer""")
def section_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections are found with their exact byte ranges: in every file each starts where one ends."""
    names = dl.Section("NAME", [("CUST_ID", "", "ID", dl.text("c_custkey")), ("CUST_NAME", "", "X", "c_name")])
    path = dl.write_deliveries(dl.delivery_texts(dl.table(spark, sf_dir, "customer"), dl.customer_section(), names))
    index = build_section_index(spark, path)
    before = F.lag("end", 1, 0).over(Window.partitionBy("path").orderBy("start"))
    return index.withColumn("joined", F.col("start") == before).groupBy("group").agg(
        F.sum("n_data").alias("n_rows"), F.bool_and("joined").alias("contiguous")
    )


@query("sliced_read", """
    select cast(c_custkey as varchar) as cust_id, c_name as cust_name, cast(c_acctbal as double) as cust_bal
    from customer""")
def sliced_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group fetched by byte range: one file per segment and task, indexed, then read."""
    names = dl.Section("NAME", [("CUST_ID", "", "ID", dl.text("c_custkey")), ("CUST_SEG", "", "X", "c_mktsegment")])
    customers = dl.table(spark, sf_dir, "customer")
    path = dl.write_deliveries(dl.delivery_texts(customers, names, dl.customer_section()))
    stored = scratch_dir(spark, "index")
    build_section_index(spark, path).write.parquet(stored)
    group = read_group_indexed(spark, path, "CUST", spark.read.parquet(stored), dl.fixture_dictionary(spark))
    return _lower(group, "CUST_ID", "CUST_NAME", "CUST_BAL")


@query("groups_profile", """
    select 'CUST' as "group", count(*) as n_rows, 5 as n_headings, 'NATN' as parent from customer
    union all select 'NAME', count(*), 2, null from customer
    union all select 'ORDR', count(*), 6, 'CUST' from orders""")
def groups_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = dl.Section("NAME", [("CUST_ID", "", "ID", dl.text("c_custkey")), ("CUST_NAME", "", "X", "c_name")])
    customers = dl.delivery_texts(dl.table(spark, sf_dir, "customer"), dl.customer_section(), names)
    orders = dl.delivery_texts(dl.table(spark, sf_dir, "orders"), dl.order_section())
    texts = customers.unionByName(orders.withColumn("doc_id", -1 - F.col("doc_id")))
    profile = Delivery.from_texts(texts, dictionary=dl.fixture_dictionary(spark)).groups()
    return profile.groupBy("group").agg(
        F.sum("n_rows").alias("n_rows"), F.max("n_headings").cast("int").alias("n_headings"), F.max("parent").alias("parent")
    )


@query("headings_profile", """
    select 'LINE' as "group", v.*, cast(n_rows > 0 as boolean) as has_rows
    from (values ('ORDR_ID', null, 'ID', 'VARCHAR', 'KEY', true, 0), ('LINE_NO', null, '0DP', 'BIGINT', 'KEY', true, 1),
                 ('PART_ID', null, 'ID', 'VARCHAR', 'KEY', true, 2), ('SUPP_ID', null, 'ID', 'VARCHAR', 'KEY', true, 3),
                 ('LINE_QTY', null, '2DP', 'DOUBLE', 'OTHER', false, 4), ('LINE_AMT', 'gbp', '2DP', 'DOUBLE', 'OTHER', false, 5),
                 ('LINE_FLAG', null, 'PA', 'VARCHAR', 'OTHER', false, 6))
         as v(heading, unit, ags_type, sql_type, status, is_key, ordinal), (select count(*) as n_rows from lineitem)""")
def headings_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = dl.delivery_texts(dl.table(spark, sf_dir, "lineitem"), dl.line_section())
    profile = Delivery.from_texts(texts, dictionary=dl.fixture_dictionary(spark)).headings()
    return profile.groupBy("group", "heading", "unit", "ags_type", "sql_type", "status", "is_key", "ordinal").agg(
        (F.count("*") > 0).alias("has_rows")
    ).withColumn("ordinal", F.col("ordinal").cast("int"))


@query("counts_side_by_side", """
    select (select count(*) from customer) as n_cust, (select count(*) from orders) as n_ordr,
           (select count(*) from lineitem) as n_line""")
def counts_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of several groups from one scan over all deliveries."""
    parts = [("customer", dl.customer_section()), ("orders", dl.order_section()), ("lineitem", dl.line_section())]
    texts = [
        dl.delivery_texts(dl.table(spark, sf_dir, name), section).withColumn("doc_id", F.concat(F.lit(name), "doc_id"))
        for name, section in parts
    ]
    counts = Delivery.from_texts(texts[0].unionByName(texts[1]).unionByName(texts[2])).row_counts()
    return counts.agg(*[
        F.coalesce(F.max(F.when(F.col("group") == code, F.col("n_rows"))), F.lit(0)).alias(f"n_{code.lower()}")
        for code in ("CUST", "ORDR", "LINE")
    ])


def scratch_database(spark: SparkSession) -> str:
    name = f"deliveries_{uuid.uuid4().hex}"
    spark.sql(f"create database {name} location '{scratch_dir(spark, 'database')}'")
    return name


def _materialised(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    customers = dl.delivery_texts(dl.table(spark, sf_dir, "customer"), dl.customer_section(), spread=False)
    orders = dl.delivery_texts(dl.table(spark, sf_dir, "orders"), dl.order_section(), spread=False)
    texts = customers.withColumn("doc_id", F.concat(F.lit("a"), "doc_id")).unionByName(
        orders.withColumn("doc_id", F.concat(F.lit("b"), "doc_id"))
    )
    path = dl.write_deliveries(texts)
    database = scratch_database(spark)
    return database, materialise(Delivery.from_files(spark, path, dl.fixture_dictionary(spark)), database)


@query("materialise", """
    with c as (select count(*) as n from customer), o as (select count(*) as n from orders)
    select * from (
      select 'CUST' as "group", 'ags_cust' as "table", 'table' as kind, n as n_rows from c
      union all select 'CUST', 'ags_cust', 'id_index', n from c
      union all select 'CUST', 'ags_cust_by_parent', 'parent_index', n from c
      union all select 'ORDR', 'ags_ordr', 'table', n from o
      union all select 'ORDR', 'ags_ordr', 'id_index', n from o
      union all select 'ORDR', 'ags_ordr_by_parent', 'parent_index', n from o)""")
def materialise_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, report = _materialised(spark, sf_dir)
    return report.select("group", F.regexp_extract("table", r"\.(.*)$", 1).alias("table"), "kind", "n_rows")


@query("materialised_join", """
    select c_mktsegment as cust_seg, count(*) as n_orders, max(o_totalprice) as top_total
    from orders join customer on o_custkey = c_custkey group by 1""")
def materialised_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child by parent id with parent by id: both tables are bucketed, so the join needs no shuffle."""
    database, _ = _materialised(spark, sf_dir)
    child, parent = spark.table(f"{database}.ags_ordr_by_parent"), spark.table(f"{database}.ags_cust")
    joined = child.join(parent, child["_parent_id"] == parent["_id"])
    return joined.groupBy(F.col("CUST_SEG").alias("cust_seg")).agg(
        F.count("*").alias("n_orders"), F.max("ORDR_TOT").alias("top_total")
    )


@query("export_roundtrip", """
    select cast(c_custkey as varchar) as cust_id, cast(c_acctbal as double) as cust_bal from customer""")
def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = dl.delivery_texts(dl.table(spark, sf_dir, "customer"), dl.customer_section())
    path = scratch_dir(spark, "export")
    export_group(read_group_text(spark, texts, "CUST", dl.fixture_dictionary(spark)), path)
    return _lower(spark.read.parquet(path), "CUST_ID", "CUST_BAL")


@query("sql_views", """
    select n_name, count(*) as n_rows from customer join nation on c_nationkey = n_nationkey
    where c_acctbal > 0 group by 1""")
def sql_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups as SQL views; one of them joined to an external Parquet table."""
    texts = dl.delivery_texts(dl.table(spark, sf_dir, "customer"), dl.customer_section())
    Delivery.from_texts(texts, dictionary=dl.fixture_dictionary(spark)).create_views("delivered_")
    nation = dl.table(spark, sf_dir, "nation")
    return spark.sql(
        "select n_name, count(*) as n_rows from delivered_cust join {nation} on natn_id = cast(n_nationkey as string) "
        "where cust_bal > 0 group by n_name",
        nation=nation,
    )
