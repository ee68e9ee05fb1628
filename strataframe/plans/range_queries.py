"""Queries on parts of large files, wide encodings, files an index no longer fits, and on what the rows say of their groups."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.operators import key_mining, relate
from strataframe.operators.dictionary import mine_dictionary
from strataframe.operators.materialise import HOT_SUFFIX, join_materialised, materialise
from strataframe.plans import deliveries as dl
from strataframe.plans.read_queries import scratch_database
from strataframe.plans.registry import query
from strataframe.plans.table_queries import SECTIONS, keyed
from strataframe.session import cut_lineage, scratch_dir
from strataframe.sources.audit import ingest_audit
from strataframe.sources.delivery import Delivery
from strataframe.sources.section_index import build_section_index, read_group_indexed


@query("one_group_of_large_files", """
    select cast(c_custkey as varchar) as cust_id, cast(c_acctbal as double) as cust_bal, true as only_its_bytes from customer""")
def one_group_of_large_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in files that hold far more orders: their byte ranges are read, and nothing else."""
    texts = [dl.delivery_texts(dl.table(spark, sf_dir, name), SECTIONS[name]()) for name in ("orders", "customer")]
    path = dl.write_deliveries(texts[0].unionAll(texts[1]).repartition(4))
    opened = Delivery.from_files(spark, path, dl.fixture_dictionary(spark), section_file_bytes=0)
    sections, read = opened._split_files.byte_spans().where("group = 'CUST'"), opened._split_files.group_ranges("CUST")
    same = sections.agg(F.sum(F.col("end") - F.col("start"))).first()[0] == read.agg(F.sum("n_read")).first()[0]
    return opened.group("CUST").select(F.col("CUST_ID").alias("cust_id"), F.col("CUST_BAL").alias("cust_bal"), F.lit(same).alias("only_its_bytes"))


# The wide encodings, and the line feed that Spark's writer puts between rows to be read as theirs.
WIDE_FEEDS = {"UTF-16LE": "\n\0", "UTF-16BE": "\0\n"}


def write_wide(texts: DataFrame, charset: str) -> str:
    """Delivery texts as files in a wide encoding."""
    path = scratch_dir(texts.sparkSession, "wide")
    raw = F.encode("content", charset).cast("string")  # the writer copies the bytes
    texts.select(raw.alias("value")).write.option("lineSep", WIDE_FEEDS[charset]).text(path)
    return path


def _wide_orders(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    halves = {"UTF-16LE": "o_orderkey % 2 = 0", "UTF-16BE": "o_orderkey % 2 = 1"}
    accented = dl.table(spark, sf_dir, "orders").withColumn("o_orderpriority", F.concat(F.lit("é𝒳Ċ "), "o_orderpriority"))
    return {c: write_wide(dl.delivery_texts(accented.where(half), dl.order_section(), spread=False), c) for c, half in halves.items()}


@query("wide_read", """
    select cast(o_orderkey as varchar) as ordr_id, 'é𝒳' || chr(266) || ' ' || o_orderpriority as ordr_prio, o_totalprice as ordr_tot,
           case when o_orderkey % 2 = 0 then 'UTF-16LE' else 'UTF-16BE' end as encoding from orders""")
def wide_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two bytes a unit, with characters whose bytes look like a line feed and pairs of units."""
    result = None
    for charset, path in _wide_orders(spark, sf_dir).items():
        rows = Delivery.from_files(spark, path, dl.fixture_dictionary(spark), charset).group("ORDR").select(
            F.col("ORDR_ID").alias("ordr_id"), F.col("ORDR_PRIO").alias("ordr_prio"), F.col("ORDR_TOT").alias("ordr_tot"), F.lit(charset).alias("encoding"))
        result = rows if result is None else result.unionAll(rows)
    return result


@query("wide_audit", """
    select e as encoding, count(*) as n_orders, 0 as n_rejected
    from orders join (values (0, 'UTF-16LE'), (1, 'UTF-16BE')) v(m, e) on o_orderkey % 2 = m group by e""")
def wide_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = None
    for charset, path in _wide_orders(spark, sf_dir).items():
        opened = Delivery.from_files(spark, path, dl.fixture_dictionary(spark), charset)
        rejected = ingest_audit(spark, path, charset).where("status <> 'ok'").count()
        row = opened.row_counts().select(F.lit(charset).alias("encoding"), F.col("n_rows").alias("n_orders"), F.lit(rejected).alias("n_rejected"))
        result = row if result is None else result.unionAll(row)
    return result


def _misfit_index(spark: SparkSession, path: str) -> DataFrame:
    """A section index that fits only some of the files: by folder it is right, of another time, without the
    file, shifted, or cut short."""
    index = build_section_index(spark, path)
    kind = F.regexp_extract("path", "kind=([0-9]+)", 1).cast("int")
    wrong = index.where(kind != 2).select(
        "path", "size", F.when(kind == 1, F.col("mtime") - F.expr("interval 1 day")).otherwise(F.col("mtime")).alias("mtime"), "group", "span_no",
        F.when(kind == 3, F.greatest(F.col("start") - 7, F.lit(0)) + 3).otherwise(F.col("start")).alias("start"),
        F.when(kind == 4, F.col("end") - 20).otherwise(F.col("end")).alias("end"), "n_data", "headings", "units", "types")
    return cut_lineage(wrong)


@query("index_that_does_not_fit", """
    select cast(o_orderkey as varchar) as ordr_id, o_totalprice as ordr_tot from orders""")
def index_that_does_not_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fresh, stale, unindexed, shifted, truncated and redeclared sections, all read with the same rows."""
    orders = dl.table(spark, sf_dir, "orders")
    texts = dl.delivery_texts(orders.where("o_orderkey % 6 <> 5"), dl.order_section()).withColumn("kind", F.col("doc_id") % 5)
    twice = dl.delivery_texts(orders.where("o_orderkey % 6 = 5"), dl.order_section()).withColumn("kind", F.lit(5).cast("long"))
    path = dl.write_deliveries(texts.unionAll(twice).repartition(3, "kind"), "kind")
    read = read_group_indexed(spark, path, "ORDR", _misfit_index(spark, path), dl.fixture_dictionary(spark))
    return read.select(F.col("ORDR_ID").alias("ordr_id"), F.col("ORDR_TOT").alias("ordr_tot"))


@query("ancestor_closure", """
    with recursive e(k, g, pk, pg) as (
      select 'R' || r_regionkey, 'REGN', null, null from region
      union all select 'N' || n_nationkey, 'NATN', 'R' || n_regionkey, 'REGN' from nation
      union all select 'C' || c_custkey, 'CUST', 'N' || c_nationkey, 'NATN' from customer
      union all select 'O' || o_orderkey, 'ORDR', 'C' || o_custkey, 'CUST' from orders
      union all select 'L' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey, 'LINE', 'O' || l_orderkey, 'ORDR' from lineitem),
    d as (select distinct * from e),
    a(k, g, ak, ag, distance) as (
      select k, g, pk, pg, 1 from d where pk in (select k from d)
      union all select a.k, a.g, d.pk, d.pg, distance + 1 from a join d on a.ak = d.k where d.pk in (select k from d))
    select g as "group", ag as ancestor_group, distance, count(*) as n_links, count(distinct ak) as n_ancestors from a group by 1, 2, 3""")
def ancestor_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From lines up to regions by the edge table alone."""
    parents = {group: parent for group, parent, _, _ in dl.FIXTURE_GROUPS}
    groups = {SECTIONS[name]().group: keyed(spark, sf_dir, name) for name in SECTIONS}
    found = relate.ancestors(relate.edges({g: (df, parents[g]) for g, df in groups.items()}), keep_packed=True)
    return found.groupBy("group", "ancestor_group", "distance").agg(
        F.count("*").alias("n_links"), F.countDistinct("ancestor_id").alias("n_ancestors"))


def _parent(table: str, column: str, parent: str, parent_column: str, group: str) -> str:
    return f"case when exists (select 1 from {table} where {column} not in (select {parent_column} from {parent})) then null else '{group}' end"


_PARENTS = {
    "REGN": "null", "NATN": _parent("nation", "n_regionkey", "region", "r_regionkey", "REGN"),
    "CUST": _parent("customer", "c_nationkey", "nation", "n_nationkey", "NATN"), "ORDR": _parent("orders", "o_custkey", "customer", "c_custkey", "CUST"),
    "LINE": _parent("lineitem", "l_orderkey", "orders", "o_orderkey", "ORDR"),
}


def _mined_keys_sql() -> str:
    """Every set of headings that are no measures, counted; the smallest unique one with most identifiers, then the first headings."""
    rows, sets, listed = [], [], []
    for table, section in SECTIONS.items():
        group, heads = section().group, section().headings
        columns = ", ".join(f"{v.replace('string', 'varchar').replace('date_format', 'strftime').replace('yyyy-MM-dd', '%Y-%m-%d')} as {h}" for h, _, _, v in heads)
        rows.append(f"{group} as (select distinct {columns} from {table})")
        wanted = [(i, h, code) for i, (h, _, code, _) in enumerate(heads) if not code.endswith("2DP")]
        for size in range(1, len(wanted) + 1):
            for chosen in combinations(wanted, size):
                names, ordinals = ", ".join(h for _, h, _ in chosen), [i for i, _, _ in chosen]
                n_ids = sum(code == "ID" for _, _, code in chosen)
                sets.append(f"select '{group}' as g, {[h for _, h, _ in chosen]} as names, {size} as n, {-n_ids} as ids, {ordinals} as ordinals, "
                            f"(select count(*) from (select distinct {names} from {group})) = (select count(*) from {group}) as ok")
        listed += [f"('{group}', '{h}')" for h, _, _, _ in heads]
    parents = " ".join(f"when '{g}' then {sql}" for g, sql in _PARENTS.items())
    return f"""
        with {', '.join(rows)}, s as ({' union all '.join(sets)}),
          k as (select g, names from s where ok qualify row_number() over (partition by g order by n, ids, ordinals) = 1)
        select h.g as "group", case h.g {parents} end as parent, h.h as heading,
               case when list_contains(k.names, h.h) then 'KEY' else 'OTHER' end as status
        from (values {', '.join(listed)}) h(g, h) left join k on k.g = h.g"""


@query("mined_keys", _mined_keys_sql())
def mined_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KEY headings and parents of the test tables' groups, from their rows."""
    texts = [dl.delivery_texts(dl.table(spark, sf_dir, name), section(), spread=False).select("content") for name, section in SECTIONS.items()]
    path = dl.write_deliveries(texts[0].unionAll(texts[1]).unionAll(texts[2]).unionAll(texts[3]).unionAll(texts[4]))
    opened = Delivery.from_files(spark, path)
    groups = {code: opened.group(code, allow_custom=True) for code in ("REGN", "NATN", "CUST", "ORDR", "LINE")}
    return key_mining.mine_keys(groups, opened.headings()).select("group", "parent", "heading", "status")


@query("dictionary_declared", """
    with d as (select distinct p_brand as g, 'P_' || (p_size % 5) as h from part),
         u as (select 'PART' as g, h from (values ('PART_ID'), ('PART_NAME')) v(h) union all select 'DICT', h from (values ('DICT_GRP'), ('DICT_HDNG')) v(h))
    select coalesce(u.g, d.g) as "group", coalesce(u.h, d.h) as heading, u.g is not null as used, d.g is not null as declared
    from u full join d on u.g = d.g and u.h = d.h""")
def dictionary_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings that deliveries use beside those that their own DICT rows declare."""
    part = dl.table(spark, sf_dir, "part")
    declared = dl.Section("DICT", [("DICT_GRP", "", "X", "p_brand"), ("DICT_HDNG", "", "X", "concat('P_', p_size % 5)")])
    section = dl.Section("PART", [("PART_ID", "", "ID", dl.text("p_partkey")), ("PART_NAME", "", "X", "p_name")])
    opened = Delivery.from_files(spark, dl.write_deliveries(dl.delivery_texts(part, section, declared)))
    mined = mine_dictionary(opened.headings(), opened.group("DICT", allow_custom=True))
    return mined.select("group", "heading", (F.col("n_uses") > 0).alias("used"), "declared")


@query("orphans_by_file", """
    select o_orderstatus as file, count(*) as n_orphans from orders
    where o_custkey not in (select c_custkey from customer where c_acctbal >= 0) group by 1""")
def orphans_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans of each delivery; one folder per order status."""
    orders = dl.table(spark, sf_dir, "orders")
    texts = None
    for (status,) in sorted(orders.select("o_orderstatus").distinct().collect()):
        part = dl.delivery_texts(orders.where(F.col("o_orderstatus") == status), dl.order_section()).withColumn("status", F.lit(status))
        texts = part if texts is None else texts.unionAll(part)
    dictionary = dl.fixture_dictionary(spark)
    child = Delivery.from_files(spark, dl.write_deliveries(texts, "status"), dictionary).group("ORDR", with_source=True)
    customers = dl.table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    counts = relate.orphan_counts(child, keyed(spark, sf_dir, "customer", customers))
    file = F.regexp_extract("_source_file", "status=([^/]*)", 1)
    return counts.groupBy(file.alias("file")).agg(F.sum("n_orphans").alias("n_orphans"))


@query("hot_parent_join", """
    select c_custkey % 2 as half, count(*) as n_orders, max(o_totalprice) as top_total, true as has_hot_part
    from (select case when o_orderkey % 3 = 0 then (select min(c_custkey) from customer) else o_custkey end as k, o_totalprice from orders)
    join customer on k = c_custkey group by 1""")
def hot_parent_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer has a third of all orders: they lie in a side table, all others in buckets."""
    customers = dl.table(spark, sf_dir, "customer")
    first = customers.agg(F.min("c_custkey")).first()[0]
    moved = F.when(F.col("o_orderkey") % 3 == 0, F.lit(first)).otherwise(F.col("o_custkey"))
    orders = dl.table(spark, sf_dir, "orders").withColumn("o_custkey", moved)
    texts = [dl.delivery_texts(customers, dl.customer_section()), dl.delivery_texts(orders, dl.order_section())]
    database = scratch_database(spark)
    materialise(Delivery.from_texts(texts[0].withColumn("doc_id", F.concat(F.lit("a"), "doc_id")).unionAll(
        texts[1].withColumn("doc_id", F.concat(F.lit("b"), "doc_id"))), dictionary=dl.fixture_dictionary(spark)), database, buckets=16)
    joined = join_materialised(spark, "ORDR", "CUST", database)
    hot = spark.catalog.tableExists(f"{database}.ags_ordr_by_parent{HOT_SUFFIX}")
    return joined.groupBy((F.col("parent.CUST_ID").cast("long") % 2).alias("half")).agg(
        F.count("*").alias("n_orders"), F.max("child.ORDR_TOT").alias("top_total")).withColumn("has_hot_part", F.lit(hot))
