"""Queries over keyed groups: joins, aggregates, revisions, duplicates, dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.operators import dedup, dictionary, relate, route
from strataframe.operators.aggregates import arg_max, duplicate_keys
from strataframe.operators.catalogue import invalid_rules, rules_table
from strataframe.operators.group_table import keyed_table
from strataframe.plans import deliveries as dl
from strataframe.plans import sql_forms as sq
from strataframe.plans.registry import query
from strataframe.sources.delivery import Delivery

SECTIONS = {
    "region": dl.region_section, "nation": dl.nation_section, "customer": dl.customer_section,
    "orders": dl.order_section, "lineitem": dl.line_section,
}


def keyed(spark: SparkSession, sf_dir: str, name: str, df: DataFrame | None = None) -> DataFrame:
    """A test table as a keyed group, straight from its columns."""
    section = SECTIONS[name]()
    spec = dictionary.group_spec(dl.fixture_dictionary(spark), section.group)
    rows = dl.table(spark, sf_dir, name) if df is None else df
    return keyed_table(section.raw(rows), spec, section.columns)


# ------------------------------------------------------------------------------- keys

_LINE_ID = sq.identity("LINE", *[f"cast({c} as varchar)" for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
_ORDER_ID = sq.identity("ORDR", "cast(o_orderkey as varchar)")
_LINE_PARENT = sq.identity("ORDR", "cast(l_orderkey as varchar)")


@query("row_ids", f"""
    select {_LINE_ID} as _id, {_LINE_PARENT} as _parent_id, cast(l_quantity as double) as line_qty from lineitem""")
def row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(spark, sf_dir, "lineitem").select("_id", "_parent_id", F.col("LINE_QTY").alias("line_qty"))


_ORDER_CONTENT = sq.content(
    "ORDR",
    ("ORDR_ID", "", "ID", "cast(o_orderkey as varchar)"), ("ORDR_STAT", "", "PA", "o_orderstatus"),
    ("ORDR_TOT", "gbp", "2DP", sq.money("o_totalprice")), ("ORDR_PRIO", "", "X", "o_orderpriority"),
    ("ORDR_DATE", "yyyy-mm-dd", "DT", "strftime(o_orderdate, '%Y-%m-%d')"), ("CUST_ID", "", "ID", "cast(o_custkey as varchar)"),
)


@query("content_hash", f"select cast(o_orderkey as varchar) as ordr_id, {_ORDER_CONTENT} as _content_hash from orders")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(spark, sf_dir, "orders").select(F.col("ORDR_ID").alias("ordr_id"), "_content_hash")


@query("text_and_table_keys_agree", """
    select count(*) as n_rows, count(*) as n_same from orders""")
def text_and_table_keys_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read from delivery text carry the same three keys as rows keyed from columns."""
    orders = dl.table(spark, sf_dir, "orders")
    texts = dl.delivery_texts(orders, dl.order_section())
    names = ["_id", "_parent_id", "_content_hash"]
    read = Delivery.from_texts(texts, dictionary=dl.fixture_dictionary(spark)).group("ORDR").select(*names)
    straight = keyed(spark, sf_dir, "orders").select(*names, F.lit(1).alias("same"))
    return read.join(straight, names, "left").agg(F.count("*").alias("n_rows"), F.count("same").alias("n_same"))


# ------------------------------------------------------------------------------- joins


@query("parent_join", """
    select o_orderstatus as ordr_stat, count(*) as n_lines, sum(cast(l_quantity as double)) as qty
    from lineitem join orders on l_orderkey = o_orderkey group by 1""")
def parent_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = relate.join_parent(keyed(spark, sf_dir, "lineitem"), keyed(spark, sf_dir, "orders"), "LINE", "ORDR")
    return joined.groupBy(F.col("ORDR.ORDR_STAT").alias("ordr_stat")).agg(
        F.count("*").alias("n_lines"), F.sum("LINE.LINE_QTY").alias("qty")
    )


@query("orphans", """
    select cast(o_orderkey as varchar) as ordr_id, cast(o_custkey as varchar) as cust_id
    from orders where o_custkey not in (select c_custkey from customer where c_acctbal >= 0)""")
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose customer is missing once customers in debt are left out of the delivery."""
    customers = dl.table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    found = relate.orphans(keyed(spark, sf_dir, "orders"), keyed(spark, sf_dir, "customer", customers))
    return found.select(F.col("ORDR_ID").alias("ordr_id"), F.col("CUST_ID").alias("cust_id"))


@query("hierarchy_walk", """
    select r_name as regn_name, count(*) as n_lines, sum(cast(l_quantity as double)) as qty
    from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1""")
def hierarchy_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = relate.hierarchy_path(dl.fixture_dictionary(spark), "LINE", "REGN")
    groups = {SECTIONS[name]().group: keyed(spark, sf_dir, name) for name in SECTIONS}
    return relate.walk(groups, path).groupBy(F.col("REGN.REGN_NAME").alias("regn_name")).agg(
        F.count("*").alias("n_lines"), F.sum("LINE.LINE_QTY").alias("qty")
    )


@query("external_join", """
    select cast(c_custkey as varchar) as cust_id, cast(c_acctbal as double) as cust_bal, n_name as zone
    from customer join nation on c_nationkey = n_nationkey""")
def external_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = dl.table(spark, sf_dir, "nation").select(F.expr(dl.text("n_nationkey")).alias("parcel"), F.col("n_name").alias("zone"))
    customers = keyed(spark, sf_dir, "customer")
    return customers.join(zones, F.col("NATN_ID") == F.col("parcel")).select(
        F.col("CUST_ID").alias("cust_id"), F.col("CUST_BAL").alias("cust_bal"), "zone"
    )


# The route used by the proximity query, in part size and retail price.
ROUTE = [(2.0, 905.0), (25.0, 930.0), (25.0, 960.0), (48.0, 995.0)]
ROUTE_DISTANCE = 3.3


def _route_sql() -> str:
    segments = ", ".join(f"({a[0]}, {a[1]}, {b[0]}, {b[1]})" for a, b in zip(ROUTE, ROUTE[1:]))
    return f"""
    with s(x1, y1, x2, y2) as (select * from (values {segments})),
         d as (select p_partkey, p_size::double as x, p_retailprice as y, x1::double as x1, y1::double as y1,
                      (x2 - x1)::double as dx, (y2 - y1)::double as dy from part, s),
         t as (select *, least(greatest(((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy), 0), 1) as t from d)
    select distinct p_partkey, x as p_size, y as p_retailprice from t
    where (x - (x1 + t * dx)) ** 2 + (y - (y1 + t * dy)) ** 2 <= {ROUTE_DISTANCE * ROUTE_DISTANCE!r}"""


@query("near_route", _route_sql())
def near_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = dl.table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    return route.near_route(parts, "p_size", "p_retailprice", route.route_segments(spark, ROUTE), ROUTE_DISTANCE)


# -------------------------------------------------------------------------- aggregates


@query("mean_by_parent", """
    select cast(c_nationkey as varchar) as natn_id, count(*) as n, round(avg(l_quantity), 1) as mean_qty
    from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
    group by 1 order by mean_qty desc, natn_id""")
def mean_by_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = {SECTIONS[name]().group: keyed(spark, sf_dir, name) for name in ("lineitem", "orders", "customer")}
    return (
        relate.walk(groups, ["LINE", "ORDR", "CUST"])
        .groupBy(F.col("CUST.NATN_ID").alias("natn_id"))
        .agg(F.count("*").alias("n"), F.round(F.avg("LINE.LINE_QTY"), 1).alias("mean_qty"))
        .orderBy(F.desc("mean_qty"), "natn_id")
    )


@query("deepest_value", """
    select cast(c_custkey as varchar) as cust_id, max(o_totalprice) as deepest,
           (array_agg(o_orderpriority order by o_totalprice desc, o_orderkey desc)
              filter (o_orderpriority <> '5-LOW'))[1] as prio_at_deepest
    from customer join orders on o_custkey = c_custkey group by 1""")
def deepest_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The highest order of each customer and the priority there, where a priority was given."""
    orders = dl.table(spark, sf_dir, "orders").withColumn("o_orderpriority", F.expr("nullif(o_orderpriority, '5-LOW')"))
    joined = relate.join_parent(
        keyed(spark, sf_dir, "orders", orders), keyed(spark, sf_dir, "customer"), "ORDR", "CUST"
    )
    total, number = F.col("ORDR.ORDR_TOT"), F.col("ORDR.ORDR_ID").cast("long")
    return joined.groupBy(F.col("CUST.CUST_ID").alias("cust_id")).agg(
        F.max(total).alias("deepest"), arg_max(F.col("ORDR.ORDR_PRIO"), total, number).alias("prio_at_deepest")
    )


@query("top_report", """
    select cast(o_custkey as varchar) as cust_id, count(*) as n_orders, max(o_totalprice) as top_total
    from orders group by 1 order by n_orders desc, cust_id limit 20""")
def top_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty customers with most orders."""
    return (
        keyed(spark, sf_dir, "orders")
        .groupBy(F.col("CUST_ID").alias("cust_id"))
        .agg(F.count("*").alias("n_orders"), F.max("ORDR_TOT").alias("top_total"))
        .orderBy(F.desc("n_orders"), "cust_id")
        .limit(20)
    )


@query("uniqueness", f"""
    select count(*) as n_rows, count(distinct {_LINE_ID}) as n_ids, count(*) = count(distinct {_LINE_ID}) as is_unique
    from lineitem""")
def uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(spark, sf_dir, "lineitem").agg(
        F.count("*").alias("n_rows"), F.countDistinct("_id").alias("n_ids"),
        (F.count("*") == F.countDistinct("_id")).alias("is_unique"),
    )


@query("duplicate_keys", """
    select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by all having count(*) > 1""")
def duplicate_keys_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(dl.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# -------------------------------------------------------------------- merging deliveries


def _phases(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two phases of the order delivery: in the second, pending orders have a higher total."""
    orders = dl.table(spark, sf_dir, "orders")
    revised = orders.withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    )
    return keyed(spark, sf_dir, "orders", orders), keyed(spark, sf_dir, "orders", revised)


_REVISED = "cast(cast(case when o_orderstatus = 'P' then o_totalprice + 1 else o_totalprice end as decimal(18,2)) as double)"


@query("latest_revision", f"""
    select ordr_id, ordr_tot, ver from (
      select cast(o_orderkey as varchar) as ordr_id, o_totalprice as ordr_tot, 1 as ver from orders
      union by name
      select cast(o_orderkey as varchar) as ordr_id, {_REVISED} as ordr_tot, 2 as ver from orders)
    qualify row_number() over (partition by ordr_id order by ver desc) = 1""")
def latest_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _phases(spark, sf_dir)
    both = dedup.union_all(first.withColumn("ver", F.lit(1)), second.withColumn("ver", F.lit(2)))
    return dedup.latest_revision(both, ["ORDR_ID"], "ver").select(
        F.col("ORDR_ID").alias("ordr_id"), F.col("ORDR_TOT").alias("ordr_tot"), "ver"
    )


@query("dedup_identity", f"""
    select {_ORDER_ID} as _id, cast(o_orderkey as varchar) as ordr_id, o_totalprice as ordr_tot from orders""")
def dedup_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order over both phases, the lower total winning."""
    merged = dedup.dedup_identity(dedup.union_all(*_phases(spark, sf_dir)), order=["ORDR_TOT"])
    return merged.select("_id", F.col("ORDR_ID").alias("ordr_id"), F.col("ORDR_TOT").alias("ordr_tot"))


@query("dedup_content", f"""
    select cast(o_orderkey as varchar) as ordr_id, o_totalprice as ordr_tot from orders
    union select cast(o_orderkey as varchar), {_REVISED} from orders""")
def dedup_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = dedup.dedup_content(dedup.union_all(*_phases(spark, sf_dir)))
    return merged.select(F.col("ORDR_ID").alias("ordr_id"), F.col("ORDR_TOT").alias("ordr_tot"))


@query("union_by_name", """
    select cast(o_custkey as varchar) as cust_id, o_orderstatus as ordr_stat from orders
    union by name
    select cast(o_custkey as varchar) as cust_id, o_orderpriority as ordr_prio from orders""")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = keyed(spark, sf_dir, "orders")
    customer = F.col("CUST_ID").alias("cust_id")
    return dedup.union_by_name(
        orders.select(customer, F.col("ORDR_STAT").alias("ordr_stat")),
        orders.select(customer, F.col("ORDR_PRIO").alias("ordr_prio")),
    )


@query("union_all", """
    select cast(o_orderkey as varchar) as ordr_id, o_totalprice as ordr_tot from orders
    union all select cast(o_orderkey as varchar), o_totalprice from orders""")
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = keyed(spark, sf_dir, "orders").select(F.col("ORDR_ID").alias("ordr_id"), F.col("ORDR_TOT").alias("ordr_tot"))
    return dedup.union_all(orders, orders)


# ------------------------------------------------------------------------- dictionaries

_DERIVED = """
    with d as (
      select ['4.0.3', '4.0.4', '4.1', '4.1.1', '4.2'][p_size % 5 + 1] as edition, p_brand as "group", p_type as heading,
             case when max(p_size) >= 40 then 'KEY' else 'OTHER' end as status,
             case when min(p_size) < 10 then '2DP' else 'X' end as ags_type,
             case when count(*) > 3 then 'mm' end as unit, max(p_name) as description, min(p_partkey) as ordinal
      from part group by 1, 2, 3),
    e as (select *, case when length("group") > 7 then substr("group", 1, 7) end as parent,
                 case ags_type when '2DP' then 'DOUBLE' else 'VARCHAR' end as sql_type from d),
    u as (select * from e qualify row_number() over (partition by "group", heading order by edition desc) = 1)
    """
_DICTIONARY_COLUMNS = '"group", parent, heading, status, ags_type, sql_type, unit, description, ordinal'


def _derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dl.derived_dictionary(dl.table(spark, sf_dir, "part"))


@query("dictionary_union", f"{_DERIVED} select {_DICTIONARY_COLUMNS} from u")
def dictionary_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.read_dictionary(_derived(spark, sf_dir))


@query("dictionary_edition", f"{_DERIVED} select {_DICTIONARY_COLUMNS} from e where edition = '4.1.1'")
def dictionary_edition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.read_dictionary(_derived(spark, sf_dir), "4.1.1")


@query("edition_growth", f'{_DERIVED} select edition, count(distinct "group") as n_groups from e group by 1')
def edition_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.edition_growth(_derived(spark, sf_dir))


@query("relationships", f"""{_DERIVED},
    g as (select distinct "group" as child, parent from u where parent is not null),
    k as (select g.child, g.parent, string_agg(p.heading, ',' order by p.ordinal, p.heading) as shared_keys
          from g join u c on c."group" = g.child and c.status = 'KEY'
                 join u p on p."group" = g.parent and p.status = 'KEY' and p.heading = c.heading group by 1, 2)
    select g.child, g.parent, coalesce(shared_keys, '') as shared_keys from g left join k using (child, parent)""")
def relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.relationships(_derived(spark, sf_dir))


@query("ordered_concat", f"""{_DERIVED}
    select "group", string_agg(heading, ',' order by ordinal, heading) as headings from u group by 1""")
def ordered_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All headings of each group in one string, in dictionary order."""
    union = dictionary.read_dictionary(_derived(spark, sf_dir))
    return dictionary.ordered_concat(union, ["group"], ["ordinal"], "heading", "headings", ",")


_MINED = """
    with h as (
      select p_type as heading, case when length(p_brand) > 7 then 'mm' else '' end as unit,
             case when p_size < 20 then '2DP' when p_size < 35 then '0DP' else 'X' end as code from part),
    c as (select heading, unit, code, count(*) as n from h group by all),
    m as (select * from c qualify row_number() over (partition by heading order by n desc, code, unit) = 1)
    select 'PART' as "group", heading, nullif(unit, '') as unit, code as ags_type, n as n_uses from m
    union all select 'PART', 'PART_ID', null, 'ID', count(*) from part having count(*) > 0"""


@query("dictionary_mined", _MINED)
def dictionary_mined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary mined from deliveries, one per part, that disagree on units and types."""
    unit = F.when(F.length("p_brand") > 7, "mm").otherwise("")
    code = F.when(F.col("p_size") < 20, "2DP").when(F.col("p_size") < 35, "0DP").otherwise("X")
    texts = dl.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("doc_id"),
        F.format_string(
            '"GROUP","PART"\n"HEADING","PART_ID","%s"\n"UNIT","","%s"\n"TYPE","ID","%s"\n"DATA","%s","%s"',
            "p_type", unit, code, F.col("p_partkey").cast("string"), F.col("p_size").cast("string"),
        ).alias("content"),
    )
    headings = Delivery.from_texts(texts, dictionary=dl.fixture_dictionary(spark)).headings()
    return dictionary.mine_dictionary(headings)


# ---------------------------------------------------------------------------- catalogue

_RULES = """
    select cast(p_partkey as varchar) as rule, case when p_size >= 5 then p_name end as title, p_type as checks,
           case when p_size < 20 then 'error' when p_size < 30 then 'warning' when p_size < 40 then 'fyi'
                when p_size < 48 then 'mixed' else 'fatal' end as severity,
           p_retailprice > 950 as fixable,
           case when p_size <> 9 then replace(p_name, ' ', ',') end as observations
    from part"""


def _rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    severity = (
        F.when(size < 20, "error").when(size < 30, "warning").when(size < 40, "fyi").when(size < 48, "mixed").otherwise("fatal")
    )
    rule = F.struct(
        F.col("p_partkey").cast("string").alias("rule"), F.when(size >= 5, F.col("p_name")).otherwise("").alias("title"),
        F.col("p_type").alias("checks"), severity.alias("severity"), (F.col("p_retailprice") > 950).alias("fixable"),
        F.when(size != 9, F.split("p_name", " ")).otherwise(F.array()).alias("observations"),
    )
    documents = dl.table(spark, sf_dir, "part").select(F.to_json(F.struct(F.array(rule).alias("rules"))).alias("content"))
    return rules_table(documents)


@query("json_catalogue", _RULES)
def json_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(spark, sf_dir)


@query("catalogue_quality", f"""
    select count(*) as n_invalid from ({_RULES})
    where title is null or severity not in ('error', 'warning', 'fyi', 'mixed')""")
def catalogue_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invalid_rules(_rules(spark, sf_dir)).agg(F.count("*").alias("n_invalid"))
