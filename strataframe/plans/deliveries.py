"""Deliveries and dictionaries that Spark derives from the relational test tables.

The tables have no delivery files of their own, so the registered queries first write their rows
as delivery text. Texts hold at most ``ROWS_PER_TEXT`` rows of one scan task each, so no key of the
data decides how large a text gets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions import text as tx
from strataframe.operators.dictionary import DICTIONARY_SCHEMA
from strataframe.session import local_table, scratch_dir

ROWS_PER_TEXT = 500
EDITION = "4.2"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: str) -> str:
    """Two decimal places, as text."""
    return f"cast(cast({column} as decimal(18,2)) as string)"


def text(column: str) -> str:
    return f"cast({column} as string)"


@dataclass(frozen=True)
class Section:
    """How the rows of a table appear as one group: (heading, unit, type, SQL value) per column."""

    group: str
    headings: Sequence[tuple[str, str, str, str]]

    @property
    def header(self) -> str:
        names, units, codes = ([h[i] for h in self.headings] for i in range(3))
        records = [("GROUP", [self.group]), ("HEADING", names), ("UNIT", units), ("TYPE", codes)]
        return "\n".join(",".join(f'"{cell}"' for cell in [tag, *cells]) for tag, cells in records)

    @property
    def columns(self) -> list[tuple[str, str, str]]:
        return [(name, unit, code) for name, unit, code, _ in self.headings]

    def data_line(self) -> str:
        return tx.record("DATA", *[value for _, _, _, value in self.headings])

    def raw(self, df: DataFrame) -> DataFrame:
        """The table's rows as raw text columns named after the headings."""
        return df.selectExpr(*[f"{value} as {name}" for name, _, _, value in self.headings])


def delivery_texts(df: DataFrame, *sections: Section, spread: bool = True) -> DataFrame:
    """``(doc_id, content)``: every text has one section per entry, all over the same rows.

    The rows of a text follow each other in one scan task, which joins them. ``spread`` then deals the texts over
    tasks; texts that are only written go without.
    """
    names = [f"s{i}" for i in range(len(sections))]
    lines = df.selectExpr(
        f"monotonically_increasing_id() div {ROWS_PER_TEXT} as doc_id",
        *[f"{section.data_line()} as {name}" for name, section in zip(names, sections)],
    )
    texts = lines.mapInArrow(_joined_lines([section.header for section in sections]), "doc_id bigint, content string")
    return texts.repartition("doc_id") if spread else texts


def _joined_lines(headers: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow function: lines in the order of their texts -> texts. A line is never NULL."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_id, held = None, []
        for batch in batches:
            count = batch.num_rows
            if not count:
                continue
            ids, done = batch.column(0).to_numpy(), []
            first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            bounds = pa.array(np.append(first, count).astype(np.int32))
            runs = [pc.binary_join(pa.ListArray.from_arrays(bounds, batch.column(i + 1)), "\n").to_pylist() for i in range(len(headers))]
            for doc_id, *lines in zip(ids[first].tolist(), *runs):
                if doc_id != open_id:
                    if open_id is not None:
                        done.append((open_id, content(held)))
                    open_id, held = doc_id, [[] for _ in headers]
                for part, line in zip(held, lines):
                    part.append(line)
            if done:
                yield table_of(done)
        if open_id is not None:
            yield table_of([(open_id, content(held))])

    def content(held: list[list[str]]) -> str:
        return "\n\n".join("\n".join([header, *lines]) for header, lines in zip(headers, held))

    def table_of(done: list[tuple[int, str]]) -> pa.RecordBatch:
        ids, texts = zip(*done)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "content"])

    return join


def write_deliveries(texts: DataFrame, *partition_by: str) -> str:
    """Write delivery texts as files; each row's lines follow those of the row before."""
    path = scratch_dir(texts.sparkSession, "deliveries")
    texts.select(*partition_by, "content").write.partitionBy(*partition_by).text(path)
    return path


# How the test tables are declared as groups.
def customer_section() -> Section:
    return Section("CUST", [
        ("CUST_ID", "", "ID", text("c_custkey")), ("CUST_NAME", "", "X", "c_name"),
        ("CUST_BAL", "gbp", "2DP", money("c_acctbal")), ("CUST_SEG", "", "PA", "c_mktsegment"),
        ("NATN_ID", "", "ID", text("c_nationkey")),
    ])


def nation_section() -> Section:
    return Section("NATN", [
        ("NATN_ID", "", "ID", text("n_nationkey")), ("NATN_NAME", "", "X", "n_name"),
        ("REGN_ID", "", "ID", text("n_regionkey")),
    ])


def region_section() -> Section:
    return Section("REGN", [("REGN_ID", "", "ID", text("r_regionkey")), ("REGN_NAME", "", "X", "r_name")])


def order_section() -> Section:
    return Section("ORDR", [
        ("ORDR_ID", "", "ID", text("o_orderkey")), ("ORDR_STAT", "", "PA", "o_orderstatus"),
        ("ORDR_TOT", "gbp", "2DP", money("o_totalprice")),
        ("ORDR_PRIO", "", "X", "o_orderpriority"),
        ("ORDR_DATE", "yyyy-mm-dd", "DT", "date_format(o_orderdate, 'yyyy-MM-dd')"),
        ("CUST_ID", "", "ID", text("o_custkey")),
    ])


def line_section() -> Section:
    return Section("LINE", [
        ("ORDR_ID", "", "ID", text("l_orderkey")), ("LINE_NO", "", "0DP", text("l_linenumber")),
        ("PART_ID", "", "ID", text("l_partkey")), ("SUPP_ID", "", "ID", text("l_suppkey")),
        ("LINE_QTY", "", "2DP", money("l_quantity")), ("LINE_AMT", "gbp", "2DP", money("l_extendedprice")),
        ("LINE_FLAG", "", "PA", "l_returnflag"),
    ])


# Group, parent, KEY headings, other headings of the groups above.
FIXTURE_GROUPS = [
    ("REGN", None, ["REGN_ID"], ["REGN_NAME"]),
    ("NATN", "REGN", ["NATN_ID"], ["NATN_NAME", "REGN_ID"]),
    ("CUST", "NATN", ["CUST_ID"], ["CUST_NAME", "CUST_BAL", "CUST_SEG", "NATN_ID"]),
    ("ORDR", "CUST", ["ORDR_ID"], ["ORDR_STAT", "ORDR_TOT", "ORDR_PRIO", "ORDR_DATE", "CUST_ID"]),
    ("LINE", "ORDR", ["ORDR_ID", "LINE_NO", "PART_ID", "SUPP_ID"], ["LINE_QTY", "LINE_AMT", "LINE_FLAG"]),
    ("TURN", None, ["CONV_ID", "TURN_NO"], ["TURN_ROLE", "TURN_TEXT"]),
    ("DOCS", None, ["DOCS_ID"], ["DOCS_LANG", "DOCS_TEXT"]),
    ("EVNT", None, ["EVNT_ID"], ["EVNT_VAL", "EVNT_USER", "EVNT_OK", "EVNT_KIND"]),
    ("PART", None, ["PART_ID"], ["PART_NAME"]),
]


def fixture_dictionary(spark: SparkSession) -> DataFrame:
    rows = [
        (EDITION, group, parent, heading, "KEY" if heading in keys else "OTHER", "", "", "", ordinal)
        for group, parent, keys, others in FIXTURE_GROUPS
        for ordinal, heading in enumerate([*keys, *others])
    ]
    return local_table(spark, rows, DICTIONARY_SCHEMA)


def derived_dictionary(part: DataFrame) -> DataFrame:
    """A dictionary in five editions mined from ``part``: brands are groups, types are headings.

    ``Brand#17`` is a child of ``Brand#1``; a heading is a KEY when the parts behind it are large.
    """
    edition = F.element_at(
        F.array(*[F.lit(e) for e in ("4.0.3", "4.0.4", "4.1", "4.1.1", "4.2")]), (F.col("p_size") % 5 + 1).cast("int")
    )
    return part.groupBy(edition.alias("edition"), F.col("p_brand").alias("group"), F.col("p_type").alias("heading")).agg(
        F.when(F.max("p_size") >= 40, "KEY").otherwise("OTHER").alias("status"),
        F.when(F.min("p_size") < 10, "2DP").otherwise("X").alias("ags_type"),
        F.when(F.count("*") > 3, "mm").otherwise("").alias("unit"),
        F.max("p_name").alias("description"),
        F.min("p_partkey").alias("ordinal"),
    ).select(
        "edition", "group",
        F.when(F.length("group") > 7, F.substring("group", 1, 7)).alias("parent"),
        "heading", "status", "ags_type", "unit", "description", "ordinal",
    )
