"""The dictionary of groups and headings, its editions, its graph, and mining one from deliveries.

A dictionary is an ordinary table ``edition, group, parent, heading, status, ags_type, unit,
description, ordinal`` that the user supplies (Parquet, CSV, JSON, ...).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from strataframe.errors import DeliveryError
from strataframe.functions.typing import sql_type_sql
from strataframe.session import local_table

# The published editions, oldest first.
EDITIONS = ("4.0.3", "4.0.4", "4.1", "4.1.1", "4.2")
# How a KEY heading's status starts, and the status of a heading not in the dictionary.
KEY_STATUS, UNKNOWN_STATUS = "KEY", "OTHER"

DICTIONARY_SCHEMA = (
    "edition string, group string, parent string, heading string, status string, "
    "ags_type string, unit string, description string, ordinal long"
)
DICTIONARY_COLUMNS = [
    "group", "parent", "heading", "status", "ags_type", "sql_type", "unit", "description", "ordinal",
]

# A starter dictionary for the groups used in the documentation and tests.
# group, parent, then (heading, status, type, unit, description) entries.
SEED_GROUPS = [
    ("PROJ", None, [
        ("PROJ_ID", "KEY+REQUIRED", "ID", "", "Project identifier"),
        ("PROJ_NAME", "OTHER", "X", "", "Project title"),
    ]),
    ("LOCA", "PROJ", [
        ("LOCA_ID", "KEY+REQUIRED", "ID", "", "Location identifier"),
        ("LOCA_TYPE", "OTHER", "PA", "", "Type of activity"),
        ("LOCA_GL", "OTHER", "2DP", "m", "Ground level relative to datum"),
        ("LOCA_NATE", "OTHER", "2DP", "m", "National grid easting"),
        ("LOCA_NATN", "OTHER", "2DP", "m", "National grid northing"),
    ]),
    ("SAMP", "LOCA", [
        ("LOCA_ID", "KEY+REQUIRED", "ID", "", "Location identifier"),
        ("SAMP_TOP", "KEY+REQUIRED", "2DP", "m", "Depth to top of sample"),
        ("SAMP_REF", "KEY", "X", "", "Sample reference"),
        ("SAMP_TYPE", "KEY+REQUIRED", "PA", "", "Sample type"),
        ("SAMP_ID", "KEY", "ID", "", "Sample unique identifier"),
    ]),
    ("LLPL", "SAMP", [
        ("LOCA_ID", "KEY+REQUIRED", "ID", "", "Location identifier"),
        ("SAMP_TOP", "KEY+REQUIRED", "2DP", "m", "Depth to top of sample"),
        ("SAMP_REF", "KEY", "X", "", "Sample reference"),
        ("SAMP_TYPE", "KEY+REQUIRED", "PA", "", "Sample type"),
        ("SAMP_ID", "KEY", "ID", "", "Sample unique identifier"),
        ("LLPL_LL", "OTHER", "0DP", "%", "Liquid limit"),
        ("LLPL_PI", "OTHER", "0DP", "%", "Plasticity index"),
    ]),
    ("TRAN", "PROJ", [
        ("TRAN_ISNO", "KEY+REQUIRED", "X", "", "Issue sequence reference"),
        ("TRAN_DATE", "REQUIRED", "DT", "yyyy-mm-dd", "Date of production"),
        ("TRAN_AGS", "REQUIRED", "X", "", "Edition reference"),
    ]),
    ("UNIT", None, [
        ("UNIT_UNIT", "KEY+REQUIRED", "X", "", "Unit"),
        ("UNIT_DESC", "REQUIRED", "X", "", "Description"),
    ]),
    ("TYPE", None, [
        ("TYPE_TYPE", "KEY+REQUIRED", "X", "", "Type code"),
        ("TYPE_DESC", "REQUIRED", "X", "", "Description"),
    ]),
    ("DICT", None, [
        ("DICT_GRP", "KEY", "X", "", "Group name"),
        ("DICT_HDNG", "KEY", "X", "", "Heading name"),
    ]),
]


def seed_dictionary(spark: SparkSession) -> DataFrame:
    """The starter dictionary, the same in every edition."""
    rows = [
        (edition, group, parent, heading, status, code, unit, description, ordinal)
        for edition in EDITIONS
        for group, parent, headings in SEED_GROUPS
        for ordinal, (heading, status, code, unit, description) in enumerate(headings)
    ]
    return local_table(spark, rows, DICTIONARY_SCHEMA)


def edition_rank(edition: Column) -> Column:
    """Sort key of an edition name: its numbers, compared left to right."""
    return F.transform(F.split(edition, r"\."), lambda part: part.try_cast("int"))


def _presented(dictionary: DataFrame) -> DataFrame:
    return dictionary.selectExpr(
        "group",
        "nullif(parent, '') as parent",
        "heading",
        "coalesce(status, '') as status",
        "coalesce(ags_type, '') as ags_type",
        f"{sql_type_sql("coalesce(ags_type, '')")} as sql_type",
        "nullif(unit, '') as unit",
        "nullif(description, '') as description",
        "cast(ordinal as long) as ordinal",
    )


def edition_dictionary(dictionary: DataFrame, edition: str) -> DataFrame:
    """One edition's groups and headings. An edition outside the published set is an error."""
    wanted = edition.strip()
    if wanted not in EDITIONS:
        raise DeliveryError(f"unknown edition '{wanted}'; expected one of {', '.join(EDITIONS)}")
    return _presented(dictionary.where(F.col("edition") == wanted))


def union_dictionary(dictionary: DataFrame) -> DataFrame:
    """All editions in one: the newest edition that has a heading describes it.

    Spark keeps one row per key on the map side before the shuffle (``row_number() = 1``).
    """
    newest = Window.partitionBy("group", "heading").orderBy(F.desc(edition_rank(F.col("edition"))))
    return _presented(
        dictionary.withColumn("_age", F.row_number().over(newest)).where("_age = 1").drop("_age")
    )


def read_dictionary(dictionary: DataFrame, edition: str | None = None) -> DataFrame:
    return union_dictionary(dictionary) if edition is None else edition_dictionary(dictionary, edition)


def edition_growth(dictionary: DataFrame) -> DataFrame:
    """Number of groups in each edition."""
    return dictionary.groupBy("edition").agg(F.countDistinct("group").alias("n_groups"))


def group_parents(dictionary: DataFrame) -> DataFrame:
    """``(group, parent)``: one parent per group, the one in the newest edition that lists the group.

    A group without parent in that edition is not in the result. If an edition gives several, the
    smallest counts.
    """
    edition = edition_rank(F.col("edition")) if "edition" in dictionary.columns else F.array(F.lit(0))
    parent = F.expr("nullif(parent, '')")
    per_edition = dictionary.groupBy("group", F.coalesce(edition, F.array(F.lit(-1))).alias("edition")).agg(F.min(parent).alias("parent"))
    newest = per_edition.groupBy("group").agg(F.max_by("parent", "edition").alias("parent"))
    return newest.where("parent is not null")


def relationships(dictionary: DataFrame) -> DataFrame:
    """``(child, parent, shared_keys)`` for every group that has a parent.

    ``shared_keys`` lists the parent's KEY headings that are KEY headings of the child as well, in
    the parent's order; it is empty when none is, and the link cannot be followed in the data.
    """
    headings = union_dictionary(dictionary) if "edition" in dictionary.columns else dictionary
    keyed = headings.where(F.col("status").startswith(KEY_STATUS))
    edges = group_parents(dictionary).withColumnRenamed("group", "child")
    child_keys = keyed.select(F.col("group").alias("child"), "heading")
    parent_keys = keyed.select(F.col("group").alias("parent"), "heading", "ordinal")
    shared = edges.join(child_keys, "child").join(parent_keys, ["parent", "heading"])
    listed = ordered_concat(shared, ["child", "parent"], ["ordinal"], "heading", "shared_keys", ",")
    return edges.join(listed, ["child", "parent"], "left").select(
        "child", "parent", F.coalesce("shared_keys", F.lit("")).alias("shared_keys")
    )


def ordered_concat(
    df: DataFrame, group_by: list[str], order: list[str], value: str, name: str, separator: str
) -> DataFrame:
    """Ordered string aggregation: the values of each group in order, joined into one string.

    The result is one string per group, so it suits groups that fit a cell, such as key lists.
    """
    entries = F.array_sort(F.collect_list(F.struct(*order, F.col(value).cast("string").alias("v"))))
    joined = F.array_join(F.transform(entries, lambda entry: entry["v"]), separator)
    return df.groupBy(*group_by).agg(joined.alias(name))


# ------------------------------------------------------------------- plan-time lookups


@dataclass(frozen=True)
class GroupSpec:
    """What the keys of a group's rows are made of."""

    group: str
    keys: tuple[str, ...] = ()
    parent: str | None = None
    parent_keys: tuple[str, ...] = field(default=())
    known: bool = True


def newest_rows(dictionary: DataFrame, group: str) -> list[Row]:
    """The dictionary rows of one group, from the newest edition that has each heading."""
    edition = "edition" if "edition" in dictionary.columns else "'' as edition"
    rows = dictionary.where(F.col("group") == group).selectExpr("parent", "heading", "status", "ordinal", edition)

    def age(row: Row) -> list[int]:
        return [int(part) if part.isdigit() else 0 for part in (row.edition or "").split(".")]

    return list({row.heading: row for row in sorted(rows.collect(), key=age)}.values())


def newest_parent(dictionary: DataFrame, group: str) -> str | None:
    """The parent of one group by the rule of :func:`group_parents`, from that group's rows."""
    rank = F.coalesce(edition_rank(F.col("edition")), F.array(F.lit(-1))) if "edition" in dictionary.columns else F.array(F.lit(0))
    rows = dictionary.where(F.col("group") == group).select("parent", rank.alias("rank")).collect()
    newest = max(([-1 if n is None else n for n in row["rank"]] for row in rows), default=None)
    return min((row.parent for row in rows if row.parent and [-1 if n is None else n for n in row["rank"]] == newest), default=None)


def group_spec(dictionary: DataFrame, group: str, allow_custom: bool = False) -> GroupSpec:
    """Look a group and its parent up. Reads the dictionary rows of these two groups only."""
    own = newest_rows(dictionary, group)
    if not own:
        if allow_custom:
            return GroupSpec(group, known=False)
        raise DeliveryError(f"group '{group}' is not in the dictionary; pass allow_custom=True to read it without keys")
    parent = newest_parent(dictionary, group)
    above = newest_rows(dictionary, parent) if parent else []

    def key_headings(rows) -> tuple[str, ...]:
        wanted = [row for row in rows if (row.status or "").startswith(KEY_STATUS)]
        return tuple(row.heading for row in sorted(wanted, key=lambda row: (row.ordinal is None, row.ordinal or 0)))

    return GroupSpec(group, key_headings(own), parent, key_headings(above))


# ------------------------------------------------------------------------------- mining


def mine_dictionary(headings: DataFrame, declared: DataFrame | None = None) -> DataFrame:
    """The unit and type most used for each heading over all deliveries.

    ``headings`` is the output of :func:`strataframe.operators.structure.headings_profile`.
    Ties go to the smaller type, then the smaller unit. ``declared`` holds the deliveries' own
    DICT rows (columns ``DICT_GRP``, ``DICT_HDNG``); pairs declared there are added and marked.
    """
    uses = headings.groupBy(
        "group", "heading", F.coalesce("unit", F.lit("")).alias("unit"), "ags_type"
    ).agg(F.count("*").alias("n_uses"))
    most_used = Window.partitionBy("group", "heading").orderBy(F.desc("n_uses"), "ags_type", "unit")
    mined = (
        uses.withColumn("_rank", F.row_number().over(most_used))
        .where("_rank = 1")
        .select("group", "heading", F.when(F.col("unit") != "", F.col("unit")).alias("unit"), "ags_type", "n_uses")
    )
    if declared is None:
        return mined
    pairs = declared.where("DICT_HDNG is not null").select(
        F.col("DICT_GRP").alias("group"), F.col("DICT_HDNG").alias("heading"), F.lit(True).alias("declared")
    ).distinct()
    return mined.join(pairs, ["group", "heading"], "full").select(
        "group", "heading", "unit", "ags_type",
        F.coalesce("n_uses", F.lit(0).cast("long")).alias("n_uses"),
        F.coalesce("declared", F.lit(False)).alias("declared"),
    )
