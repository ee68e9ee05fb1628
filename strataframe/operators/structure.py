"""What a delivery contains: its groups, its headings, its row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.functions.typing import sql_type_sql
from strataframe.operators.dictionary import KEY_STATUS, UNKNOWN_STATUS, group_parents, union_dictionary
from strataframe.session import broadcast_if_small


def _dictionary_rows(dictionary: DataFrame) -> DataFrame:
    return union_dictionary(dictionary) if "edition" in dictionary.columns else dictionary


def groups_profile(heads: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``(source, group, n_rows, n_headings, parent)`` in file order, one row per file and group.

    A group declared in several sections of a file counts once, with all its rows.
    """
    parents = group_parents(dictionary)
    per_group = heads.groupBy("source", "group").agg(
        F.sum("n_data").alias("n_rows"),
        F.max(F.size("headings")).cast("long").alias("n_headings"),
        F.min("pos").alias("first"),
    )
    return (
        per_group.join(broadcast_if_small(parents), "group", "left")
        .orderBy("source", "first")
        .select("source", "group", "n_rows", "n_headings", "parent")
    )


def headings_profile(heads: DataFrame, dictionary: DataFrame) -> DataFrame:
    """One row per file, group and heading, with the file's unit and type and the KEY status, in file order.

    If a group is declared more than once in a file, the first section with the heading counts.
    """
    status = _dictionary_rows(dictionary).select("group", "heading", F.col("status").alias("known_status"))
    cell = F.struct(
        F.coalesce(F.get("units", F.col("ordinal")), F.lit("")).alias("unit"),
        F.coalesce(F.get("types", F.col("ordinal")), F.lit("")).alias("ags_type"),
        F.col("ordinal").cast("long").alias("ordinal"),
    )
    listed = heads.select("source", "group", "pos", "units", "types", F.posexplode("headings").alias("ordinal", "heading"))
    first = listed.groupBy("source", "group", "heading").agg(
        F.min_by(cell, F.struct("pos", "ordinal")).alias("cell"), F.min(F.struct("pos", "ordinal")).alias("first")
    )
    joined = first.join(broadcast_if_small(status), ["group", "heading"], "left")
    return joined.orderBy("source", "first").select(
        "source",
        "group",
        "heading",
        F.when(F.col("cell.unit") != "", F.col("cell.unit")).alias("unit"),
        F.col("cell.ags_type").alias("ags_type"),
        F.expr(sql_type_sql("cell.ags_type")).alias("sql_type"),
        F.coalesce("known_status", F.lit(UNKNOWN_STATUS)).alias("status"),
        F.coalesce(F.col("known_status").startswith(KEY_STATUS), F.lit(False)).alias("is_key"),
        F.col("cell.ordinal").alias("ordinal"),
    )


def row_counts(heads: DataFrame) -> DataFrame:
    """Rows of every group over all deliveries, from one scan."""
    return heads.groupBy("group").agg(F.sum("n_data").alias("n_rows"))
