"""Merging deliveries: unions, and what counts as the same row.

``_id`` says *which thing* a row describes, ``_content_hash`` says *what it says about it*.
Every function here keeps at most one row per key on the map side before the shuffle, so a key
that occurs in a third of all rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Columns made by hashing others.
HASHED = ("_id", "_parent_id", "_content_hash")


def union_all(*tables: DataFrame) -> DataFrame:
    """All rows of all tables, columns matched by name, missing ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def union_by_name(*tables: DataFrame) -> DataFrame:
    """:func:`union_all` without duplicate rows."""
    return union_all(*tables).distinct()


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order."""
    ranked = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def _tie(df: DataFrame) -> Column:
    """A hash that decides between rows without any key having to be made for it."""
    return F.xxhash64(*([c for c in df.columns if c not in HASHED] or df.columns))


def _own_key() -> Column:
    """A key no other row has, for rows that share theirs with nobody."""
    return F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))


def dedup_identity(df: DataFrame, order: Sequence[Column | str] | None = None) -> DataFrame:
    """One row per ``_id``: the first in ``order``, or without ``order`` that with the smallest content hash.

    Rows that tie in ``order`` fall to the smallest hash of their cells. Rows without an id, such as those of a
    group outside the dictionary, have no identity to share; they all stay. The input is read once.
    """
    ties = [*order, _tie(df)] if order else ["_content_hash"]
    keyed = df.withColumn("_key", F.coalesce(F.col("_id"), _own_key()))
    return first_per_key(keyed, ["_key"], ties).drop("_key")


def dedup_content(df: DataFrame) -> DataFrame:
    """One row per distinct content; a revised row is kept next to the original."""
    return df.dropDuplicates(["_content_hash"])


def latest_revision(df: DataFrame, key: Sequence[str], version: str, ties: Sequence[str] = ()) -> DataFrame:
    """The row with the highest ``version`` of each key; ties fall to the smallest ``ties`` values, then to
    the smallest hash of the cells.

    A row with a NULL in its key is nobody's revision, and stays. The input is read once.
    """
    keyed = reduce(Column.__and__, [F.col(name).isNotNull() for name in key])
    alone = df.withColumn("_alone", F.when(~keyed, _own_key()))
    return first_per_key(alone, [*key, "_alone"], [F.desc(version), *ties, _tie(df)]).drop("_alone")
