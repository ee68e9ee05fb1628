"""Aggregates that Spark has no single function for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def arg_max(value: Column, by: Column, *ties: Column) -> Column:
    """The non-NULL ``value`` at the highest ``by``; among equals, at the highest ``ties``."""
    order = F.struct(by, *ties) if ties else by
    return F.max_by(value, F.when(value.isNotNull() & by.isNotNull(), order))


def is_unique(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether no two rows agree in all of ``columns``. Stops at the first repeated key it finds."""
    return duplicate_keys(df, columns).limit(1).count() == 0


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every key that occurs more than once, with its number of rows."""
    return df.groupBy(*columns).agg(F.count("*").alias("n_rows")).where("n_rows > 1")
