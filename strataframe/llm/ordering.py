"""Neighbours in the order of an id, without a sort of all rows in one task."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.llm.tables import partitions

BLOCKS_PER_PARTITION = 4
_LAST = -(1 << 63)  # the place of a row without key


def descending_blocks(df: DataFrame, key: str, n_blocks: int | None = None) -> DataFrame:
    """``df`` with ``block`` and ``guest``, in partitions of whole blocks sorted by descending ``key``.

    Blocks are ranges of the key of about equal size, numbered along the order. Behind its own rows
    (``guest`` 0) each block holds a copy of the rows with the next block's largest key (``guest`` 1),
    the last block those of the first, so the successor of every row is in its block. The rows are
    shuffled once; only one boundary per block reaches the driver. NULL keys come last. Rows of one
    key are in one block, in the order of their other columns.
    """
    spark = df.sparkSession
    n_blocks = n_blocks or BLOCKS_PER_PARTITION * partitions(spark)
    place = F.coalesce(F.col(key), F.lit(_LAST)).cast("long")
    cuts = df.select(
        F.percentile_approx(F.col(key), [i / n_blocks for i in range(1, n_blocks)], 10 * n_blocks).alias("cuts")
    ).first().cuts
    bounds = np.unique(np.asarray(cuts or [], np.int64))

    @F.pandas_udf("int")
    def block_of(keys: pd.Series) -> pd.Series:
        return pd.Series((len(bounds) - np.searchsorted(bounds, keys.to_numpy(), "left")).astype(np.int32))

    tops = {r.block: r.top for r in df.select(place.alias("at")).groupBy(block_of("at").alias("block")).agg(F.max("at").alias("top")).collect()}
    used = sorted(tops)
    # The rows that open a block also go to the end of the block before it.
    before = {tops[b]: used[i - 1] for i, b in enumerate(used)}

    @F.pandas_udf("int")
    def also_in(keys: pd.Series) -> pd.Series:
        return keys.map(before).fillna(-1).astype("int32")

    own = F.struct(block_of(place).alias("block"), F.lit(0).alias("guest"))
    guest = F.struct(also_in(place).alias("block"), F.lit(1).alias("guest"))
    placed = df.withColumn("_own", own).withColumn("_guest", guest).select(
        F.explode(F.when(F.col("_guest.block") < 0, F.array("_own")).otherwise(F.array("_own", "_guest"))).alias("_at"),
        *df.columns,
    ).select("_at.block", "_at.guest", *df.columns)
    return placed.repartition(partitions(spark), "block").sortWithinPartitions(
        "block", "guest", F.col(key).desc_nulls_last(), *[c for c in df.columns if c != key]
    )
