"""Reading the tables of the registered queries, and small plan helpers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.session import cut_lineage, scratch_dir

__all__ = ["documents", "table", "vocabulary", "partitions", "cut_lineage", "scratch_dir", "over_batches", "text_hash", "unused"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The place of a public vocabulary file on this machine; executors have it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def over_batches(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Run a function of one Arrow batch over all batches of ``df``."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)
        give_back_memory()

    return df.mapInArrow(run, schema)


def give_back_memory() -> None:
    """Return what a worker has freed to the machine, as it stays alive for the tasks of later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # absent where the C library is another
    if trim is not None:
        trim(0)


def unused(columns, name: str) -> str:
    """A column name that none of ``columns`` has (case aside)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_hash(column: str = "text"):
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))
