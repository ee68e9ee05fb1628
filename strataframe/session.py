"""Session settings and the small helpers every module shares."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.errors import DeliveryError

# A lookup side is broadcast only after it has been found to be at most this many rows and bytes of text.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024

# Settings the jobs rely on; every one is a plain Spark setting a cluster may override.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A generated method beyond 8000 bytes of bytecode is never compiled by the JVM's JIT. With this
    # limit Spark evaluates such a stage operator by operator, in small methods that are.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: int | str = "*", app: str = "strataframe", **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks. Clusters bring their own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **SESSION_DEFAULTS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    use_own_scratch(spark)
    return spark


# Where a local session without ``spark.checkpoint.dir`` keeps intermediate files.
OWN_SCRATCH = "strataframe.scratch.dir"


def use_own_scratch(spark: SparkSession) -> str:
    """Give a local session a folder of its own, once. Its driver and executors are one process on one machine."""
    folder = spark.conf.get(OWN_SCRATCH, None)
    if folder is None:
        folder = tempfile.mkdtemp(prefix="strataframe-")
        spark.conf.set(OWN_SCRATCH, folder)
    return folder


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small table of constants. Filters on it are answered while planning, without a job."""
    names = [entry.split()[0] for entry in schema.split(",")]
    columns = list(zip(*rows)) or [()] * len(names)
    return spark.createDataFrame(pd.DataFrame(dict(zip(names, map(list, columns))), dtype=object), schema)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate files, on storage every executor can reach.

    The cluster names that storage in ``spark.checkpoint.dir``. Only a local session may do without: it is
    given a folder of its own (:func:`use_own_scratch`).
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise DeliveryError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = use_own_scratch(spark)
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that later jobs never recompute it."""
    spark = df.sparkSession
    path = scratch_dir(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS, n_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast when it is measured to be small; otherwise leave the choice to Spark.

    Rows and the bytes of their values as text are measured in one job, which stops at ``limit + 1``
    rows, so it stays cheap however large ``df`` is.
    """
    text = F.octet_length(F.to_json(F.struct(*df.columns)))
    found = df.limit(limit + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(text), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if found.n <= limit and found["bytes"] <= n_bytes else df
