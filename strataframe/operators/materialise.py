"""Writing deliveries out: one bucketed, keyed table per group, or a plain export of one group."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.operators.dictionary import group_spec
from strataframe.operators.group_table import discover_layouts, group_table
from strataframe.session import broadcast_if_small, cut_lineage, local_table, scratch_dir
from strataframe.sources.delivery import Delivery
from strataframe.sources.pieces import SECTION_COLUMNS

REPORT_SCHEMA = "seq long, group string, table string, kind string, n_rows long, layout string"
# The three kinds of step, in the order they are taken for a group.
TABLE, ID_INDEX, PARENT_INDEX = "table", "id_index", "parent_index"
# How a table is laid out: in buckets, and with a side table for the keys too hot for one.
BUCKETS, HOT = "buckets", "hot"
HOT_SUFFIX = "_hot"
# A key with more than this many average buckets' worth of rows is too hot for one bucket.
HOT_BUCKETS = 4
# Groups that are written at the same time, so that the tail of one's jobs does not leave the cluster idle.
AT_ONCE = 4
# Delivery text that goes into one bucket.
BUCKET_BYTES = 256 * 1024 * 1024


def export_group(table: DataFrame, path: str, mode: str = "error") -> None:
    """One typed group as Parquet."""
    table.write.mode(mode).parquet(path)


def _write_bucketed(df: DataFrame, key: str, buckets: int, name: str) -> None:
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(name)
    )


def _buckets_for(n_bytes: int) -> int:
    """A power of two, so that tables of different size still join bucket by bucket."""
    return 1 << max(0, (n_bytes // BUCKET_BYTES).bit_length())


def hot_keys(df: DataFrame, key: str, buckets: int, n_rows: int) -> DataFrame:
    """``(_hot, n)``: the keys with more than ``HOT_BUCKETS`` average buckets' worth of rows; NULL counts as one.

    There are at most ``buckets / HOT_BUCKETS`` of them, so they may be broadcast. Rows are combined per key before the shuffle.
    """
    counts = df.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > HOT_BUCKETS * max(n_rows // buckets, 1))


def _write_laid_out(df: DataFrame, key: str, buckets: int, name: str, n_rows: int) -> str:
    """Write a table by ``key`` and say how.

    The rows of ordinary keys are bucketed, so that child and parent join without a shuffle. Keys that would overfill
    a bucket (or the rows without any) go to a side table of their own, ``<name>_hot``, range-sorted into even files.
    """
    spark = df.sparkSession
    spark.sql(f"drop table if exists {name}{HOT_SUFFIX}")
    hot = cut_lineage(hot_keys(df, key, buckets, n_rows)) if buckets > 1 else None
    if hot is None or hot.isEmpty():
        _write_bucketed(df, key, buckets, name)
        return BUCKETS
    same = F.col(key).eqNullSafe(F.col("_hot"))
    _write_bucketed(df.join(F.broadcast(hot), same, "left_anti"), key, buckets, name)
    side = df.join(F.broadcast(hot), same, "left_semi")
    by = [F.col(key), F.xxhash64(*df.columns)]
    side.repartitionByRange(buckets, *by).sortWithinPartitions(key).write.mode("overwrite").format("parquet").saveAsTable(f"{name}{HOT_SUFFIX}")
    return f"{BUCKETS}+{HOT}"


def stage_by_group(delivery: Delivery) -> DataFrame:
    """All sections written once, partitioned by group, so that each group is then read alone.

    The rebalance hint gives files of even size: a group that is most of the data is split over
    many tasks, small groups share one.
    """
    path = scratch_dir(delivery.spark, "stage")
    sections = delivery.bodies()
    sections.hint("rebalance", "group").write.partitionBy("group").parquet(path)
    staged = delivery.spark.read.schema(sections.schema).option("basePath", path).parquet(path)
    return staged.select(*SECTION_COLUMNS)


def materialise(
    delivery: Delivery,
    database: str | None = None,
    prefix: str = "ags_",
    buckets: int | None = None,
    allow_custom: bool = False,
) -> DataFrame:
    """Write every group of the delivery and report the steps taken.

    For each group in file order: the table itself by ``_id``, and if the group has a parent, a copy by
    ``_parent_id``. ``buckets`` sets one number of buckets for all; without it each group's follows
    from its text. Returns ``(seq, group, table, kind, n_rows, layout)``; ``layout`` is ``buckets``, or
    ``buckets+hot`` where keys that would overfill their bucket are in the side table ``<table>_hot``. Read such
    tables with :func:`read_table` and :func:`join_materialised`.
    """
    spark = delivery.spark
    staged = Delivery(spark, delivery.dictionary, stage_by_group(delivery))
    # One pass over the staged headers finds all layouts, another all sizes.
    layouts = discover_layouts(staged.heads())
    measured = staged.bodies().groupBy("group").agg(F.sum(F.octet_length("body")).alias("bytes"), F.sum("n_data").alias("rows"))
    sizes = {r.group: (r.bytes or 0, r.rows or 0) for r in measured.collect()}

    def write_group(code: str) -> Iterator[tuple]:
        spec = group_spec(delivery.dictionary, code, allow_custom)
        n_bytes, expected = sizes.get(code, (0, 0))
        count = buckets or _buckets_for(n_bytes)
        table = f"{database + '.' if database else ''}{prefix}{code.lower()}"
        rows = group_table(staged.bodies(code), layouts[code], spec)
        # An id repeats where a group has no keys, or none of its own in the dictionary.
        kind = _write_laid_out(rows, "_id", count, table, expected)
        stored = read_table(spark, table)
        n_rows = stored.count()
        yield code, table, TABLE, n_rows, kind
        yield code, table, ID_INDEX, n_rows, kind
        if spec.parent is not None:
            by_parent = f"{table}_by_parent"
            yield code, by_parent, PARENT_INDEX, n_rows, _write_laid_out(stored, "_parent_id", count, by_parent, n_rows)

    # The largest groups begin first; the report keeps the order of the files.
    by_size = sorted(layouts, key=lambda code: -sizes.get(code, (0, 0))[0])
    with ThreadPoolExecutor(AT_ONCE) as pool:
        written = {code: pool.submit(lambda code=code: list(write_group(code))) for code in by_size}
        try:
            report = [step for code in layouts for step in written[code].result()]
        except BaseException:
            pool.shutdown(cancel_futures=True)
            raise
    return local_table(spark, [(i, *step) for i, step in enumerate(report)], REPORT_SCHEMA)


def _parts(spark: SparkSession, table: str) -> list[DataFrame]:
    """A written table and, if it has one, its side table of hot keys."""
    names = [table] + ([f"{table}{HOT_SUFFIX}"] if spark.catalog.tableExists(f"{table}{HOT_SUFFIX}") else [])
    return [spark.table(name) for name in names]


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """All rows of a written table, those of hot keys included."""
    parts = _parts(spark, table)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_materialised(spark: SparkSession, group: str, by_parent: bool = False, prefix: str = "ags_") -> DataFrame:
    return read_table(spark, f"{prefix}{group.strip().lower()}{'_by_parent' if by_parent else ''}")


def join_materialised(spark: SparkSession, child: str, parent: str, database: str | None = None, prefix: str = "ags_") -> DataFrame:
    """Child rows with their parent rows, part by part, as two structs: refer to columns as ``child.X``, ``parent.Y``.

    The bucketed parts join bucket by bucket, without an Exchange. The children of hot parents join the few parent rows
    of those ids, which are broadcast once they are found to be few. If the parent's ids repeat so often that it has a
    side table itself, that part joins all children by a shuffle, where Spark splits what is skewed.
    """
    names = [f"{database + '.' if database else ''}{prefix}{group.strip().lower()}" for group in (child, parent)]
    ordinary, *hot = [part.alias("child") for part in _parts(spark, f"{names[0]}_by_parent")]
    parents, *repeated = [part.alias("parent") for part in _parts(spark, names[1])]
    link = F.col("child._parent_id") == F.col("parent._id")
    joined = [ordinary.join(parents, link)]
    if hot:
        ids = hot[0].where("_parent_id is not null").select(F.col("_parent_id").alias("_hot")).distinct()
        wanted = parents.join(F.broadcast(cut_lineage(ids)), F.col("parent._id") == F.col("_hot"), "left_semi")
        joined.append(hot[0].join(broadcast_if_small(wanted).alias("parent"), link))
    if repeated:
        joined += [part.join(repeated[0], link) for part in (ordinary, *hot)]
    rows = [j.select(F.struct("child.*").alias("child"), F.struct("parent.*").alias("parent")) for j in joined]
    return reduce(DataFrame.unionAll, rows)
