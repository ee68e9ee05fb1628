"""The section index: where every section of every file starts and ends, with its headers.

It is an ordinary table, kept wherever the user likes. A read that finds a file's entry still
fresh (same size, same modification time) fetches only the bytes of the wanted group, once a look at
both ends of its span has found the group there; everything else is read whole, so an out-of-date or
wrong index costs time but never rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataframe.functions import text as tx
from strataframe.operators.dictionary import group_spec
from strataframe.operators.group_table import discover_layout, group_table
from strataframe.session import cut_lineage
from strataframe.sources import pieces
from strataframe.sources.byte_ranges import file_listing, range_bodies, spans_fit
from strataframe.sources.delivery import Delivery
from strataframe.sources.encoding import UTF8, charset_rules, decoded, is_wide, resolve_encoding

INDEX_COLUMNS = [
    "path", "size", "mtime", "group", "span_no", "start", "end", "n_data", "headings", "units", "types",
]
FILE_KEY = ["path", "size", "mtime"]


def _small_file_spans(spark: SparkSession, paths: Sequence[str], limit: int) -> DataFrame:
    """Byte ranges from running sums of section lengths. Only headers and lengths are shuffled."""
    size = F.col("_metadata.file_size")
    scan = spark.read.option("lineSep", pieces.SECTION_SEPARATOR).text(list(paths))
    rows = scan.where(~pieces._is_large(limit)).select(
        F.col("_metadata.file_path").alias("source"),
        pieces._position(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("pos"),
        F.octet_length("value").cast("long").alias("nb"),
        decoded(F.col("value"), UTF8).alias("text"),
        size.alias("size"),
        F.col("_metadata.file_modification_time").alias("mtime"),
    )
    heads = rows.selectExpr(
        "*", f"{tx.after_group_mark(tx.first_line('text'))} as head", f"{tx.rest('text')} as body"
    ).selectExpr("source", "pos", "nb", "size", "mtime", *pieces.section_columns())
    separator, mark = len(pieces.SECTION_SEPARATOR), len(tx.GROUP_MARK)
    file = Window.partitionBy("source")
    earlier = file.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    with_separator = F.col("nb") + separator
    text_start = F.coalesce(F.sum(with_separator).over(earlier), F.lit(0))
    # The reader drops a byte order mark; what the file has more than the rows is that mark.
    unseen = F.col("size") - (F.sum(with_separator).over(file) - separator)
    placed = heads.withColumn("text_start", text_start).withColumn("unseen", unseen)
    first = F.col("text_start") == 0
    return placed.where("group <> ''").select(
        F.col("source").alias("path"), "size", "mtime", "group", "n_data", "headings", "units", "types",
        (F.col("unseen") + F.when(first, 0).otherwise(F.col("text_start") - mark)).cast("long").alias("start"),
        F.least(F.col("unseen") + F.col("text_start") + F.col("nb") + 1, "size").alias("end"),
    )


def build_section_index(
    spark: SparkSession,
    paths: str | Sequence[str],
    section_file_bytes: int = pieces.SECTION_FILE_BYTES,
    max_file_bytes: int | None = None,
) -> DataFrame:
    """One row per section of every uncompressed file; a redeclared group has several spans."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    pieces.refuse_larger_files(spark, paths, max_file_bytes)
    parts = [_small_file_spans(spark, paths, section_file_bytes)]
    if pieces.has_large_files(spark, paths, section_file_bytes):
        times = file_listing(spark, paths).select("path", "mtime")
        spans = pieces.SplitFiles(spark, paths, UTF8, section_file_bytes).byte_spans()
        parts.append(spans.join(times, "path").select(*[c for c in INDEX_COLUMNS if c != "span_no"]))
    spans = reduce(DataFrame.unionByName, parts)
    number = F.row_number().over(Window.partitionBy("path", "group").orderBy("start"))
    return spans.withColumn("span_no", number.cast("long")).select(*INDEX_COLUMNS)


def _sliced_bodies(spans: DataFrame, charset: str) -> DataFrame:
    """The text of the given spans, read as byte ranges, in the columns of a section reader."""
    with charset_rules(spans.sparkSession, charset):
        return range_bodies(spans, charset).select(
            F.col("path").alias("source"), pieces._position(F.lit(0), F.col("at")).alias("pos"),
            "group", "headings", "units", "types", "n_data",
            decoded(F.col("body"), charset).alias("body"),
        )


def split_by_freshness(listing: DataFrame, index: DataFrame, group: str) -> tuple[DataFrame, DataFrame]:
    """Spans that may be sliced, and files that must be read whole.

    Only a fresh file in which the group has exactly one span is sliced. A fresh file without the
    group is in neither part: the index is complete, so the file can be skipped.
    """
    spans_of_group = F.count_if(F.col("group") == group)
    known = index.groupBy(*FILE_KEY).agg(spans_of_group.alias("n_spans"))
    files = listing.join(known, FILE_KEY, "left")
    single = files.where("n_spans = 1").select(*FILE_KEY, "location")
    spans = single.join(index.where(F.col("group") == group), FILE_KEY)
    whole = files.where("n_spans is null or n_spans > 1").select("path", "size", "location")
    return spans, whole


def spans_to_read(listing: DataFrame, index: DataFrame, group: str) -> tuple[DataFrame, DataFrame]:
    """Spans to slice, and files (path, size, location) to read whole: those not sliced by :func:`split_by_freshness`,
    and those whose spans turn out not to hold the group, as a file changed without a new size or time, or an index
    was made from other files. Both are written, so that they stay what was probed."""
    spans, whole = split_by_freshness(listing, index, group)
    spans = cut_lineage(spans)
    probed = cut_lineage(spans_fit(spans, group))
    fitting = spans.join(probed.where("fits").select("path"), "path", "left_semi")
    others = whole.unionByName(spans.join(probed.where("not fits").select("path"), "path", "left_semi").select(*whole.columns))
    return fitting, cut_lineage(others)


def read_group_indexed(
    spark: SparkSession,
    paths: str | Sequence[str],
    group: str,
    index: DataFrame,
    dictionary: DataFrame | None = None,
    encoding: str | None = None,
    allow_custom: bool = False,
    with_source: bool = False,
    section_file_bytes: int = pieces.SECTION_FILE_BYTES,
    max_file_bytes: int | None = None,
) -> DataFrame:
    """Like :func:`strataframe.sources.delivery.read_group`, reading only the group's bytes where it can.

    Files to be read whole are rows of a table, opened by the tasks. Compressed ones, which the index never has, are the
    exception: their names go through the driver to Spark's reader. UTF-16 files are not indexed and are all read whole.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    code, charset = group.strip().upper(), resolve_encoding(encoding)
    pieces.refuse_larger_files(spark, paths, max_file_bytes)
    listing = file_listing(spark, paths)
    spans, whole = spans_to_read(listing, index.limit(0) if is_wide(charset) else index, code)
    packed = F.col("path").rlike(pieces.COMPRESSED)
    sources = []
    if not whole.where(~packed).isEmpty():
        sources.append(Delivery.from_listing(spark, whole.where(~packed), dictionary, encoding))
    locations = [row.location for row in whole.where(packed).select("location").collect()]
    if locations:
        sources.append(Delivery.from_files(spark, locations, dictionary, encoding, section_file_bytes))
    heads = [spans.select(F.col("path").alias("source"), "headings", "types")]
    heads += [s.heads().where(F.col("group") == code).select("source", "headings", "types") for s in sources]
    layout = discover_layout(reduce(DataFrame.unionByName, heads))
    if not layout.columns:
        return Delivery.from_files(spark, paths, dictionary, encoding, section_file_bytes).group(code, allow_custom=allow_custom)
    bodies = [_sliced_bodies(spans, charset)] + [s.bodies(code) for s in sources]
    spec = group_spec(Delivery(spark, dictionary, None).dictionary, code, allow_custom)
    return group_table(reduce(DataFrame.unionByName, bodies), layout, spec, with_source)
