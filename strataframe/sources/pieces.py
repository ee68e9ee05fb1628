"""Cutting delivery text into sections, in parallel and without moving the text.

A *section* is one GROUP record and everything up to the next one. Three readers give the same
columns ``source, pos, group, headings, units, types, n_data, body``, where ``body`` holds the
section's lines (or some of them, if the section is spread over several pieces):

* :func:`text_sections` for text that is already in a column;
* :func:`file_sections` for files of ordinary size: the text source splits at ``\\n"GROUP",``
  instead of at ``\\n``, so that each row it delivers *is* one section, headers included. No
  window, no shuffle, no Python; a section that crosses a split is read by the split it starts in;
* :class:`SplitFiles` for large files, whose sections may be larger than one row can be. Each task
  numbers the sections of its own split while it streams over it; one small row per split then
  carries the count from split to split. One group is then read by its byte ranges alone.
  :class:`RangedFiles` does the same for files that are rows of a table, or that Spark cannot split (UTF-16).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataframe.errors import DeliveryError
from strataframe.functions import text as tx
from strataframe.session import broadcast_if_small, cut_lineage
from strataframe.sources import byte_ranges as br
from strataframe.sources.encoding import UTF8, charset_rules, decoded

SECTION_SEPARATOR = "\n" + tx.GROUP_MARK
# Files up to this size are read section by section, larger ones split by split.
SECTION_FILE_BYTES = 32 * 1024 * 1024
# How many of the files over a limit an error names.
NAMED_FILES = 20
COMPRESSED = r"\.(gz|bz2|zst|lz4|snappy|deflate)$"

SECTION_COLUMNS = ["source", "pos", "group", "headings", "units", "types", "n_data", "body"]


def _position(block: Column, number: Column) -> Column:
    return F.struct(block.cast("long").alias("blk"), number.cast("long").alias("n"))


def section_columns() -> list[str]:
    """What every reader takes from a section: ``head`` is its first line from the group code on, ``body``
    its text behind that line."""
    return [
        f"if(head rlike {tx.literal(tx.STRAY_RECORD)}, '', {tx.group_code('head')}) as group",
        f"{tx.header_cells('body', 'HEADING')} as headings",
        f"{tx.header_cells('body', 'UNIT')} as units",
        f"{tx.header_cells('body', 'TYPE')} as types",
        f"{tx.data_count('body')} as n_data",
    ]


def _with_headers(pieces: DataFrame) -> DataFrame:
    """Name each section's group and headers. Text in front of a first GROUP record is dropped.

    The group comes from ``head``, the section's first line, so that passing over an unwanted
    section never touches the rest of its text.
    """
    group, *headers = section_columns()
    return pieces.selectExpr("*", group).where("group <> ''").selectExpr("source", "pos", "group", *headers, "body")


def text_sections(docs: DataFrame, content: str, source: str) -> DataFrame:
    """Sections of the delivery texts in column ``content``, one text per row."""
    before_mark = tx.literal(f"\n(?={tx.GROUP_MARK})")
    parts = docs.selectExpr(
        f"cast({tx.name(source)} as string) as source",
        f"posexplode(split({tx.name(content)}, {before_mark})) as (n, part)",
    )
    return _with_headers(
        parts.selectExpr(
            "source",
            "named_struct('blk', 0L, 'n', cast(n as long)) as pos",
            f"{tx.after_group_mark(tx.first_line('part'))} as head",
            f"{tx.rest('part')} as body",
        )
    )


def _is_large(limit: int) -> Column:
    """Large enough to need :class:`SplitFiles`. A compressed file may grow manifold."""
    size, path = F.col("_metadata.file_size"), F.col("_metadata.file_path")
    return (size > limit) | path.rlike(COMPRESSED)


def size_at_most(ceiling: int | None) -> Column:
    return F.lit(True) if ceiling is None else F.col("_metadata.file_size") <= ceiling


def refuse_larger_files(spark: SparkSession, paths: Sequence[str], ceiling: int | None) -> None:
    """Raise if any file is over the ceiling, before anything is read."""
    if ceiling is None:
        return
    files = spark.read.format("binaryFile").load(list(paths))
    over = files.where(F.col("length") > ceiling).select("path", "length").limit(NAMED_FILES).collect()
    if over:
        names = ", ".join(f"{row.path} ({row.length} bytes)" for row in over)
        raise DeliveryError(f"over the limit of {ceiling} bytes: {names}")


def has_large_files(spark: SparkSession, paths: Sequence[str], limit: int) -> bool:
    """Whether any file is large. The listing decides which files the check opens at all: only those."""
    return bool(spark.read.text(list(paths)).where(_is_large(limit)).select(F.lit(1)).limit(1).collect())


def file_sections(
    spark: SparkSession,
    paths: Sequence[str],
    charset: str,
    limit: int = SECTION_FILE_BYTES,
) -> DataFrame:
    """Sections of the files up to ``limit`` bytes, one row each."""
    scan = spark.read.option("lineSep", SECTION_SEPARATOR).text(list(paths))
    with charset_rules(spark, charset):
        pieces = scan.where(~_is_large(limit)).select(
            F.col("_metadata.file_path").alias("source"),
            _position(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("pos"),
            decoded(F.expr(tx.first_line("value")), charset).alias("first_line"),
            decoded(F.col("value"), charset).alias("text"),
        )
    return _with_headers(
        pieces.selectExpr(
            "source",
            "pos",
            f"{tx.after_group_mark('first_line')} as head",
            f"{tx.rest('text')} as body",
        )
    )


# --------------------------------------------------------------------------- large files

RUN_SCHEMA = "source string, blk long, ls long, at long, nb long, n_data long, body binary"
_RUN_ARROW = pa.schema(
    [
        ("source", pa.string()),
        ("blk", pa.int64()),
        ("ls", pa.int64()),
        ("at", pa.int64()),
        ("nb", pa.int64()),
        ("n_data", pa.int64()),
        ("body", pa.binary()),
    ]
)


def _section_runs(keep_rows: bool):
    """Arrow function: lines of a split in order, with their bytes in the file -> runs of lines of the same section.

    ``ls`` numbers the GROUP records of the split from 1 (0 = the lines before the first one),
    ``at`` is the byte offset of the run in the split, ``nb`` its size. Without ``keep_rows`` the
    body holds the header records only.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, groups_before, bytes_before = None, 0, 0
        for batch in batches:
            count = batch.num_rows
            if count == 0:
                continue
            line, source, block = batch.column("line"), batch.column("source"), batch.column("blk")
            mark = tx.GROUP_MARK.encode()
            bom_mark = tx.BYTE_ORDER_MARK.encode() + mark
            is_group = pc.or_(pc.starts_with(line, mark), pc.starts_with(line, bom_mark))
            is_group = is_group.to_numpy(zero_copy_only=False)
            is_data = pc.starts_with(line, tx.DATA_MARK.encode()).to_numpy(zero_copy_only=False)
            size = batch.column("nb").to_numpy(zero_copy_only=False).astype(np.int64)

            new_split = np.empty(count, dtype=bool)
            new_split[0] = last != (source[0].as_py(), block[0].as_py())
            if count > 1:
                moved = pc.or_(
                    pc.not_equal(source.slice(1), source.slice(0, count - 1)),
                    pc.not_equal(block.slice(1), block.slice(0, count - 1)),
                )
                new_split[1:] = moved.to_numpy(zero_copy_only=False)

            group_total, byte_end = np.cumsum(is_group), np.cumsum(size)
            byte_start = byte_end - size
            split_of = np.cumsum(new_split)
            starts = np.flatnonzero(new_split)
            # What to take off the batch-wide totals so that each split counts from its own start.
            group_base = np.concatenate(([-groups_before], group_total[starts] - is_group[starts]))
            byte_base = np.concatenate(([-bytes_before], byte_start[starts]))
            number = group_total - group_base[split_of]
            offset = byte_start - byte_base[split_of]

            first = np.flatnonzero(new_split | is_group | (np.arange(count) == 0))
            after = np.append(first[1:], count)
            data_total = np.concatenate(([0], np.cumsum(is_data)))
            if keep_rows:
                kept = np.ones(count, dtype=bool)
            else:  # the headers stand in front of a run's first DATA line
                kept = data_total[1:] == np.repeat(data_total[first], after - first)
            kept_total = np.concatenate(([0], np.cumsum(kept)))
            byte_total = np.concatenate(([0], byte_end))
            bounds = np.append(kept_total[first], kept_total[count]).astype(np.int32)
            kept_lines = line if keep_rows else line.filter(pa.array(kept))
            body = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), kept_lines), b"\n")

            take = pa.array(first)
            yield pa.RecordBatch.from_arrays(
                [
                    source.take(take),
                    block.take(take),
                    pa.array(number[first].astype(np.int64)),
                    pa.array(offset[first]),
                    pa.array(byte_total[after] - byte_total[first]),
                    pa.array((data_total[after] - data_total[first]).astype(np.int64)),
                    body.cast(pa.binary()),
                ],
                schema=_RUN_ARROW,
            )
            last = (source[count - 1].as_py(), block[count - 1].as_py())
            groups_before = int(number[-1])
            bytes_before = int(offset[-1] + size[-1])

    return runs


class SplitFiles:
    """Sections of files too large to be read section by section."""

    def __init__(self, spark: SparkSession, paths: Sequence[str], charset: str, limit: int,
                 ceiling: int | None = None):
        self._spark, self._paths, self._charset = spark, list(paths), charset
        self._limit, self._ceiling = limit, ceiling
        self._header_runs: DataFrame | None = None
        self._spans: DataFrame | None = None
        self._byte_spans: DataFrame | None = None
        self._kept: DataFrame | None = None
        self._seekable: bool | None = None

    def persist(self, level: StorageLevel) -> None:
        """Keep the files' text, in the order of its groups, for the reads that follow."""
        self._kept = laid_out_by_group(self.bodies()).persist(level)

    def unpersist(self) -> None:
        if self._kept is not None:
            self._kept.unpersist()
            self._kept = None

    def _files(self) -> DataFrame:
        """``path, size, location`` of the files."""
        listing = br.file_listing(self._spark, self._paths).select("path", "size", "location")
        large = (F.col("size") > self._limit) | F.col("path").rlike(COMPRESSED)
        return listing.where(large & (F.lit(True) if self._ceiling is None else F.col("size") <= self._ceiling))

    def _runs(self, keep_rows: bool) -> DataFrame:
        scan = self._spark.read.option("lineSep", "\n").text(self._paths)
        lines = scan.where(
            _is_large(self._limit) & size_at_most(self._ceiling)
        ).select(
            F.col("_metadata.file_path").alias("source"),
            F.col("_metadata.file_block_start").alias("blk"),
            F.col("value").cast("binary").alias("line"),
            (F.octet_length("value") + 1).cast("long").alias("nb"),
        )
        return lines.mapInArrow(_section_runs(keep_rows), RUN_SCHEMA)

    def header_runs(self) -> DataFrame:
        """All runs with their header records only: one pass over the files, stored."""
        if self._header_runs is None:
            self._header_runs = cut_lineage(self._runs(keep_rows=False))
        return self._header_runs

    def numbered_runs(self, keep_rows: bool) -> DataFrame:
        """Runs of lines with their section number and byte offset in the whole file.

        What is carried from split to split is one row per split; text is not shuffled for it
        unless there are more splits than may be broadcast.
        """
        runs = self._runs(keep_rows=True) if keep_rows else self.header_runs()
        by_split = Window.partitionBy("source").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
        splits = broadcast_if_small(
            self.header_runs()
            .groupBy("source", "blk")
            .agg(F.max("ls").alias("groups"), F.sum("nb").alias("bytes"))
            .select(
                "source",
                "blk",
                F.coalesce(F.sum("groups").over(by_split), F.lit(0)).alias("groups_before"),
                F.coalesce(F.sum("bytes").over(by_split), F.lit(0)).alias("bytes_before"),
            )
        )
        return runs.join(splits, ["source", "blk"]).select(
            "source",
            "blk",
            "ls",
            (F.col("ls") + F.col("groups_before")).alias("section_no"),
            (F.col("at") + F.col("bytes_before")).alias("at"),
            "nb",
            "n_data",
            "body",
        )

    def spans(self) -> DataFrame:
        """One row per section and split it touches, with the section's headers and byte range.

        Made from the header records alone, then stored: it is the table all later reads of these
        files join to.
        """
        if self._spans is not None:
            return self._spans
        numbered = self.numbered_runs(keep_rows=False).where("section_no > 0")
        with charset_rules(self._spark, self._charset):
            readable = numbered.withColumn("body", decoded(F.col("body"), self._charset))
        sections = self._section_heads(readable)
        touched = numbered.groupBy("source", "section_no", "blk", "ls").agg(F.min("at").alias("at"))
        self._spans = cut_lineage(
            touched.join(sections, ["source", "section_no"]).withColumn("is_start", F.col("at") == F.col("start"))
        )
        return self._spans

    @staticmethod
    def _section_heads(runs: DataFrame) -> DataFrame:
        def first_line(tag: str) -> Column:
            line = F.when(F.col("in_front"), F.expr(tx.header_line("body", tag)))
            return F.min_by(F.when(line != "", line), F.when(line != "", F.col("at"))).alias(tag)

        earlier = Window.partitionBy("source", "section_no").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        in_front = F.coalesce(F.sum("n_data").over(earlier), F.lit(0)) == 0
        return (
            runs.withColumn("in_front", in_front).groupBy("source", "section_no")
            .agg(
                F.min_by("body", "at").alias("body"),
                F.min("at").alias("start"),
                F.sum("nb").alias("bytes"),
                F.sum("n_data").alias("n_data"),
                *[first_line(tag) for tag in tx.HEADER_TAGS],
            )
            .select(
                "source",
                "section_no",
                "start",
                "bytes",
                "n_data",
                F.expr(tx.group_code(tx.after_group_mark("body"))).alias("group"),
                *[
                    F.expr(tx.values(f"coalesce(`{tag}`, '')")).alias(name)
                    for tag, name in zip(tx.HEADER_TAGS, ("headings", "units", "types"))
                ],
            )
        )

    def heads(self) -> DataFrame:
        """One row per section, without its text."""
        return self.spans().where("is_start").select(
            "source", _position(F.lit(0), F.col("section_no")).alias("pos"),
            "group", "headings", "units", "types", "n_data", "start", "bytes",
        )

    def byte_spans(self) -> DataFrame:
        """``path, size, location`` and ``start, end`` in the file of every section of a plain file, with its headers. Stored."""
        if self._byte_spans is None:
            plain = self.heads().where(~F.col("source").rlike(COMPRESSED)).withColumnRenamed("source", "path")
            spans = plain.join(self._files(), "path")
            seen = plain.groupBy("path").agg(F.max(F.col("start") + F.col("bytes")).alias("seen"))
            # Spark's reader drops a byte order mark, and then every place is too low by it. A last line
            # without line feed makes the total one too high, never too low.
            unseen = F.when(F.col("seen") < F.col("size"), len(tx.BYTE_ORDER_MARK.encode())).otherwise(0)
            self._byte_spans = cut_lineage(spans.join(seen, "path").select(
                "path", "size", "location", "pos", "group", "n_data", "headings", "units", "types",
                (F.col("start") + unseen).alias("start"),
                F.least(F.col("start") + unseen + F.col("bytes"), "size").alias("end"),
            ))
        return self._byte_spans

    def _can_seek(self) -> bool:
        """Whether the files can be opened outside Spark's readers, judged by one of them."""
        if self._seekable is None:
            one = self.byte_spans().select("location").first()
            self._seekable = one is not None and br.can_open(one.location)
        return self._seekable

    def group_ranges(self, group: str) -> DataFrame:
        """The chunks of a group's sections, read as byte ranges: no other byte of the files is read."""
        return br.range_bodies(self.byte_spans().where(F.col("group") == group), self._file_charset)

    @property
    def _file_charset(self) -> str:
        return self._charset

    def bodies(self, group: str | None = None) -> DataFrame:
        """The text, in pieces, next to its section's headers.

        One group is read by its byte ranges where the files can be sought in. Otherwise all text is passed, and
        the join key names a section *within a split*, so no key holds more than one split's text, however
        large the section is.
        """
        if self._kept is not None:
            return self._kept if group is None else self._kept.where(F.col("group") == group)
        if group is None or not self._can_seek():
            return self._passed_bodies(group)
        with charset_rules(self._spark, self._charset):
            ranged = self.group_ranges(group).select(
                F.col("path").alias("source"), "pos", "group", "headings", "units", "types", "n_data",
                decoded(F.col("body"), self._charset).alias("body"),
            )
        packed = self._passed_bodies(group, F.col("source").rlike(COMPRESSED))
        return ranged.unionByName(packed) if self._has_packed() else ranged

    def _has_packed(self) -> bool:
        return not self.spans().where(F.col("source").rlike(COMPRESSED)).isEmpty()

    def _passed_bodies(self, group: str | None, which: Column | None = None) -> DataFrame:
        spans = self.spans()
        if group is not None:
            spans = spans.where(F.col("group") == group)
        spans = spans.select("source", "blk", "ls", "section_no", "group", "headings", "units", "types")
        pieces = self._runs(keep_rows=True).select("source", "blk", "ls", "body", "n_data")
        if which is not None:
            pieces, spans = pieces.where(which), spans.where(which)
        joined = pieces.join(broadcast_if_small(spans), ["source", "blk", "ls"])
        with charset_rules(self._spark, self._charset):
            return joined.select(
                "source", _position(F.lit(0), F.col("section_no")).alias("pos"),
                "group", "headings", "units", "types", "n_data",
                decoded(F.col("body"), self._charset).alias("body"),
            )


class RangedFiles(SplitFiles):
    """Sections of the plain files ``path, size, location`` of a table, whatever their size.

    Tasks open the files themselves and read them chunk by chunk. Wide text is cut at its own line feeds
    and goes on as UTF-8.
    """

    def __init__(self, spark: SparkSession, files: DataFrame, charset: str):
        super().__init__(spark, [], UTF8 if charset in br.WIDE else charset, 0)
        self._listed, self._own_charset = files.select("path", "size", "location"), charset
        self._seekable = True

    @property
    def _file_charset(self) -> str:
        return self._own_charset

    def _files(self) -> DataFrame:
        return self._listed

    def _has_packed(self) -> bool:
        return False

    def _runs(self, keep_rows: bool) -> DataFrame:
        whole = self._listed.select("path", "location", F.lit(0).cast("long").alias("start"), F.col("size").alias("end"))
        read, number = br.lines_reader(self._own_charset), _section_runs(keep_rows)
        return br.chunked(whole).select("path", "location", "end", "at", "to").mapInArrow(lambda batches: number(read(batches)), RUN_SCHEMA)


def laid_out_by_group(sections: DataFrame) -> DataFrame:
    """Sections in the order of their groups, for a cache: a read of one group then skips the batches of all
    others by their statistics. A group that is most of the text is split by source and place."""
    order = ["group", F.xxhash64("source", "pos")]
    return sections.repartitionByRange(*order).sortWithinPartitions(*order)
