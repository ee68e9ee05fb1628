"""Byte ranges of files as rows, read by the tasks that hold the rows.

Spark's own text source delivers whole files, split by split. Where only part of a file is wanted, or where
its splits would cut characters apart (UTF-16), the ranges are rows of a table instead: each task seeks,
reads and cuts at line feeds. A line belongs to the chunk it begins in, so the line that is under way at
a chunk's start is the chunk before's. No list of files or ranges passes through the driver.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions import text as tx
from strataframe.session import cut_lineage, local_table

# Bytes of a range that one task reads at a time; a longer range is read in several chunks.
CHUNK_BYTES = 16 * 1024 * 1024
PARTITION_BYTES = 64 * 1024 * 1024
STEP_BYTES = 64 * 1024
# Bytes of a chunk that are taken apart at a time.
PIECE_BYTES = 1024 * 1024
# Python's codec of the encodings with two bytes a unit, and their line feed.
WIDE = {"UTF-16LE": ("utf-16-le", b"\n\x00"), "UTF-16BE": ("utf-16-be", b"\x00\n")}
# Line records of Arrow batches.
LINE_ARROW = pa.schema([("source", pa.string()), ("blk", pa.int64()), ("line", pa.binary()), ("nb", pa.int64())])
LINES_AT_ONCE = 1 << 16


def file_listing(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, size, mtime`` of every file, and the name to open it by. Reads no content."""
    return spark.read.format("binaryFile").load(list(paths)).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("mtime"),
        F.col("path").alias("location"),
    )


def file_system(location: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a location and the name of the file in it."""
    if location.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub("^file:/*", "/", location)
    if re.match("^[a-z0-9]+:", location):
        return pafs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", location))
    return pafs.LocalFileSystem(), location


def can_open(location: str) -> bool:
    """Whether a file can be opened by its location outside Spark's readers."""
    try:
        system, name = file_system(location)
        return system.get_file_info(name).type == pafs.FileType.File
    except (OSError, ValueError):  # ValueError: Arrow's errors for an unknown scheme
        return False


def chunked(ranges: DataFrame) -> DataFrame:
    """``ranges`` (location, start, end, ...) cut into chunks ``at..to``, spread over tasks by their bytes."""
    chunks = ranges.where(F.col("end") > F.col("start")).withColumn(
        "at", F.explode(F.sequence("start", F.col("end") - 1, F.lit(CHUNK_BYTES).cast("long")))
    ).withColumn("to", F.least(F.col("at") + CHUNK_BYTES, "end"))
    totals = chunks.agg(F.count("*").alias("n"), F.sum(F.col("to") - F.col("at")).alias("bytes")).first()
    wanted = max((totals.bytes or 0) // PARTITION_BYTES, ranges.sparkSession.sparkContext.defaultParallelism)
    return chunks.repartition(int(max(1, min(totals.n, wanted))), "location", "at")


def _find_feed(data: bytes, feed: bytes, start: int = 0) -> int:
    """The first line feed at or after ``start``; in wide text only whole units count."""
    at = data.find(feed, start)
    while at >= 0 and at % len(feed):
        at = data.find(feed, at + 1)
    return at


class ShortRead(OSError):
    """A file holds fewer bytes than its listing or index says."""


def read_lines_of(file, start: int, end: int, at: int, to: int, feed: bytes = b"\n") -> bytes:
    """The lines of ``start..end`` that begin in ``at..to``."""
    unit = len(feed)
    begin = at if at == start else at - unit
    file.seek(begin)
    data = file.read(to - begin)
    if len(data) < to - begin:
        raise ShortRead(f"{len(data)} bytes at {begin}, expected {to - begin}")
    # Complete the last line, but never go beyond the range.
    position, pieces = to, [data]
    if not (len(data) % unit == 0 and data.endswith(feed)):
        while position < end:
            more = file.read(min(STEP_BYTES, end - position))
            if not more:
                break
            cut = _find_feed(more, feed)
            pieces.append(more if cut < 0 else more[: cut + unit])
            if cut >= 0:
                break
            position += len(more)
    data = b"".join(pieces)
    if at != start:
        # The line that is under way at the chunk's start belongs to the chunk before.
        cut = _find_feed(data, feed)
        data = b"" if cut < 0 or begin + cut + unit >= to else data[cut + unit :]
    return data


def _without_mark(data: bytes) -> bytes:
    return data.removeprefix(tx.BYTE_ORDER_MARK.encode())


def _ranges_reader(charset: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow function: adds to each chunk its lines (wide text as UTF-8), and how many bytes they are in the file."""
    codec, feed = WIDE.get(charset, (None, b"\n"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                location, start, end, at, to = (row.column(n)[0].as_py() for n in ("location", "start", "end", "at", "to"))
                if location != opened:
                    (system, name), opened = file_system(location), location
                with system.open_input_file(name) as file:
                    data = read_lines_of(file, start, end, at, to, feed)
                n_read = len(data)
                if codec:
                    data = data.decode(codec, "replace").encode()
                if at == start:
                    data = _without_mark(data)
                    if not data.startswith(tx.GROUP_MARK.encode()):
                        raise OSError(f"{location}: no section begins at byte {start}")
                columns = [row.column(n) for n in row.schema.names] + [pa.array([data], pa.binary()), pa.array([n_read], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [*row.schema.names, "body", "n_read"])

    return read


def range_bodies(ranges: DataFrame, charset: str) -> DataFrame:
    """The chunks of ``ranges``, each a section, with their text in ``body`` and its bytes in the file in ``n_read``."""
    chunks = chunked(ranges)
    schema = chunks.withColumns({"body": F.lit(b""), "n_read": F.lit(0).cast("long")}).schema
    return chunks.mapInArrow(_ranges_reader(charset), schema)


def lines_reader(charset: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow function: chunks of whole files -> their lines ``source, blk, line, nb`` in order.

    ``blk`` is where the chunk begins, ``nb`` a line's bytes in the file with its line feed. Lines of wide text are UTF-8.
    """
    codec, feed = WIDE.get(charset, (None, b"\n"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, name = file_system(row["location"])
                with system.open_input_file(name) as file:
                    data = read_lines_of(file, 0, row["end"], row["at"], row["to"], feed)
                # A few lines at a time: text and lists of lines take many times the bytes of the file.
                position = 0
                while position < len(data):
                    cut = _find_feed(data, feed, min(position + PIECE_BYTES, len(data)))
                    stop = len(data) if cut < 0 else cut + len(feed)
                    yield from pieces_of(row, data[position:stop], position == 0)
                    position = stop
                del data
                pa.default_memory_pool().release_unused()

    def pieces_of(row: dict, data: bytes, begins: bool) -> Iterator[pa.RecordBatch]:
        text = data.decode(codec, "replace") if codec else None
        lines = (text.encode() if codec else data).split(b"\n")
        if lines[-1] == b"":
            lines.pop()
        if begins and row["at"] == 0:  # a byte order mark counts as read, but is no text
            lines[:1] = map(_without_mark, lines[:1])
        if codec:
            nb = [2 * (len(line.encode(codec)) // 2 + 1) for line in text.split("\n")[: len(lines)]]
        else:
            nb = [len(line) + 1 for line in lines]
        for k in range(0, len(lines), LINES_AT_ONCE):
            part = pa.array(lines[k : k + LINES_AT_ONCE], pa.binary())
            yield pa.RecordBatch.from_arrays([
                pa.repeat(pa.scalar(row["path"]), len(part)), pa.repeat(pa.scalar(row["at"], pa.int64()), len(part)),
                part, pa.array(np.asarray(nb[k : k + LINES_AT_ONCE], np.int64)),
            ], schema=LINE_ARROW)

    return read


def spans_fit(spans: DataFrame, group: str) -> DataFrame:
    """``path, fits`` of spans (path, location, size, start, end): does a section of ``group`` stand at those bytes?

    Reads a few bytes at either end: the file has the size, a line begins at ``start`` with the group's record, and at
    ``end`` the file ends or the next section begins. A file that cannot be opened does not fit.
    """
    mark, record = tx.GROUP_MARK.encode(), f'{tx.GROUP_MARK}"{group}"'.encode()

    def at_line(file, at: int) -> bool:
        if at == 0:
            return True
        file.seek(max(0, at - 3))
        before = file.read(min(3, at))
        return before.endswith(b"\n") or (at == 3 and before == tx.BYTE_ORDER_MARK.encode())

    def fits(row: dict) -> bool:
        try:
            system, name = file_system(row["location"])
            with system.open_input_file(name) as file:
                if file.size() != row["size"] or not at_line(file, row["start"]):
                    return False
                file.seek(row["start"])
                if not _without_mark(file.read(len(record) + 3)).startswith(record):
                    return False
                if row["end"] == row["size"]:
                    return True
                if not at_line(file, row["end"]):
                    return False
                file.seek(row["end"])
                return file.read(len(mark)) == mark
        except OSError:
            return False

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = [fits(row) for row in batch.to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(found)], ["path", "fits"])

    return spans.select("path", "location", "size", "start", "end").mapInArrow(probe, "path string, fits boolean")


# ------------------------------------------------------------------------------ listing

_GLOB = re.compile(r"[*?\[{]")
_LISTED = "location string, rest array<string>, is_file boolean, size long"


def _glob_pattern(part: str) -> re.Pattern:
    """One path component of a Hadoop glob as a pattern: ``* ? [a-b] [^a] {a,b}``."""
    found, depth, i = "", 0, 0
    while i < len(part):
        c = part[i]
        if c == "[" and (close := part.find("]", i + 1)) > 0:
            found, i = found + f"[{part[i + 1 : close]}]", close
        elif c == "{":
            found, depth = found + "(?:", depth + 1
        elif c == "}" and depth:
            found, depth = found + ")", depth - 1
        elif c == "," and depth:
            found += "|"
        else:
            found += {"*": ".*", "?": "."}.get(c, re.escape(c))
        i += 1
    return re.compile(found, re.S)


def _started(path: str) -> tuple[str, list[str]]:
    """The folder a path's listing starts in, and the components that are still to be matched."""
    head, slashes, tail = re.match(r"^((?:[A-Za-z0-9+.-]+:(?://[^/]*)?)?)(/*)(.*)$", path).groups()
    parts = [p for p in tail.split("/") if p]
    fixed = next((i for i, p in enumerate(parts) if _GLOB.search(p)), len(parts))
    return head + slashes + "/".join(parts[:fixed]), parts[fixed:]


def _list_folder(location: str, rest: list[str]) -> Iterator[tuple[str, list[str], bool, int]]:
    system, name = file_system(location)
    info = system.get_file_info(name)
    if info.type == pafs.FileType.File:
        if not rest:
            yield location, [], True, info.size
        return
    if info.type != pafs.FileType.Directory:
        return
    wanted = _glob_pattern(rest[0]) if rest else None
    for child in system.get_file_info(pafs.FileSelector(name)):
        base, place = child.base_name, f"{location.rstrip('/')}/{child.base_name}"
        is_file = child.type == pafs.FileType.File
        if wanted is not None:
            if wanted.fullmatch(base) and (not is_file or len(rest) == 1):
                yield place, rest[1:], is_file, child.size if is_file else 0
        elif not base.startswith(("_", ".")) and (is_file or "=" in base):  # what Spark reads of a folder
            yield place, [], is_file, child.size if is_file else 0


def can_list(path: str) -> bool:
    """Whether the folder that a path's listing starts in can be seen outside Spark's readers."""
    try:
        system, name = file_system(_started(path)[0])
        return system.get_file_info(name).type != pafs.FileType.NotFound
    except (OSError, ValueError):
        return False


def listed_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``location, size`` of the files that ``paths`` (files, folders, globs) name, empty ones included.

    Folders are rows; each round lists the folders that the one before found, in tasks. Only the number of folders
    left comes back to the driver.
    """
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = list(_list_folder(row["location"], row["rest"] or []))
                for k in range(0, len(found), LINES_AT_ONCE):
                    columns = list(zip(*found[k : k + LINES_AT_ONCE]))
                    kinds = (pa.string(), pa.list_(pa.string()), pa.bool_(), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, kinds)], names=["location", "rest", "is_file", "size"])

    todo = local_table(spark, [(*_started(p), False, 0) for p in paths], _LISTED)
    rounds = []
    while True:
        spread = todo.repartition(spark.sparkContext.defaultParallelism, "location")
        found = cut_lineage(spread.mapInArrow(step, _LISTED))
        rounds.append(found.where("is_file").select("location", "size"))
        todo = found.where("not is_file")
        if todo.isEmpty():
            break
    result = rounds[0]
    for more in rounds[1:]:
        result = result.unionAll(more)
    return result.distinct()
