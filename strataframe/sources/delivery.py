"""Opening deliveries and reading groups from them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.errors import DeliveryError
from strataframe.operators import structure
from strataframe.operators.dictionary import group_spec, seed_dictionary
from strataframe.operators.group_table import Layout, discover_layout, discover_layouts, group_table
from strataframe.session import local_table
from strataframe.sources import pieces
from strataframe.sources.byte_ranges import file_listing
from strataframe.sources.encoding import is_wide, resolve_encoding

HEAD_COLUMNS = [name for name in pieces.SECTION_COLUMNS if name != "body"]
# How many group codes an error message lists.
LISTED_GROUPS = 200


class Delivery:
    """Any number of delivery files, or of delivery texts, as one lazily read source.

    ``dictionary`` supplies parents and KEY headings; the starter dictionary is used by default.
    """

    def __init__(self, spark: SparkSession, dictionary: DataFrame | None,
                 sections: DataFrame | None, split_files: pieces.SplitFiles | None = None):
        self.spark = spark
        self.dictionary = seed_dictionary(spark) if dictionary is None else dictionary
        self._sections = sections
        self._split_files = split_files

    # ------------------------------------------------------------------ opening

    @classmethod
    def from_files(
        cls,
        spark: SparkSession,
        paths: str | Sequence[str],
        dictionary: DataFrame | None = None,
        encoding: str | None = None,
        section_file_bytes: int = pieces.SECTION_FILE_BYTES,
        max_file_bytes: int | None = None,
    ) -> Delivery:
        """Files, folders or globs on any file system the cluster can open.

        With ``max_file_bytes`` a file over that size is an error that names it; there is no limit
        otherwise. Files over ``section_file_bytes`` are read split by split.
        """
        paths = [paths] if isinstance(paths, str) else list(paths)
        charset = resolve_encoding(encoding)
        pieces.refuse_larger_files(spark, paths, max_file_bytes)
        if is_wide(charset):
            return cls.from_listing(spark, file_listing(spark, paths), dictionary, charset)
        sections = pieces.file_sections(spark, paths, charset, section_file_bytes)
        split_files = None
        if pieces.has_large_files(spark, paths, section_file_bytes):
            split_files = pieces.SplitFiles(spark, paths, charset, section_file_bytes)
        return cls(spark, dictionary, sections, split_files)

    @classmethod
    def from_listing(
        cls, spark: SparkSession, files: DataFrame, dictionary: DataFrame | None = None, encoding: str | None = None,
    ) -> Delivery:
        """Plain files that are rows of a table ``path, size, location``, read in byte ranges by the tasks."""
        return cls(spark, dictionary, None, pieces.RangedFiles(spark, files, resolve_encoding(encoding)))

    @classmethod
    def from_texts(
        cls, docs: DataFrame, content: str = "content", source: str = "doc_id",
        dictionary: DataFrame | None = None,
    ) -> Delivery:
        """Delivery texts held in a string column."""
        return cls(docs.sparkSession, dictionary, pieces.text_sections(docs, content, source))

    @classmethod
    def from_text(cls, spark: SparkSession, content: str, dictionary: DataFrame | None = None) -> Delivery:
        """One delivery given as a string."""
        docs = local_table(spark, [("text", content)], "doc_id string, content string")
        return cls.from_texts(docs, dictionary=dictionary)

    def persist(self, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Delivery:
        """Keep the sections for the queries that follow, in the order of their groups, so that a read of one
        group passes over the others'. Call :meth:`unpersist` when done."""
        if self._sections is not None:
            self._sections = pieces.laid_out_by_group(self._sections).persist(level)
        if self._split_files is not None:
            self._split_files.persist(level)
        return self

    def unpersist(self) -> Delivery:
        if self._sections is not None:
            self._sections.unpersist()
        if self._split_files is not None:
            self._split_files.unpersist()
        return self

    # ------------------------------------------------------------------ sections

    def heads(self) -> DataFrame:
        """One row per section: ``source, pos, group, headings, units, types, n_data``."""
        parts = []
        if self._sections is not None:
            parts.append(self._sections.select(*HEAD_COLUMNS))
        if self._split_files is not None:
            parts.append(self._split_files.heads().select(*HEAD_COLUMNS))
        return reduce(DataFrame.unionByName, parts)

    def bodies(self, group: str | None = None) -> DataFrame:
        """Section text next to its headers; a section of a large file comes in several rows."""
        parts = []
        if self._sections is not None:
            parts.append(self._sections if group is None else self._sections.where(F.col("group") == group))
        if self._split_files is not None:
            parts.append(self._split_files.bodies(group))
        return reduce(DataFrame.unionByName, [part.select(*pieces.SECTION_COLUMNS) for part in parts])

    # ------------------------------------------------------------------ reading

    def layout(self, group: str, temporal: bool = False) -> Layout:
        """The columns of a group, from the header records. Runs one small aggregate."""
        code = group.strip().upper()
        found = discover_layout(self.heads().where(F.col("group") == code), temporal)
        if found.columns:
            return found
        if not self.heads().where(F.col("group") == code).isEmpty():
            raise DeliveryError(f"group '{code}' has no HEADING record")
        order = F.min(F.struct("source", "pos")).alias("first")
        first = self.heads().groupBy("group").agg(order).orderBy("first").limit(LISTED_GROUPS + 1).collect()
        listed = ", ".join(row["group"] for row in first[:LISTED_GROUPS])
        more = ", and more" if len(first) > LISTED_GROUPS else ""
        raise DeliveryError(f"group '{code}' not found; the deliveries hold {listed or 'no groups'}{more}")

    def group(
        self,
        group: str,
        layout: Layout | None = None,
        allow_custom: bool = False,
        with_source: bool = False,
        temporal: bool = False,
        malformed: str = "error",
    ) -> DataFrame:
        """One group as a table ``_id, _parent_id, headings..., _content_hash``.

        Give ``layout`` if the columns are known already; it saves the pass that finds them.
        ``temporal`` parses ``DT`` headings as timestamps instead of leaving them text. ``malformed``
        says what becomes of lines that are not well-formed, see :func:`group_table`.
        """
        code = group.strip().upper()
        columns = layout or self.layout(code, temporal)
        spec = group_spec(self.dictionary, code, allow_custom)
        return group_table(self.bodies(code), columns, spec, with_source, malformed)

    def groups(self) -> DataFrame:
        return structure.groups_profile(self.heads(), self.dictionary)

    def headings(self) -> DataFrame:
        return structure.headings_profile(self.heads(), self.dictionary)

    def row_counts(self) -> DataFrame:
        return structure.row_counts(self.heads())

    def group_codes(self) -> list[str]:
        """The group codes present, in order of first appearance."""
        order = F.min(F.struct("source", "pos")).alias("first")
        return [row["group"] for row in self.heads().groupBy("group").agg(order).orderBy("first").collect()]

    def create_views(self, prefix: str = "ags_", allow_custom: bool = True) -> list[str]:
        """A temporary view per group that has headings, for use from SQL. One pass finds all layouts."""
        names = []
        for code, layout in discover_layouts(self.heads()).items():
            name = f"{prefix}{code.lower()}"
            self.group(code, layout, allow_custom=allow_custom).createOrReplaceTempView(name)
            names.append(name)
        return names


def read_group(spark: SparkSession, paths: str | Sequence[str], group: str, encoding: str | None = None,
               dictionary: DataFrame | None = None, section_file_bytes: int = pieces.SECTION_FILE_BYTES,
               max_file_bytes: int | None = None, **options) -> DataFrame:
    """One group of the deliveries at ``paths``, typed and keyed."""
    opened = Delivery.from_files(spark, paths, dictionary, encoding, section_file_bytes, max_file_bytes)
    return opened.group(group, **options)


def read_group_text(spark: SparkSession, content: str | DataFrame, group: str,
                    dictionary: DataFrame | None = None, **options) -> DataFrame:
    """One group of a delivery text, or of a DataFrame ``(doc_id, content)`` of texts."""
    if isinstance(content, str):
        return Delivery.from_text(spark, content, dictionary).group(group, **options)
    return Delivery.from_texts(content, dictionary=dictionary).group(group, **options)
