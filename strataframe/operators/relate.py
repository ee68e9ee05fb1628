"""Joins between groups. The keys line up by construction, so no key column is ever named."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.errors import DeliveryError
from strataframe.operators.dictionary import newest_parent
from strataframe.session import broadcast_if_small, cut_lineage


def join_parent(child: DataFrame, parent: DataFrame, child_name: str, parent_name: str,
                how: str = "inner") -> DataFrame:
    """Child rows with their parent rows; refer to columns as ``child_name.X``, ``parent_name.Y``.

    A plain equi-join: a parent with very many children is split at run time by Spark's skew join,
    rows without a parent are filtered out ahead of the shuffle.
    """
    return walk({child_name: child, parent_name: parent}, [child_name, parent_name], how)


def walk(groups: Mapping[str, DataFrame], path: Sequence[str], how: str = "inner") -> DataFrame:
    """Follow parent links upwards along ``path``, e.g. ``["LLPL", "SAMP", "LOCA"]``."""
    missing = [name for name in path if name not in groups]
    if missing:
        raise DeliveryError(f"no table given for {', '.join(missing)}")
    joined = groups[path[0]].alias(path[0])
    for lower, upper in pairwise(path):
        link = F.col(f"{lower}._parent_id") == F.col(f"{upper}._id")
        joined = joined.join(groups[upper].alias(upper), link, how)
    return joined


def hierarchy_path(dictionary: DataFrame, start: str, stop: str) -> list[str]:
    """The groups from ``start`` up to its ancestor ``stop``, read off the dictionary's edges."""
    path = [start]
    while path[-1] != stop:
        parent = newest_parent(dictionary, path[-1])
        if parent is None or parent in path:
            raise DeliveryError(f"'{stop}' is not an ancestor of '{start}'")
        path.append(parent)
    return path


def orphans(child: DataFrame, parent: DataFrame) -> DataFrame:
    """Child rows whose parent row is not there, rows without any parent id included.

    Rows without a parent id would all meet in one task; they are given a key of their own that
    matches nothing (ids start with a hexadecimal digit), which spreads them evenly.
    """
    key = F.coalesce(F.col("_parent_id"), F.concat(F.lit("-"), F.coalesce("_id", "_content_hash")))
    ids = parent.select(F.col("_id").alias("_known_id"))
    return child.withColumn("_key", key).join(ids, F.col("_key") == F.col("_known_id"), "left_anti").drop("_key")


def orphan_counts(child: DataFrame, parent: DataFrame) -> DataFrame:
    """Number of orphans in each source file (read the child ``with_source``)."""
    return orphans(child, parent).groupBy("_source_file").agg(F.count("*").alias("n_orphans"))


def edges(groups: Mapping[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """``(group, _id, parent_group, _parent_id)`` of keyed groups, each given with the code of its parent group."""
    tables = [
        df.select(F.lit(code).alias("group"), "_id", F.lit(parent).cast("string").alias("parent_group"), "_parent_id")
        for code, (df, parent) in groups.items()
    ]
    return reduce(DataFrame.unionAll, tables)


# An id in the form all keys of this library have, and the tags before the bytes of any other id.
_UUID = r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}\z"
_TAG, _LONG_TAG, _UUID_BYTES = b"\0", b"\1\1", 16


def packed(id_column: str) -> Column:
    """A text id in fewer bytes: a UUID in its 16, any other text behind a tag that keeps it from having 16 bytes."""
    value, raw = F.col(id_column), F.col(id_column).cast("binary")
    tagged = F.when(F.octet_length(value) == _UUID_BYTES - len(_TAG), F.concat(F.lit(_LONG_TAG), raw)).otherwise(F.concat(F.lit(_TAG), raw))
    return F.when(value.rlike(_UUID), F.unhex(F.translate(value, "-", ""))).otherwise(tagged).alias(id_column)


def unpacked(id_column: str) -> Column:
    """The text of a packed id."""
    value, digits = F.col(id_column), F.lower(F.hex(id_column))
    uuid = F.concat_ws("-", *[F.substring(digits, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    tag = F.when(F.substring(value, 1, 1) == F.lit(_TAG), F.lit(len(_TAG))).otherwise(F.lit(len(_LONG_TAG)))
    text = F.substring(value, tag + 1, F.octet_length(value)).cast("string")
    return F.when(F.octet_length(value) == _UUID_BYTES, uuid).otherwise(text).alias(id_column)


def ancestors(edge_table: DataFrame, keep_packed: bool = False) -> DataFrame:
    """All ancestors of every row: ``(group, _id, distance, ancestor_group, ancestor_id)``, from the edge table alone.

    Pointer doubling: once all ancestors up to distance n are known, those up to 2n come from one join, of the
    rows exactly n below an ancestor with that ancestor's own, so the number of joins is the logarithm of the
    depth. Links to rows that are not there and rows without id count for nothing, repeated rows once. A row that is
    its own ancestor is an error that names it.

    Only groups that are some row's parent group are doubled and stored. The rows of all others are joined once, with their
    parents' ancestors, when the result is read. Ids travel packed (:func:`packed`), and with ``keep_packed`` they come so, which
    serves where they are only counted or joined. The edge table is read once.
    """
    text = all(dict(edge_table.dtypes)[name] == "string" for name in ("_id", "_parent_id"))
    pack, unpack = (packed, unpacked) if text else (F.col, F.col)
    table = cut_lineage(edge_table.select("group", pack("_id"), "parent_group", pack("_parent_id"))).where("_id is not null")
    links = table.where("_parent_id is not null").select(
        "group", "_id", F.col("parent_group").alias("ancestor_group"), F.col("_parent_id").alias("ancestor_id"))
    # What reaches the driver is pairs of groups.
    pairs = table.where("_parent_id is not null").select("group", "parent_group").distinct().collect()
    parents = {r.parent_group for r in pairs if r.parent_group is not None}
    above_leaves = {r.parent_group for r in pairs if r.parent_group is not None and r["group"] not in parents}
    has_children = F.coalesce(F.col("group").isin(sorted(parents)), F.lit(False))
    nodes = table.where(has_children).select(F.col("group").alias("ancestor_group"), F.col("_id").alias("ancestor_id"))
    known = _doubled(links.where(has_children), nodes, unpack)
    if above_leaves:
        own = nodes.distinct().select(
            F.col("ancestor_group").alias("group"), F.col("ancestor_id").alias("_id"), F.lit(0).alias("distance"), "ancestor_group", "ancestor_id")
        upper = own.unionAll(known).where(F.col("group").isin(sorted(above_leaves)))
        known = known.unionAll(_below(links.where(~has_children), upper))
    return known if keep_packed else known.select("group", unpack("_id"), "distance", "ancestor_group", unpack("ancestor_id"))


def _doubled(links: DataFrame, nodes: DataFrame, unpack: Callable[[str], Column]) -> DataFrame:
    """All ancestors along ``links``, stored."""
    known = cut_lineage(links.distinct().join(nodes, ["ancestor_group", "ancestor_id"], "left_semi").select(
        "group", "_id", F.lit(1).alias("distance"), "ancestor_group", "ancestor_id"))
    reached = 1
    while True:
        _refuse_cycles(known, unpack)
        farthest = known.where(F.col("distance") == reached)
        groups = [r[0] for r in farthest.select("ancestor_group").distinct().collect()]
        if not groups:
            return known
        farther = cut_lineage(_joined(farthest, known.where(F.col("group").isin(groups))).distinct())
        if farther.isEmpty():
            return known
        known, reached = known.unionAll(farther), 2 * reached


def _joined(lower: DataFrame, upper: DataFrame) -> DataFrame:
    """The rows of ``lower`` with the ancestors of their ancestors."""
    further = upper.select(
        F.col("group").alias("ancestor_group"), F.col("_id").alias("ancestor_id"), F.col("distance").alias("_further"),
        F.col("ancestor_group").alias("_top_group"), F.col("ancestor_id").alias("_top_id"))
    return lower.join(broadcast_if_small(further), ["ancestor_group", "ancestor_id"]).select(
        "group", "_id", (F.col("distance") + F.col("_further")).alias("distance"),
        F.col("_top_group").alias("ancestor_group"), F.col("_top_id").alias("ancestor_id"))


def _below(leaves: DataFrame, upper: DataFrame) -> DataFrame:
    """All ancestors of rows that are nobody's parents: ``upper`` holds those of their parents, themselves at distance 0.

    A row with one link cannot meet an ancestor twice, so only the others (told by a hash, which may take a few too many) are made distinct.
    """
    leaves, named = leaves.withColumn("distance", F.lit(1)), F.xxhash64("group", "_id")
    repeated = cut_lineage(leaves.groupBy(named.alias("_h")).count().where("count > 1").select("_h"))
    if repeated.isEmpty():
        return _joined(leaves, upper)
    repeated = broadcast_if_small(repeated)
    several = cut_lineage(leaves.join(repeated, named == F.col("_h"), "left_semi").distinct())
    once = leaves.join(repeated, named == F.col("_h"), "left_anti")
    return _joined(once, upper).unionAll(_joined(broadcast_if_small(several), upper).distinct())


def _refuse_cycles(known: DataFrame, unpack: Callable[[str], Column]) -> None:
    own = known.where((F.col("group") == F.col("ancestor_group")) & (F.col("_id") == F.col("ancestor_id"))).select("group", unpack("_id")).first()
    if own is not None:
        raise DeliveryError(f"row {own['_id']} of group '{own['group']}' is its own ancestor")
