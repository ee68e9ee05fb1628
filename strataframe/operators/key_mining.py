"""Keys and parents of groups that no dictionary describes, mined from the rows themselves.

A key is a smallest set of headings that no two rows share and no row leaves blank, searched level by level:
sets of one heading, of two, and so on. A set can only be unique if the numbers of different values of its
headings multiply to the number of rows, and estimates of its own number of values must come near it; one
aggregate per level makes all of a group's estimates, and only sets that pass are counted exactly.

The parent of a group is one whose key headings it carries under the same names, with no value that the
parent does not have. The inclusions in one parent come from one job over hashed values.
Values travel as 128-bit hashes. What reaches the driver is counts per heading, set or pair of groups.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations
from math import prod
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.functions.typing import column_type
from strataframe.session import BROADCAST_ROWS, broadcast_if_small, cut_lineage, local_table

ID_CODE = "ID"  # the type of identifiers, preferred in keys
MOST_HEADINGS = 6
# A unique set's estimated number of values is this share of the rows at least (three times the estimate's error).
NEAR = 0.85
RSD = 0.05
SETS_AT_ONCE = 64
# A set is refuted by one of this many parts of its values, if that holds a repeat.
FIRST_PARTS = 64
WORD_BITS = 60
MINED_SCHEMA = "group string, parent string, heading string, status string, ags_type string, ordinal long"


@dataclass(frozen=True)
class Heading:
    name: str
    code: str
    ordinal: int

    @property
    def may_be_key(self) -> bool:
        """Measured values are no names of things, even if no two happen to be equal."""
        return column_type(self.code) != "double"


def _hashes(names: Sequence[str]) -> Column:
    values = [F.col(f"`{n}`").cast("string") for n in names]
    return F.struct(F.xxhash64(*values), F.xxhash64(F.lit("other"), *values))


def _near_unique(rows: DataFrame, sets: Sequence[tuple[str, ...]], n_rows: int) -> tuple[list[tuple[str, ...]], dict]:
    """The sets whose estimated number of values comes near the rows, and all estimates."""
    estimates = {}
    for k in range(0, len(sets), SETS_AT_ONCE):
        part = sets[k : k + SETS_AT_ONCE]
        found = rows.agg(*[F.approx_count_distinct(_hashes(s), RSD).alias(f"_{i}") for i, s in enumerate(part)]).first()
        estimates |= dict(zip(part, found))
    return [s for s in sets if estimates[s] >= NEAR * n_rows], estimates


def _is_unique(rows: DataFrame, names: Sequence[str]) -> bool:
    """Whether no two rows share the values of ``names``, counted exactly.

    A repeat among the values in one of ``FIRST_PARTS`` parts settles it. Without one all are counted, by a hash of 8 bytes first;
    only where those repeat do both hashes count.
    """
    whole = rows.select(_hashes(names).alias("h"))
    short = F.col("h.col1")
    first = whole.where(F.pmod(short, F.lit(FIRST_PARTS)) == 0)
    if not first.groupBy("h").count().where("count > 1").isEmpty():
        return False
    repeats = repeated_hashes(whole, short)
    if repeats.isEmpty():
        return True
    alike = whole.join(broadcast_if_small(repeats), short == F.col("_repeated"), "left_semi")
    return alike.groupBy("h").count().where("count > 1").isEmpty()


def repeated_hashes(rows: DataFrame, value: Column) -> DataFrame:
    """``_repeated``: the values of a hash that more than one row has. Stored."""
    return cut_lineage(rows.groupBy(value.alias("_repeated")).count().where("count > 1").select("_repeated"))


def distinct_rows(rows: DataFrame) -> DataFrame:
    """The different rows of a stored table. Only rows whose hash repeats are compared whole."""
    value = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    repeats = repeated_hashes(rows, value)
    n_repeats = repeats.limit(BROADCAST_ROWS + 1).count()
    if not n_repeats:
        return rows
    if n_repeats > BROADCAST_ROWS:
        return cut_lineage(rows.distinct())
    repeats = F.broadcast(repeats)
    several = rows.join(repeats, value == F.col("_repeated"), "left_semi").distinct()
    return cut_lineage(rows.join(repeats, value == F.col("_repeated"), "left_anti").unionAll(several))


def mine_key(rows: DataFrame, headings: Sequence[Heading], most: int = MOST_HEADINGS) -> tuple[str, ...]:
    """The smallest unique set of a group's headings, () if there is none of ``most`` headings or fewer.

    Of several of one size that with most identifiers is taken, then that with the first headings. A heading with a
    blank cell is in no key. Without rows there is no key.
    """
    wanted = [h for h in headings if h.may_be_key]
    if not wanted:
        return ()
    counts = rows.agg(F.count("*").alias("_n"), *[F.count(f"`{h.name}`").alias(f"_{i}") for i, h in enumerate(wanted)]).first()
    n_rows = counts["_n"]
    full = [h for i, h in enumerate(wanted) if counts[f"_{i}"] == n_rows]
    if not n_rows or not full:
        return ()
    by_name, sizes = {h.name: h for h in full}, {}
    for size in range(1, min(most, len(full)) + 1):
        sets = list(combinations([h.name for h in full], size))
        if size > 1:  # more values than the product of its headings' a set cannot have
            sets = [s for s in sets if prod(sizes[(n,)] for n in s) >= NEAR**size * n_rows]
        near, estimates = _near_unique(rows, sets, n_rows)
        if size == 1:
            sizes = estimates
        # In the order of preference, so that the first unique set is the key.
        for chosen in sorted(near, key=lambda s: (-sum(by_name[n].code == ID_CODE for n in s), [by_name[n].ordinal for n in s])):
            if _is_unique(rows, chosen):
                return chosen
    return ()


def _blank(key: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(f"`{k}`").isNull() for k in key])


def _with_bits(mask: int) -> Column:
    return F.count(F.when(F.col("bits").bitwiseAND(F.lit(mask)) == mask, 1))


class Inclusion(NamedTuple):
    """How many different values of a parent's key a member holds, and how many of them the parent has."""

    parent: str
    member: str
    n: int
    known: int


def mine_parents(groups: Mapping[str, DataFrame], keys: Mapping[str, tuple[str, ...]]) -> dict[str, str]:
    """The parent of each group that has one.

    Of several the one counts whose key is part of the group's own key, then that with more key headings, then with more
    values in the group, then the smaller code. Rows with a blank cell in a link are no evidence against it.
    """
    counted = []
    for parent, key in keys.items():
        lower = [k.lower() for k in key]
        members = [m for m, rows in groups.items() if m != parent and key and set(key) != set(keys.get(m, ()))
                   and {c.lower() for c in rows.columns}.issuperset(lower)]
        # Each value says in bits which groups hold it; a parent's own bit is the first of each word.
        for k in range(0, len(members), WORD_BITS):
            part = [parent, *members[k : k + WORD_BITS]]
            held = [groups[m].where(~_blank(key)).select(_hashes(key).alias("h"), F.lit(1 << i).cast("long").alias("bits")) for i, m in enumerate(part)]
            bits = reduce(DataFrame.unionAll, held).groupBy("h").agg(F.bit_or("bits").alias("bits"))
            counts = bits.agg(*[c for i in range(1, len(part)) for c in (_with_bits(1 << i), _with_bits(1 << i | 1))]).first()
            counted += [(parent, m, counts[2 * i], counts[2 * i + 1]) for i, m in enumerate(part[1:])]
    # All values of the member's that there are, and those that the parent has.
    included = [Inclusion(*c) for c in counted if c[2] and c[2] == c[3]]
    best: dict[str, tuple] = {}
    for row in included:
        own, key = set(keys.get(row.member, ())), keys[row.parent]
        rank = (not own.issuperset(key), -len(key), -row.n, row.parent)
        best[row.member] = min(best.get(row.member, rank), rank)
    return {member: rank[-1] for member, rank in best.items()}


def mine_keys(groups: Mapping[str, DataFrame], headings: DataFrame, most: int = MOST_HEADINGS) -> DataFrame:
    """``(group, parent, heading, status, ags_type, ordinal)`` mined from the typed rows of ``groups``.

    ``headings`` is the output of :func:`strataframe.operators.structure.headings_profile` for the same deliveries; of
    several types of a heading the smallest counts. ``status`` is KEY or OTHER. Rows may repeat: each different row counts once.
    """
    listed = headings.where(F.col("group").isin(list(groups))).groupBy("group", "heading").agg(
        F.min("ags_type").alias("code"), F.min("ordinal").alias("ordinal")).collect()
    of = {g: sorted((Heading(r.heading, r.code, r.ordinal) for r in listed if r["group"] == g), key=lambda h: (h.ordinal, h.name)) for g in groups}
    rows = {g: distinct_rows(cut_lineage(df.select(*[f"`{h.name}`" for h in of[g]]))) for g, df in groups.items() if of[g]}
    keys = {g: mine_key(df, of[g], most) for g, df in rows.items()}
    parents = mine_parents(rows, keys)
    mined = [
        (g, parents.get(g), h.name, "KEY" if h.name in keys[g] else "OTHER", h.code, h.ordinal) for g in rows for h in of[g]
    ]
    return local_table(next(iter(groups.values())).sparkSession, mined, MINED_SCHEMA)
