"""One group of a delivery as a typed, keyed table.

The column list is fixed when the plan is built, from a small aggregate over the header records
(:func:`discover_layout`). Everything else is one projection per row: the header-dependent part
(where each heading sits, how its cells enter the content key) is worked out once per section, the
row-dependent part once per line.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.errors import DeliveryError
from strataframe.functions import keys, text, typing
from strataframe.operators.dictionary import GroupSpec


# What to do with a line that is not well-formed.
MALFORMED = ("error", "null")


@dataclass(frozen=True)
class Layout:
    """The headings of a group, in file order, with their Spark types."""

    columns: tuple[tuple[str, str], ...]

    @classmethod
    def of(cls, **columns: str) -> Layout:
        """A layout from declared type codes: ``Layout.of(LOCA_ID="ID", LOCA_GL="2DP")``."""
        return cls(tuple((name, typing.column_type(code)) for name, code in columns.items()))

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]


def discover_layout(heads: DataFrame, temporal: bool = False) -> Layout:
    """Headings and types over all sections of one group, merged by name."""
    return next(iter(discover_layouts(heads.withColumn("group", F.lit("")), temporal).values()), Layout(()))


def discover_layouts(heads: DataFrame, temporal: bool = False) -> dict[str, Layout]:
    """The layout of every group in ``heads``, groups in order of first appearance if ``pos`` is there.

    One aggregate, whose result has a row per distinct group, heading and type, whatever the number of
    files. Headings of a section that are equal but for case are an error, as their cells could not be
    told apart.
    """
    columns = heads.columns
    source = "source" if "source" in columns else "'the delivery'"
    first = "struct(source, pos)" if "source" in columns and "pos" in columns else "0"
    named = "filter(headings, h -> h <> '')"
    twice = f"size(array_distinct(transform({named}, h -> upper(h)))) < size({named})"
    found = (
        heads.selectExpr("group", "posexplode(headings) as (ordinal, heading)", "types",
                         f"if({twice}, {source}, null) as twice", f"{first} as first")
        .where("heading <> ''")
        .selectExpr("*", f"coalesce(get(types, ordinal), '{typing.DEFAULT_CODE}') as code")
        .selectExpr("*", f"{typing.column_type_sql('code', temporal)} as type")
        .groupBy("group", "heading", "type")
        .agg(F.min("ordinal").alias("ordinal"), F.min("twice").alias("twice"), F.min("first").alias("first"))
        .collect()
    )
    layouts: dict[str, dict[str, tuple[int, set[str]]]] = {}
    for row in sorted(found, key=lambda row: row.first):
        if row.twice is not None:
            raise DeliveryError(f"{row.twice}: a heading of group '{row.group}' occurs twice (case aside)")
        merged = layouts.setdefault(row.group, {})
        ordinal, types = merged.get(row.heading, (row.ordinal, set()))
        merged[row.heading] = (min(ordinal, row.ordinal), types | {row.type})
    return {group: _merged_layout(group, merged) for group, merged in layouts.items()}


def _merged_layout(group: str, merged: dict[str, tuple[int, set[str]]]) -> Layout:
    if len({heading.upper() for heading in merged}) < len(merged):
        raise DeliveryError(f"the files spell a heading of group '{group}' in several ways: {', '.join(sorted(merged))}")
    order = sorted(merged, key=lambda heading: (merged[heading][0], heading))
    return Layout(tuple((heading, typing.merged_type(merged[heading][1])) for heading in order))


# Where heading ``h`` stands in a section; -1 if it does not, and ``get`` gives NULL for that.
PLACE = "cast(array_position(headings, h) as int) - 1"


def _section_plan(names: Sequence[str]) -> tuple[str, str]:
    """Per section: the place of each heading, and its content-key prefix."""
    wanted = f"array({', '.join(map(text.literal, names))})"
    unit, code = (f"coalesce(get({array}, {PLACE}), '')" for array in ("units", "types"))
    prefix = keys.concat(*map(keys.element, ("h", unit, code)))
    hashing = f"named_struct('prefix', {prefix}, 'numeric', {typing.is_numeric_sql(code)})"
    return f"transform({wanted}, h -> {PLACE})", f"transform({wanted}, h -> {hashing})"


# Every heading's cell as it enters the content key, and what it adds; NULL for a blank cell.
SHOWN_CELLS = f"""
    zip_with(hashing, transform(places, place -> get(cells, place)),
             (plan, value) -> if(plan.numeric, {keys.canonical_number('value')}, value))"""
ENCODED_CELLS = f"""
    zip_with(hashing, shown, (plan, value) -> if(trim(value) <> '', concat(plan.prefix, {keys.element('value')}), null))"""


def group_table(
    bodies: DataFrame,
    layout: Layout,
    spec: GroupSpec,
    with_source: bool = False,
    malformed: str = "error",
) -> DataFrame:
    """``_id, _parent_id``, the typed headings, ``_content_hash`` for one group's sections.

    A line that is not made of quoted cells is an error that names its file. With ``malformed="null"``
    such a DATA line stays: cells without quotes are NULL, the others keep their headings, and
    ``_malformed`` marks it; any other such line is an error all the same.
    """
    if malformed not in MALFORMED:
        raise DeliveryError(f"malformed is one of {', '.join(MALFORMED)}")
    in_name_order = sorted(layout.names)
    # A KEY heading of the dictionary need not be among the headings the files carry.
    index = {name.upper(): i for i, name in enumerate(in_name_order)}
    places, hashing = _section_plan(in_name_order)
    # The plan columns come in a projection of their own: next to the explode they would be
    # computed once per line instead of once per section.
    sections = bodies.selectExpr("source", f"{places} as places", f"{hashing} as hashing", "body")
    lines = sections.selectExpr("source", "places", "hashing", f"explode({text.row_lines('body')}) as line")
    sound, values = text.well_formed("line"), text.values("line")
    lenient = malformed == "null"
    kept = f"startswith(trim(line), {text.literal(text.DATA_MARK)})" if lenient else "false"
    message = "concat('malformed line in ', source, ': ', left(line, 200))"
    lines = lines.where(f"if({sound} or {kept}, true, raise_error({message}) is null)")
    rows = lines.selectExpr(
        "source", "places", "hashing", "line", *([f"not {sound} as _malformed"] if lenient else []),
        f"{f'if({sound}, {values}, {text.placed_cells('line')})' if lenient else values} as cells",
    )
    rows = rows.selectExpr("*", f"{SHOWN_CELLS} as shown")

    def raw(name: str) -> str:
        return f"get(cells, get(places, {index[name.upper()]}))"

    def own_key(name: str) -> str:
        return raw(name) if name.upper() in index else "''"

    def carried_key(name: str) -> tuple[str, str] | None:
        if name.upper() not in index:
            return None
        # Naming the line keeps a filter on this condition with the rows: pushed down to the sections
        # it would have their headers taken apart twice.
        return raw(name), f"if(length(line) > 0, get(places, {index[name.upper()]}) >= 0, false)"

    keyed = keys.with_uuids(
        rows,
        _id=keys.identity(spec.group, [own_key(k) for k in spec.keys]) if spec.known else keys.NO_KEY,
        _parent_id=keys.parent_identity(spec.parent, [carried_key(k) for k in spec.parent_keys]),
        _content_hash=keys.content_from(spec.group, ENCODED_CELLS),
    )
    return keyed.selectExpr(
        *(["source as _source_file"] if with_source else []),
        "_id",
        "_parent_id",
        *[f"{typing.typed_cell(raw(name), kind)} as {text.name(name)}" for name, kind in layout.columns],
        "_content_hash",
        *(["_malformed"] if lenient else []),
    )


def keyed_table(df: DataFrame, spec: GroupSpec, headings: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Keys for rows that are already columns: ``headings`` lists (name, unit, type code).

    Every listed column holds raw text; the result has the same shape as :func:`group_table`.
    """
    raw = {name: text.name(name) for name, _, _ in headings}
    missing = [key for key in spec.keys if key not in raw]
    if missing:
        raise DeliveryError(f"group '{spec.group}' needs its KEY headings {', '.join(missing)}")
    # Numbers in canonical text, each made once per row.
    shown = {n: f"_shown_{i}" if typing.column_type(c) in ("bigint", "double") else raw[n] for i, (n, _, c) in enumerate(headings)}
    numbers = {column: F.expr(keys.canonical_number(raw[n])) for n, column in shown.items() if column != raw[n]}
    keyed = keys.with_uuids(
        df.withColumns(numbers) if numbers else df,
        _id=keys.identity(spec.group, [raw[k] for k in spec.keys]),
        _parent_id=keys.parent_identity(spec.parent, [(raw[k], "true") if k in raw else None for k in spec.parent_keys]),
        _content_hash=keys.content(spec.group, [(n, u, c, shown[n]) for n, u, c in headings]),
    )
    return keyed.selectExpr(
        "_id",
        "_parent_id",
        *[f"{typing.typed_cell(raw[n], typing.column_type(code))} as {raw[n]}" for n, _, code in headings],
        "_content_hash",
    )
