"""Deterministic row keys, as SQL expressions.

Three keys, each a version-8 UUID made from the SHA-256 of a preimage:

* identity: the group code and the row's KEY values as raw text;
* parent identity: the same preimage over the parent's code and the parent's KEY values, which a
  child row carries itself, so the two sides agree without any lookup;
* content: the group code and, in heading order, every non-blank cell with its unit and type.

Every element of a preimage is written as ``length:value,`` so that no value can imitate a
separator. Numbers enter the content preimage as canonical text (``100.50`` and ``100.5`` agree);
they are never parsed, so no digit is lost.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.functions.text import literal

# The first element of each kind of preimage.
IDENTITY_KIND, CONTENT_KIND = "id", "row"
PLAIN_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"


def fixed(value: str) -> str:
    """A preimage element known when the plan is built."""
    return literal(f"{len(value)}:{value},")


def element(value: str) -> str:
    return f"concat(length({value}), ':', {value}, ',')"


def concat(*parts: str) -> str:
    return f"concat({', '.join(parts)})"


def uuid_sql(digest: str) -> str:
    """A SHA-256 in hexadecimal as a UUID: version nibble 8, variant bits 10."""
    variant = f"translate(substring({digest}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab')"
    return (
        f"concat(substring({digest}, 1, 8), '-', substring({digest}, 9, 4), '-8', substring({digest}, 14, 3), "
        f"'-', {variant}, substring({digest}, 18, 3), '-', substring({digest}, 21, 12))"
    )


@dataclass(frozen=True)
class Key:
    """A key to be made: its preimage (never NULL), and the condition under which there is one."""

    preimage: str
    condition: str = "true"


NO_KEY = Key("''", "false")


def with_uuids(df: DataFrame, **keys: Key) -> DataFrame:
    """Add one UUID column per key, in two projections.

    Each digest gets a column first, so that it is made only once per row. Digests are declared
    non-NULL and the condition is kept apart, so that the ``IS NOT NULL`` filter Spark derives from
    a join on a key comes down to the condition and never hashes a row twice.
    """
    digests = {name: F.expr(f"coalesce(sha2({key.preimage}, 256), '')") for name, key in keys.items()}
    conditions = {f"{name}_known": F.expr(key.condition) for name, key in keys.items()}
    uuids = {name: F.expr(f"if({name}_known, {uuid_sql(name)}, null)") for name in keys}
    return df.withColumns({**digests, **conditions}).withColumns(uuids).drop(*conditions)


def identity(group: str, key_values: Sequence[str]) -> Key:
    """Row id from KEY values in dictionary order. A blank or missing value counts as ''."""
    elements = [element(f"coalesce({value}, '')") for value in key_values]
    return Key(concat(fixed(IDENTITY_KIND), fixed(group), *elements))


def parent_identity(parent: str | None, key_values: Sequence[tuple[str, str] | None]) -> Key:
    """The parent's row id, seen from the child: ``(value, condition)`` per KEY heading of the parent.

    A ``None`` entry is a heading no child row carries; a condition tells whether this row's file
    carries it. Where one is missing the link cannot be resolved and the id is NULL.
    """
    if parent is None or not key_values or any(entry is None for entry in key_values):
        return NO_KEY
    elements = [element(f"coalesce({value}, '')") for value, _ in key_values]
    conditions = sorted({condition for _, condition in key_values})
    return Key(concat(fixed(IDENTITY_KIND), fixed(parent), *elements), " and ".join(conditions))


def canonical_number(value: str) -> str:
    """A plain decimal number as canonical text; anything else unchanged. ``value`` should be a column."""
    text = f"trim({value})"
    digits = f"ltrim('+-0', if(contains({text}, '.'), rtrim('.', rtrim('0', {text})), {text}))"
    sign = f"if(startswith({text}, '-') and {digits} <> '', '-', '')"
    zero = f"if({digits} = '' or startswith({digits}, '.'), '0', '')"
    return f"if({text} rlike {literal(PLAIN_NUMBER)}, concat({sign}, {zero}, {digits}), {value})"


def content_from(group: str, cells: str) -> Key:
    """Content key from an array of encoded cells in heading order; NULL entries are blank cells."""
    return Key(concat(fixed(CONTENT_KIND), fixed(group), f"array_join({cells}, '')"))


def content(group: str, columns: Sequence[tuple[str, str, str, str]]) -> Key:
    """Content key of a row given as ``(heading, unit, type code, shown text)`` entries.

    The text of a number is to be canonical already.
    """
    encoded = []
    for heading, unit, code, value in sorted(columns, key=lambda entry: entry[0]):
        prefix = literal("".join(f"{len(part)}:{part}," for part in (heading, unit, code)))
        encoded.append(f"if(trim({value}) <> '', concat({prefix}, {element(value)}), '')")
    return Key(concat(fixed(CONTENT_KIND), fixed(group), *encoded))
