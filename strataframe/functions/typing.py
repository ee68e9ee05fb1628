"""Declared type codes, the column type each one gives, and lenient typed cells (as SQL)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from strataframe.functions.text import literal

# The four column types a heading can have, by Spark name and by SQL name.
SQL_NAMES = {"double": "DOUBLE", "bigint": "BIGINT", "boolean": "BOOLEAN", "string": "VARCHAR"}

# The type-code patterns and the column type of each; any other code is text.
INTEGER_CODE = "^0DP$"
DECIMAL_CODE = "^([1-9][0-9]*DP|[0-9]+SF|[0-9]+SCI)$"
BOOLEAN_CODE = "^YN$"
TEMPORAL_CODE = "^DT$"

# Which cells conform to the number types and to YN.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
TRUE_CELL, FALSE_CELL = "Y", "N"

# A heading beyond the end of its TYPE record is free text.
DEFAULT_CODE = "X"


def column_type(code: str) -> str:
    """The Spark type name of a declared type code."""
    if re.match(INTEGER_CODE, code):
        return "bigint"
    if re.match(DECIMAL_CODE, code):
        return "double"
    if re.match(BOOLEAN_CODE, code):
        return "boolean"
    return "string"


def column_type_sql(code: str, temporal: bool = False) -> str:
    """:func:`column_type` as an expression."""
    branches = [(INTEGER_CODE, "bigint"), (DECIMAL_CODE, "double"), (BOOLEAN_CODE, "boolean")]
    if temporal:
        branches.append((TEMPORAL_CODE, "timestamp"))
    cases = " ".join(f"when {code} rlike {literal(pattern)} then '{name}'" for pattern, name in branches)
    return f"case {cases} else 'string' end"


def sql_type_sql(code: str) -> str:
    pairs = ", ".join(f"'{spark_name}', '{sql_name}'" for spark_name, sql_name in SQL_NAMES.items())
    return f"element_at(map({pairs}), {column_type_sql(code)})"


def is_numeric_sql(code: str) -> str:
    return f"({code} rlike {literal(INTEGER_CODE)} or {code} rlike {literal(DECIMAL_CODE)})"


def merged_type(types: Iterable[str]) -> str:
    """The type of a heading that deliveries declare differently."""
    distinct = set(types)
    if len(distinct) == 1:
        return distinct.pop()
    return "double" if distinct == {"bigint", "double"} else "string"


def typed_cell(raw: str, spark_type: str) -> str:
    """``raw`` as ``spark_type``; a blank or non-conforming cell is NULL, never an error."""
    text = f"trim({raw})"
    if spark_type == "double":
        return f"case when {text} rlike {literal(NUMBER_PATTERN)} then try_cast({text} as double) end"
    if spark_type == "bigint":
        return f"case when {text} rlike {literal(INTEGER_PATTERN)} then try_cast({text} as bigint) end"
    if spark_type == "boolean":
        return f"case {text} when '{TRUE_CELL}' then true when '{FALSE_CELL}' then false end"
    if spark_type == "timestamp":
        return f"try_to_timestamp({text})"
    return f"case when {text} <> '' then {raw} end"
