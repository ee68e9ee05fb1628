"""SQL expressions over delivery text: quoted cells, header lines, row lines.

Like the other modules of this package these functions return Spark SQL text, for ``F.expr`` and
``selectExpr``. A long expression then costs one call into the JVM instead of one per node.
"""

from __future__ import annotations

# Fixed values of the text format.
GROUP_MARK = '"GROUP",'
DATA_MARK = '"DATA"'
HEADER_TAGS = ("HEADING", "UNIT", "TYPE")
KNOWN_TAGS = ("GROUP", "HEADING", "UNIT", "TYPE", "DATA")
# One quoted cell. The possessive quantifiers keep Java's matcher iterative, so a long cell or one
# with many doubled quotes cannot overflow the stack.
CELL_PATTERN = r'"([^"]*+(?:""[^"]*+)*+)"'
# A whole well-formed line: quoted cells separated by commas, nothing else.
LINE_PATTERN = r'^"[^"]*+(?:""[^"]*+)*+"(?:,"[^"]*+(?:""[^"]*+)*+")*+$'
# One cell of a line that is not well-formed, with the comma behind it; cells follow each other without a gap.
PLACED_CELL = r'\G(?:"[^"]*+(?:""[^"]*+)*+"|[^,"]*+)(?:,|$)'
# A record that belongs in front of a section, not at its start: a tag and a cell that says something.
# A group may be called like a tag, and its GROUP line may be padded with blank cells.
STRAY_RECORD = '^"(?:' + "|".join(KNOWN_TAGS) + ')",[^\\r\\n]*[^",\\s]'
BYTE_ORDER_MARK = "\ufeff"
# More cells than a line can have. `slice` adds it to its start, so it stays well below 2^31.
ALL = 10**9


def literal(value: str) -> str:
    """A Spark SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\r", "\\r")
    return f"'{escaped}'"


def name(column: str) -> str:
    """A column name, quoted."""
    return "`" + column.replace("`", "``") + "`"


def cells(line: str) -> str:
    """The unquoted cells of one line, record tag first."""
    found = f"regexp_extract_all({line}, {literal(CELL_PATTERN)}, 1)"
    return f"""transform({found}, cell -> replace(cell, '""', '"'))"""


def values(line: str) -> str:
    """The cells of one line after its record tag."""
    return f"slice({cells(line)}, 2, {ALL})"


def rest(body: str) -> str:
    """Section text behind its GROUP line, so that a group's code is never taken for a record tag."""
    return f"substring({body}, length({first_line(body)}) + 2)"


def header_line(body: str, tag: str) -> str:
    """The first line with ``tag`` in front of the first DATA line; '' when there is none."""
    body = f"substring_index(concat('\\n', {body}), {literal(chr(10) + DATA_MARK)}, 1)"
    pattern = f'(?:^|\n)("{tag}"[^\r\n]*)'
    return f"regexp_extract({body}, {literal(pattern)}, 1)"


def header_cells(body: str, tag: str) -> str:
    return values(header_line(body, tag))


def after_group_mark(text: str) -> str:
    """Section text from the group code on, whether or not the mark is still in front of it."""
    clean = f"ltrim({literal(BYTE_ORDER_MARK)}, {text})"
    mark = literal(GROUP_MARK)
    return f"if(startswith({clean}, {mark}), substring({clean}, {len(GROUP_MARK) + 1}), {clean})"


def first_line(text: str) -> str:
    return f"substring_index({text}, '\\n', 1)"


def group_code(body: str) -> str:
    """The group code of a section whose text starts at the code's own opening quote."""
    pattern = '^"([^"\r\n]*)"'
    return f"regexp_extract({body}, {literal(pattern)}, 1)"


def lines(body: str) -> str:
    """The lines of a piece of text as an array, both line endings accepted."""
    return f"transform(split({body}, '\\n'), line -> rtrim('\\r', line))"


def well_formed(line: str) -> str:
    return f"rtrim('\\r', {line}) rlike {literal(LINE_PATTERN)}"


def row_lines(body: str) -> str:
    """The DATA lines of a section, and every line that is neither blank nor well-formed."""
    wanted = f"startswith(line, {literal(DATA_MARK)}) or not (trim(line) in ('', '\\r') or {well_formed('line')})"
    return f"filter(split({body}, '\\n'), line -> {wanted})"


def placed_cells(line: str) -> str:
    """The cells of a malformed line, each in its place. A cell without quotes is NULL, and so is
    everything from an open quote on."""
    found = f"regexp_extract_all(trim(rtrim('\\r', {line})), {literal(PLACED_CELL)}, 0)"
    bare = "regexp_replace(cell, ',$', '')"
    unquoted = f"""replace(substring({bare}, 2, length({bare}) - 2), '""', '"')"""
    return f"""slice(transform({found}, cell -> if(startswith(cell, '"'), {unquoted}, null)), 2, {ALL})"""


def data_count(body: str) -> str:
    """How many DATA lines a section has, counted without taking the text apart."""
    pattern = f"(?:^|\n){DATA_MARK}"
    return f"cast(regexp_count({body}, {literal(pattern)}) as long)"


def quoted(value: str) -> str:
    """One value as a quoted cell; NULL becomes the blank cell."""
    return f"""concat('"', replace(coalesce(cast({value} as string), ''), '"', '""'), '"')"""


def record(tag: str, *values: str) -> str:
    """One line of delivery text."""
    return f"concat_ws(',', {', '.join([literal(chr(34) + tag + chr(34)), *map(quoted, values)])})"
