"""Row keys in SQL, for the oracle side of the checks."""

from __future__ import annotations


def element(expression: str) -> str:
    return f"length({expression})::varchar || ':' || ({expression}) || ','"


def literal(value: str) -> str:
    return "'" + f"{len(value)}:{value},".replace("'", "''") + "'"


def uuid(preimage: str) -> str:
    digest = f"sha256({preimage})"
    return (
        f"substr({digest},1,8) || '-' || substr({digest},9,4) || '-8' || substr({digest},14,3) || '-' || "
        f"translate(substr({digest},17,1),'0123456789abcdef','89ab89ab89ab89ab') || substr({digest},18,3) "
        f"|| '-' || substr({digest},21,12)"
    )


def identity(group: str, *keys: str) -> str:
    return uuid(" || ".join([literal("id"), literal(group), *[element(key) for key in keys]]))


def canonical(expression: str) -> str:
    """Canonical text of a plain decimal number."""
    bare = f"ltrim(rtrim(rtrim(ltrim({expression}, '+-'), '0'), '.'), '0')"
    whole = f"case when {bare} = '' or starts_with({bare}, '.') then '0' || {bare} else {bare} end"
    return f"case when starts_with({expression}, '-') and ({whole}) <> '0' then '-' || ({whole}) else {whole} end"


def content(group: str, *cells: tuple[str, str, str, str]) -> str:
    """Content key from (heading, unit, type, value) cells; numbers must have a decimal point."""
    parts = [literal("row"), literal(group)]
    for heading, unit, code, value in sorted(cells):
        shown = canonical(value) if code == "2DP" else value
        prefix = literal(heading) + " || " + literal(unit) + " || " + literal(code)
        parts.append(f"case when trim({value}) <> '' then {prefix} || {element(shown)} else '' end")
    return uuid(" || ".join(parts))


def money(column: str) -> str:
    return f"cast(cast({column} as decimal(18,2)) as varchar)"
