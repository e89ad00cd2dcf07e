"""Table identifiers: parsing with a default schema, and quoting."""

from __future__ import annotations

import re

_PART = re.compile(r'\s*(?:"((?:[^"]|"")+)"|([^\W\d][\w$]*))\s*')


def qualify(name: str, default_schema: str) -> tuple[str, str]:
    """(schema, table) of ``table`` or ``schema.table``.

    Unquoted parts fold to lower case, double quotes keep a part as written. More than two
    parts raise.
    """
    parts, position = [], 0
    while True:
        match = _PART.match(name, position)
        if not match:
            raise ValueError(f"not a table identifier: {name!r}")
        quoted, plain = match.groups()
        parts.append(quoted.replace('""', '"') if quoted else plain.lower())
        position = match.end()
        if position == len(name):
            break
        if name[position] != ".":
            raise ValueError(f"not a table identifier: {name!r}")
        position += 1
    if len(parts) > 2:
        raise ValueError(f"expected table or schema.table, got {len(parts)} parts: {name!r}")
    return (default_schema, parts[0]) if len(parts) == 1 else (parts[0], parts[1])


def quote(*parts: str) -> str:
    """The parts as one catalog name in back ticks."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)
