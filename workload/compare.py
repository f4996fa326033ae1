"""Comparing rows of two engines."""

from __future__ import annotations


def canonical(names: list[str], rows) -> list[tuple]:
    """Rows as sorted tuples of plain values, columns by name."""
    order = sorted(range(len(names)), key=lambda i: names[i])

    def plain(value):
        if value is None:
            return "\0"  # not the empty string
        if isinstance(value, float):
            return f"{value:.9g}" if value else "0"
        return str(value)

    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


# Spark type -> type it must have in DuckDB.
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def same_types(ours: dict[str, str], theirs: dict[str, str]) -> bool:
    return all(TYPES.get(kind) == theirs[name] for name, kind in ours.items())
