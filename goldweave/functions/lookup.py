"""Small fixed dictionaries as literals, so that a lookup needs no join."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, int):
        return str(value)
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def literal_map(entries: dict[str, object]) -> Column:
    """A map literal, written as one SQL expression: building it from single
    literals would cost a round trip to the JVM for each."""
    return F.expr("map(" + ", ".join(sql_literal(x) for pair in entries.items() for x in pair) + ")")
