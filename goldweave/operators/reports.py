"""Reports on normalization."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import present


Fields = dict[str, tuple[Column, Column]]


def reject_counts(fields: Fields) -> list[Column]:
    """Aggregates n_in, null_0, rejected_0, null_1, ... of raw and clean columns."""
    counts = [F.count(F.lit(1)).alias("n_in")]
    for i, (raw, clean) in enumerate(fields.values()):
        given = F.coalesce(present(raw), F.lit(False))
        counts += [
            F.count_if(~given).alias(f"null_{i}"),
            F.count_if(given & ~F.coalesce(present(clean), F.lit(False))).alias(f"rejected_{i}"),
        ]
    return counts


def reject_report(table: DataFrame, source: str, fields: Fields) -> DataFrame:
    """(field, source, n_in, n_null, n_rejected): how many values came in, were
    empty, and were dropped by the normalization. ``fields`` maps a field to its
    raw and its normalized column; one pass over the table counts them all."""
    lines = [
        f"named_struct('field', '{field}', 'source', '{source}', 'n_in', n_in, "
        f"'n_null', null_{i}, 'n_rejected', rejected_{i})"
        for i, field in enumerate(fields)
    ]
    return table.agg(*reject_counts(fields)).selectExpr(f"inline(array({', '.join(lines)}))")


class Watch:
    """The same counts beside the work: taken of rows on their way to the
    facts, known when the facts have been written."""

    def __init__(self) -> None:
        self.seen: list[tuple[str, list[str], Observation]] = []

    def over(self, rows: DataFrame, source: str, fields: Fields) -> DataFrame:
        seen = Observation()
        self.seen.append((source, list(fields), seen))
        return rows.observe(seen, *reject_counts(fields))

    def report(self) -> list[tuple[str, str, int, int, int]]:
        out = []
        for source, fields, seen in self.seen:
            found = seen.get
            out += [(f, source, found["n_in"], found[f"null_{i}"], found[f"rejected_{i}"]) for i, f in enumerate(fields)]
        return out


REJECTS = "field string, source string, n_in bigint, n_null bigint, n_rejected bigint"


def watched(rows: DataFrame, watch: Watch | None, source: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Count raw and clean columns by name, if there is a watch; the raw ones,
    named by the first of each pair, are dropped after it."""
    if watch is not None:
        rows = watch.over(rows, source, {f: (F.col(raw), F.col(clean)) for f, (raw, clean) in fields.items()})
    return rows.drop(*[raw for raw, _ in fields.values()])
