"""From one wide source record to its tagged facts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import EXPERIENCE_TYPE, FACT_COLUMNS
from ..functions import Rules
from ..functions.lookup import sql_literal


@dataclass(frozen=True)
class Reading:
    """One fact a source record may yield; an empty column yields none.

    ``columns`` is the column of the value, or company and title of a job.
    """

    field: str
    method: str
    confidence_milli: int
    columns: tuple[str, ...]

    def usable(self) -> str:
        return "(" + " AND ".join(f"coalesce({c} <> '', false)" for c in self.columns) + ")"


def facts_of(
    records: DataFrame, source: str, source_ord: int, readings: list[Reading], blocked: str | None = None
) -> DataFrame:
    """Unpivot records to facts; a record with no fact leaves one marker row.

    The marker (field is null) keeps the person on the list of candidates, so
    no separate list has to be shuffled and joined later. Records whose
    ``blocked`` column is true count as having no fact. The array has a fixed
    length and stays inside generated code: one Generate and one Filter.
    """
    allowed = f"NOT {blocked} AND " if blocked else ""
    slots = []
    for i, r in enumerate(readings):
        if len(r.columns) == 1:
            value, exp = r.columns[0], f"CAST(NULL AS {EXPERIENCE_TYPE})"
        else:
            company, title = r.columns
            value = "CAST(NULL AS STRING)"
            exp = (
                f"CAST(named_struct('company', {company}, 'title', {title}, 'start', NULL, 'end', NULL, "
                f"'summary', '') AS {EXPERIENCE_TYPE})"
            )
        slots.append(
            f"named_struct('keep', {allowed}{r.usable()}, 'field', {sql_literal(r.field)}, 'value', {value}, "
            f"'exp', {exp}, 'method', {sql_literal(r.method)}, 'confidence_milli', {r.confidence_milli}, 'emit_ord', {i})"
        )
    any_usable = f"{allowed}({' OR '.join(r.usable() for r in readings)})"
    slots.append(
        f"named_struct('keep', NOT ({any_usable}), 'field', NULL, 'value', NULL, 'exp', NULL, 'method', NULL, "
        "'confidence_milli', NULL, 'emit_ord', NULL)"
    )
    return (
        records.selectExpr("candidate_id", "record_ord", f"inline(array({', '.join(slots)}))")
        .filter("keep")
        .selectExpr(*[
            f"{sql_literal(source)} AS source" if c == "source"
            else f"{source_ord} AS source_ord" if c == "source_ord"
            else c
            for c in FACT_COLUMNS
        ])
    )


def as_facts(table: DataFrame, rules: Rules, source_ord: int) -> DataFrame:
    """A table of facts in the fact schema. What it need not say is filled in:
    the prior of its field and source, method, arrival order."""
    have = set(table.columns)
    filled = {
        "value": F.lit(None).cast("string"), "exp": F.lit(None).cast(EXPERIENCE_TYPE), "method": F.lit("direct"),
        "source_ord": F.lit(source_ord), "record_ord": F.lit(0).cast("bigint"), "emit_ord": F.lit(0),
    }
    given = F.col("confidence_milli") if "confidence_milli" in have else F.lit(None).cast("int")
    prior = F.when(F.col("field").isNotNull(), rules.prior_of(F.col("field"), F.col("source")))
    return table.select(*[
        F.coalesce(given, prior).cast("int").alias(c) if c == "confidence_milli"
        else F.col(c) if c in have else filled[c].alias(c)
        for c in FACT_COLUMNS
    ])


def without_markers(facts: DataFrame) -> DataFrame:
    return facts.filter(F.col("field").isNotNull())
