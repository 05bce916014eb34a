"""Priors, priorities and confidences in whole thousandths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (
    DEFAULT_PRIOR_MILLI,
    PRIOR_MILLI,
    SOURCE_PRIORITY,
    UNKNOWN_PRIORITY,
)
from .lookup import literal_map


def checked_priors(priors: dict[str, dict[str, int]]) -> dict[str, dict[str, int]]:
    """Priors must be whole thousandths between 0 and 1000."""
    for field, by_source in priors.items():
        for source, milli in by_source.items():
            if not isinstance(milli, int) or not 0 <= milli <= 1000:
                raise ValueError(f"prior of ({field}, {source}) is not in thousandths: {milli!r}")
    return priors


def prior(field: str, source: str, priors: dict[str, dict[str, int]] = PRIOR_MILLI) -> int:
    """Prior of a field and a source that are known when the plan is made."""
    return priors.get(field, {}).get(source, DEFAULT_PRIOR_MILLI)


def prior_of(field: Column, source: Column, priors: dict[str, dict[str, int]] = PRIOR_MILLI) -> Column:
    """Prior by (field, source) of a row; 500 where the table has no cell."""
    cells = {
        f"{f}|{s}": milli for f, row in checked_priors(priors).items() for s, milli in row.items()
    }
    found = F.try_element_at(literal_map(cells), F.concat_ws("|", field, source))
    return F.coalesce(found, F.lit(DEFAULT_PRIOR_MILLI))


def priority_of(source: Column) -> Column:
    """Place of a source in the tie order; an unknown source comes last."""
    places = literal_map({s: i for i, s in enumerate(SOURCE_PRIORITY)})
    return F.coalesce(F.try_element_at(places, source), F.lit(UNKNOWN_PRIORITY))


def mean_milli(total: Column, n: Column) -> Column:
    """Mean in thousandths, halves up, in whole numbers; 0 for no values."""
    rounded = F.call_function("div", total.cast("bigint") * 2 + n, n * 2)
    return F.when(n > 0, rounded).otherwise(F.lit(0)).cast("int")


def as_ratio(milli: Column) -> Column:
    return milli.cast("double") / F.lit(1000.0)
