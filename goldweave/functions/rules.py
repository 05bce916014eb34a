"""Priors and priorities of a run: the fixed ones, or tables of one's own.

A new source needs a prior per field it speaks about and a place among the other
sources. Both come as small tables that are laid over the fixed values and
compiled to one literal map each, so that a lookup needs no join.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import DEFAULT_PRIOR_MILLI, PRIOR_MILLI, SOURCE_PRIORITY, UNKNOWN_PRIORITY
from .confidence import checked_priors
from .lookup import literal_map

# rows of a rule table; a table of rules is one row per field and source
MAX_RULES = 10_000


@dataclass(frozen=True)
class Rules:
    """`priors` by field and source; a source's prior for all its other fields
    stands in `source_priors`. `places` sort sources that tie, least first."""

    priors: dict[str, dict[str, int]] = field(default_factory=lambda: PRIOR_MILLI)
    source_priors: dict[str, int] = field(default_factory=dict)
    default_prior: int = DEFAULT_PRIOR_MILLI
    places: dict[str, float] = field(default_factory=lambda: {s: i for i, s in enumerate(SOURCE_PRIORITY)})
    unknown_place: float = UNKNOWN_PRIORITY

    def __post_init__(self) -> None:
        checked_priors(self.priors)
        checked_priors({"any other field": self.source_priors | {"any other source": self.default_prior}})

    def prior(self, name: str, source: str) -> int:
        """Prior of a field and a source that are known when the plan is made."""
        return self.priors.get(name, {}).get(source, self.source_priors.get(source, self.default_prior))

    def prior_of(self, name: Column, source: Column) -> Column:
        """The same for the field and source of a row."""
        cells = {f"{f}|{s}": milli for f, row in self.priors.items() for s, milli in row.items()}
        found = [F.try_element_at(literal_map(cells), F.concat_ws("|", name, source))] if cells else []
        if self.source_priors:
            found.append(F.try_element_at(literal_map(self.source_priors), F.coalesce(source, F.lit(""))))
        return F.coalesce(*found, F.lit(self.default_prior))

    def place_of(self, source: Column) -> Column:
        """Place of a row's source in the tie order."""
        # whole places stay whole numbers
        every = [*self.places.values(), self.unknown_place]
        number = int if all(float(p).is_integer() for p in every) else float
        places = literal_map({s: number(p) for s, p in self.places.items()})
        return F.coalesce(F.try_element_at(places, source), F.lit(number(self.unknown_place)))


FIXED = Rules()


def _few(table: DataFrame, what: str) -> list:
    rows = table.limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rows of {what}")
    return rows


def rules_from(priors: DataFrame | None = None, places: DataFrame | None = None, base: Rules = FIXED) -> Rules:
    """Rules out of tables laid over the base: priors (field, source,
    prior_milli), where a null field stands for all other fields of the source
    and a row with both null for everything else; places (source, place), where
    a null source stands for unknown ones. A key may stand there once."""
    by_field = {f: dict(row) for f, row in base.priors.items()}
    by_source, default = dict(base.source_priors), base.default_prior
    seen = set()

    def once(key: tuple) -> None:
        if key in seen:
            raise ValueError(f"two rules for {key}")
        seen.add(key)

    for r in _few(priors, "priors") if priors is not None else []:
        once(("prior", r["field"], r["source"]))
        if r["field"] is not None and r["source"] is not None:
            by_field.setdefault(r["field"], {})[r["source"]] = r["prior_milli"]
        elif r["source"] is not None:
            by_source[r["source"]] = r["prior_milli"]
        elif r["field"] is None:
            default = r["prior_milli"]
        else:
            raise ValueError(f"a prior for {r['field']!r} without a source")
    order, unknown = dict(base.places), base.unknown_place
    for r in _few(places, "places") if places is not None else []:
        once(("place", r["source"]))
        if r["place"] is None:
            raise ValueError(f"no place for {r['source']!r}")
        if r["source"] is None:
            unknown = r["place"]
        else:
            order[r["source"]] = r["place"]
    return Rules(by_field, by_source, default, order, unknown)
