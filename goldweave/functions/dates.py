"""Year-month values as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import MONTHS
from .lookup import literal_map
from .text import WS, strip


def year_month(raw: Column) -> Column:
    """YYYY-MM out of an ISO date, a month name with a year, or a bare year;
    null for everything else. The month of an ISO date is taken as it stands."""
    text = strip(raw)
    iso = F.nullif(F.regexp_extract(text, r"(?U)^(\d{4}-\d{2})", 1), F.lit(""))
    named = rf"(?U)^([A-Za-z]{{3,}})\.?{WS}+(\d{{4}})$"
    month = F.try_element_at(
        literal_map(MONTHS), F.lower(F.substring(F.regexp_extract(text, named, 1), 1, 3))
    )
    by_name = F.concat_ws("-", F.regexp_extract(text, named, 2), month)
    return (
        F.when(iso.isNotNull(), iso)
        .when(month.isNotNull(), by_name)
        .when(text.rlike(r"(?U)^\d{4}$"), F.concat(text, F.lit("-01")))
    )
