"""Skill names as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import SKILL_ALIASES
from .lookup import literal_map
from .text import strip, title_case


def skill_name(raw: Column) -> Column:
    """Display name of a known alias, title case of anything else."""
    text = strip(raw)
    return F.coalesce(
        F.try_element_at(literal_map(SKILL_ALIASES), F.lower(text)), title_case(text)
    )
