"""Applicant-tracking records: objects with foreign attribute names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ATS, ATS_ALIASES
from ..functions import FIXED, Rules, clean_text, email_address, present
from ..operators.reports import Watch, watched
from . import untyped
from .documents import RECORD, extras, with_document
from .files import read_lines
from .unpivot import Reading, facts_of


def read_ats_json(spark: SparkSession, paths: str | list[str], multi_line: bool = False) -> DataFrame:
    """JSON files as (payload, position): the payload is the whole object as
    text, parsed later, so that one bad record harms no other; the position
    says where it stands.

    With ``multi_line`` every file is one document, and its path stands in for
    a missing id; a line without an id has none and goes to quarantine.
    """
    lines = read_lines(spark, paths, multi_line)
    return lines.withColumn("spare_id", F.col("position.file")) if multi_line else lines


def first_filled(columns: list[Column]) -> Column:
    """First value that is not empty; blanks count as filled at this point."""
    return F.coalesce(*[F.when(present(c), c) for c in columns])


def pick_columns(table: DataFrame) -> DataFrame:
    """The four attributes of a typed table by their known names."""
    have = set(table.columns)
    return table.select(
        "candidate_id",
        "record_ord",
        *[
            first_filled([F.col(k) for k in keys if k in have] or [F.lit(None).cast("string")]).alias(name)
            for name, keys in ATS_ALIASES.items()
        ],
    )


def pick_json(table: DataFrame) -> DataFrame:
    """The four attributes of JSON payloads, and why a payload is unusable.
    Id and number of a record come from the table or else from the payload."""
    names = list(ATS_ALIASES)
    keys = list(dict.fromkeys(k for known in ATS_ALIASES.values() for k in known))
    parsed = with_document(table, keys)
    # in steps, so that no expression is repeated in the code of the next
    read = parsed.select(
        *RECORD, *extras(table), "text", F.col("document._broken").alias("broken"),
        *[untyped.usable_value(F.col(f"document.{k}")).alias(k) for k in keys],
    )
    picked = read.select(
        *RECORD, *extras(table), "text", untyped.malformed(F.col("text"), F.col("broken")).alias("malformed"),
        *[F.coalesce(*known).alias(n) for n, known in ATS_ALIASES.items()],
    )
    reason = F.when(F.col("malformed"), "malformed json").when(
        untyped.usable(F.col("text")) & ~F.col("text").startswith("{"), "not an object"
    )
    for n in names:
        reason = reason.when(~F.col(n)["text"], f"{n} is not a text")
    return untyped.computed_once(picked.select(
        *RECORD,
        *[F.when(F.col(n)["text"], F.col(n)["chars"]).alias(n) for n in names],
        reason.alias("reason"),
        *extras(table),
    ))


def ats_facts(
    picked: DataFrame, source_ord: int = 1, rules: Rules = FIXED, watch: Watch | None = None
) -> DataFrame:
    """Facts of picked attributes. A phone is not read from this source."""
    extra = ["blocked"] if "blocked" in picked.columns else []
    clean = picked.select(
        "candidate_id",
        "record_ord",
        *[F.col(c).alias(f"raw_{c}") for c in ATS_ALIASES],
        clean_text(F.col("name")).alias("name"),
        email_address(F.col("email")).alias("email"),
        clean_text(F.col("company")).alias("company"),
        clean_text(F.col("title")).alias("title"),
        *extra,
    )
    clean = watched(clean, watch, ATS, {
        "full_name": ("raw_name", "name"), "emails": ("raw_email", "email"),
        "experience.company": ("raw_company", "company"), "experience.title": ("raw_title", "title")})
    return facts_of(
        clean,
        ATS,
        source_ord,
        [
            Reading("full_name", "direct", rules.prior("full_name", ATS), ("name",)),
            Reading("emails", "direct", rules.prior("emails", ATS), ("email",)),
            Reading("experience", "direct", rules.prior("experience", ATS), ("company", "title")),
        ],
        "blocked" if extra else None,
    )
