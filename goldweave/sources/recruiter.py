"""Recruiter tables: one row per person, header CSV or any table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import RECRUITER, RECRUITER_COLUMNS, RECRUITER_EXPERIENCE_DISCOUNT
from ..functions import FIXED, Rules, clean_text, email_address, phone_e164
from ..operators.reports import Watch, watched
from .files import cells, csv_records, few
from .unpivot import Reading, facts_of


# some files begin with it
BYTE_ORDER_MARK = "\ufeff"


def by_name(table: DataFrame, columns: list[str]) -> DataFrame:
    """Columns by name; one that the table lacks is null."""
    have = set(table.columns)
    return table.select(
        *[(F.col(f"`{c}`") if c in have else F.lit(None)).cast("string").alias(c) for c in columns]
    )


def read_recruiter_csv(
    spark: SparkSession, paths: str | list[str], id_column: str = "candidate_id", multi_line: bool = False
) -> DataFrame:
    """CSV files whose headers may differ from file to file.

    Spark binds CSV columns by position, which would put values of one file
    under the names of another. So every value is picked by the place its name
    has in the header of its own file. A name the header lacks gives null;
    nothing is invented. The files are read once (see `csv_records`).
    """
    records, width, files = csv_records(spark, paths, multi_line)
    parsed = records.select("is_header", "position", cells(width).alias("cells"))
    heads = parsed.filter("is_header").select(
        F.col("position.file").alias("_file"),
        F.transform("cells", lambda n: F.ltrim(n, F.lit(BYTE_ORDER_MARK))).alias("names"))
    rows = parsed.filter("NOT is_header")

    def pick(name: str):
        # of two equal names in a header the last one counts
        place = F.size("names") + 1 - F.array_position(F.reverse("names"), name)
        return F.when(F.array_contains("names", name), F.try_element_at("cells", place.cast("int")))

    return rows.join(few(heads, files), F.col("position.file") == F.col("_file")).select(
        pick(id_column).alias("candidate_id"), "position", *[pick(c).alias(c) for c in RECRUITER_COLUMNS])


def first_row(table: DataFrame, order: str = "record_ord") -> DataFrame:
    """First row of every candidate, whatever it holds.

    An aggregate in place of a ranking window: it combines before the shuffle,
    so a candidate with very many rows is no hot task.
    """
    rest = [c for c in table.columns if c not in ("candidate_id", order)]
    return (
        table.groupBy("candidate_id")
        .agg(F.min_by(F.struct(*rest), order).alias("row"), F.min(order).alias(order))
        .select("candidate_id", order, "row.*")
    )


def recruiter_records(table: DataFrame, watch: Watch | None = None) -> DataFrame:
    """First rows with cleaned and normalized attributes.

    Tables give the order of rows in ``record_ord``; file scans in ``position``.
    """
    order = "record_ord" if "record_ord" in table.columns else "position"
    number = F.col("record_ord") if order == "record_ord" else F.lit(0).cast("bigint")
    rows = first_row(table.select("candidate_id", order, *RECRUITER_COLUMNS), order).select(
        "candidate_id",
        number.alias("record_ord"),
        *[F.col(c).alias(f"raw_{c}") for c in RECRUITER_COLUMNS],
        clean_text(F.col("name")).alias("name"),
        email_address(F.col("email")).alias("email"),
        phone_e164(F.col("phone")).alias("phone"),
        clean_text(F.col("current_company")).alias("company"),
        clean_text(F.col("title")).alias("title"),
    )
    return watched(rows, watch, RECRUITER, {
        "full_name": ("raw_name", "name"), "emails": ("raw_email", "email"), "phones": ("raw_phone", "phone"),
        "experience.company": ("raw_current_company", "company"), "experience.title": ("raw_title", "title")})


def recruiter_facts(
    table: DataFrame, source_ord: int = 0, rules: Rules = FIXED, watch: Watch | None = None
) -> DataFrame:
    """Facts of a recruiter table. Its title and company are a snapshot rather
    than a history, hence the discount."""
    return facts_of(
        recruiter_records(table, watch),
        RECRUITER,
        source_ord,
        [
            Reading("full_name", "direct", rules.prior("full_name", RECRUITER), ("name",)),
            Reading("emails", "direct", rules.prior("emails", RECRUITER), ("email",)),
            Reading("phones", "normalized", rules.prior("phones", RECRUITER), ("phone",)),
            Reading(
                "experience", "direct", rules.prior("experience", RECRUITER) - RECRUITER_EXPERIENCE_DISCOUNT,
                ("company", "title"),
            ),
        ],
    )
