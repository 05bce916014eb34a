"""JSON payloads as records: id, number, known attributes, place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import untyped

RECORD = ["candidate_id", "record_ord"]
OWN = ["candidate_id", "record_ord"]


def extras(table: DataFrame) -> list[str]:
    """What a payload of a file carries on: its position, and whether its line
    is blank."""
    return ["position", "blank"] if "position" in table.columns else []


def with_document(table: DataFrame, keys: list[str]) -> DataFrame:
    """candidate_id, record_ord, the payload without outer blanks as `text`, and
    its known attributes as `document`. Where the table has no id or number,
    the payload's own counts."""
    have = set(table.columns)
    asked = keys + [k for k in OWN if k not in have and k not in keys]
    text = untyped.whole(F.col("payload"))
    rows = table.select(
        *[c for c in (*OWN, "position", "spare_id") if c in have], text.alias("text"),
        untyped.known(F.col("payload"), asked).alias("document"))
    if "candidate_id" not in have:
        spare = F.col("spare_id") if "spare_id" in have else F.lit(None)
        rows = rows.withColumn("candidate_id", F.coalesce(untyped.text_value(F.col("document.candidate_id")), spare))
    if "record_ord" not in have:
        rows = rows.withColumn("record_ord", F.try_variant_get(F.col("document.record_ord"), "$", "bigint"))
    if "position" in have:
        rows = rows.withColumn("blank", F.col("text") == "")
    return rows
