"""Isolation of broken source records.

One broken record takes all facts of its source from its candidate and nothing
from anybody else; the reasons go to a quarantine table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .membership import marked, without


def broken_ids(records: DataFrame) -> DataFrame:
    return records.filter(F.col("reason").isNotNull()).select("candidate_id")


def quarantine(records: DataFrame, source: str) -> DataFrame:
    """(candidate_id, source, reason, n_records) of records with a reason.
    Records of files come one by one, with file and line."""
    bad = records.filter(F.col("reason").isNotNull())
    if "line" in records.columns:
        return bad.select(
            "candidate_id", F.lit(source).alias("source"), "reason", F.lit(1).cast("bigint").alias("n_records"),
            "file", "line")
    return (
        bad.groupBy("candidate_id", "reason")
        .agg(F.count("*").alias("n_records"))
        .select("candidate_id", F.lit(source).alias("source"), "reason", "n_records")
    )


def isolate(records: DataFrame, broken: DataFrame | None = None) -> DataFrame:
    """Mark the records of candidates with a broken record as blocked. They
    stay as rows, so that the candidate keeps a profile. Sound records are not
    shuffled for it. ``broken`` holds the ids, if not those of the records."""
    ids = broken_ids(records) if broken is None else broken
    return marked(records.drop("reason"), ids, "blocked")


def without_broken(rows: DataFrame, records: DataFrame) -> DataFrame:
    """Rows of candidates none of whose records is broken."""
    return without(rows, broken_ids(records))
