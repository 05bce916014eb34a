"""Sinks: profile documents as JSON, tables as Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORTING = ("_document", "_validation_errors", "_projection_errors")


def documents(df: DataFrame) -> DataFrame:
    """One JSON document per row, nulls written out as they are part of the
    fixed shape. Validation errors are attached where there are some."""
    errors = F.col("_validation_errors") if "_validation_errors" in df.columns else None
    if "_document" in df.columns:
        body = F.col("_document")
        inner = F.substr(body, F.lit(2), F.length(body) - 2)
        parts = [F.when(inner != "", inner)]
        if errors is not None:
            parts.append(F.when(errors.isNotNull(), F.concat(F.lit('"_validation_errors":'), F.to_json(errors))))
        return df.select(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("value"))
    # every row is written out once, with its errors or without
    shape = [F.col(c) for c in df.columns if c not in REPORTING]
    value = _text(*shape)
    return df.select((value if errors is None else F.when(errors.isNull(), value).otherwise(_text(*shape, errors))).alias("value"))


def _text(*columns: Column) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def write_documents(df: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    """One document per line."""
    documents(df).write.mode(mode).text(folder)


def write_table(df: DataFrame, folder: str, mode: str = "errorifexists") -> DataFrame:
    """Parquet table; returns the table as read back, so that later steps start
    from the files and not from the sources."""
    df.write.mode(mode).parquet(folder)
    return df.sparkSession.read.parquet(folder)
