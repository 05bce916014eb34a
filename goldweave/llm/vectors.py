"""Column expressions for vectors, shared by the operators on embeddings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest component after scaling, so that an int holds it.
LARGEST = 2**30


def finite(vector: Column) -> Column:
    """Neither null nor with a null, infinite or undefined component."""
    def fine(x: Column) -> Column:
        x = x.cast("double")
        return F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False))

    # in Spark's order NaN is larger than infinity
    return F.coalesce(F.forall(vector, fine), F.lit(False))


def floored(vector: Column, scale: int) -> Column:
    """Each component x as the whole number floor(scale * x), x as double."""
    def whole_number(x: Column) -> Column:
        y = F.lit(float(scale)) * x.cast("double")
        return F.when(F.abs(y) <= LARGEST, F.floor(y).cast("int")).otherwise(
            F.raise_error(F.lit(f"a vector component passes {LARGEST} after scaling by {scale}")).cast("int"))

    return F.transform(vector, whole_number)


def padded(vector: Column, width: int) -> Column:
    """Missing components count as 0."""
    return F.concat(vector, F.array_repeat(F.lit(0), F.greatest(F.lit(width) - F.size(vector), F.lit(0))))


def whole_vectors(rows: DataFrame, vector: str, scale: int, *columns: Column) -> DataFrame:
    """The given columns and `parts`, the floored vector, of the rows with a
    finite one."""
    kept = rows.filter(finite(F.col(f"`{vector}`")))
    return kept.select(*columns, floored(F.col(f"`{vector}`"), scale).alias("parts"))
