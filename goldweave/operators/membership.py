"""Which rows belong to a set of ids, without shuffling the rows that do not.

The ids are hashed into a bitmap of fixed size (at most 513 rows of 4 KB), which
is broadcast and tested on every row. Rows without a hit are outside for
certain and stay where they are. Only hits are joined with the ids: the true
ones and the few that share a bit with one. The join is salted, as one id may
hold a third of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import settle

BITS = 1 << 24
SALTS = 8
BUCKET_BITS = 32_768


def _bit(id_: Column) -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(BITS)) + 1


def bitmap(ids: DataFrame) -> DataFrame:
    """(bucket, bits) of a table of candidate_id."""
    bit = _bit(F.col("candidate_id"))
    return settle(
        ids.groupBy(F.bitmap_bucket_number(bit).alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("_bits")))


def _hit() -> Column:
    at = F.bitmap_bit_position(_bit(F.col("candidate_id")))
    byte = F.conv(F.hex(F.substr("_bits", (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1, F.lit(False))


def possibly(rows: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """The rows with a column that is true for all of the ids, and for the few
    others that share a bit with one. No row is moved."""
    return (
        rows.withColumn("_bucket", F.bitmap_bucket_number(_bit(F.col("candidate_id"))))
        .join(F.broadcast(bitmap(ids)), "_bucket", "left")
        .withColumn(name, _hit()).drop("_bucket", "_bits")
    )


def hits(rows: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows outside for certain, rows that may be inside)."""
    tested = possibly(rows, ids, "_hit")
    return tested.filter(~F.col("_hit")).drop("_hit"), tested.filter("_hit").drop("_hit")


def marked(rows: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """The rows with a column that says whether their id is one of the ids."""
    outside, maybe = hits(rows, ids)
    salted = ids.select("candidate_id").distinct().select(
        "candidate_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"), F.lit(True).alias(name))
    inside = (
        maybe.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        .join(salted, ["candidate_id", "_salt"], "left").drop("_salt")
        .withColumn(name, F.coalesce(name, F.lit(False)))
    )
    return outside.withColumn(name, F.lit(False)).unionByName(inside)


def within(rows: DataFrame, ids: DataFrame) -> DataFrame:
    return marked(rows, ids, "_inside").filter("_inside").drop("_inside")


def without(rows: DataFrame, ids: DataFrame) -> DataFrame:
    return marked(rows, ids, "_inside").filter(~F.col("_inside")).drop("_inside")
