"""Vector codes (product quantisation) by member-resident Lloyd rounds.

A vector of whole numbers is cut into equal parts; every part position has a
codebook. The training state is a table of members (position, entry, salt,
part): an owner is one (position, entry, salt), and a member lives with its
owner. The salt spreads the members of one entry over owners, so that an entry
with a third of all members, or with copies of one vector only, is many owners.

A round of Lloyd:
1. Owners hold their resident members against the codebook of their position.
   Who keeps its entry is written where it is, without a shuffle; only members
   that change their entry go through the shuffle to their new owner.
2. Owners add up their residents; sums and counts are combined before the few
   rows (positions x entries) reach the driver, which divides them.

The first round deals all members out, so there everything moves once. The
state of a round is a table in the shared folder: a lost executor costs part of
one round. When no member moves, the codebook stays what it is and the rounds
that are left would change nothing. At the end one pass over the vectors gives
codes and errors under the final codebooks, each part again to its nearest
entry; the error per label is an aggregate, joined back in salted parts.

All arithmetic is on whole numbers: exact in float64 below 2**52 (checked), in
int64 beyond it.

Defined results: vectors that are null or hold null, infinite or undefined
components take no part; shorter vectors are filled with 0 to the longest, and
up to a multiple of the number of parts; a null vec_id comes last in the order
that seeds the codebooks; equal vec_ids go by their components; repeated rows
are rows of their own; with fewer rows than entries the codebook is as small; an
entry without members stays as it is; null labels are one label; an empty table
gives an empty result; components so large that a
squared distance passes a long stop the job with a message; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.storage import new_folder, written
from .vectors import padded, whole_vectors

Codebooks = np.ndarray  # position x entry x component, int64

MEMBERS = "position int, entry int, salt int, part array<int>"


@dataclass(frozen=True)
class Quantiser:
    scale: int = 4096
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    # members of one owner, at most about so many even if all share an entry
    owner: int = 200_000
    label_salts: int = 32


def scaled(rows: DataFrame, quantiser: Quantiser, vector: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, label, parts) as a written table, and the width of a part."""
    out = written(whole_vectors(rows, vector, quantiser.scale, F.col("vec_id"), F.col("label")), "whole-vectors")
    largest = F.max(F.array_max(F.transform("parts", lambda x: F.abs(x.cast("long")))))
    least, most, value = out.agg(F.min(F.size("parts")), F.max(F.size("parts")), largest).first()
    width = -(-(most or 0) // quantiser.parts)
    if 4 * width * (value or 0) ** 2 * quantiser.parts >= 2**63:
        raise ValueError(f"components up to {value} after scaling: squared distances do not fit a long")
    if least != width * quantiser.parts:
        out = out.withColumn("parts", padded(F.col("parts"), width * quantiser.parts))
    return out, width


def first_codebooks(vectors: DataFrame, width: int, quantiser: Quantiser) -> Codebooks:
    seeds = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "parts").limit(quantiser.entries).collect()
    whole = np.array([r.parts for r in seeds], np.int64).reshape(len(seeds), quantiser.parts, width)
    return whole.transpose(1, 0, 2)


def nearest(parts: np.ndarray, codebook: np.ndarray) -> np.ndarray:
    """The entry of least squared distance, the lowest of equals. The part's
    own square is the same for all entries and left out."""
    width = parts.shape[1]
    most = max(int(np.abs(parts).max(initial=0)), int(np.abs(codebook).max(initial=0)))
    kind = np.float64 if 3 * width * most * most < 2**52 else np.int64
    book = codebook.astype(kind)
    return np.argmin((book * book).sum(axis=1) - 2 * (parts.astype(kind) @ book.T), axis=1)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def deal(vectors: DataFrame, n_rows: int, quantiser: Quantiser, width: int) -> DataFrame:
    """Every part of every vector as a member without an entry."""
    salts = max(8, -(-n_rows // quantiser.owner))
    cut = F.transform(F.sequence(F.lit(0), F.lit(quantiser.parts - 1)), lambda p: F.struct(
        p.alias("position"), F.slice("parts", p * width + 1, width).alias("part")))
    return vectors.withColumn("salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).cast("int")).select(
        F.explode(cut).alias("m"), "salt").select("m.position", F.lit(-1).alias("entry"), "salt", "m.part")


def reassigned(members: DataFrame, books: Codebooks) -> DataFrame:
    """The members with their nearest entry and `moved`."""
    width = books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            position, entry = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            parts = _matrix(batch.column(3), width)
            now = np.empty(len(batch), np.int32)
            for p in np.unique(position):
                now[position == p] = nearest(parts[position == p], books[p])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(now), batch.column(2), batch.column(3), pa.array(now != entry)],
                names=["position", "entry", "salt", "part", "moved"])

    return members.mapInArrow(run, MEMBERS + ", moved boolean")


def migrate(members: DataFrame, books: Codebooks) -> tuple[DataFrame, DataFrame]:
    """(residents, arrivals) after a round: the first are written in place, only
    the second are shuffled, to the owner of (position, entry, salt)."""
    spark = members.sparkSession
    folder = new_folder(spark, "members")
    reassigned(members, books).write.partitionBy("moved").parquet(folder)
    state = spark.read.schema(MEMBERS + ", moved boolean").parquet(folder)
    residents = state.filter(~F.col("moved")).drop("moved")
    leaving = state.filter("moved").drop("moved")
    return residents, written(leaving.repartition("position", "entry", "salt"), "arrivals")


def updated(members: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry with members becomes the floor of their mean."""
    width = books.shape[2]
    sums = members.groupBy("position", "entry").agg(
        F.count("*").alias("n"), *[F.sum(F.get("part", F.lit(k)).cast("long")).alias(f"s{k}") for k in range(width)])
    out = books.copy()
    for r in sums.collect():  # positions x entries rows
        out[r.position, r.entry] = [r[f"s{k}"] // r.n for k in range(width)]
    return out


def train(vectors: DataFrame, width: int, quantiser: Quantiser = Quantiser()) -> Codebooks:
    books = first_codebooks(vectors, width, quantiser)
    if not books.shape[1]:
        return books
    members = deal(vectors, vectors.count(), quantiser, width)
    for _ in range(quantiser.rounds):
        residents, arrivals = migrate(members, books)
        if arrivals.isEmpty():
            break
        members = residents.unionByName(arrivals)
        books = updated(members, books)
    return books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """The given columns, code (two hex digits a part) and error per vector."""
    positions, _, width = books.shape
    names = [n for n in vectors.columns if n != "parts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = _matrix(batch.column(len(names)), positions * width).reshape(-1, positions, width)
            error = np.zeros(len(batch), np.int64)
            codes = np.empty((len(batch), positions), np.uint8)
            for p in range(positions):
                codes[:, p] = nearest(parts[:, p], books[p])
                error += ((parts[:, p] - books[p][codes[:, p]]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(names)], pa.array([bytes(c).hex() for c in codes], pa.string()), pa.array(error)],
                names=[*names, "code", "error"])

    schema = ", ".join(f"{n} {vectors.schema[n].dataType.simpleString()}" for n in names)
    return vectors.select(*names, "parts").mapInArrow(run, f"{schema}, code string, error bigint")


def digest(books: Codebooks) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame, quantiser: Quantiser) -> DataFrame:
    """The rows with the error summed over their label. The sums stand once for
    each salt, so a label with a third of the rows is joined in parts."""
    salts = quantiser.label_salts
    salt = F.pmod(F.xxhash64("vec_id", "code", "error"), F.lit(salts)).cast("int")
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).select(
        F.col("label").alias("_label"), "label_error",
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))

    def key(label: Column) -> list[Column]:
        return [label.isNull(), F.coalesce(label.cast("string"), F.lit(""))]

    left = coded.withColumn("salt", salt)
    same = [a == b for a, b in zip(key(left["label"]), key(sums["_label"]))]
    return left.join(sums, [left["salt"] == sums["_salt"], *same]).drop("salt", "_salt", "_label")


def vector_codes(rows: DataFrame, quantiser: Quantiser = Quantiser(), vector: str = "embedding") -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256."""
    vectors, width = scaled(rows, quantiser, vector)
    books = train(vectors, width, quantiser)
    if not books.shape[1]:
        return vectors.select(
            "vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
            F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    coded = written(encode(vectors, books), "codes")
    return with_label_error(coded, quantiser).withColumn("codebooks_sha256", F.lit(digest(books)))
