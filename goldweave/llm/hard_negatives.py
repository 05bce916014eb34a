"""Hard negatives by exact scores from residue-number products.

A score is the inner product of two vectors of whole numbers. Component
matrices are reduced modulo several small primes, to residues around 0, and
multiplied in float32: with components below p / 2 and as few columns at a time
as keep every partial sum below 2**24, float32 is exact. The residues of a
product under all primes give the signed score by Chinese remaindering (mixed
radix, in int64). How many primes are needed follows from the largest squared
length in the table: no score passes it.

Anchors are a stated query set, held against all rows in cells: a cell is a
group of anchors (a few thousand) and a share of the rows. Its anchors come
first, then its rows stream through in Arrow batches, so a task holds the
anchors, one batch and the best so far, whatever the size of the table.

1. Positives: per anchor the first rows of its label, first within each cell,
   then by a window over the few rows that cells return.
2. Negatives: every positive opens a window of scores, low to high percent of
   its own; per anchor and positive the first rows of other labels inside the
   window, again within each cell and then over the cells.

The best-so-far lists only drop what is behind as many better rows, so results
do not depend on the number of cells, batches or tasks.

Defined results: rows with a null vec_id or label, a null vector, or a null,
infinite or undefined component take no part; shorter vectors are filled with 0;
a row is never a partner of an anchor with its own vec_id; repeated rows take
part as often as they stand, but an anchor that stands twice is mined once; of
equal scores the smaller vec_id is first; an anchor without positives, or a
positive without negatives, has no row; an empty table gives an empty result;
vectors so long that a score passes a long stop the job with a message; further
columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.storage import written
from .vectors import padded, whole_vectors

COLUMNS = 4096  # of a matrix multiplied at once, at most
ROWS = 1024  # of a batch scored at once


@dataclass(frozen=True)
class Mining:
    scale: int = 256
    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    # anchors of a cell, about; rows of a cell, about
    anchors: int = 2_048
    rows: int = 1_000_000


def primes_for(bound: int, width: int) -> list[int]:
    """The largest primes whose residues multiply exactly in float32, as many
    as tell whole numbers from -bound to bound apart."""
    # residues reach (p - 1) / 2
    largest = 2 * math.isqrt((2**24 - 1) // max(1, min(width, COLUMNS))) + 1
    out, p, span = [], largest, 1
    while span <= 2 * bound or len(out) < 2:
        if p < 3:
            raise ValueError("vectors too long for exact scores")
        if p % 2 and all(p % d for d in range(3, math.isqrt(p) + 1, 2)):
            out.append(p)
            span *= p
        p -= 1
    if span >= 2**62:
        raise ValueError(f"scores up to {bound} do not fit a long")
    return out


def residues(parts: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """Component matrices modulo each prime, from -(p - 1) / 2 to (p - 1) / 2."""
    return [((parts + p // 2) % p - p // 2).astype(np.float32) for p in primes]


def scores(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """All inner products of the rows of two matrices, exact, as int64."""
    out, span = None, 1
    for a, b, p in zip(left, right, primes):
        r = np.zeros((len(a), len(b)), np.int64)
        for at in range(0, a.shape[1], COLUMNS):
            r += (a[:, at:at + COLUMNS] @ b[:, at:at + COLUMNS].T).astype(np.int64)
        r %= p
        if out is None:
            out = r
        else:
            # the next digit in mixed radix
            r -= out % p
            r *= pow(span, -1, p)
            r %= p
            out += r * span
        span *= p
    out[out > span // 2] -= span
    return out


class Best:
    """The first `keep` rows of each group by falling score, then vec_id."""

    def __init__(self, groups: int, keep: int):
        self.keep = keep
        self.floor = np.full(groups, np.iinfo(np.int64).min)
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = self.settled = 0

    def add(self, group: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        self.held.append((group, score, vec_id))
        self.size += len(group)
        if self.size > 2 * self.settled + 100_000:
            self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        group, score, vec_id = (np.concatenate(c) for c in zip(*self.held)) if self.held else [np.empty(0, np.int64)] * 3
        order = np.lexsort((vec_id, -score, group))
        group, score, vec_id = group[order], score[order], vec_id[order]
        first = np.searchsorted(group, group, "left")
        rank = np.arange(len(group)) - first
        full = rank == self.keep - 1
        # a row of the same score may still come before it by its id
        self.floor[group[full]] = score[full]
        use = rank < self.keep
        self.held = [(group[use], score[use], vec_id[use])]
        self.size = self.settled = int(use.sum())
        return self.held[0]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


CELL = "cell int, kind int, vec_id bigint, tag bigint, label bigint, parts array<int>, wanted array<bigint>"


@dataclass(frozen=True)
class Table:
    """Rows of whole vectors, written, with what the products need to know."""

    rows: DataFrame
    width: int
    primes: list[int]
    n: int


def prepared(rows: DataFrame, mining: Mining, vector: str) -> Table:
    numbered = whole_vectors(
        rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull()), vector, mining.scale,
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"))
    out = written(numbered.withColumn("share", F.monotonically_increasing_id()), "whole-vectors")
    length = F.aggregate("parts", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, least, most, bound = out.agg(
        F.count("*"), F.min(F.size("parts")), F.max(F.size("parts")), F.max(length)).first()
    if least != most:
        out = out.withColumn("parts", padded(F.col("parts"), most))
    # a little more than the largest, as it was added up in floating point
    return Table(out, most or 0, primes_for(int((bound or 0.0) * (1 + 1e-9)) + 1, most or 0), n)


def cells(table: Table, anchors: DataFrame, n_anchors: int, mining: Mining) -> DataFrame:
    """Each group of anchors with each share of the rows, the anchors first."""
    spark = anchors.sparkSession
    groups = max(1, -(-n_anchors // mining.anchors))
    cores = spark.sparkContext.defaultParallelism
    shares = max(1, -(-table.n // mining.rows), min(-(-cores // groups), -(-table.n // ROWS)))

    def all_of(count: int) -> Column:
        return F.sequence(F.lit(0), F.lit(count - 1))

    left = anchors.withColumn("g", F.pmod(F.xxhash64("vec_id", "tag"), F.lit(groups)).cast("int")).select(
        F.explode(F.transform(all_of(shares), lambda s: F.col("g") * shares + s)).alias("cell"),
        F.lit(0).alias("kind"), "vec_id", "tag", "label", "parts", "wanted")
    right = table.rows.withColumn("s", F.pmod(F.xxhash64("share"), F.lit(shares)).cast("int")).select(
        F.explode(F.transform(all_of(groups), lambda g: g * shares + F.col("s"))).alias("cell"),
        F.lit(1).alias("kind"), "vec_id", F.lit(0).cast("long").alias("tag"), "label", "parts",
        F.array().cast("array<bigint>").alias("wanted"))
    return left.unionByName(right).repartition(groups * shares, "cell").sortWithinPartitions("cell", "kind")


def best_of_cells(table: Table, anchors: DataFrame, n_anchors: int, mining: Mining) -> DataFrame:
    """(vec_id, tag, place, partner, score). Anchors want, per place, scores
    from `wanted[2 * place]` to `wanted[2 * place + 1]` of other labels; an
    anchor with nothing wanted looks for its own label."""
    width, primes = table.width, table.primes
    names = ["vec_id", "tag", "place", "partner", "score"]

    def close(ids: np.ndarray, tags: np.ndarray, places: int, best: Best) -> pa.RecordBatch:
        group, score, partner = best.settle()
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (ids[group // places], tags[group // places], group % places, partner, score)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, head, state = None, [], None

        def open_cell() -> tuple:
            ids, tags, labels = (np.concatenate([h[k] for h in head]) for k in range(3))
            wanted = [w for h in head for w in h[4]]
            places = max(1, max(len(w) // 2 for w in wanted))
            low = np.full((len(ids), places), np.iinfo(np.int64).max)
            high = np.full((len(ids), places), np.iinfo(np.int64).min)
            for i, w in enumerate(wanted):
                low[i, :len(w) // 2], high[i, :len(w) // 2] = w[::2], w[1::2]
            same = not any(wanted)
            best = Best(len(ids) * places, mining.positives if same else mining.negatives)
            return ids, tags, labels, residues(np.concatenate([h[3] for h in head]), primes), low, high, same, places, best

        def take(rows: tuple) -> None:
            ids, _, labels, left, low, high, same, places, best = state
            for at in range(0, len(rows[0]), ROWS):
                row_ids, row_labels, parts = (rows[k][at:at + ROWS] for k in (0, 2, 3))
                found = scores(left, residues(parts, primes), primes)
                alike = labels[:, None] == row_labels[None, :]
                fits = (alike if same else ~alike) & (ids[:, None] != row_ids[None, :])
                for place in range(places):
                    floor = best.floor[place::places]
                    if same:
                        use = fits & (found >= floor[:, None])
                    else:
                        use = fits & (found >= np.maximum(floor, low[:, place])[:, None]) & (found <= high[:, place][:, None])
                    i, j = np.nonzero(use)
                    best.add(i * places + place, found[i, j], row_ids[j])

        for batch in batches:
            numbers = [batch.column(k).to_numpy() for k in range(5)]
            parts = _matrix(batch.column(5), width)
            change = np.flatnonzero(np.diff(numbers[0].astype(np.int64) * 2 + numbers[1])) + 1
            for lo, hi in zip([0, *change], [*change, len(batch)]):
                if lo == hi:
                    continue
                part = (*(numbers[k][lo:hi] for k in (2, 3, 4)), parts[lo:hi])
                if numbers[0][lo] != cell:
                    if state is not None:
                        yield close(state[0], state[1], state[7], state[8])
                    cell, head, state = numbers[0][lo], [], None
                if numbers[1][lo] == 0:
                    head.append((*part, batch.column(6).slice(lo, hi - lo).to_pylist()))
                elif head:
                    state = state or open_cell()
                    take(part)
        if state is not None:
            yield close(state[0], state[1], state[7], state[8])

    return cells(table, anchors, n_anchors, mining).mapInArrow(
        run, "vec_id bigint, tag bigint, place bigint, partner bigint, score bigint")


def hard_negatives(
    rows: DataFrame, is_anchor: Column, mining: Mining = Mining(), vector: str = "embedding"
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score, positive_rank. `is_anchor` is told from vec_id and label."""
    table = prepared(rows, mining, vector)
    tag = F.xxhash64("label", "parts")
    anchors = written(
        table.rows.filter(is_anchor).select("vec_id", tag.alias("tag"), "label", "parts").distinct()
        .withColumn("wanted", F.array().cast("array<bigint>")), "anchors")
    n_anchors = anchors.count()
    near = best_of_cells(table, anchors, n_anchors, mining)
    first = Window.partitionBy("vec_id", "tag", "place").orderBy(F.col("score").desc(), "partner")

    def leading(found: DataFrame, keep: int) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= keep)

    positives = written(leading(near, mining.positives), "positives")
    positives_of = positives.groupBy("vec_id", "tag").agg(
        F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("p"))
    # low * p <= 100 * n <= high * p, for whole n
    wide = F.transform(F.col("p")["score"], lambda s: F.array(
        -_floor_div(-s * mining.low, 100), _floor_div(s * mining.high, 100)))
    seekers = anchors.drop("wanted").join(
        positives_of.select("vec_id", "tag", F.flatten(wide).alias("wanted")), ["vec_id", "tag"])
    far = leading(best_of_cells(table, seekers, n_anchors, mining), mining.negatives)
    pair = positives.select(
        "vec_id", "tag", (F.col("rank") - 1).cast("long").alias("place"), F.col("partner").alias("positive_id"),
        F.col("score").alias("positive_score"))
    return far.join(pair, ["vec_id", "tag", "place"]).select(
        F.col("vec_id").alias("anchor_id"), "positive_id", "rank", F.col("partner").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"), (F.col("place") + 1).cast("int").alias("positive_rank"))


def _floor_div(number: Column, by: int) -> Column:
    """Whole division, rounded down."""
    return F.call_function("div", number - F.pmod(number, F.lit(by).cast("long")), F.lit(by).cast("long"))
