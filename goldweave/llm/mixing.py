"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over the training run: weights at evenly
spaced knots, linear between them. The integral of a schedule says how much of
the source's target should have been used by time t; inverting it gives each
document (copy) the time at which its first word is due, its position. A range
sort by position is the training order.

Targets: the sources share a budget (percent of all words) by weight; none gets
more than `max_passes` times its own words, and what is cut off is shared anew
by weight until nothing is above. Sources fill up in the order of cap by weight:
one is full if, when all before it are, its share of the rest is its cap or more.
So running sums in that order tell all that are full at once, however many.

Within a source, documents follow each other in the order of a digest of their
id, pass after pass. Running sums are made in two steps, within a slice of the
digest and over the slices, so a source with a third of all rows is not summed
by one task, and reruns agree. The last document may be taken in part, so that
the words taken are the rounded target.

Built-in functions only. Defined results: null or empty texts have size 0, are
taken with 0 words and get no copy in the order; a null source is a source,
after all others; a source without words has target 0; repeated rows are
documents of their own (ties in the digest go by id, size and a hash of the row);
an empty table gives an empty result; a very long text is one document, split by
no pass; further columns of the input are dropped
by `plan_mix` and kept by `training_order`.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.storage import settle, written
from .text import let, n_words, packed, unpacked

BUDGET_PERCENT = 150
MAX_PASSES = 2
WEIGHTS = (3, 1, 2)
# Schedules by rank of the source, repeating: early, even, late.
SCHEDULES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))
# hex digits of the digest that name a slice: 4096 slices a source
SLICE_DIGITS = 3
# sources that one task still numbers; beyond, they are dealt out by ranges
FEW_SOURCES = 100_000
# they replace columns of the input that have the same name
MIX_COLUMNS = ("size", "source_size", "target", "taken", "position")


def measured(docs: DataFrame) -> DataFrame:
    """One slim row per document: id, source, size in words, place in order."""
    return settle(docs.select(
        "doc_id", "source", n_words(F.col("text")).alias("size"), tag_of(docs).alias("tag"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("_place"),
    ))


def tag_of(docs: DataFrame) -> Column:
    """A hash of the row, to tell rows with the same id apart in every run."""
    plain = [f.name for f in docs.schema if f.dataType.typeName() not in ("map", "variant")]
    return F.xxhash64(*[F.col(f"`{c}`") for c in plain])


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, schedules: Sequence[Sequence[float]] = SCHEDULES,
    budget_percent: int = BUDGET_PERCENT, max_passes: int = MAX_PASSES,
) -> DataFrame:
    """One row per source: source_size, weight, target, schedule.

    All sums are whole numbers, so a target is one division.
    """
    weights = [int(w) for w in weights]
    sources = settle(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    n, total = sources.agg(F.count("*"), F.sum("source_size")).first()
    few = n <= FEW_SOURCES
    by_name = [F.col("source").asc_nulls_last()]
    sources = running(sources, by_name, {"_rank": F.lit(1).cast("long")}, few)
    place = F.col("_rank").cast("int") % len(weights)
    knots = F.get(
        F.array(*[F.array(*[F.lit(float(v)) for v in s]) for s in schedules]), F.col("_rank").cast("int") % len(schedules))
    cap = F.col("source_size") * max_passes
    level = math.lcm(*weights)
    sources = sources.select(
        "source", "source_size", F.get(F.array(*[F.lit(w).cast("long") for w in weights]), place).alias("weight"),
        knots.alias("schedule"), _whole(cap).alias("cap"),
        # the share of the budget, per weight, at which a source is full
        (_whole(cap) * F.get(F.array(*[F.lit(level // w).cast("decimal(10,0)") for w in weights]), place)).cast(
            "decimal(38,0)").alias("_level"))
    sources = settle(running(sources, [F.col("_level"), *by_name], {"_caps": F.col("cap"), "_weights": _whole(F.col("weight"))}, few))
    budget = (total or 0) * budget_percent
    all_weights = sources.agg(F.sum(_whole(F.col("weight")))).first()[0] or 0
    # those before it are full; so is this one if it gets its cap or more of the rest
    room = _whole(F.lit(budget)) - F.col("_caps") * 100
    full = (room * F.col("weight")).cast("decimal(38,0)") >= (
        F.col("cap") * 100 * (_whole(F.lit(int(all_weights))) - F.col("_weights"))).cast("decimal(38,0)")
    sources = sources.withColumn("full", full)
    used, share = sources.agg(
        F.sum(F.when(F.col("full"), F.col("cap"))), F.sum(F.when(~F.col("full"), F.col("weight")))).first()
    left, share = budget - 100 * int(used or 0), int(share or 0)
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
        (_whole(F.lit(left)) * F.col("weight")).cast("double") / F.lit(max(100 * share, 1)).cast("double"))
    return sources.select("source", "source_size", "weight", "schedule", target.alias("target"))


def _whole(number: Column) -> Column:
    """Products of word counts and weights pass a long."""
    return number.cast("decimal(20,0)")


def running(table: DataFrame, order: list[Column], sums: dict[str, Column], few: bool) -> DataFrame:
    """The table with sums over all rows before each in the order. A long table
    is dealt out by ranges and summed within each, on top of the ranges before."""
    names = list(sums)
    if few:
        before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return table.withColumns({n: F.coalesce(F.sum(v).over(before), F.lit(0)) for n, v in sums.items()})
    placed = settle(
        table.withColumns(sums).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    parts = placed.groupBy("_part").agg(*[F.sum(n).alias(f"{n}_part") for n in names])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", *[F.coalesce(F.sum(f"{n}_part").over(earlier), F.lit(0)).alias(f"{n}_part") for n in names])
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition
    return placed.join(F.broadcast(parts), "_part").withColumns(
        {n: F.coalesce(F.sum(n).over(inside), F.lit(0)) + F.col(f"{n}_part") for n in names}
    ).drop("_part", *[f"{n}_part" for n in names])


def due_time(share: Column, schedule: Column) -> Column:
    """The time in [0, 1] by which a share of the schedule's integral is used.

    Between two knots the weight is linear and its integral quadratic; the
    root is taken in the form that stays exact for flat pieces.
    """
    last = F.size(schedule) - 1

    def area(w: Column) -> Column:
        pieces = F.transform(F.sequence(F.lit(0), last - 1), lambda k: (F.get(w, k) + F.get(w, k + 1)) / 2)
        return F.aggregate(pieces, F.array(F.lit(0.0)), lambda a, p: F.concat(a, F.array(F.element_at(a, -1) + p)))

    def solve(w: Column, sums: Column) -> Column:
        wanted = share * F.element_at(sums, -1)
        k = F.least(F.greatest(F.size(F.filter(sums, lambda s: s <= wanted)) - 1, F.lit(0)), last - 1)
        rest, low, slope = wanted - F.get(sums, k), F.get(w, k), F.get(w, k + 1) - F.get(w, k)
        root = 2 * rest / (low + F.sqrt(F.greatest(low * low + 2 * slope * rest, F.lit(0.0))))
        return (k + F.when(rest <= 0, 0.0).otherwise(root)) / last

    return let(schedule, lambda w: let(area(w), lambda sums: solve(w, sums)))


def plan_mix(docs: DataFrame, max_passes: int = MAX_PASSES, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, tag, and `copies`: for each
    pass that takes words of the document, its words and its position."""
    sizes = measured(docs)
    targets = source_targets(sizes, max_passes=max_passes, **options)
    sized = sizes.withColumn("_slice", F.substring("_place", 1, SLICE_DIGITS))
    slices = (
        sized.groupBy("source", "_slice").agg(F.sum("size").alias("_words"))
        .withColumn("_before", F.coalesce(F.sum("_words").over(
            Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumnsRenamed({"source": "_source", "_slice": "_of"}).drop("_words")
    )
    inside = Window.partitionBy("source", "_slice").orderBy("_place", "doc_id", "size", "tag").rowsBetween(
        Window.unboundedPreceding, -1)
    run = (
        sized.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(slices, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_slice") == F.col("_of")))
        .withColumn("_start", F.col("_in") + F.col("_before"))
        .drop("_source", "_of", "_in", "_before", "_slice")
    )
    run = run.join(
        F.broadcast(targets.withColumnRenamed("source", "_source")) if targets.count() <= 10_000
        else targets.withColumnRenamed("source", "_source"),
        F.col("source").eqNullSafe(F.col("_source")),
    ).drop("_source")
    goal = F.round("target").cast("long")

    def copy(p: Column) -> Column:
        start = F.col("_start") + p * F.col("source_size")
        taken = F.greatest(F.least(goal - start, F.col("size")), F.lit(0).cast("long"))
        return F.struct(
            taken.alias("taken"),
            due_time(start.cast("double") / F.greatest(F.col("target"), F.lit(1.0)), F.col("schedule")).alias("position"),
        )

    copies = F.filter(
        F.transform(F.sequence(F.lit(0).cast("long"), F.lit(max_passes - 1).cast("long")), copy),
        lambda c: c["taken"] > 0)
    return run.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "tag",
        F.aggregate("copies", F.lit(0).cast("long"), lambda n, c: n + c["taken"]).alias("taken"), "copies",
    )


def training_order(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: one row per copy with `taken` words to read from its
    start, range-sorted by `position`.

    Rows that repeat in full are interchangeable for the plan; if there are any,
    they are numbered so that each meets its own. The texts move twice: to meet
    their plan, and to their place in the order.
    """
    return _in_order(docs, numbered(plan_mix(docs, **options))).drop(MARK)


# which row of the plan a copy is of
MARK = "_plan_row"
KEY = ["doc_id", "source", "tag"]


def numbered(plan: DataFrame) -> DataFrame:
    """The plan with a number for each row among those that repeat in full, in
    the order of what is taken of them, the same in every run."""
    if plan.groupBy(*KEY).count().filter("count > 1").isEmpty():
        return plan.withColumn("_n", F.lit(1))
    return plan.withColumn("_n", F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("taken"), "copies")))


def _in_order(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The training order by a numbered plan, with the plan's row in `MARK`."""
    left = docs.select(packed(docs, without=()), "doc_id", "source", tag_of(docs).alias("tag"))
    if plan.filter("_n > 1").isEmpty():
        left = left.withColumn("_n", F.lit(1))
    else:
        left = left.withColumn("_n", F.row_number().over(Window.partitionBy(*KEY).orderBy(F.lit(0))))
    plan = plan.select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("tag").alias("_tag"),
        F.col("_n").alias("_m"), "size", "source_size", "target", F.explode("copies").alias("_copy"))
    return (
        left.join(plan, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source"))
                  & (F.col("tag") == F.col("_tag")) & (F.col("_n") == F.col("_m")))
        .select(*[c for c, n in zip(unpacked(docs), docs.columns) if n not in MIX_COLUMNS], "size", "source_size",
                "target", F.col("_copy.taken").alias("taken"), F.col("_copy.position").alias("position"),
                F.struct(F.col("_tag").alias("tag"), F.col("_m").alias("n")).alias(MARK))
        .repartitionByRange(F.col("position"), F.col("doc_id"))
        .sortWithinPartitions("position", "doc_id")
    )


def mix_digests(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target of every document, with `taken` words
    and first `position` as the mixed corpus has them: its copies are put in
    order with their texts, and the words of each are counted there. A document
    without a copy has taken nothing and has no position."""
    plan = numbered(plan_mix(docs, **options))
    order = _in_order(docs, plan)
    read = F.least(n_words(F.col("text")), F.col("taken"))
    copies = written(order.select("doc_id", "source", F.col(MARK), read.alias("_read"), "position"), "training-order")
    got = copies.groupBy(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col(f"{MARK}.tag").alias("_tag"),
        F.col(f"{MARK}.n").alias("_m"),
    ).agg(F.sum("_read").alias("_read"), F.min("position").alias("position"))
    return plan.join(
        got, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source"))
        & (F.col("tag") == F.col("_tag")) & (F.col("_n") == F.col("_m")), "left",
    ).select("doc_id", "size", "source_size", "target", F.coalesce("_read", F.lit(0).cast("long")).alias("taken"), "position")
