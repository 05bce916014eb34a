"""Candidates with too many rows for one task.

A placeholder id may gather a large share of all rows. Such candidates are
found by a count, split off, and dealt to parts by the order of their rows, so
that one candidate may lie in several parts; all the others take the path by
candidate. Both give the same numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from .membership import possibly
from .storage import written

# Facts of one candidate that a single task still ranks. Chooses a plan, not a
# result.
HOT_LIMIT = 20_000
# Facts of ordinary candidates that are sorted by one task: its memory does not
# grow with the tables.
TASK_FACTS = 250_000
# Ids sent to every executor as they are; a longer list becomes a bitmap.
MAX_BROADCAST_IDS = 10_000
# Rows in the sample for every part that they are dealt to.
SAMPLED = 100
# the number of a row has that of its part above this bit
PARTITION_BITS = 33


@dataclass(frozen=True)
class Split:
    regular: DataFrame
    hot: DataFrame | None = None
    # tasks for the regular facts; none leaves it to the engine
    tasks: int | None = None


def weigh(tables: list[tuple[DataFrame, int]]) -> DataFrame:
    """(candidate_id, weight) of source tables, each with the most facts one
    of its rows can give. Only the id column is read."""
    parts = [
        t.select(
            F.coalesce(F.col("candidate_id").cast("string"), F.lit("")).alias("candidate_id"),
            F.lit(n).alias("weight"),
        )
        for t, n in tables
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def split_hot(facts: DataFrame, limit: int = HOT_LIMIT, weights: DataFrame | None = None) -> Split:
    """Facts of ordinary candidates, and those of hot ones if there are any.

    The count combines before its shuffle. Ids come to the driver only up to a
    fixed number; a longer list becomes a bitmap, which may call a few others
    hot too. The facts of hot candidates are written once, as they are read
    several times.
    """
    # a row without an id belongs to the candidate with the empty id, which the
    # validation reports; a null key would escape the joins below
    facts = facts.withColumn("candidate_id", F.coalesce("candidate_id", F.lit("")))
    if weights is None:
        weights = facts.select("candidate_id", F.lit(1).alias("weight"))
    seen = Observation()
    hot_ids = (
        weights.observe(seen, F.sum("weight").alias("n")).groupBy("candidate_id").agg(F.sum("weight").alias("n")).filter(F.col("n") > limit)
    ).select("candidate_id")
    head = hot_ids.limit(MAX_BROADCAST_IDS + 1).collect()
    total = seen.get.get("n") or 0
    # small tables are cut into as many parts as there are cores by the engine
    small_enough = total <= TASK_FACTS * facts.sparkSession.sparkContext.defaultParallelism
    tasks = None if small_enough else total // TASK_FACTS + 1
    if not head:
        return Split(facts, tasks=tasks)
    if len(head) > MAX_BROADCAST_IDS:  # no fact is moved for the split
        marked = written(possibly(facts, hot_ids, "_hot"), "split")
        return Split(marked.filter("NOT _hot").drop("_hot"), marked.filter("_hot").drop("_hot"), tasks)
    side = F.broadcast(facts.sparkSession.createDataFrame(head, "candidate_id string"))
    return Split(
        facts.join(side, "candidate_id", "left_anti"),
        written(facts.join(side, "candidate_id", "left_semi"), "split"),
        tasks,
    )


def small(df: DataFrame, few: bool) -> DataFrame:
    """Broadcast a table that holds a handful of rows per part, if few."""
    return F.broadcast(df) if few else df


def n_parts(df: DataFrame, rows: int) -> int:
    """Parts for so many rows: none holds more than a task can sort."""
    return max(rows // TASK_FACTS + 1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def cut_points(df: DataFrame, keys: list[str], parts: int, rows: int) -> Column:
    """The keys that divide the rows into parts of about the same size, in
    order, as a constant: where a row belongs can be told from the row alone,
    in any run. They come from a sample that one task sorts."""
    key = F.struct(*keys)
    share = min(1.0, SAMPLED * parts / max(rows, 1))
    some = df if share == 1 else df.sample(share, seed=0)
    picked = "[]"
    if parts > 1:
        places = f"transform(sequence(1, {parts - 1}), i -> get(keys, CAST(i * size(keys) div {parts} AS INT)))"
        picked = some.agg(F.sort_array(F.collect_list(key)).alias("keys")).select(
            F.to_json(F.expr(f"array_distinct(filter({places}, k -> k IS NOT NULL))"))).first()[0]
    kind = ArrayType(df.select(key.alias("key")).schema["key"].dataType)
    # sorted anew, whatever became of odd characters on the way
    return F.sort_array(F.from_json(F.lit(picked), kind))


def part_of(key: Column, points: Column, parts: int) -> Column:
    """The number of cut points below the key of a row, by halving."""
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(parts.bit_length()))])

    def below(it: Column) -> Column:
        return F.aggregate(
            steps, F.lit(0), lambda at, step: at + F.when(F.get(points, at + step - 1) < it, step).otherwise(0))

    # in a list, so that the key is made once for all steps
    return F.get(F.transform(F.array(key), below), 0)


def are_few(parts: int) -> bool:
    """Whether what there is once or so per part may be broadcast."""
    return parts <= MAX_BROADCAST_IDS


def in_order(df: DataFrame, groups: list[str], order: list[str], parts: int) -> tuple[DataFrame, DataFrame]:
    """The rows, each with its `_part`, with `_row`, a number that grows with
    group and order and is unique; and per group and part what makes it the
    number in the group: `_row` - `_start` + `_offset` + 1.

    A large group lies in several parts one after the other. The number of a
    row is its place in its part plus the sizes of the parts of its group before
    it. There are at most as many sizes as groups and parts together.
    """
    place = f"shiftleft(_part, {PARTITION_BITS}) + (monotonically_increasing_id() & {(1 << PARTITION_BITS) - 1})"
    placed = written(
        df.repartitionById(parts, "_part")
        .withColumn("_part", F.col("_part").cast("bigint"))
        .sortWithinPartitions(*groups, *order)
        .withColumn("_row", F.expr(place)), "in-order"
    )
    before = (
        Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    sizes = (
        placed.groupBy(*groups, "_part")
        .agg(F.min("_row").alias("_start"), F.count("*").alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    return placed, sizes


NUMBER = "CAST({} - _start + _offset + 1 AS BIGINT)"


def ranked(df: DataFrame, groups: list[str], order: list[str], name: str, few: bool) -> DataFrame:
    """Number the rows of every group, without gathering a group in one task."""
    rows, keys = df.count(), [*groups, *order]
    parts = n_parts(df, rows)
    part = part_of(F.struct(*keys), cut_points(df, keys, parts, rows), parts)
    placed, sizes = in_order(df.withColumn("_part", part), groups, order, parts)
    return (
        placed.join(small(sizes, few), [*groups, "_part"])
        .withColumn(name, F.expr(NUMBER.format("_row")))
        .drop("_row", "_part", "_start", "_offset")
    )
