"""Connected components of a link table, as joins and aggregates.

Alternating stars: in a large step every node links its larger neighbours to
the smallest node it knows, in a small step it links its smaller neighbours to
it. Both only ever replace links, so the table does not grow; when nothing
changes, every node hangs directly on the smallest one of its component. Each
round is settled, so lineage stays short and a lost executor costs one round.
The centre of a large star is joined in parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.storage import settle


# a node with a thousandth of all links, and with so many at least, is joined in parts
HOT = 1_000
SALTS = 16


def _joined(links: DataFrame, nodes: DataFrame, n_links: int) -> DataFrame:
    """links joined with nodes (u, n, ...) on u. The centre of a large star is
    dealt out: n counts a node's links, and not more than 2,000 nodes can have a
    thousandth of them, so these are broadcast to salt the links."""
    hot = F.col("n") > max(2 * n_links // 1000, HOT)
    centres = nodes.filter(hot).select("u", F.lit(True).alias("_hot"))
    salted = links.join(F.broadcast(centres), "u", "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))).drop("_hot")
    salts = F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return salted.join(nodes.withColumn("_salt", F.explode(salts)).drop("n"), ["u", "_salt"]).drop("_salt")


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.sum(F.expr("xxhash64(v, u) % 1000003"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (u, v); root is the smallest node
    of the component. Self-links and repeats are allowed."""
    now = settle(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(now)
    while state[0]:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("u", "m"))
        large = _joined(both.filter("v > u"), least, state[0]).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        roots = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        # one row per link, and one to the smallest neighbour itself
        small = _joined(large, roots, state[0]).select(
            F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("l"))
        after = settle(
            small.select(F.col("l.v").alias("u"), F.col("l.m").alias("v")).filter("u <> v").distinct())
        before, state = state, _state(after)
        now = after
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
