"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a grouped minimum (combined before its shuffle) and an equi-join whose both sides are plain
exchanges, so that adaptive execution can split a node that holds a large part of all edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import discard, written


def probe(table: DataFrame, key: str) -> Column:
    """A second name for a key, a string or a number: a join by it shuffles both sides alike, and can be split."""
    return F.reverse(key) if table.schema[key].dataType.simpleString() == "string" else F.bitwise_not(key)


def _star(sym: DataFrame, larger: bool) -> DataFrame:
    """One step over (u, v): hang the larger (or smaller) neighbours of each u below the least of u and its neighbours."""
    least = sym.groupBy("u").agg(F.min("v").alias("m")).select(probe(sym, "u").alias("k"), F.least("u", "m").alias("m"))
    met = sym.withColumn("k", probe(sym, "u")).join(least, "k")
    if larger:
        return met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return met.select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: non-null strings or longs); root is the least node of its component.

    No edges: no rows. Loops and repeated edges are allowed. Raises if ``max_rounds`` do not suffice, rather than
    returning half-joined components.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(max_rounds):
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == seen or mark[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b")).distinct()
        seen = mark
        both = now.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.*")
        hung = _star(both, True).where("a <> b").distinct()
        down = hung.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        before, now = now, written(_star(down, False).where("a <> b").distinct())
        discard(before)
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
