"""Mixing sources to target weights by weighted fair queueing, in DataFrame expressions only.

Each source plays its documents in a keyed shuffle, up to ``max_repeats`` times over. A document's virtual finish time
is its source's cumulative size divided by its source's target; all sources therefore finish at about time 1. The plays
of all sources are sorted by finish time and truncated where their total size reaches the budget. Running sums are
taken in two levels (inside buckets of bounded size, and over bucket totals), never over a whole source in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written

BLANK = r"[\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    """Number of words; null has none."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK), "")).cast("long")


def targets(totals: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """(source, source_size, target): shares of the sum of all sizes in proportion to weights, which repeat in source order.

    ``totals``: (source, source_size), one row per source. A target stops at ``max_repeats`` times its source's size;
    the excess is shared among the others by weight until none is above (the level is found in closed form).
    """
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))))
    one = totals.withColumn("w", w).withColumn("cap", (F.col("source_size") * max_repeats).cast("double"))
    every = Window.partitionBy(F.lit(0))
    upto = every.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    total = F.sum(F.col("source_size").cast("double")).over(every)
    at = F.sum("cap").over(upto) + F.col("cap") / F.col("w") * (F.sum("w").over(every) - F.sum("w").over(upto))
    one = one.withColumn("total", total).withColumn("full", at <= total)
    rest = F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every), F.lit(0.0))
    free = F.sum(F.when(~F.col("full"), F.col("w"))).over(every)
    return one.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(rest * F.col("w") / free).alias("target"))


def _running(rows: DataFrame, group: list[str], bucket: str, order: list[Column], value: str, out: str) -> DataFrame:
    """``rows`` with the running sum of ``value`` in each group, in order of bucket and ``order``."""
    sums = rows.groupBy(*group, bucket).agg(F.sum(value).alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(Window.partitionBy(*(group or [F.lit(0)])).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select(*[F.col(g).alias(f"_{g}") for g in group], F.col(bucket).alias("_b"), before.alias("_start"))
    inside = rows.withColumn("_in", F.sum(value).over(Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    same = F.col(bucket) == F.col("_b")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return inside.join(starts, same).withColumn(out, F.col("_in") + F.col("_start")).drop("_in", "_start", "_b", *[f"_{g}" for g in group])


def mix(docs: DataFrame, seed: int = 17, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, n_taken, taken (and ``keep``).

    Sources are taken by code point, null last. Null texts have size 0 and are never taken; repeated rows are documents
    of their own; an empty table gives an empty result. Whole documents are taken: the play that would pass the budget
    ends the mix. Reruns agree, since the shuffle is a keyed hash of doc_id and text, so that rows without doc_id are
    spread as well (ties: doc_id, size). Names of ``keep`` are not those of the result nor begin with an underscore.
    """
    sized = written(docs.select(*keep, "doc_id", "source", size_of(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("_h")))
    n = sized.count()
    bits = max(0, math.ceil(math.log2(max(1.0, n / max(128.0, math.sqrt(n))))))
    goal = written(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_repeats))
    budget = goal.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    order = [F.col("_h"), F.col("doc_id"), F.col("size"), *map(F.col, keep)]
    bucket = F.shiftrightunsigned(F.col("_h").bitwiseXOR(F.lit(-(2**63))), 64 - bits) if bits else F.lit(0).cast("long")
    placed = _running(sized.withColumn("_bucket", bucket), ["source"], "_bucket", order, "size", "_cum").drop("_bucket")
    goal = goal.withColumnRenamed("source", "_src")
    placed = written(placed.join(F.broadcast(goal) if goal.count() <= 100_000 else goal, F.col("source").eqNullSafe(F.col("_src"))).drop("_src"))
    # within a source every document with words has a running sum of its own
    plays = placed.where("size > 0 and target > 0").select("_h", "doc_id", "size", "source", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("_e"), "_cum", "source_size", "target")
    plays = plays.withColumn("_v", (F.col("_e") * F.col("source_size") + F.col("_cum")).cast("double") / F.col("target"))
    scale = float(max(1, 2**bits))
    plays = plays.withColumn("_slot", F.floor(F.when(F.col("_v") < 1, F.col("_v") * scale).otherwise((1 + F.ln("_v")) * scale)).cast("long"))
    run = _running(plays, [], "_slot", [F.col("_v"), F.col("_h"), F.col("doc_id"), F.col("source"), F.col("_e"), F.col("size")], "size", "_total")
    taken = run.where(F.col("_total") <= budget).groupBy("source", "_cum").agg(F.count("*").alias("_n")).select(F.col("source").alias("_s"), F.col("_cum").alias("_c"), "_n")
    n_taken = F.least(F.coalesce(F.col("_n"), F.lit(0)), F.lit(max_repeats)).cast("int")
    return placed.join(taken, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_cum") == F.col("_c")) & (F.col("size") > 0), "left").select(*keep, "doc_id", "source", "size", "source_size", "target", n_taken.alias("n_taken"), (n_taken * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with all their columns, a document that is taken n times n times over.

    Rows are told apart by a hash of all their columns, whatever their names; equal rows share what they are taken together.
    """
    own = {c.lower() for c in docs.columns}
    key, count, equal, play = [x for x in (f"row{i}" for i in range(len(own) + 4)) if x not in own][:4]
    keyed = docs.withColumn(key, F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), {"ignoreNullFields": "false"}), 256))
    plan = mix(keyed.select(F.col(key).alias("row_key"), "doc_id", "source", "text"), keep=("row_key",), **options)
    plan = plan.groupBy(F.col("row_key").alias(key)).agg(F.sum("n_taken").cast("int").alias(count), F.count("*").alias(equal))
    plan = written(plan.where(F.col(count) > 0))
    met = keyed.join(plan.where(F.col(equal) == 1), key)
    if plan.where(F.col(equal) > 1).limit(1).count():  # one of several equal rows stands for all
        met = met.unionByName(keyed.join(plan.where(F.col(equal) > 1), key).dropDuplicates([key]))
    return met.withColumn(play, F.explode(F.sequence(F.lit(1), F.col(count)))).select(*[F.col(f"`{c}`") for c in docs.columns])
