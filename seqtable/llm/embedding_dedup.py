"""Near-duplicate vectors of equal label by cosine, compared tile against tile in PCA order.

Vectors are scaled to length 1 and rotated to the principal axes of all vectors of their dimension. Two unit vectors
with cosine >= t lie at most sqrt(2 - 2t) apart, so only equal or neighbouring cells of that width on the two leading
axes can hold links. Cells are dealt out in blocks of bounded size, each compared with the blocks it may have links
with, tile by tile. Within a pair of tiles the products of the leading axes are summed first; by Cauchy-Schwarz the rest
is at most the product of the suffix norms, and pairs that cannot reach t any more are dropped after every step. What
remains is decided by the cosine of the given components in double precision. A pair of blocks emits link counts and a
spanning forest of its links, never the links themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .scratch import discard, written

#: Vectors compared at once, and those sent to a task for each side: at most BLOCK, and some BLOCK_NUMBERS numbers.
TILE, BLOCK, BLOCK_NUMBERS = 1024, 8192, 1 << 21
#: A cell and its neighbours on two axes.
AROUND = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
STEPS = (8, 16, 32, 64, 128, 256, 512, 1024, 2048, 4096)


def _usable() -> Column:
    """Whether a row can have links: label and vector given, all components finite, not all zero."""
    ok = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    return F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(ok, F.lit(False))


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring their largest component to about 1: cosines stay as they are, bit for bit,
    and squares of very large and very small components neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _matrix(b: pa.RecordBatch, column: str, d: int) -> np.ndarray:
    return b.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """For each dimension the principal axes (columns, leading first) of all unit vectors; d x d numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims).tolist():
                x = _unit(_matrix(b.filter(pa.array(dims == d)), "embedding", d))
                sums[d] = sums.get(d, 0) + x.T @ x
        for d, m in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d * d, d, np.int32)), pa.array(np.arange(d * d, dtype=np.int32)), pa.array(m.ravel())], names=["dim", "at", "v"])

    total = classes.select("dim", "embedding").mapInArrow(run, "dim int, at int, v double").groupBy("dim", "at").agg(F.sum("v").alias("v"))
    out: dict[int, np.ndarray] = {}
    for d, rows in total.toPandas().groupby("dim"):
        m = rows.sort_values("at")["v"].to_numpy().reshape(d, d)
        out[int(d)] = np.ascontiguousarray(np.linalg.eigh((m + m.T) / 2)[1][:, ::-1])
    return out


def close_pairs(a: np.ndarray, b: np.ndarray, raw_a: np.ndarray, raw_b: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i, j) with cosine >= t. ``a``, ``b``: unit vectors on the principal axes; ``raw_*``: as given."""
    d = a.shape[1]
    tail = lambda x: np.sqrt(np.maximum(np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1], 0))
    ta, tb = np.pad(tail(a), ((0, 0), (0, 1))), np.pad(tail(b), ((0, 0), (0, 1)))
    slack, first = t - 1e-9, min(STEPS[0], d)
    part = a[:, :first] @ b[:, :first].T
    i, j = np.nonzero(part + ta[:, first, None] * tb[None, :, first] >= slack)
    s, at = part[i, j], first
    for k in (*[x for x in STEPS if first < x < d], d):
        if at >= d or not len(i):
            break
        for low in range(0, len(i), 1 << 18):  # bounded memory however many pairs are left
            cut = slice(low, low + (1 << 18))
            s[cut] += np.einsum("ij,ij->i", a[i[cut], at:k], b[j[cut], at:k])
        stay = s + ta[i, k] * tb[j, k] >= slack
        i, j, s, at = i[stay], j[stay], s[stay], k
    ok = np.zeros(len(i), bool)
    raw_a, raw_b = _scaled(raw_a), _scaled(raw_b)
    na, nb = np.sqrt((raw_a * raw_a).sum(axis=1)), np.sqrt((raw_b * raw_b).sum(axis=1))
    for low in range(0, len(i), 1 << 18):
        cut = slice(low, low + (1 << 18))
        ok[cut] = np.einsum("ij,ij->i", raw_a[i[cut]], raw_b[j[cut]]) / (na[i[cut]] * nb[j[cut]]) >= t
    return i[ok], j[ok]


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least index of each node's component under links (i, j)."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def near_duplicates(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (least vec_id reachable by links), kept.

    Only vectors of equal label and dimension are compared. Null, zero and non-finite vectors, and those with null
    components or a null label, link with nothing. Equal vectors are compared once and linked; rows that repeat a vec_id
    are vectors of their own; a null vec_id is never the least of its component unless all are null (then the component
    is null and kept is true). Vectors are arrays of any numbers; labels and ids are of any type. Other columns are not read.
    """
    spark = vectors.sparkSession
    key = F.concat_ws(" ", *[F.lower(F.hex(F.xxhash64(F.lit(seed), "label", "embedding"))) for seed in (1, 2)])
    # labels of any type are told apart as texts, numbers of any type are compared in double precision
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    named = written(vectors.where(_usable()).select("vec_id", key.alias("key"), F.col("label").cast("string").alias("label"), F.col("embedding").cast(kind).alias("embedding")))
    classes = written(named.groupBy("key").agg(F.count("*").alias("weight"), F.min("vec_id").alias("first"), F.first("label").alias("label"), F.first("embedding").alias("embedding")).withColumn("dim", F.size("embedding")))
    axes = spark.sparkContext.broadcast(principal_axes(classes))
    width = float(np.sqrt(2 - 2 * threshold)) + 1e-9

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("dim").to_numpy()
            cell = np.zeros((2, b.num_rows), np.int32)
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                lead = axes.value[d][:, :2]
                cell[: lead.shape[1], at] = np.floor((_unit(_matrix(b.take(pa.array(at)), "embedding", d)) @ lead).T / width)
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, cell)], names=[*b.schema.names, "c0", "c1"])

    celled = written(classes.mapInArrow(place, T.StructType([*classes.schema.fields, *[T.StructField(c, T.IntegerType()) for c in ("c0", "c1")]])))
    block = F.greatest(F.least(F.floor(F.lit(BLOCK_NUMBERS) / F.col("dim")), F.lit(BLOCK)), F.lit(TILE))
    sizes = celled.groupBy("label", "dim", "c0", "c1").agg(F.ceil(F.count("*") / block).cast("int").alias("n"))
    # every cell tells itself and its neighbours how many blocks it has: one row for each cell, with nine numbers at most
    told = sizes.select("label", "dim", "c0", "c1", "n", F.explode(F.array(*[F.struct(F.lit(a).alias("o0"), F.lit(b).alias("o1")) for a, b in AROUND])).alias("o"))
    plan = told.groupBy("label", "dim", (F.col("c0") + F.col("o.o0")).alias("c0"), (F.col("c1") + F.col("o.o1")).alias("c1")).agg(F.max(F.when(F.expr("o.o0 = 0 and o.o1 = 0"), F.col("n"))).alias("own"), F.collect_list(F.struct("o.o0", "o.o1", "n")).alias("near")).where("own > 0")
    plan = plan.select(*[F.col(c).alias(f"_{c}") for c in ("label", "dim", "c0", "c1")], "own", "near")
    met = celled.join(plan, [F.col(c) == F.col(f"_{c}") for c in ("label", "dim", "c0", "c1")])
    met = met.withColumn("t", F.pmod(F.xxhash64("key"), F.col("own")).cast("int"))

    def pairs(x: Column) -> Column:
        """The pairs of blocks, named from the lesser cell, in which a vector meets the cell that told ``x``."""
        mine, up = F.col("t"), (x["o0"] > 0) | ((x["o0"] == 0) & (x["o1"] > 0))
        same = (x["o0"] == 0) & (x["o1"] == 0)

        def pair(o: Column) -> Column:
            fields = {"b0": F.col("c0") - F.when(up, x["o0"]).otherwise(0), "b1": F.col("c1") - F.when(up, x["o1"]).otherwise(0), "d0": F.abs(x["o0"]), "d1": F.when(up, x["o1"]).otherwise(-x["o1"])}
            i = F.when(same, F.least(o, mine)).when(up, o).otherwise(mine)
            j = F.when(same, F.greatest(o, mine)).when(up, mine).otherwise(o)
            return F.struct(*[v.alias(k) for k, v in fields.items()], i.alias("i"), j.alias("j"), F.when(same, mine > o).otherwise(up).alias("side"))

        return F.transform(F.sequence(F.lit(0), x["n"] - 1), pair)

    dealt = met.withColumn("p", F.explode(F.flatten(F.transform("near", pairs)))).select("label", "dim", "p.*", "key", "weight", "embedding")

    def compare(table: pa.Table) -> pa.Table:
        d = table["dim"][0].as_py()
        raw = table["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
        key_, weight, side = np.array(table["key"].to_pylist(), object), table["weight"].to_numpy(), table["side"].to_numpy()
        x = _unit(raw) @ axes.value[d]
        alone = not table["d0"][0].as_py() and not table["d1"][0].as_py() and table["i"][0].as_py() == table["j"][0].as_py()
        a, b = (np.arange(len(raw)),) * 2 if alone else (np.flatnonzero(~side), np.flatnonzero(side))
        links, edges = np.zeros(len(raw)), [np.empty((2, 0), int)]
        for low in range(0, len(a), TILE):
            for high in range(low if alone else 0, len(b), TILE):
                p, q = a[low : low + TILE], b[high : high + TILE]
                i, j = close_pairs(x[p], x[q], raw[p], raw[q], threshold)
                i, j = p[i], q[j]
                if alone and low == high:
                    i, j = i[i < j], j[i < j]
                links += np.bincount(i, weights=weight[j], minlength=len(raw)) + np.bincount(j, weights=weight[i], minlength=len(raw))
                some, local = np.unique(np.concatenate([i, j]), return_inverse=True)
                edges.append(np.stack([some, some[_forest(len(some), *np.split(local, 2))]]))  # no more than a tile's rows
        i, j = np.concatenate(edges, axis=1)
        at = np.flatnonzero(links)
        low = _forest(len(raw), i, j)
        return pa.table({"a": pa.array(key_[at], pa.string()), "n": pa.array(links[at].astype(np.int64)), "b": pa.array(key_[low[at]], pa.string())})

    found = written(dealt.groupBy("label", "dim", "b0", "b1", "d0", "d1", "i", "j").applyInArrow(compare, "a string, n bigint, b string"))
    roots = components(found.select("a", "b"))
    links = found.groupBy("a").agg(F.sum("n").alias("n"))
    out = classes.select("key", "weight", "first").join(links, F.col("key") == F.col("a"), "left").join(roots, F.col("key") == F.col("node"), "left")
    out = written(out.select("key", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "first", F.coalesce("root", "key").alias("root")))
    discard(classes, celled, found)
    least = out.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = out.withColumn("k", F.reverse("root")).join(least.select(F.reverse("root").alias("k"), "component_id"), "k").select(F.col("key").alias("_key"), "n_links", "component_id")
    linked = named.select("vec_id", "key").join(of_class, F.col("key") == F.col("_key")).select("vec_id", "n_links", "component_id")
    alone = vectors.where(~_usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))
