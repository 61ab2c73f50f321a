"""Hard-negative mining: exact integer inner products of anchors with all rows by Strassen's recursion, tile by tile.

Anchors and candidates are dealt into a grid of blocks. A cell multiplies its anchors with tiles of its candidates, as
64-bit integers, and keeps a heap of the best entries for each anchor; heaps are merged from tile to tile and, over the
cells, in Spark. Two passes: the first finds each anchor's positives, where only rows of the anchor's label are
multiplied; the second, which knows their scores, finds the negatives inside the window below each positive.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import discard, small_batches, written

#: Anchors of a block, candidates multiplied at a time, and most candidates of a block.
ANCHORS, TILE, BLOCK = 1024, 2048, 16384
#: The recursion ends where a side is this short.
LEAF = 16
_LAST = np.iinfo(np.int64).max


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The exact product of two int64 matrices: seven products of halves for eight, odd sides filled up with a zero.

    Sums of quarters may leave 64 bits on the way; they wrap, and the result is right modulo 2**64.
    """
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2  # noqa: E741
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    out = np.empty((2 * i, 2 * l), np.int64)
    one = strassen(a11 + a22, b11 + b22, leaf)
    two = strassen(a21 + a22, b11, leaf)
    three = strassen(a11, b12 - b22, leaf)
    four = strassen(a22, b21 - b11, leaf)
    five = strassen(a11 + a12, b22, leaf)
    out[:i, :l] = one + four - five + strassen(a12 - a22, b21 + b22, leaf)
    out[:i, l:] = three + five
    out[i:, :l] = two + four
    out[i:, l:] = one - two + three + strassen(a21 - a11, b11 + b12, leaf)
    return out[:m, :n]


class Heaps:
    """The ``size`` best entries of each of ``n`` rows: higher score first, then smaller id; ids of null come last."""

    def __init__(self, n: int, size: int) -> None:
        self.n, self.size = n, size
        self.row, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))

    def merge(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Take in further entries."""
        row, score, ids = np.concatenate([self.row, row]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score, row))
        row = row[order]
        first = np.searchsorted(row, np.arange(self.n))
        kept = np.arange(len(row)) - first[row] < self.size
        self.row, self.score, self.id = row[kept], score[order][kept], ids[order][kept]

    def offer(self, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Take in a matrix, a row for each heap, where ``allowed``; what lies below the row's ``size`` best is not looked at."""
        if scores.shape[1] > self.size:
            low = np.iinfo(np.int64).min
            least = np.partition(np.where(allowed, scores, low), -self.size, axis=1)[:, -self.size]
            allowed = allowed & (scores >= least[:, None])
        row, at = np.nonzero(allowed)
        self.merge(row, scores[row, at], ids[at])


def _usable(d: Column) -> Column:
    """Label and vector given, all components finite and small enough for 64-bit inner products."""
    limit = F.sqrt(F.lit(2.0**63) / F.greatest(F.size(d), F.lit(1))) - 1
    return F.coalesce(F.forall(d, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * 256) < limit)), F.lit(False)) & F.col("label").isNotNull()


def _ints(t: pa.Table, d: int) -> np.ndarray:
    x = t["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(256 * x).astype(np.int64).reshape(t.num_rows, d)


def _numbers(t: pa.Table, column: str, null: int) -> np.ndarray:
    return t[column].combine_chunks().fill_null(null).to_numpy(zero_copy_only=False)


def _sides(t: pa.Table) -> tuple[pa.Table, pa.Table]:
    side = t["is_anchor"].combine_chunks()
    candidates = t.filter(pa.compute.invert(side))
    return t.filter(side), candidates.take(pa.compute.sort_indices(candidates, [("vec_id", "ascending"), ("row", "ascending")]))


def _products(anchors: pa.Table, candidates: pa.Table, d: int):
    """(first, last, scores) of each tile of the candidates."""
    a = _ints(anchors, d)
    for low in range(0, candidates.num_rows, TILE):
        some = candidates.slice(low, TILE)
        yield low, low + some.num_rows, strassen(a, np.ascontiguousarray(_ints(some, d).T)) if d else np.zeros((len(a), some.num_rows), np.int64)


def _entries(heaps: Heaps, columns: dict[str, pa.Array]) -> pa.Table:
    return pa.table({**columns, "id": pa.array(heaps.id, mask=heaps.id == _LAST), "score": pa.array(heaps.score)})


def mine(vectors: DataFrame, n_positives: int = 5, n_negatives: int = 5, low_percent: int = 80, high_percent: int = 100, anchors_every: int = 100, mislabel_every: int | None = 7, n_labels: int = 10) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of (vec_id, embedding, label) rows.

    Components become floor(256 * x). Anchors are the rows whose vec_id is divisible by ``anchors_every``; their positives
    are the best ``n_positives`` other rows of their label. For each positive the best ``n_negatives`` rows of another label
    are given whose score lies between ``low_percent`` and ``high_percent`` of the positive's. Where vec_id is divisible by
    ``mislabel_every`` the label first becomes (label + 1) % ``n_labels`` (None: nowhere).

    Rows with a null label or vector, null or non-finite components, or components whose inner products could leave 64 bits
    take no part; vectors of different dimensions do not meet. A null vec_id is a candidate that loses every tie. Rows that
    repeat a vec_id are rows of their own, and each is an anchor. Anchors without positives, and positives without
    negatives, have no row. Other columns are not read.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    label = F.col("label").cast("long")
    if mislabel_every:
        label = F.when(F.col("vec_id") % mislabel_every == 0, (label + 1) % n_labels).otherwise(label)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col("embedding").cast(kind).alias("embedding"))
    rows = rows.where(_usable(F.col("embedding"))).select("vec_id", label.alias("label"), "embedding", F.size("embedding").alias("dim"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()))  # written, so that the numbers stay
    of = rows.where(F.col("vec_id") % anchors_every == 0)
    n, m = rows.count(), of.count()
    n_blocks = max(1, -(-n // min(BLOCK, max(512, n // 32))))
    n_rows = max(1, -(-m // ANCHORS))
    block = lambda of, seed: F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(of)).cast("int")

    def dealt(anchors: DataFrame) -> DataFrame:
        """Anchors and candidates, each in all cells of its row or column of the grid."""
        each = lambda of: F.explode(F.sequence(F.lit(0), F.lit(of - 1)))
        a = anchors.withColumns({"r": block(n_rows, 1), "is_anchor": F.lit(True)}).withColumn("c", each(n_blocks))
        c = rows.withColumns({"c": block(n_blocks, 2), "is_anchor": F.lit(False)}).withColumn("r", each(n_rows))
        return a.unionByName(c, allowMissingColumns=True).groupBy("dim", "r", "c")

    def positives(t: pa.Table) -> pa.Table:
        d = t["dim"][0].as_py()
        anchors, candidates = _sides(t)
        own, theirs = anchors["label"].to_numpy(), candidates["label"].to_numpy()
        found = []
        for label in np.unique(own):
            a, c = anchors.filter(pa.array(own == label)), candidates.filter(pa.array(theirs == label))
            heaps, me, ids, they = Heaps(a.num_rows, n_positives), a["row"].to_numpy(), _numbers(c, "vec_id", _LAST), c["row"].to_numpy()
            for low, high, scores in _products(a, c, d):
                heaps.offer(scores, me[:, None] != they[None, low:high], ids[low:high])
            found.append(_entries(heaps, {"row": pa.array(me[heaps.row])}))
        return pa.concat_tables(found) if found else _entries(Heaps(0, 1), {"row": pa.array([], pa.int64())})

    def negatives(t: pa.Table) -> pa.Table:
        d = t["dim"][0].as_py()
        anchors, candidates = _sides(t)
        own, theirs, ids = anchors["label"].to_numpy(), candidates["label"].to_numpy(), _numbers(candidates, "vec_id", _LAST)
        # the k-th positive's score of each anchor; anchors are few, and so are their positives
        given = [[p["score"] for p in ps] for ps in anchors["positives"].to_pylist()]
        heaps = [Heaps(len(own), n_negatives) for _ in range(n_positives)]
        for low, high, scores in _products(anchors, candidates, d):
            other = own[:, None] != theirs[None, low:high]
            for k, heap in enumerate(heaps):
                at = [i for i, ps in enumerate(given) if len(ps) > k]
                # the window in whole numbers: 100 * score >= 80 * positive is score >= ceil(80 * positive / 100)
                window = np.full((2, len(own)), 1, np.int64)
                window[1] = 0
                if at:
                    window[0, at] = [-(-low_percent * given[i][k] // 100) for i in at]
                    window[1, at] = [high_percent * given[i][k] // 100 for i in at]
                heap.offer(scores, other & (scores >= window[0, :, None]) & (scores <= window[1, :, None]), ids[low:high])
        rows_ = anchors["row"].to_numpy()
        return pa.concat_tables([_entries(h, {"row": pa.array(rows_[h.row]), "k": pa.array(np.full(len(h.row), k, np.int32))}) for k, h in enumerate(heaps)])

    best = (F.desc("score"), F.asc_nulls_last("id"))
    met = dealt(of).applyInArrow(positives, "row long, id long, score long")
    first = met.withColumn("k", F.row_number().over(Window.partitionBy("row").orderBy(*best)) - 1).where(F.col("k") < n_positives)
    first = written(first.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("k", "id", "score"))).alias("positives")))
    anchors = written(of.join(first, "row"))
    met = dealt(anchors).applyInArrow(negatives, "row long, k int, id long, score long")
    ranked = met.withColumn("rank", F.row_number().over(Window.partitionBy("row", "k").orderBy(*best))).where(F.col("rank") <= n_negatives)
    named = anchors.select(F.col("row").alias("_row"), F.col("vec_id").alias("anchor_id"), "positives")
    out = ranked.join(named, F.col("row") == F.col("_row")).withColumn("p", F.get("positives", F.col("k")))
    out = written(out.select("anchor_id", F.col("p.id").alias("positive_id"), "rank", F.col("id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score")))
    discard(rows, first, anchors)
    return out
