"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Two Gaussian classes with shrunk covariances (towards the pooled covariance, then towards its scaled identity); the
score is the logistic of the difference of the log-densities, each taken from a Mahalanobis distance through a Cholesky
factor that is computed once and sent with the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import discard, least_hashed, small_batches, written

STATISTICS = ("log_words", "word_length", "distinct", "symbols", "capitals", "digits", "repeats", "dup_lines", "line_length", "marks", "pipes")
#: Bound on the labelled rows that the two classes are fitted on, least keyed hashes first.
MAX_LABELLED = 50_000


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one whole text; null and empty texts give those of no words."""
    b = (text or "").encode("utf-8", "surrogatepass")
    words = b.split()
    n, chars = len(words), sum(map(len, words))
    lines = [x for x in b.split(b"\n") if x.strip()]
    share = lambda k, of: math.log((k + 0.5) / (of + 1.0))
    gone = lambda which: len(b) - len(b.translate(None, which))
    return [
        math.log1p(n),
        math.log((chars + 5.0) / (n + 1.0)),
        math.log((len(set(words)) + 1.0) / (n + 1.0)) + 0.12 * math.log1p(n),
        share(gone(b"#*$%&<>"), chars),
        share(gone(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), chars),
        share(gone(b"0123456789"), chars),
        share(sum(map(eq, words, words[1:])), n),
        share(len(lines) - len(set(lines)), len(lines)),
        math.log1p(n / (len(lines) + 1.0)),
        share(gone(b"!?"), chars),
        share(gone(b"|"), chars),
    ]


def with_statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and x, the array of the transformed statistics of each text."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.array([statistics(t) for t in b.column("_text").to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], x], names=[*keep, "x"])

    schema = docs.select(*keep).schema.add("x", T.ArrayType(T.DoubleType()))
    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and log-normalisers of the classes 0 and 1; ``shift`` and ``scale`` standardise."""

    shift: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    inverse_factors: np.ndarray
    constants: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 of each row."""
        z = (np.asarray(x, dtype=float).reshape(-1, len(self.shift)) - self.shift) / self.scale
        logs = [c - 0.5 * (((z - m) @ f.T) ** 2).sum(axis=1) for m, f, c in zip(self.means, self.inverse_factors, self.constants, strict=True)]
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit(x: np.ndarray, y: np.ndarray, to_pooled: float = 0.15, to_identity: float = 0.05) -> Discriminant:
    """Fit the two classes. A class without rows gets the pooled moments, so that every score is then the class prior."""
    d = len(STATISTICS)
    x, y = np.asarray(x, dtype=float).reshape(-1, d), np.asarray(y)
    shift = x.mean(axis=0) if len(x) else np.zeros(d)
    scale = np.maximum(x.std(axis=0), 1e-3) if len(x) else np.ones(d)
    z = (x - shift) / scale
    own = [z[y == k] for k in (0, 1)]
    pooled = sum(((c - c.mean(axis=0)).T @ (c - c.mean(axis=0)) for c in own if len(c)), np.zeros((d, d))) / max(1, len(z)) if len(z) else np.eye(d)
    means, factors, constants = [], [], []
    for c in own:
        cov = np.cov(c.T, bias=True) if len(c) > 1 else pooled
        cov = (1 - to_pooled) * cov + to_pooled * pooled
        cov = (1 - to_identity) * cov + to_identity * max(np.trace(cov) / d, 1e-6) * np.eye(d)
        low = np.linalg.cholesky(cov)
        means.append(c.mean(axis=0) if len(c) else np.zeros(d))
        factors.append(np.linalg.inv(low))
        constants.append(math.log((len(c) + 1) / (len(z) + 2)) - np.log(np.diag(low)).sum())
    return Discriminant(shift, scale, np.array(means), np.array(factors), np.array(constants))


def fit_on(stats: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Discriminant:
    """Fit on at most ``max_labelled`` rows of ``stats`` (doc_id, x) with label 0 or 1 in ``labels`` (doc_id, quality).

    Null labels do not count; a document with several labels counts with the least. The bound takes the least keyed
    hashes of doc_id: a sample that does not depend on partitions.
    """
    one = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    met = stats.join(one, "doc_id").select("doc_id", "x", "quality")
    rows = sorted(least_hashed(met, F.xxhash64("doc_id", F.lit(3)), max_labelled).collect())  # one order of summing in every run
    return fit(np.array([r["x"] for r in rows]), np.array([r["quality"] for r in rows]))


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``; ``predicted`` is 1 from ``threshold`` on.

    Rows whose crc32(doc_id as text) mod 3 is 1 never lend their labels. Null and empty texts are scored as texts without
    words; a null doc_id is scored and never learned from; repeated rows are scored alike; other columns are not read.
    """
    stats = written(with_statistics(docs.select("doc_id", "text"), ["doc_id"]))
    model = fit_on(stats.where(~held_out(F.col("doc_id"))), labels, max_labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    scored = stats.mapInArrow(run, stats.select("doc_id").schema.add("score", T.DoubleType()))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their columns; rows are scored where they stand.

    The documents to learn from are at most ``max_labelled`` ids, those with the least keyed hashes, which are broadcast.
    """
    small_batches(docs.sparkSession)
    # the ids of labelled rows are chosen first, so that no text is shuffled to meet the labels
    one = labels.where("quality in (0, 1)").select("doc_id").distinct().where(~held_out(F.col("doc_id")))
    ids = written(least_hashed(one.join(docs.select("doc_id"), "doc_id", "left_semi"), F.xxhash64("doc_id", F.lit(3)), max_labelled))
    known = written(with_statistics(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi"), ["doc_id"]))
    model = fit_on(known, labels, max_labelled)
    discard(ids, known)
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = model.score(np.array([statistics(t) for t in b.column(at).to_pylist()])) >= threshold
            yield b.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
