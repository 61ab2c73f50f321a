"""Whole pipelines from reads to tables; each long step is a written stage."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import features as ft
from ..operators import profiles as pf
from ..operators import reads as rd
from ..operators import similarity as sm
from .stages import scope, staged


class Tables(NamedTuple):
    """What a pipeline gives: counts (feature_id, sample_id, n), a row for each feature that they hold, and the one row of its guard."""

    counts: DataFrame
    features: DataFrame
    guard: DataFrame


def otu_pipeline(reads: DataFrame, minsize: int = 2, strand: str = "plus") -> Tables:
    """Counts, representatives (feature_id, seq, size) and the abundance check of short reads (sample_id, seq).

    Dereplicate, check, cluster at 99 %, denoise, remove chimeras, cluster at 97 %, map back, drop rare features and their
    sequences. Where the check says that the reads cannot be trusted, both tables are empty. Reads without a sequence do not
    count. The tables are written; all others made on the way are deleted.
    """
    with scope() as keep:
        reads = reads.where("seq is not null")
        every = staged(ft.dereplicate(reads))
        guard = keep(ft.derep_check(every, reads))
        if guard.first()["untrustworthy"]:
            reads, every = reads.limit(0), every.limit(0)
        unique = staged(ft.min_size(every, minsize).select(F.md5("seq").alias("feature_id"), "seq", "size"))
        close = staged(sized(unique, sm.greedy_cluster(unique, 0.99, strand=strand)))
        clean = staged(sized(close, sm.denoise_by_skew(close, minsize, strand=strand)))
        clean = staged(sm.remove_chimeras(clean))
        otus = staged(sized(clean, sm.greedy_cluster(clean, 0.97, strand=strand)))
        counts = keep(ft.min_frequency(staged(sm.map_back(reads, otus, 0.97, strand)), 2))
        return Tables(counts, keep(ft.keep_features(otus, counts)), guard)


def ont_pipeline(reads: DataFrame, q: float = 10, lo: int | None = None, hi: int | None = None, mapping: Callable[..., DataFrame] = sm.map_back) -> Tables:
    """Counts, representatives (feature_id, seq, size) and length window (lo, hi) of long reads (sample_id, seq, qual).

    Filter by quality and length, denoise each sample, merge, cluster at 97 %, map back at 90 %, all on both strands, and
    drop rare features and their sequences. A bound of the window that is not given is detected from the first 10,000 reads
    of each file, by ``read_no``, or from all where there is no such column. ``mapping`` compares all reads exactly;
    ``longreads.map_long`` is for reads of full length. The tables are written; all others made on the way are deleted.
    """
    with scope() as keep:
        if lo is None or hi is None:
            numbered = reads if "read_no" in reads.columns else reads.withColumn("read_no", F.lit(0))
            found = pf.length_window(numbered.where("length(seq) > 0")).first()
            lo, hi = found["lo"] if lo is None else lo, found["hi"] if hi is None else hi
        guard = keep(reads.sparkSession.range(1).select(F.lit(lo).cast("int").alias("lo"), F.lit(hi).cast("int").alias("hi")))
        kept = staged(rd.filter_mean_quality(reads, q, lo, hi))
        per = staged(ft.dereplicate(kept, ("sample_id",)).withColumn("feature_id", F.md5("seq")))
        clean = sm.denoise_by_skew(per, 1, by=("sample_id",), strand="both")
        named = per.select(F.col("sample_id").alias("_sample"), F.col("feature_id").alias("_id"), "size")
        size = clean.join(named, F.col("sample_id").eqNullSafe(F.col("_sample")) & (F.col("feature_id") == F.col("_id"))).groupBy(F.col("centroid_id").alias("feature_id")).agg(F.sum("size").alias("size"))
        merged = staged(ft.merge_sequences([per.select("feature_id", "seq")]).join(size, "feature_id"))
        otus = staged(sized(merged, sm.greedy_cluster(merged, 0.97, strand="both")))
        counts = keep(ft.min_frequency(staged(mapping(kept, otus, 0.90, "both")), 2))
        return Tables(counts, keep(ft.keep_features(otus, counts)), guard)


def merge_or_forward(pairs: DataFrame, min_overlap: int = 10, max_diff_pct: float = 10.0, min_rate: float = 0.5) -> DataFrame:
    """(sample_id, read_no, seq, qual, use) of read pairs: merged, or the forward reads of samples that merge too rarely.

    One decision for each sample, a small table, routes the rows: of a sample whose share of merged pairs is below
    ``min_rate`` every forward read stands, of the others the pairs that merged.
    """
    pairs = staged(pairs.select("sample_id", "read_no", "seq1", "qual1", "seq2", "qual2"))
    merged = staged(sm.merge_pairs(pairs, min_overlap, max_diff_pct))
    decided = staged(ft.merge_rate(pairs, merged, min_rate).select(F.col("sample_id").alias("_sample"), "use"))
    forward = pairs.select("sample_id", "read_no", F.col("seq1").alias("seq"), F.col("qual1").alias("qual"))
    both = merged.withColumn("_is", F.lit("merged")).unionByName(forward.withColumn("_is", F.lit("forward")))
    return both.join(decided, (F.col("sample_id") == F.col("_sample")) & (F.col("_is") == F.col("use"))).select("sample_id", "read_no", "seq", "qual", "use")


def sized(features: DataFrame, clusters: DataFrame) -> DataFrame:
    return sm.cluster_sizes(features, clusters)


def merge_and_classify(tables: list[DataFrame], sequences: list[DataFrame], reference: DataFrame, model: DataFrame, keep: DataFrame | None = None, confidence: float = 0.7) -> Tables:
    """Counts, taxonomy and length spread of several datasets: merge, orient, keep what the reference fits, look at the lengths,
    classify, keep a given list.

    A warning of the spread (features of several regions) stops nothing. The tables are written; all others made on the way
    are deleted.
    """
    with scope() as done:
        counts, seqs = staged(ft.merge_tables(tables)), staged(ft.merge_sequences(sequences))
        oriented = staged(sm.orient(seqs, reference)[0])
        guard = done(ft.length_spread(oriented))
        counts = ft.keep_features(counts, oriented)
        taxonomy = sm.classify(oriented, model, confidence)
        if keep is not None:
            counts, taxonomy = ft.keep_features(counts, keep), ft.keep_features(taxonomy, keep)
        return Tables(done(counts), done(taxonomy), guard)
