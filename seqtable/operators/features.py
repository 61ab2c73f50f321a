"""Feature tables: dereplicated sequences, counts per sample, merging, filters and summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Variable regions of the 16S gene on its reference, name, start and end.
REGIONS = [("V1", 69, 99), ("V2", 137, 242), ("V3", 433, 497), ("V4", 576, 682), ("V5", 822, 879), ("V6", 986, 1043), ("V7", 1117, 1173), ("V8", 1243, 1294), ("V9", 1435, 1465)]


def dereplicate(reads: DataFrame, by: tuple[str, ...] = (), *more: Column) -> DataFrame:
    """(by, seq, size, more): distinct sequences with their abundance and further aggregates; combined before the shuffle."""
    return reads.groupBy(*by, F.upper("seq").alias("seq")).agg(F.count("*").alias("size"), *more)


def by_abundance(features: DataFrame) -> DataFrame:
    return features.orderBy(F.desc("size"), "seq")


def min_size(features: DataFrame, n: int = 2, col: str = "size") -> DataFrame:
    return features.where(F.col(col) >= n)


def min_frequency(counts: DataFrame, n: int = 2) -> DataFrame:
    """Counts of features with at least ``n`` reads over all samples."""
    kept = counts.groupBy("feature_id").agg(F.sum("n").alias("_t")).where(F.col("_t") >= n)
    return counts.join(kept.select("feature_id"), "feature_id", "left_semi")


def feature_counts(reads: DataFrame) -> DataFrame:
    """(feature_id, sample_id, n): counts of each distinct sequence, named by its hash."""
    return reads.groupBy(F.md5(F.upper("seq")).alias("feature_id"), "sample_id").agg(F.count("*").alias("n"))


def keep_features(df: DataFrame, ids: DataFrame) -> DataFrame:
    return df.join(ids.select("feature_id"), "feature_id", "left_semi")


def removed_features(df: DataFrame, ids: DataFrame) -> DataFrame:
    return df.join(ids.select("feature_id"), "feature_id", "left_anti")


def check_references(counts: DataFrame, features: DataFrame, manifest: DataFrame) -> DataFrame:
    """(issue, level, n): features without sequence (error) and samples outside the manifest (warning)."""
    lost = counts.select("feature_id").distinct().join(features.select("feature_id"), "feature_id", "left_anti").agg(F.count("*").alias("n"))
    odd = counts.select("sample_id").distinct().join(manifest.select("sample_id"), "sample_id", "left_anti").agg(F.count("*").alias("n"))
    return lost.select(F.lit("feature_without_sequence").alias("issue"), F.lit("error").alias("level"), "n").unionByName(odd.select(F.lit("sample_not_in_manifest").alias("issue"), F.lit("warning").alias("level"), "n"))


def merge_tables(tables: list[DataFrame]) -> DataFrame:
    """Sum of several (feature_id, sample_id, n) tables."""
    return reduce(DataFrame.unionByName, tables).groupBy("feature_id", "sample_id").agg(F.sum("n").alias("n"))


def merge_sequences(tables: list[DataFrame]) -> DataFrame:
    """One sequence per feature_id (the least, should they differ)."""
    return reduce(DataFrame.unionByName, tables).groupBy("feature_id").agg(F.min("seq").alias("seq"))


def table_totals(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return counts.groupBy(*by).agg(F.sum("n").alias("n"))


def raw_read_counts(reads: DataFrame) -> DataFrame:
    return reads.groupBy("sample_id").agg(F.count("*").alias("raw"))


def with_counts(samples: DataFrame, raw: DataFrame, final: DataFrame) -> DataFrame:
    """Samples with raw and final read counts, 0 where there are none."""
    out = samples.join(raw.select("sample_id", "raw"), "sample_id", "left").join(final.select("sample_id", "final"), "sample_id", "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in ("raw", "final")})


def sample_summary(samples: DataFrame, raw: DataFrame, counts: DataFrame, paired: bool = False) -> DataFrame:
    """(sample_id, raw, final): paired raw counts are halved, rounding down."""
    out = with_counts(samples, raw, table_totals(counts, ("sample_id",)).withColumnRenamed("n", "final"))
    return out.withColumn("raw", F.floor(F.col("raw") / 2).cast("bigint")) if paired else out


def retention(raw: DataFrame, counts: DataFrame, paired: bool = True, threshold: float = 0.5) -> DataFrame:
    """(raw, final, pct, decision): below the threshold pairs fall back to forward reads, single reads are low quality."""
    row = raw.agg(F.sum("raw").alias("raw")).crossJoin(counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("final")))
    pct = F.try_divide(F.col("final"), F.floor(F.col("raw") / 2) if paired else F.col("raw"))
    return row.withColumn("pct", pct).withColumn("decision", F.when(F.col("pct") < threshold, "forward_reads" if paired else "low_quality").otherwise("keep"))


def abundance_check(reads: DataFrame, limit_ppt: int = 950) -> DataFrame:
    """(n, n_unique, ppt, untrustworthy): unique per thousand reads, truncated; only a single sample can fail."""
    row = reads.agg(F.count("*").alias("n"), F.countDistinct("seq").alias("n_unique"), F.countDistinct("sample_id").alias("s"))
    return _trusted(row, limit_ppt)


def derep_check(unique: DataFrame, samples: DataFrame, limit_ppt: int = 950) -> DataFrame:
    """:func:`abundance_check` of reads that are dereplicated already: (seq, size) rows, and ``samples`` with any number of rows each."""
    row = unique.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n"), F.count("*").alias("n_unique"))
    return _trusted(row.crossJoin(samples.agg(F.countDistinct("sample_id").alias("s"))), limit_ppt)


def _trusted(row: DataFrame, limit_ppt: int) -> DataFrame:
    row = row.withColumn("ppt", F.when(F.col("n") > 0, F.floor(F.col("n_unique") * 1000 / F.col("n"))).otherwise(0).cast("bigint"))
    return row.select("n", "n_unique", "ppt", ((F.col("s") == 1) & (F.col("ppt") > limit_ppt)).alias("untrustworthy"))


def length_spread(seqs: DataFrame, limit: float = 1.5) -> DataFrame:
    """(n, p05, p95, ratio, warn) of the sequence lengths, as order statistics; fewer than 20 never warn.

    Lengths are counted first, so that only distinct lengths meet in one task.
    """
    counts = seqs.groupBy(F.length("seq").alias("len")).count()
    w = Window.partitionBy(F.lit(0)).orderBy("len")
    run = counts.withColumn("upto", F.sum("count").over(w)).withColumn("n", F.sum("count").over(Window.partitionBy(F.lit(0))))
    out = run.agg(F.max("n").alias("n"), F.min(F.when(F.col("upto") >= F.floor(F.col("n") * 0.05) + 1, F.col("len"))).alias("p05"), F.min(F.when(F.col("upto") >= F.floor(F.col("n") * 0.95), F.col("len"))).alias("p95"))
    return out.withColumn("ratio", F.try_divide(F.col("p95").cast("double"), F.col("p05"))).withColumn("warn", (F.col("n") >= 20) & (F.col("ratio") > limit))


def summarize_table(counts: DataFrame) -> DataFrame:
    """(samples, features, total, sample_min, sample_median, sample_max, feature_median) of a table."""
    s = table_totals(counts, ("sample_id",)).agg(F.count("*").alias("samples"), F.sum("n").alias("total"), F.min("n").alias("sample_min"), F.percentile("n", 0.5).alias("sample_median"), F.max("n").alias("sample_max"))
    f = table_totals(counts, ("feature_id",)).agg(F.count("*").alias("features"), F.percentile("n", 0.5).alias("feature_median"))
    return s.crossJoin(f)


def dataset_totals(summary: DataFrame) -> DataFrame:
    """(dataset_id, samples, raw, final) of a sample summary whose counts are texts; bad numbers are ignored."""
    return summary.groupBy("dataset_id").agg(F.count("*").alias("samples"), *[F.coalesce(F.sum(F.col(c).cast("string").try_cast("bigint")), F.lit(0)).alias(c) for c in ("raw", "final")])


def summary_rollup(summary: DataFrame) -> DataFrame:
    """Totals per dataset, and over all (null dataset)."""
    return summary.rollup("dataset_id").agg(F.count("*").alias("samples"), F.sum("raw").alias("raw"), F.sum("final").alias("final"))


def call_region(lo: Column, hi: Column, min_overlap: float = 0.5) -> Column:
    """Name of the regions that a span covers by at least ``min_overlap`` of their width, first to last."""
    every = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(s).alias("s"), F.lit(e).alias("e")) for n, s, e in REGIONS])
    covered = F.filter(every, lambda r: F.greatest(F.lit(0), F.least(hi, r["e"]) - F.greatest(lo, r["s"])) >= min_overlap * (r["e"] - r["s"]))
    return F.when(F.size(covered) == 0, "unclassified").when(F.size(covered) == len(REGIONS), "V1-V9").when(F.size(covered) == 1, F.get(covered, F.lit(0))["name"]).otherwise(F.concat(F.get(covered, F.lit(0))["name"], F.lit("-"), F.element_at(covered, -1)["name"]))


def call_regions(spans: DataFrame) -> DataFrame:
    return spans.withColumn("region", call_region(F.col("lo"), F.col("hi")))


def region_consensus(spans: DataFrame, by: tuple[str, ...] = ("dataset_id",)) -> DataFrame:
    """(by, region, lo, hi, confidence, n): region of the median span, and the share of spans with that region, in hundredths."""
    mid = spans.groupBy(*by).agg(F.percentile("lo", 0.5).cast("int").alias("_lo"), F.percentile("hi", 0.5).cast("int").alias("_hi")).withColumn("_region", call_region(F.col("_lo"), F.col("_hi")))
    same = (F.col("region") == F.col("_region")).cast("double")
    met = call_regions(spans).join(F.broadcast(mid) if not by else mid, list(by))
    return met.groupBy(*by, F.col("_region").alias("region"), F.col("_lo").alias("lo"), F.col("_hi").alias("hi")).agg(F.bround(F.avg(same), 2).alias("confidence"), F.count("*").alias("n")).select(*by, "region", "lo", "hi", "confidence", "n")


def layout(files: DataFrame) -> DataFrame:
    """(dataset_id, n_se, n_pe, layout): the majority of single files and pairs; ties are pairs."""
    per = files.groupBy("dataset_id", "sample_id").agg(F.countDistinct("mate").alias("mates"))
    out = per.groupBy("dataset_id").agg(F.count_if(F.col("mates") < 2).alias("n_se"), F.count_if(F.col("mates") == 2).alias("n_pe"))
    return out.withColumn("layout", F.when(F.col("n_pe") >= F.col("n_se"), "PE").otherwise("SE"))


def keep_layout(files: DataFrame, merge: bool = False) -> DataFrame:
    """The files of each dataset's majority layout; those of the minority go or, with ``merge``, join a single-end dataset.

    A paired sample in a single-end dataset then gives both its files as single ones (mate null); a single file never
    joins pairs.
    """
    per = files.groupBy("dataset_id", "sample_id").agg((F.countDistinct("mate") == 2).alias("_pair"))
    met = files.join(per, ["dataset_id", "sample_id"]).join(layout(files).select("dataset_id", (F.col("layout") == "PE").alias("_pe")), "dataset_id")
    kept = met if merge else met.where("_pair = _pe")
    kept = kept.where("_pair or not _pe").withColumn("mate", F.when(F.col("_pe") | ~F.col("_pair"), F.col("mate")))
    return kept.drop("_pair", "_pe")


def completeness(files: DataFrame, runs: DataFrame) -> DataFrame:
    """(dataset_id, n_runs, n_files, complete, layout): one or two files for every run; pairs if mates 2 are nine tenths of mates 1."""
    f = files.groupBy("dataset_id").agg(F.count("*").alias("n_files"), F.count_if(F.col("mate") == 1).alias("r1"), F.count_if(F.col("mate") == 2).alias("r2"))
    r = runs.groupBy("dataset_id").agg(F.count("*").alias("n_runs"))
    out = r.join(f, "dataset_id", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_files", "r1", "r2")})
    done = (F.col("n_files") == F.col("n_runs")) | (F.col("n_files") == 2 * F.col("n_runs"))
    return out.select("dataset_id", "n_runs", "n_files", done.alias("complete"), F.when((F.col("r2") > 0) & (10 * F.col("r2") >= 9 * F.col("r1")), "PE").otherwise("SE").alias("layout"))


def merge_rate(pairs: DataFrame, merged: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(sample_id, n_pairs, n_merged, rate, use): samples that merge too rarely use their forward reads."""
    a, b = (d.groupBy("sample_id").agg(F.count("*").alias(n)) for d, n in ((pairs, "n_pairs"), (merged, "n_merged")))
    out = a.join(b, "sample_id", "left").withColumn("n_merged", F.coalesce("n_merged", F.lit(0)))
    rate = F.col("n_merged") / F.col("n_pairs")
    return out.withColumn("rate", rate).withColumn("use", F.when(F.col("rate") < threshold, "forward").otherwise("merged"))


def dataset_summary(regions: DataFrame, quality: DataFrame, platforms: DataFrame, totals: DataFrame) -> DataFrame:
    """One row per dataset of ``totals`` with region, quality and platform; NA where one is missing."""
    out = totals
    for table, cols in ((platforms, ["platform"]), (quality, ["quality_status"]), (regions, ["region", "lo", "hi", "confidence"])):
        out = out.join(table.select("dataset_id", *cols), "dataset_id", "left")
    return out.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in ("platform", "quality_status", "region", "lo", "hi", "confidence")})


def prefix_collisions(samples: DataFrame) -> DataFrame:
    """(sample_id, other): samples whose name is a proper prefix of another; prefixes are exploded and met by equality."""
    names = samples.select("sample_id").distinct()
    prefixes = names.where(F.length("sample_id") > 1).select(F.col("sample_id").alias("other"), F.explode(F.sequence(F.lit(1), F.length("sample_id") - 1)).alias("k"))
    return prefixes.select("other", F.substr(F.col("other"), F.lit(1), F.col("k")).alias("sample_id")).join(names, "sample_id").select("sample_id", "other")


def drop_orphans(files: DataFrame) -> DataFrame:
    """Files without mates that are of no use: lone first mates go, and the single file of a sample that has both mates."""
    per = files.groupBy("dataset_id", "sample_id").agg(F.bool_or(F.col("mate") == 1).alias("_1"), F.bool_or(F.col("mate") == 2).alias("_2"))
    met = files.join(per, ["dataset_id", "sample_id"])
    both = F.coalesce(F.col("_1") & F.col("_2"), F.lit(False))
    return met.where(F.when(F.col("mate").isNull(), ~both).otherwise(both)).drop("_1", "_2")
