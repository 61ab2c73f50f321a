"""Positional profiles of reads and what is decided from them: primers, tails, length windows, quality."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import count_n, iupac_mask, revcomp
from ..plans.stages import staged
from .reads import head_reads

BASES = "ACGT"
#: Primers of the 16S gene, forward and reverse.
FORWARD = [("1100F", "YAACGAGCGCAACCC"), ("27F", "AGAGTTTGATCMTGGCTCAG"), ("799F(3)", "AACMGGATTAGATACCCKG"), ("341F357F", "TACGGRNGGCWGCAG"), ("515F518F", "YCAGCMGCCGCGGTAA"), ("784f", "RGGATTAGATACCC"), ("926f", "TAAAACTYAAAKGAATTGACGGGG"), ("939f", "GAATTGACGGGGGCCCGCACAAG"), ("969f", "ACGCGHNRAACCTTACC")]
REVERSE = [("1064RD", "CGACRRCCATGCANCACCT"), ("1100RD", "GGGTTGCGCTCGTTG"), ("1193RD", "ACGTCATCCCCACCTTCC"), ("1391RD", "CGGTGTGTACAAGGCCCGGGAACG"), ("1406RD", "ACGGGCRGTGWGTRCAA"), ("1492RD", "TACGGYTACCTTGTTAYGACTT"), ("336R", "ACTGCTGCSYCCCGTAG"), ("388R", "GTGCTGCCTCCCGTAGGAGT"), ("503RD", "CCGCGGCTGCTGGCAC"), ("518R(2)", "CGTATTACCGCGGCTGCTGG"), ("534RD", "ATTACCGCGGCTGCTGG"), ("806RD", "CTACNVGGGTWTCTAAT"), ("926R1D", "CCGYCAATTYMTTTRAGT")]


def letter_counts(strings: DataFrame, by_position: bool = True) -> DataFrame:
    """(pos, code, n): how often each byte stands at each position (from 0; all 0 if not ``by_position``) of a column of strings.

    Counted in numpy batch by batch; a task sends a row for each position and letter that it has seen. Null and empty
    strings have no letters.
    """
    name = strings.columns[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        for b in batches:
            texts = b.column(0).cast(pa.large_string()).fill_null("")
            bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
            raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
            at = raw.astype(np.int64)
            if by_position:
                at += 256 * (np.arange(len(raw)) - np.repeat(bounds[:-1] - bounds[0], np.diff(bounds)))
            if len(at) and int(at.max()) < 16 * len(at):
                n = np.bincount(at)
                new = np.flatnonzero(n)
                n = n[new]
            else:  # few long strings
                new, n = np.unique(at, return_counts=True)
            keys, inverse = np.unique(np.concatenate([keys, new]), return_inverse=True)
            counts = np.bincount(inverse, np.concatenate([counts, n]), len(keys)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array((keys // 256).astype(np.int32)), pa.array((keys % 256).astype(np.int32)), pa.array(counts)], names=["pos", "code", "n"])

    return strings.select(name).mapInArrow(run, "pos int, code int, n bigint").groupBy("pos", "code").agg(F.sum("n").alias("n"))


def base_profile(reads: DataFrame, n: int = 60) -> DataFrame:
    """(pos, n, a, c, g, t): shares of A, C, G and T at each of the first ``n`` positions (from 0); 0.25 each without any.

    Letters are combined by position before the shuffle: a task sends at most ``n`` rows, however many reads it has.
    """
    letters = letter_counts(reads.select(F.substring(F.upper("seq"), 1, n).alias("s")))
    counts = letters.groupBy("pos").agg(*[F.coalesce(F.sum(F.when(F.col("code") == ord(b), F.col("n"))), F.lit(0)).alias(b) for b in BASES])
    every = reads.sparkSession.range(n).select(F.col("id").cast("int").alias("pos"))
    long = every.join(counts, "pos", "left").select("pos", *[F.coalesce(b, F.lit(0)).alias(b) for b in BASES])
    total = F.col("A") + F.col("C") + F.col("G") + F.col("T")
    return long.select("pos", total.alias("n"), *[F.when(total > 0, F.col(b) / total).otherwise(0.25).alias(b.lower()) for b in BASES])


def _ranked() -> Column:
    """Shares of a position with their base, largest first; ties in the order A, C, G, T."""
    return F.array_sort(F.array(*[F.struct((-F.col(b.lower())).alias("f"), F.lit(i).alias("i"), F.lit(b).alias("b")) for i, b in enumerate(BASES)]))


def position_states(profile: DataFrame) -> DataFrame:
    """(pos, state, base): C with one dominant base, D with two, else V."""
    r = profile.withColumn("r", _ranked())
    f1, f2 = -F.col("r")[0]["f"], -F.col("r")[1]["f"]
    state = F.when(f1 >= 0.80, "C").when((f1 + f2 >= 0.80) & (f2 >= 0.10), "D").otherwise("V")
    return r.select("pos", state.alias("state"), F.col("r")[0]["b"].alias("base"))


def consensus(states: DataFrame, n: int = 30) -> DataFrame:
    """(consensus,): the dominant base where a position is C, else N; one row of ``n`` letters."""
    letters = F.array_sort(F.collect_list(F.struct("pos", F.when(F.col("state") == "C", F.col("base")).otherwise("N").alias("x"))))
    return states.where(F.col("pos") < n).agg(F.array_join(F.transform(letters, lambda s: s["x"]), "").alias("consensus"))


def primer_boundary(states: DataFrame, lo: int = 10, hi: int = 30, max_v: int = 2) -> DataFrame:
    """(boundary,): length of the longest prefix of C and D; runs of at most ``max_v`` V between three or more others are tolerated.

    ``states`` has one row per position. Runs are numbered by changes (gaps and islands); a boundary below ``lo`` is 0.
    """
    w = Window.partitionBy(F.lit(0)).orderBy("pos")
    v = F.col("state") == "V"
    runs = states.withColumn("v", v).withColumn("change", F.coalesce((F.col("v") != F.lag("v").over(w)).cast("int"), F.lit(0))).withColumn("run", F.sum("change").over(w))
    runs = runs.groupBy("run", "v").agg(F.min("pos").alias("start"), F.count("*").alias("len"))
    at = Window.partitionBy(F.lit(0)).orderBy("run")
    runs = runs.withColumn("before", F.coalesce(F.lag("len").over(at), F.lit(0))).withColumn("after", F.coalesce(F.lead("len").over(at), F.lit(0)))
    kept = (F.col("len") <= max_v) & (F.col("before") >= 3) & (F.col("after") >= 3)
    bad = F.min(F.when(F.col("v") & ~kept & (F.col("start") < hi), F.col("start")))
    ceiling = F.greatest(F.lit(hi), F.coalesce(F.max(F.when(F.col("v") & kept & (F.col("start") < hi), F.col("start") + F.col("len"))), F.lit(0)))
    out = runs.agg(F.coalesce(bad, ceiling, F.lit(0)).cast("int").alias("b"), F.sum("len").alias("n"))
    b = F.least(F.col("b"), F.coalesce(F.col("n"), F.lit(0)).cast("int"))
    return out.select(F.when(b < lo, 0).otherwise(b).alias("boundary"))


def match_primers(consensus_row: DataFrame, primers: list[tuple[str, str]], min_identity: float = 0.85) -> DataFrame:
    """(name, trim, identity) of the best primer in either orientation at any offset; no row if none reaches ``min_identity``.

    N of the consensus says nothing; at least half of a primer must be told. Ties go to the first primer, its own
    orientation, the least offset. ``primers`` is a short list.
    """
    spark = consensus_row.sparkSession
    db = spark.createDataFrame([(i, n, s) for i, (n, s) in enumerate(primers)], "ord int, name string, fwd string")
    both = db.select("ord", F.explode(F.array(F.struct(F.lit(0).alias("rc"), "name", F.col("fwd").alias("primer")), F.struct(F.lit(1).alias("rc"), F.concat("name", F.lit("_RC")).alias("name"), revcomp(F.col("fwd")).alias("primer")))).alias("x")).select("ord", "x.*")
    size = F.length("consensus") - F.length("primer")
    placed = both.crossJoin(consensus_row).where(size >= 0).withColumn("offset", F.explode(F.sequence(F.lit(0), size)))
    letters = F.zip_with(F.split(F.substr(F.col("consensus"), F.col("offset") + 1, F.length("primer")), ""), F.split("primer", ""), lambda a, b: F.struct((a != "N").alias("told"), F.coalesce(iupac_mask(a).bitwiseAND(iupac_mask(b)) > 0, a == b).alias("fits")))
    told, fit = (F.size(F.filter("z", f)) for f in (lambda z: z["told"], lambda z: z["told"] & z["fits"]))
    scored = placed.withColumn("z", F.filter(letters, lambda z: z["told"].isNotNull())).withColumn("told", told).withColumn("fit", fit)
    ok = scored.where((F.col("told") > 0) & (F.col("told") >= 0.5 * F.length("primer"))).withColumn("identity", F.col("fit") / F.col("told")).where(F.col("identity") >= min_identity)
    best = ok.agg(F.min(F.struct((-F.col("identity")).alias("i"), "ord", "rc", "offset", "name", F.length("primer").alias("len"), "identity")).alias("b")).where("b is not null")
    return best.select("b.name", (F.col("b.offset") + F.col("b.len")).alias("trim"), "b.identity")


def detect_primer(reads: DataFrame, primers: list[tuple[str, str]] | None = None) -> DataFrame:
    """(detected, name, trim, consensus, boundary, d_density): database match, else the boundary unless it looks like a gene."""
    states = staged(position_states(base_profile(reads)))  # 60 rows, read four times
    b = primer_boundary(states)
    density = states.crossJoin(b).where("pos < boundary").agg(F.coalesce(F.avg((F.col("state") == "D").cast("double")), F.lit(0.0)).alias("d_density"))
    one = consensus(states, 30)
    hit = match_primers(one, primers or FORWARD)
    row = one.crossJoin(b).crossJoin(density).join(hit, F.lit(True), "left")
    trim = F.when(F.col("name").isNotNull(), F.col("trim")).when(F.col("boundary") >= 30, 0).when(F.col("d_density") > 0.25, 0).otherwise(F.col("boundary"))
    name = F.when(F.col("name").isNotNull(), F.col("name")).when((trim > 0), "unknown").otherwise("none")
    return row.select((trim > 0).alias("detected"), name.alias("name"), trim.cast("int").alias("trim"), F.substr(F.col("consensus"), F.lit(1), trim.cast("int")).alias("consensus"), "boundary", "d_density")


def mixed_orientation(reads: DataFrame, profile: DataFrame, n: int = 15) -> DataFrame:
    """(mixed, n_bimodal, best_pos, majority, minority, ratio): whether two bases share more than half of the first positions."""
    r = profile.where(F.col("pos") < n).withColumn("r", _ranked())
    f1, f2 = -F.col("r")[0]["f"], -F.col("r")[1]["f"]
    bimodal = (f1 + f2 > 0.85) & (f2 > 0.15) & (f1 < 0.85)
    best = r.agg(F.count_if(bimodal).alias("n_bimodal"), F.count("*").alias("n"), F.min(F.when(bimodal, F.struct((-f2).alias("f"), "pos", F.col("r")[0]["b"].alias("maj"), F.col("r")[1]["b"].alias("mino")))).alias("b"))
    best = best.select("n_bimodal", (F.col("n_bimodal") / F.col("n") > 0.5).alias("mixed"), "b.pos", "b.maj", "b.mino")
    split = reads.select("seq").crossJoin(F.broadcast(best)).agg(F.avg((F.upper(F.substr(F.col("seq"), F.col("pos") + 1, F.lit(1))) == F.col("mino")).cast("double")).alias("share"))
    on = lambda c: F.when(F.col("mixed"), c)
    return best.crossJoin(split).select("mixed", "n_bimodal", on(F.col("pos")).alias("best_pos"), on(F.col("maj")).alias("majority"), on(F.col("mino")).alias("minority"), on(F.coalesce("share", F.lit(0.0))).alias("ratio"))


def length_window(reads: DataFrame, tolerance: float = 0.15, floor: int = 200, n: int = 10000, bin_: int = 50) -> DataFrame:
    """(center, share, lo, hi): window about the modal length bin if it and its neighbours hold a quarter, else about the median."""
    rows = head_reads(reads, n).select(F.length("seq").alias("len"))
    bins = rows.groupBy(F.floor(F.col("len") / bin_).alias("b")).count()
    top = bins.agg(F.min(F.struct((-F.col("count")).alias("n"), "b")).alias("t"), F.sum("count").alias("total")).select(F.col("t.b").alias("top"), "total")
    near = bins.crossJoin(F.broadcast(top)).agg(F.first("top").alias("top"), (F.sum(F.when(F.abs(F.col("b") - F.col("top")) <= 1, F.col("count"))) / F.first("total")).alias("share"))
    row = near.crossJoin(rows.agg(F.percentile("len", 0.5).alias("median")))
    center = F.when(F.col("share") >= 0.25, F.col("top") * bin_ + bin_ // 2).otherwise(F.col("median")).cast("int")
    lo = F.greatest(F.lit(floor), F.bround(center * (1 - tolerance)).cast("int"))
    hi = F.bround(center * (1 + tolerance)).cast("int")
    return row.select(center.alias("center"), "share", lo.alias("lo"), F.when(hi <= lo, lo + 50).otherwise(hi).alias("hi"))


def leading_run(df: DataFrame, by: list[str], pos: str, pred: Column) -> DataFrame:
    """(by, run): how many positions from 0 on satisfy ``pred``."""
    grouped = df.groupBy(*by) if by else df.groupBy()
    return grouped.agg(F.coalesce(F.min(F.when(~pred, F.col(pos))), F.max(pos) + 1).alias("run"))


def tail_profile(reads: DataFrame, n: int = 10000, width: int = 50, cap: int = 30) -> DataFrame:
    """(trim_length, max_ambiguous): bases to cut at the 3' end by the share of N there, and the 95th percentile of N per read after that.

    The background is the mean share 25 to 44 bases from the end; a position counts above the larger of three times that
    and 0.01.
    """
    rows = head_reads(reads, n)
    tail = F.reverse(F.upper(F.substring("seq", -width, width)))
    seen = letter_counts(rows.select(tail.alias("s"))).groupBy("pos").agg((F.sum(F.when(F.col("code") == ord("N"), F.col("n")).otherwise(0)) / F.sum("n")).alias("f"))
    freq = rows.sparkSession.range(width).select(F.col("id").cast("int").alias("pos")).join(seen, "pos", "left").select("pos", F.coalesce("f", F.lit(0.0)).alias("f"))
    limit = freq.agg(F.greatest(3 * F.avg(F.when(F.col("pos").between(25, 44), F.col("f"))), F.lit(0.01)).alias("limit"))
    run = leading_run(freq.crossJoin(F.broadcast(limit)), [], "pos", F.col("f") > F.col("limit")).select(F.least("run", F.lit(cap)).cast("int").alias("trim_length"))
    cut = F.when(F.length("seq") > F.col("trim_length"), F.substr(F.col("seq"), F.lit(1), F.length("seq") - F.col("trim_length"))).otherwise(F.col("seq"))
    left = rows.crossJoin(F.broadcast(run)).groupBy("trim_length").agg(F.percentile(count_n(cut), 0.95).cast("int").alias("max_ambiguous"))
    return left


def quality_status(reads: DataFrame, cutoff: int = 5) -> DataFrame:
    """(n_chars, status): fewer than ``cutoff`` quality characters mean binned or dummy scores."""
    seen = letter_counts(reads.select("qual"), by_position=False).agg(F.count("code").alias("n_chars"))
    return seen.withColumn("status", F.when(F.col("n_chars") < cutoff, "degraded_binned").otherwise("normal"))


def truncation_length(reads: DataFrame, front: int = 15) -> DataFrame:
    """(length,): 10th percentile of the positive lengths that are left after ``front`` bases."""
    left = F.length("seq") - front
    return reads.where(left > 0).agg(F.coalesce(F.percentile(left, 0.10).cast("int"), F.lit(0)).alias("length"))


def quality_profile(reads: DataFrame, probs: tuple[float, ...] = (0.02, 0.09, 0.25, 0.5, 0.75, 0.91, 0.98)) -> DataFrame:
    """(pos, n, p02 ...): quantiles of the scores at each position.

    Scores are counted first (at most 94 per position), so that the quantiles are taken from a small table.
    """
    chars = letter_counts(reads.select("qual")).select("pos", (F.col("code") - 33).alias("q"), F.col("n").alias("count"))
    names = [f"p{int(round(p * 100)):02d}" for p in probs]
    return chars.groupBy("pos").agg(F.sum("count").alias("n"), *[F.percentile("q", p, F.col("count")).alias(n) for p, n in zip(probs, names, strict=True)])


def trim_positions(qprofile: DataFrame, q: float = 25, window: int = 5, consecutive: int = 5, min_retain: int = 50) -> DataFrame:
    """(start, end) of the stable part of a quality profile (pos, n, p25): smoothed scores of at least ``q`` in a row.

    Depth ends where n first falls below min(9000, 0.7 max n), at 40 or later. One row per position.
    """
    w = Window.partitionBy(F.lit(0)).orderBy("pos")
    ahead = w.rowsBetween(0, window - 1)
    p = qprofile.withColumn("sm", F.when(F.count("*").over(ahead) == window, F.avg("p25").over(ahead)))
    most = F.max("n").over(Window.partitionBy(F.lit(0)))
    thin = F.when((F.col("n") < F.least(F.lit(9000.0), 0.7 * most)), F.col("pos"))
    p = p.withColumn("limit", F.greatest(F.lit(40), F.coalesce(F.min(thin).over(Window.partitionBy(F.lit(0))), F.max("pos").over(Window.partitionBy(F.lit(0))) + 1)))
    good = lambda frame: (F.count("sm").over(frame) == consecutive) & (F.min("sm").over(frame) >= q)
    p = p.withColumn("fwd", good(w.rowsBetween(0, consecutive - 1))).withColumn("bwd", good(w.rowsBetween(-(consecutive - 1), 0)))
    out = p.agg(F.min(F.when(F.col("fwd"), F.col("pos"))).alias("start"), F.max(F.when(F.col("bwd") & (F.col("pos") < F.col("limit")), F.col("pos"))).alias("end"))
    start, end = F.coalesce("start", F.lit(0)), F.coalesce("end", F.lit(0))
    return out.select(start.cast("int").alias("start"), F.greatest(end, start + min_retain).cast("int").alias("end"))


def long_read_share(reads: DataFrame, over: int = 1400, n: int = 1000) -> DataFrame:
    """(share, long): share of the first reads longer than ``over`` bases, and whether it is above one half."""
    return head_reads(reads, n).agg(F.coalesce(F.avg((F.length("seq") > over).cast("double")), F.lit(0.0)).alias("share")).withColumn("long", F.col("share") > 0.5)


def primer_report(results: DataFrame, mode: str = "SE") -> DataFrame:
    """(report,): a detection result (one row, or one for each mate) as JSON, with its mode: SE, PE, SE_mixed or PE_mixed."""
    return results.select(F.to_json(F.struct(F.lit(mode).alias("mode"), *results.columns)).alias("report"))


def report_mode(paired: bool, mixed: bool) -> str:
    return ("PE" if paired else "SE") + ("_mixed" if mixed else "")
