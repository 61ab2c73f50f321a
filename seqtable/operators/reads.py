"""Filters and projections on reads (dataset_id?, sample_id, mate?, read_no, seq, qual): narrow jobs, built-in expressions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import IUPAC, base_entropy, complexity, count_n, expected_errors, fasta_id, iupac_regex, mean_error_phred, mean_phred, revcomp
from ..plans.stages import staged

#: Reads that are sorted together when reads are numbered.
NUMBERED = 100_000


def min_length(reads: DataFrame, n: int = 50, paired: bool = False) -> DataFrame:
    """Reads of at least ``n`` bases; paired: both mates go if either is shorter."""
    if not paired:
        return reads.where(F.length("seq") >= n)
    short = reads.where(F.length("seq") < n).select("sample_id", "read_no").distinct()
    return reads.join(short, ["sample_id", "read_no"], "left_anti")


def prefilter(reads: DataFrame, min_len: int = 50, min_q: float = 20, min_complexity: float = 0.3, min_entropy: float = 1.0, skip_qual: bool = False) -> DataFrame:
    """``reads`` with discard_reason: the first of length, quality, complexity, entropy that fails; null if none."""
    reason = F.when(F.length("seq") < min_len, "length")
    if not skip_qual:
        reason = reason.when(mean_phred(F.col("qual")) < min_q, "quality")
    reason = reason.when(complexity(F.col("seq")) < min_complexity, "complexity").when(base_entropy(F.col("seq")) < min_entropy, "entropy")
    return reads.withColumn("discard_reason", reason)


def trim_truncate(reads: DataFrame, front: int = 15, length: int | None = None, max_n: int = 1, min_length: int = 50, forward_only: bool = False) -> DataFrame:
    """Cut ``front`` bases, truncate to ``length``, drop reads that are then too short or hold more than ``max_n`` N."""
    rows = reads.where("mate = 1") if forward_only and "mate" in reads.columns else reads
    cut = lambda c: F.substr(F.col(c), F.lit(front + 1), F.lit(length)) if length else F.substr(F.col(c), F.lit(front + 1))
    rows = rows.withColumns({"seq": cut("seq"), "qual": cut("qual")})
    return rows.where((F.length("seq") >= max(length or 0, min_length)) & (count_n(F.col("seq")) <= max_n))


def trim_losses(reads: DataFrame, front: int = 15, length: int | None = None, max_n: int = 1, min_length: int = 50) -> DataFrame:
    """(n_short, n_ambiguous): what :func:`trim_truncate` drops."""
    cut = F.substr(F.col("seq"), F.lit(front + 1), F.lit(length)) if length else F.substr(F.col("seq"), F.lit(front + 1))
    short = F.length(cut) < max(length or 0, min_length)
    return reads.agg(F.count_if(short).alias("n_short"), F.count_if(~short & (count_n(cut) > max_n)).alias("n_ambiguous"))


def filter_expected_error(reads: DataFrame, maxee: float | None = 1.0, rate: float | None = None, min_len: int | None = None, max_len: int | None = None, strip_left: int = 0) -> DataFrame:
    """Reads within an expected error, an expected error rate and a length window, after cutting ``strip_left`` bases."""
    rows = reads
    if strip_left:
        rows = rows.withColumns({c: F.substr(F.col(c), F.lit(strip_left + 1)) for c in ("seq", "qual")}).where(F.length("seq") > 0)
    ee = expected_errors(F.col("qual"))
    keep = F.lit(True)
    if maxee is not None:
        keep = keep & (ee <= maxee)
    if rate is not None:
        keep = keep & (ee / F.length("qual") <= rate)
    if min_len is not None:
        keep = keep & (F.length("seq") >= min_len)
    if max_len is not None:
        keep = keep & (F.length("seq") <= max_len)
    return rows.where(keep)


def filter_length_fraction(reads: DataFrame, fraction: float, min_q: int = 4, window: int = 3, max_n: int = 0) -> DataFrame:
    """Truncate before the first run of more than ``window`` scores below ``min_q``; keep reads of at least ``fraction`` of their length."""
    # where the first window + 1 low scores begin, -1 without any
    least = math.ceil(min_q) + 32
    run = F.regexp_instr("qual", F.lit(rf"[\x{{0}}-\x{{{least:x}}}]{{{window + 1}}}")) - 1 if least >= 0 else F.when(F.col("qual").isNotNull(), -1)
    cut = F.when(run < 0, F.length("seq")).otherwise(run)
    rows = reads.withColumn("_cut", cut.cast("int")).where(F.col("_cut") >= fraction * F.length("seq"))
    rows = rows.withColumns({c: F.substr(F.col(c), F.lit(1), F.col("_cut")) for c in ("seq", "qual")}).drop("_cut")
    return rows.where(count_n(F.col("seq")) <= max_n)


def filter_mean_quality(reads: DataFrame, q: float = 10, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Reads whose mean error probability is at most that of ``q``, within a length window."""
    keep = mean_error_phred(F.col("qual")) >= q
    if lo is not None:
        keep = keep & (F.length("seq") >= lo)
    if hi is not None:
        keep = keep & (F.length("seq") <= hi)
    return reads.where(keep)


def empty_samples(samples: DataFrame, reads: DataFrame) -> DataFrame:
    """The samples (sample_id) that a filter has left without reads."""
    return samples.select("sample_id").distinct().join(reads.select("sample_id"), "sample_id", "left_anti")


def trim_tail(reads: DataFrame, k: int) -> DataFrame:
    """Cut ``k`` bases at the end of reads longer than that."""
    cut = lambda c: F.when(F.length("seq") > k, F.substr(F.col(c), F.lit(1), F.length("seq") - k)).otherwise(F.col(c))
    return reads.withColumns({"seq": cut("seq"), "qual": cut("qual")})


def trim_fixed(reads: DataFrame, lengths: DataFrame) -> DataFrame:
    """Cut each dataset's primer length (dataset_id, trim); datasets without one stay."""
    met = reads.join(lengths.select("dataset_id", "trim"), "dataset_id", "left").withColumn("trim", F.coalesce("trim", F.lit(0)))
    return met.withColumns({c: F.substr(F.col(c), F.col("trim") + 1) for c in ("seq", "qual")}).drop("trim")


def pair_mates(reads: DataFrame) -> DataFrame:
    """(sample_id, read_no, seq1, qual1, seq2, qual2) of reads that have both mates; one grouped pass instead of a join."""
    side = lambda m, c: F.max(F.when(F.col("mate") == m, F.col(c))).alias(f"{c}{m}")
    both = reads.groupBy("sample_id", "read_no").agg(side(1, "seq"), side(1, "qual"), side(2, "seq"), side(2, "qual"))
    return both.where("seq1 is not null and seq2 is not null")


def repair_orientation(pairs: DataFrame, best_pos: int, majority: str, r1_trim: int, r2_trim: int) -> DataFrame:
    """Swap mates whose base at ``best_pos`` (from 0) is not the majority's, then trim; reads shorter than that are not swapped."""
    flip = (F.length("seq1") > best_pos) & (F.upper(F.substr(F.col("seq1"), F.lit(best_pos + 1), F.lit(1))) != majority)
    pick = lambda a, b, k: F.substr(F.when(F.col("swapped"), F.col(b)).otherwise(F.col(a)), F.lit(k + 1))
    rows = pairs.withColumn("swapped", flip)
    return rows.select("sample_id", "read_no", "swapped", pick("seq1", "seq2", r1_trim).alias("seq1"), pick("qual1", "qual2", r1_trim).alias("qual1"), pick("seq2", "seq1", r2_trim).alias("seq2"), pick("qual2", "qual1", r2_trim).alias("qual2"))


def _mismatches(seq: Column, primer: str) -> Column:
    """Positions at which the beginning of ``seq`` does not fit the primer."""
    return sum((~F.coalesce(F.substr(seq, F.lit(i + 1), F.lit(1)).isin(*IUPAC.get(p, p)), F.lit(False))).cast("int") for i, p in enumerate(primer.upper()))


def trim_primer(reads: DataFrame, fwd: str, rev: str | None = None, error_rate: float = 0.0) -> DataFrame:
    """Remove an explicit primer at the 5' end; mate 2 uses ``rev``. Reads without it stay as they are, with trimmed false."""

    def hit(primer: str) -> Column:
        if error_rate == 0:
            return F.upper("seq").rlike("^" + iupac_regex(primer))
        return _mismatches(F.upper("seq"), primer) <= int(error_rate * len(primer))

    n = F.when(hit(fwd), len(fwd))
    if rev is not None:
        n = F.when(F.col("mate") == 2, F.when(hit(rev), len(rev))).otherwise(n)
    rows = reads.withColumn("_n", F.coalesce(n, F.lit(0)))
    return rows.withColumns({"trimmed": F.col("_n") > 0, **{c: F.substr(F.col(c), F.col("_n") + 1) for c in ("seq", "qual") if c in reads.columns}}).drop("_n")


def extract_amplicon(seqs: DataFrame, fwd: str, rev: str, lo: int = 300, hi: int = 500) -> DataFrame:
    """The region between the forward primer and the reverse primer's complement, on either strand, of a length in [lo, hi]."""
    complement = str.maketrans("ACGTRYSWKMBDHVN", "TGCAYRSWMKVHDBN")
    pattern = iupac_regex(fwd) + "([A-Z]*?)" + iupac_regex(rev.upper().translate(complement)[::-1])
    plus, minus = (F.regexp_extract(F.upper(s), pattern, 1) for s in (F.col("seq"), revcomp(F.col("seq"))))
    # looked for on the other strand only where it must be, and once a read: a filter would look for it again
    found = F.array(F.coalesce(F.nullif(plus, F.lit("")), minus))
    return seqs.withColumn("seq", F.explode(F.filter(found, lambda s: F.length(s).between(lo, hi))))


def head_reads(reads: DataFrame, n: int) -> DataFrame:
    """The first ``n`` reads of each file (read_no counts from 1)."""
    return reads.where(F.col("read_no") <= n)


def has_dummy_quality(reads: DataFrame, n: int = 1000) -> DataFrame:
    """(sample_id, dummy): whether the first reads hold at most one quality character."""
    chars = head_reads(reads, n).select("sample_id", F.explode(F.array_distinct(F.filter(F.split("qual", ""), lambda c: c != ""))).alias("c"))
    return chars.groupBy("sample_id").agg((F.countDistinct("c") <= 1).alias("dummy"))


def clean_fasta_ids(df: DataFrame) -> DataFrame:
    """Upper-case sequences with ids cut at the first ``;``; residual is true where a size annotation is left."""
    return df.select(fasta_id(F.col("id")).alias("id"), F.upper("seq").alias("seq"), fasta_id(F.col("id")).contains("size=").alias("residual"))


def number_reads(reads: DataFrame) -> DataFrame:
    """Running number of the reads of each sample, over files in order.

    Reads are range-sorted, some NUMBERED to a part, and written with their place in the order, so that neither a sample nor
    a file is one task's. What stands before a sample's first row of a part is a running sum over the parts, a row for each part and
    sample in it.
    """
    columns, reads = [F.col(f"`{c}`") for c in reads.columns], staged(reads)
    order = ["sample_id", "file", "read_no"]
    parts = max(int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(reads.count() / NUMBERED))
    placed = staged(reads.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_p")
    runs = placed.groupBy(F.col("sample_id").alias("_s"), part).agg(F.min("_at").alias("_low"), F.count("*").alias("_c"))
    before = F.sum("_c").over(Window.partitionBy("_s").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    offsets = runs.select("_s", F.col("_p").alias("_q"), (F.coalesce(before, F.lit(0)) - F.col("_low") + 1).alias("_b"))
    met = placed.select("*", part).join(offsets, F.col("sample_id").eqNullSafe(F.col("_s")) & (F.col("_p") == F.col("_q")))
    return met.select(*columns, (F.col("_at") + F.col("_b")).alias("n"))


def label_reads(reads: DataFrame, *keep: str) -> DataFrame:
    """FASTA lines ``>sample_n;sample=sample;`` with their sequence, and the columns ``keep``."""
    label = F.concat(F.lit(">"), "sample_id", F.lit("_"), F.col("n").cast("string"), F.lit(";sample="), "sample_id", F.lit(";\n"), "seq")
    return number_reads(reads).select(label.alias("value"), *keep)


#: Places of the bit table of :func:`repeats`: at most 1,048,576 words are broadcast.
PLACES = 1 << 26


def repeats(rows: DataFrame, *columns: str) -> DataFrame:
    """(_word, _bits), a bit table of the hashes that more than one row has: for :func:`may_repeat`. Only hashes are shuffled."""
    twice = rows.select(F.xxhash64(*columns).alias("h")).groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    place = twice.select(F.pmod("h", F.lit(PLACES)).alias("p"))
    return staged(place.groupBy(F.expr("p div 64").alias("_word")).agg(F.expr("bit_or(shiftleft(1L, CAST(p % 64 AS INT)))").alias("_bits")))


def may_repeat(rows: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """``rows`` and again: false where a row surely has no equal; true for all others and, as the table is of fixed size, for
    some that have none."""
    place = F.pmod(F.xxhash64(*columns), F.lit(PLACES))
    met = rows.withColumn("_p", place).join(F.broadcast(table), F.expr("_p div 64") == F.col("_word"), "left")
    return met.select(*rows.columns, F.expr("coalesce(shiftright(_bits, CAST(_p % 64 AS INT)) & 1, 0) = 1").alias("again"))
