from pyspark.sql import functions as F

from seqtable.functions import scalars as sc
from seqtable.functions import sequences as sq


def one(spark, expr, *values, types=None):
    row = spark.createDataFrame([values], types or ", ".join(f"c{i} string" for i in range(len(values))))
    return row.select(expr(*[F.col(c) for c in row.columns]).alias("x")).first()["x"]


def test_accessions(spark):
    kinds = {"SAMN12": "biosample", "SRR1": "sra", "CRX9": "sra", "PRJCA1": "cncb", "PRJNA7": "ncbi", "x": "unknown", "PRJNA7 ": "unknown"}
    assert {k: one(spark, sc.accession_kind, k) for k in kinds} == kinds
    assert one(spark, sc.is_run, "CRR12") and not one(spark, sc.is_run, "SRX1")


def test_latlon(spark):
    assert one(spark, sc.parse_latlon, "12.5 N 33.1 W") == (12.5, -33.1)
    assert one(spark, sc.parse_latlon, "1° S, 2° E") == (-1.0, 2.0)
    for bad in ("missing", "12.5 N", "1 N 2 E 3 W", ""):
        assert one(spark, sc.parse_latlon, bad) is None


def test_filesize_rounds_half_to_even(spark):
    assert one(spark, sc.filesize_to_mb, "524288") == 0
    assert one(spark, sc.filesize_to_mb, str(3 * 524288)) == 2
    assert one(spark, sc.filesize_to_mb, "1048576|1048576") == 2
    assert one(spark, sc.filesize_to_mb, "1048576|x") is None


def test_names(spark):
    assert one(spark, sc.camel_case, "BioSample_name") == "BiosampleName"
    assert one(spark, sc.camel_case, "LibraryLayout") == "LibraryLayout"
    assert one(spark, sc.name_prefix, "libraryLayout") == "library"
    assert one(spark, sc.sample_id_of, "/a/S1_R2.fastq.gz") == "S1" and one(spark, sc.mate_of, "/a/S1_R2.fastq.gz") == 2
    assert one(spark, sc.mate_of, "/a/S1.fq") is None
    assert one(spark, sc.normalize_platform, "Ion Torrent S5") == "ION_TORRENT"


def test_sequences(spark):
    assert one(spark, sq.revcomp, "ACGTRN") == "NYACGT"
    assert one(spark, lambda c: sq.revcomp(sq.revcomp(c)), "GATTACA") == "GATTACA"
    assert one(spark, sq.mean_phred, "I5") == 30.0
    assert abs(one(spark, sq.expected_errors, "++") - 0.2) < 1e-9
    assert one(spark, lambda c: sq.kmers(c, 3), "ACGT") == ["ACG", "CGT"] and one(spark, lambda c: sq.kmers(c, 3), "AC") == []
    assert one(spark, sq.complexity, "AAAA") == 1 / 16
    assert one(spark, sq.base_entropy, "ACGT") == 2.0 and one(spark, sq.base_entropy, "NN") == 0.0
    assert one(spark, sq.iupac_compatible, "R", "A") and not one(spark, sq.iupac_compatible, "R", "C")
    assert sq.iupac_regex("ARN") == "A[AG][ACGT]"
    assert one(spark, sq.fasta_size, "x;size=12") == 12 and one(spark, sq.fasta_sample, "x;sample=a;") == "a"
