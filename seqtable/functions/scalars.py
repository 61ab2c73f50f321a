"""Column functions on accessions, names, places and sizes. Null in, null out unless a docstring says otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accession patterns, in the order in which they are tried.
ACCESSIONS = {
    "biosample": r"^SAM[CEDN][A-Z]?\d+$",
    "sra": r"^[CEDS]R[RSXP]\d+$",
    "cncb": r"^PRJC[A-Z]\d+$",
    "ncbi": r"^PRJ[EDN][A-Z]\d+$",
}
#: Columns that are recognised by their content.
CONTENT = {"Run": r"^[CEDS]RR\d+$", "Bioproject": r"^PRJ[CEDN][A-Z]\d+$", "Biosample": r"^SAM[CEDN][A-Z]?\d+$", "Experiment": r"^[CEDS]RX\d+$"}
RUN = CONTENT["Run"]
#: Texts that mean "no value" in coordinates.
NO_PLACE = ["", "missing", "unknown", "not applicable", "not collected", "nan", "na"]
#: Stage at which processing failed to status; any other stage is a download error.
STAGES = {"validation": "invalid_format", "no_run": "no_run", "no_data": "no_data"}
#: Platform by substring, in the order in which they are tried.
PLATFORMS = [("ILLUMINA", "ILLUMINA HISEQ NOVASEQ MISEQ"), ("OXFORD_NANOPORE", "NANOPORE MINION PROMETHION"), ("PACBIO_SMRT", "PACBIO SEQUEL"), ("ION_TORRENT", "ION TORRENT"), ("LS454", "454 ROCHE")]


def accession_kind(c: Column) -> Column:
    """biosample, sra, cncb, ncbi or unknown; the first pattern that fits."""
    out = F
    for kind, pattern in ACCESSIONS.items():
        out = out.when(c.rlike(pattern), kind)
    return out.otherwise("unknown")


def is_run(c: Column) -> Column:
    return F.coalesce(c.rlike(RUN), F.lit(False))


def clean_id(c: Column) -> Column:
    """Without spaces, newlines and tabs."""
    return F.translate(c, " \n\t", "")


def parse_latlon(c: Column) -> Column:
    """struct(lat, lon) of texts like ``12.5 N 33.1 W``; null unless exactly two parts with a hemisphere are found."""
    t = F.when(F.lower(F.trim(c)).isin(NO_PLACE), None).otherwise(F.translate(c, "°,", "  "))
    number = F.regexp_extract_all(t, F.lit(r"([0-9.]+)\s*[NSEWnsew]"), F.lit(1))
    side = F.regexp_extract_all(t, F.lit(r"[0-9.]+\s*([NSEWnsew])"), F.lit(1))
    signed = F.zip_with(number, side, lambda x, s: x.try_cast("double") * F.when(F.upper(s).isin("S", "W"), -1).otherwise(1))
    return F.when(F.size(number) == 2, F.struct(F.get(signed, F.lit(0)).alias("lat"), F.get(signed, F.lit(1)).alias("lon")))


def filesize_to_mb(c: Column) -> Column:
    """Bytes, or several joined by ``|``, as whole megabytes rounded half to even; null if any part is no number."""
    parts = F.transform(F.split(c, r"\|"), lambda x: F.trim(x).try_cast("bigint"))
    total = F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return F.bround(total / 1048576).cast("bigint")


def camel_case(c: Column) -> Column:
    """Words split at blanks, underscores, hyphens and dots, each capitalised with the rest lowered; names of one word stay."""
    words = F.filter(F.split(c, r"[\s_\-.]+"), lambda w: w != "")
    return F.when(F.size(words) > 1, F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))), "")).otherwise(c)


def name_prefix(c: Column) -> Column:
    """First word of a column name, lowered; words end at lower-to-upper changes and separators."""
    return F.lower(F.split(c, r"(?<=[a-z])(?=[A-Z])|[\s_\-.]+")[0])


def sample_id_of(name: Column) -> Column:
    """Sample of a FASTQ file name: without compression, format and mate endings."""
    return F.regexp_replace(F.regexp_replace(F.substring_index(name, "/", -1), r"\.(fastq|fq)(\.gz)?$", ""), r"_R?[12]$", "")


def mate_of(name: Column) -> Column:
    """1 or 2 by the ending of a FASTQ file name, null for single files."""
    return F.nullif(F.regexp_extract(name, r"_R?([12])\.(fastq|fq)(\.gz)?$", 1), F.lit("")).cast("tinyint")


def run_sample_name(project: Column, sample: Column, run: Column) -> Column:
    return F.concat_ws("_", project, F.coalesce(F.nullif(F.trim(sample), F.lit("")), run))


def fmt_pct(share: Column) -> Column:
    return F.format_string("%.1f%%", share * 100)


def stage_status(c: Column) -> Column:
    out = F
    for stage, status in STAGES.items():
        out = out.when(c == stage, status)
    return out.otherwise("download_error")


def normalize_platform(*cols: Column) -> Column:
    """Platform of the first non-blank of ``cols`` by substring rules; the upper-cased text if none fits."""
    t = F.upper(F.trim(F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cols])))
    out = F
    for platform, parts in PLATFORMS:
        out = out.when(t.rlike(parts.replace(" ", "|")), platform)
    return out.otherwise(t)


def first_text(*cols: Column) -> Column:
    """The first text that is not blank."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cols])


def safe_name(c: Column, n: int = 80) -> Column:
    """A file name of a text: word characters, underscores for the rest, at most ``n`` long."""
    return F.substring(F.regexp_replace(F.regexp_replace(F.trim(c), r"[^A-Za-z0-9_.-]+", "_"), r"^_+|_+$", ""), 1, n)


def html_cell(c: Column, labels: list[str], min_len: int = 1) -> Column:
    """Text of the table cell after the first of ``labels`` that has one of at least ``min_len`` characters."""
    found = []
    for label in labels:
        cell = F.regexp_extract(c, r"(?is)<t[dh][^>]*>\s*" + label + r"\s*:?\s*</t[dh]>\s*<td[^>]*>(.*?)</td>", 1)
        text = F.trim(F.regexp_replace(F.regexp_replace(cell, r"(?s)<[^>]*>", ""), r"\s+", " "))
        found.append(F.when(F.length(text) >= min_len, text))
    return F.coalesce(*found)
