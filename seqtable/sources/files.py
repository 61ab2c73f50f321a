"""Text, table, XML and FASTA files of metadata and reads, read as strings; and the sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import clean_id, mate_of, sample_id_of
from ..functions.sequences import fasta_id, fasta_sample, fasta_size

#: Texts that mean "no value" in tables.
NULLS = ["", "NA", "N/A", "NaN", "nan", "null", "None"]


def _nulled(df: DataFrame) -> DataFrame:
    return df.select(*[F.when(F.trim(F.col(f"`{c}`")).isin(NULLS), None).otherwise(F.col(f"`{c}`")).alias(c) for c in df.columns])


def read_runs(spark: SparkSession, path: str, project_col: str, run_col: str, platform_col: str | None = None) -> DataFrame:
    """(project, run[, platform], ...) of a run table whose key columns the user names; rows without project are dropped."""
    df = _nulled(spark.read.csv(path, header=True, inferSchema=False))
    named = df.withColumnRenamed(project_col, "project").withColumnRenamed(run_col, "run")
    named = named.withColumnRenamed(platform_col, "platform") if platform_col else named
    return named.withColumns({c: clean_id(F.col(c)) for c in ("project", "run")}).where("project is not null")


def read_id_lists(spark: SparkSession, folder: str) -> DataFrame:
    """(id, file, pos): ids of all ``.txt`` files of a folder, blank and ``#`` lines skipped, first occurrence kept."""
    lines = spark.read.option("wholetext", True).option("pathGlobFilter", "*.txt").text(folder).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("pos", "id"))
    ids = lines.withColumn("id", F.trim("id")).where("id <> '' and not startswith(id, '#')")
    return ids.groupBy("id").agg(F.min(F.struct("file", "pos")).alias("f")).select("id", "f.file", "f.pos")


def read_search_results(spark: SparkSession, path: str, sep: str, mapping: dict[str, str]) -> DataFrame:
    """The mapped columns (file name to our name) of a search result table; malformed lines are skipped."""
    df = spark.read.csv(path, header=True, sep=sep, mode="DROPMALFORMED", inferSchema=False)
    return _nulled(df.select(*[F.col(f"`{a}`").alias(b) for a, b in mapping.items() if a in df.columns]))


def largest_sheet(sheets: dict[str, DataFrame]) -> DataFrame:
    """The sheet with most rows; the first of equals."""
    return max(sheets.values(), key=lambda d: d.count())


def xml_records(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """(xml) of all whole elements ``tag``, which do not nest, of XML files of any size.

    The text source cuts files at the start of the element, so that a file is read in as many tasks as its size asks for
    and no string is longer than a record. Elements of longer names, and one that a file breaks off, have no row.
    """
    rest = spark.read.option("lineSep", f"<{tag}").text(path)
    body = F.regexp_extract("value", rf"(?s)^([\s>].*?</{tag})\s*>", 1)
    return rest.select(body.alias("b")).where("b <> ''").select(F.concat(F.lit(f"<{tag}"), "b", F.lit(">")).alias("xml"))


def read_project_xml(spark: SparkSession, path: str) -> DataFrame:
    """(accession, title, description, organism) of project records."""
    return parse_project_xml(xml_records(spark, path, "DocumentSummary"), "xml")


def parse_project_xml(df: DataFrame, col: str) -> DataFrame:
    """The same from a column with one record each."""
    x = lambda p: F.nullif(F.trim(F.xpath_string(F.col(col), F.lit(p))), F.lit(""))
    return df.select(x("//ArchiveID/@accession").alias("accession"), x("//ProjectDescr/Title").alias("title"), x("//ProjectDescr/Description").alias("description"), x("//OrganismName").alias("organism"))


def parse_experiment_xml(df: DataFrame, col: str) -> DataFrame:
    """(experiment, run, platform, design) of experiment packages, one row per run."""
    x = lambda p: F.nullif(F.trim(F.xpath_string(F.col(col), F.lit(p))), F.lit(""))
    platform = F.nullif(F.regexp_extract(col, r"(?s)<PLATFORM>\s*<([A-Z0-9_]+)", 1), F.lit(""))
    return df.select(x("//EXPERIMENT/@accession").alias("experiment"), F.explode_outer(F.xpath(F.col(col), F.lit("//RUN/@accession"))).alias("run"), platform.alias("platform"), x("//DESIGN/DESIGN_DESCRIPTION").alias("design"))


def read_experiment_xml(spark: SparkSession, path: str) -> DataFrame:
    """(experiment, run, platform, design) of the experiment packages of files."""
    return parse_experiment_xml(xml_records(spark, path, "EXPERIMENT_PACKAGE"), "xml")


def parse_article_xml(df: DataFrame, col: str) -> DataFrame:
    """(pmid, title, abstract, doi): labelled abstract parts as ``Label: text``, only the article's own doi."""
    x = lambda p: F.nullif(F.trim(F.xpath_string(F.col(col), F.lit(p))), F.lit(""))
    parts = F.regexp_extract_all(col, F.lit(r"(?s)<AbstractText\b[^>]*>.*?</AbstractText>"), F.lit(0))
    text = lambda p: F.trim(F.regexp_replace(p, r"(?s)<[^>]*>", ""))
    labelled = F.transform(parts, lambda p: F.concat(F.when(p.rlike(r'^<AbstractText[^>]*\bLabel="'), F.concat(F.regexp_extract(p, r'Label="([^"]*)"', 1), F.lit(": "))).otherwise(""), text(p)))
    return df.select(x("//PMID").alias("pmid"), x("//Article/ArticleTitle").alias("title"), F.array_join(labelled, " ").alias("abstract"), x("//PubmedData/ArticleIdList/ArticleId[@IdType='doi']").alias("doi"))


def read_article_xml(spark: SparkSession, path: str) -> DataFrame:
    """(pmid, title, abstract, doi) of the articles of files."""
    return parse_article_xml(xml_records(spark, path, "PubmedArticle"), "xml")


def parse_sample_text(df: DataFrame, text_col: str) -> DataFrame:
    """(uid, biosample, sample_name, organism, attrs) of flat text: numbered blocks with header fields and ``/key="value"`` lines."""
    b = df.select(F.explode(F.split(text_col, r"\n(?=\d+:\s+)")).alias("b")).where(F.trim("b") != "")
    x = lambda p: F.nullif(F.trim(F.regexp_extract("b", p, 1)), F.lit(""))
    key, value = (F.regexp_extract_all("b", F.lit(r'(?m)^\s*/([^=\n]+)="([^"]*)"'), F.lit(i)) for i in (1, 2))
    # a repeated key keeps its last value
    pairs = F.map_from_entries(F.filter(F.arrays_zip(key.alias("k"), value.alias("v")), lambda z: z["k"].isNotNull()))
    distinct = F.size(F.array_distinct(key)) == F.size(key)
    attrs = F.when(distinct, pairs).otherwise(F.map_from_arrays(F.array_distinct(key), F.transform(F.array_distinct(key), lambda k: F.element_at(F.filter(F.arrays_zip(key.alias("k"), value.alias("v")), lambda z: z["k"] == k), -1)["v"])))
    return b.select(x(r"ID:\s*(\d+)").alias("uid"), x(r"(?:Accession|BioSample):\s*([A-Z]+\d+)").alias("biosample"), x(r"Sample name:\s*([^;\n]+)").alias("sample_name"), x(r"(?m)^Organism:\s*(.+)$").alias("organism"), attrs.alias("attrs"))


def read_sample_text(spark: SparkSession, path: str) -> DataFrame:
    """The samples of flat text files of any size, whose records are parted by a blank line."""
    return parse_sample_text(spark.read.option("lineSep", "\n\n").text(path), "value")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(id, size, sample, seq) of FASTA records with sequences over any number of lines."""
    records = spark.read.option("lineSep", ">").text(path).where(F.trim("value") != "")
    head = F.trim(F.substring_index("value", "\n", 1))
    seq = F.regexp_replace(F.substr(F.col("value"), F.length(F.substring_index("value", "\n", 1)) + 1), r"\s", "")
    return records.select(fasta_id(head).alias("id"), fasta_size(head).alias("size"), fasta_sample(head).alias("sample"), seq.alias("seq"))


def read_count_table(spark: SparkSession, path: str) -> DataFrame:
    """(feature_id, sample_id, n) of a wide table whose first column names features (cut at ``;``); zero counts are left out.

    Lines that begin with ``#`` are comments, but for the header ``#OTU ID``; without one the first other line is the header.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    named = F.col("value").startswith("#OTU ID")
    head = lines.where(named).first() or lines.where(~F.col("value").startswith("#")).first()
    if head is None:
        return spark.createDataFrame([], "feature_id string, sample_id string, n bigint")
    cells = lines.where(~F.col("value").startswith("#") & (F.col("value") != head["value"])).select(F.split("value", "\t").alias("v"))
    cells = cells.select(F.split(F.col("v")[0], ";")[0].alias("feature_id"), F.posexplode("v").alias("at", "x")).where("at > 0").select("feature_id", "at", F.col("x").try_cast("double").cast("bigint").alias("n")).where("n > 0")
    # samples are met by position, a row each, so that the plan does not grow with their number
    names = spark.createDataFrame(list(enumerate(head["value"].split("\t"))), "_at int, sample_id string")
    return cells.join(names, F.col("at") == F.col("_at")).select("feature_id", "sample_id", "n")


def fastq_integrity(lines: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """(file, n_lines, valid) of (file, value) lines: not empty, and four lines per record.

    A file without lines has no row among them; it is found, and invalid, if ``files`` (file) lists it.
    """
    found = lines.groupBy("file").agg(F.count("*").alias("n_lines"))
    if files is not None:
        found = files.select("file").distinct().join(found, "file", "left").withColumn("n_lines", F.coalesce("n_lines", F.lit(0)))
    return found.withColumn("valid", (F.col("n_lines") > 0) & (F.col("n_lines") % 4 == 0))


def discover_samples(spark: SparkSession, folder: str) -> DataFrame:
    """(path, sample_id, mate) of the FASTQ files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{fastq,fq,fastq.gz,fq.gz}").load(folder).select("path")
    return files.select("path", sample_id_of(F.col("path")).alias("sample_id"), mate_of(F.col("path")).alias("mate"))


def manifest_single(files: DataFrame) -> DataFrame:
    """(sample_id, path): one file per sample, the first by path."""
    return files.groupBy("sample_id").agg(F.min("path").alias("path"))


def manifest_paired(files: DataFrame) -> DataFrame:
    """(sample_id, forward_path, reverse_path) of complete pairs."""
    side = lambda m, n: F.min(F.when(F.col("mate") == m, F.col("path"))).alias(n)
    return files.groupBy("sample_id").agg(side(1, "forward_path"), side(2, "reverse_path")).where("forward_path is not null and reverse_path is not null")


def write_report(df: DataFrame, path: str, sep: str = ",", byte_order_mark: bool = False) -> None:
    """A report as CSV or TSV with header, in UTF-8.

    With ``byte_order_mark``, by which spreadsheets tell the encoding, each file begins with one: it is the first character
    of its header. Quotes inside values are doubled.
    """
    first, *others = df.columns
    named = df.select(F.col(f"`{first}`").alias("\ufeff" + first), *[F.col(f"`{c}`") for c in others]) if byte_order_mark else df
    named.write.mode("overwrite").csv(path, sep=sep, header=True, escape='"', encoding="UTF-8")


def write_per_dataset(df: DataFrame, path: str, col: str = "bioproject") -> None:
    """One folder per dataset."""
    df.write.mode("overwrite").partitionBy(col).parquet(path)
