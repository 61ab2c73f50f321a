"""Run metadata: joins, standard columns, profiles and keyed updates.

Steps that depend on a table's content are one aggregation that decides and one projection that applies.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import CONTENT, accession_kind, clean_id, is_run

#: Columns that come first, and the core columns.
PRIORITY = "Run Bioproject Description DesignDescription Biosample Experiment".split()
CORE = "Run Bioproject Description DesignDescription Biosample Experiment Center ReleaseDate FileType FileName SizeMb Title LibraryStrategy LibrarySelection LibrarySource LibraryLayout InsertSize Platform Platform.1 SampleType HostTaxonomyId ScientificName Submission".split()

#: Columns that name local files.
PATH_COLUMNS = ("DownloadPath", "DownloadReadFile1", "DownloadReadFile2", "ReadFilename1", "ReadFilename2")
#: Rules of a routing table that every dataset is compared with.
MAX_RULES = 10_000

def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


# rows


def classify_accessions(df: DataFrame, col: str) -> DataFrame:
    """``df`` with the kind of each accession."""
    return df.withColumn("kind", accession_kind(_c(col)))


def has_valid_run(df: DataFrame, dataset: str, run: str) -> DataFrame:
    """(dataset, valid): whether any of its runs is an accession. Rows without dataset are left out."""
    return df.where(_c(dataset).isNotNull()).groupBy(_c(dataset).alias("dataset")).agg(F.bool_or(is_run(_c(run))).alias("valid"))


def datasets(runs: DataFrame, project: str, platform: str | None = None) -> DataFrame:
    """Distinct datasets with cleaned ids, optionally with platform."""
    cols = [clean_id(_c(project)).alias("dataset"), *([_c(platform).alias("platform")] if platform else [])]
    return runs.where(_c(project).isNotNull()).select(*cols).distinct()


def split_without_run(df: DataFrame, run: str = "Run") -> tuple[DataFrame, DataFrame]:
    """(rows with a run, rows without): a blank run is none."""
    has = F.coalesce(F.trim(_c(run)) != "", F.lit(False))
    return df.where(has), df.where(~has)


def tag_provenance(df: DataFrame, project: str, source: str, description: str) -> DataFrame:
    return df.withColumns({"Bioproject": F.lit(project), "Source_Database": F.lit(source), "Description": F.lit(description)})


def first_n(df: DataFrame, by: list[str], order: list[Column], n: int = 2) -> DataFrame:
    """The first ``n`` rows of each group under a total order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def after_first(df: DataFrame, by: list[str], order: list[Column], n: int = 2) -> DataFrame:
    """The rows that :func:`first_n` leaves out."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_n") > n).drop("_n")


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in ``order``; an aggregation, so that a frequent key is combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min(F.struct(*order, *[c for c in rest if c not in order])).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the last in ``order``."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def union_all(tables: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def missing(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of ``a`` whose key is not in ``b``."""
    return a.join(b.select(key), key, "left_anti")


def pending(ids: DataFrame, completed: DataFrame, key: str = "id") -> DataFrame:
    """The ids that still have to be done."""
    return missing(ids, completed, key)


def expand_queries(field: DataFrame, organism: DataFrame, opt: DataFrame | None = None) -> DataFrame:
    """One search text for each combination of two or three short keyword lists (column keyword)."""
    parts = [("a", field), ("b", organism), *([("c", opt)] if opt is not None else [])]
    out = reduce(lambda x, y: x.crossJoin(y), [d.select(F.col("keyword").alias(n)) for n, d in parts])
    return out.select(F.array_join(F.array(*[F.concat(F.lit('("'), F.col(n), F.lit('")')) for n, _ in parts]), " AND ").alias("query"))


def combine_results(results: list[DataFrame]) -> DataFrame:
    """Search results (accession, query_ix, source_ix, ...) as one: projects only, the first row of each accession."""
    rows = union_all(results).where(F.col("accession").startswith("PRJ"))
    return keep_first(rows, ["accession"], ["query_ix", "source_ix"])


# joins


def join_samples(runs: DataFrame, samples: DataFrame) -> DataFrame:
    """Runs with the attributes of their sample, by Biosample, else by Run; clashing sample columns get ``_biosample``."""
    key = next((k for k in ("Biosample", "Run") if k in runs.columns and k in samples.columns), None)
    if key is None:
        return runs
    right = samples.select(_c(key), *[_c(c).alias(f"{c}_biosample" if c in runs.columns else c) for c in samples.columns if c != key])
    return runs.join(right, key, "left")


def _prefixed(df: DataFrame, prefix: str, keep: list[str]) -> DataFrame:
    return df.select(*[_c(c).alias(c if c in keep else f"{prefix}_{c}") for c in df.columns])


def join_sheets(run: DataFrame, experiment: DataFrame, sample: DataFrame) -> DataFrame:
    """Three sheets linked by Run.Experiment accession and Experiment.BioSample accession, with prefixed columns."""
    r, e, s = (_prefixed(d, n, []) for d, n in ((run, "Run"), (experiment, "Experiment"), (sample, "Sample")))
    out = r.join(e, F.col("`Run_Experiment accession`") == F.col("`Experiment_Accession`"), "left")
    return out.join(s, F.col("`Experiment_BioSample accession`") == F.col("`Sample_Accession`"), "left")


def join_runs(csv: DataFrame, sheets: DataFrame) -> DataFrame:
    """The run list with its sheets' columns, by the first run key of each that exists."""
    left = next(c for c in ("Run", "Run accession", "Accession") if c in csv.columns)
    right = next(c for c in ("Run_Accession", "Run", "Accession") if c in sheets.columns)
    s = sheets.select(_c(right).alias("_run"), *[_c(c).alias(f"{c}_sheet" if c in csv.columns else c) for c in sheets.columns if c != right])
    return csv.join(s, _c(left) == F.col("_run"), "left").drop("_run")


def lookup(df: DataFrame, mapping: DataFrame, on: str, value: str, default: str | None = "") -> DataFrame:
    """``df`` with ``value`` of its key in ``mapping`` (unique keys); ``default`` where there is none."""
    return df.join(mapping.select(on, value), on, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def status_report(ids: DataFrame, status: DataFrame) -> DataFrame:
    """(id, pos, status) in input order; ids never seen are unknown."""
    return ids.select("id", "pos").join(status.select("id", "status"), "id", "left").withColumn("status", F.coalesce("status", F.lit("unknown")))


def found_status(ids: DataFrame, df: DataFrame, cols: list[str]) -> DataFrame:
    """(id, status): has_data if the id stands in any of the columns, else no_data."""
    found = df.select(F.explode(F.array(*[_c(c).cast("string") for c in cols])).alias("id")).where("id is not null").distinct().withColumn("_f", F.lit(True))
    return ids.select("id").join(found, "id", "left").select("id", F.when(F.col("_f"), "has_data").otherwise("no_data").alias("status"))


def match_or_first(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """The row with ``key = value``, else the first row by ``order``; one row."""
    best = F.struct((~F.coalesce(_c(key) == value, F.lit(False))).alias("_miss"), *[_c(c) for c in [order, *[c for c in df.columns if c != order]]])
    return df.agg(F.min(best).alias("_r")).select(*[F.col(f"_r.{c}").alias(c) for c in df.columns])


def source_gap(runs: DataFrame, urls: DataFrame) -> DataFrame:
    """(dataset_id, n_gap, source): any run without url moves its whole dataset to the other source."""
    gap = F.count_if(F.col("url").isNull()).alias("n_gap")
    return runs.join(urls.select("run", "url"), "run", "left").groupBy("dataset_id").agg(gap).withColumn("source", F.when(F.col("n_gap") > 0, "other").otherwise("first"))


def associate_publications(tiers: DataFrame, articles: DataFrame, max_abstracts: int = 2) -> DataFrame:
    """Publications of each project from its first tier that has any.

    ``tiers``: (project, tier, pos, pmid); ``articles``: (pmid, title, abstract, doi), one row for each pmid. All ids of
    the tier are joined by ``;``, titles and abstracts of the first ``max_abstracts`` by `` || ``, distinct dois in order by
    ``;``. The first ids are found before articles are met, so that a project gathers no other texts.
    """
    named = tiers.where("pmid is not null").select(F.col("project").alias("_p"), "tier", "pos", "pmid")
    first = named.groupBy(F.col("_p").alias("_q")).agg(F.min("tier").alias("_t"))
    best = named.join(first, F.col("_p").eqNullSafe(F.col("_q")) & (F.col("tier") == F.col("_t")))
    ids = best.groupBy("_p").agg(F.min("tier").alias("tier"), F.array_sort(F.collect_list(F.struct("pos", "pmid"))).alias("a"))
    met = ids.select(F.col("_p").alias("_q"), F.posexplode("a.pmid").alias("k", "pmid")).join(articles.select("pmid", "title", "abstract", "doi"), "pmid")
    head = F.when(F.col("k") < max_abstracts, F.struct("k", "title", "abstract"))
    of = met.groupBy("_q").agg(F.array_sort(F.collect_list(head)).alias("h"), F.array_sort(F.collect_list(F.when(F.col("doi").isNotNull(), F.struct("k", "doi")))).alias("d"))
    joined = lambda c, sep: F.coalesce(F.array_join(c, sep), F.lit(""))
    out = ids.join(of, F.col("_p").eqNullSafe(F.col("_q")), "left")
    return out.select(F.col("_p").alias("project"), "tier", F.array_join("a.pmid", ";").alias("pmids"), joined(F.col("h.title"), " || ").alias("titles"), joined(F.col("h.abstract"), " || ").alias("abstracts"), joined(F.array_distinct("d.doi"), ";").alias("dois"))


# columns


def to_long(df: DataFrame, key: str) -> DataFrame:
    """(key, ord, col, value) of all other columns as strings."""
    cols = [c for c in df.columns if c != key]
    return df.select(key, F.posexplode(F.array(*[F.struct(F.lit(c).alias("col"), _c(c).cast("string").alias("value")) for c in cols])).alias("ord", "x")).select(key, "ord", "x.*")


def empty_columns(df: DataFrame) -> list[str]:
    """Columns with nothing but null, blank or ``nan``; one aggregation."""
    filled = lambda c: (F.trim(c) != "") & (F.lower(F.trim(c)) != "nan")
    counts = df.agg(*[F.count_if(filled(_c(c).cast("string"))).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return [c for i, c in enumerate(df.columns) if counts[f"c{i}"] == 0]


def drop_path_columns(df: DataFrame, names: tuple[str, ...] = PATH_COLUMNS) -> DataFrame:
    """Without the columns that name local files, whichever of them are there."""
    return df.drop(*[c for c in names if c in df.columns])


def drop_empty_columns(df: DataFrame) -> DataFrame:
    gone = empty_columns(df)
    return df.select(*[_c(c) for c in df.columns if c not in gone])


def column_fingerprints(df: DataFrame, key: str) -> DataFrame:
    """(col, ord, n, h1, h2): sums of hashes of (row, value); equal columns have equal fingerprints."""
    long = to_long(df, key)
    v = F.coalesce("value", F.lit("\u0000"))
    return long.groupBy("col").agg(F.min("ord").alias("ord"), F.count("value").alias("n"), F.sum(F.xxhash64(F.col(key), v).cast("decimal(38,0)")).alias("h1"), F.sum(F.xxhash64(v, F.col(key), F.lit(7)).cast("decimal(38,0)")).alias("h2"))


def duplicate_columns(df: DataFrame, key: str) -> list[str]:
    """Columns whose content equals that of an earlier column (128-bit fingerprints, one row per column)."""
    seen, out = set(), []
    for r in column_fingerprints(df, key).orderBy("ord").collect():
        mark = (r["n"], r["h1"], r["h2"])
        if mark in seen:
            out.append(r["col"])
        seen.add(mark)
    return out


def drop_duplicate_columns(df: DataFrame, key: str) -> DataFrame:
    gone = duplicate_columns(df, key)
    return df.select(*[_c(c) for c in df.columns if c not in gone])


def detect_accession_columns(df: DataFrame, patterns: dict[str, str] | None = None) -> dict[str, str]:
    """Column to standard name: every non-null value fits one pattern; each name once, left to right."""
    patterns = patterns or CONTENT
    found = df.agg(*[F.coalesce(F.bool_and(_c(c).cast("string").rlike(p)), F.lit(False)).alias(f"{i}_{n}") for i, c in enumerate(df.columns) for n, p in patterns.items()]).first()
    out: dict[str, str] = {}
    for i, c in enumerate(df.columns):
        name = next((n for n in patterns if found[f"{i}_{n}"] and n not in out.values()), None)
        if name:
            out[c] = name
    return out


def merge_columns(target: Column, source: Column) -> Column:
    """Cells of two columns as one: the only value, the target if equal but for case, else ``target_source``."""
    a, b = blank_to_null(target), blank_to_null(source)
    return F.when(a.isNull(), b).when(b.isNull() | (F.lower(a) == F.lower(b)), a).otherwise(F.concat_ws("_", a, b))


def _camel(name: str) -> str:
    words = [w for w in re.split(r"[\s_\-.]+", name) if w]
    return "".join(w[:1].upper() + w[1:].lower() for w in words) if len(words) > 1 else name


def standardize_columns(df: DataFrame, dictionary: dict[str, list[str]] | None = None, aliases: tuple[str, ...] = ("design_description", "DESIGN_DESCRIPTION", "Design Description"), core: list[str] | None = None) -> DataFrame:
    """Standard names and order of the columns.

    Prefixes and suffixes of the joins go; columns recognised by content and synonyms get their standard name; names
    become CamelCase, and columns that then share a name are merged; the first alias becomes DesignDescription. The core
    columns come first, then the others in groups of a common first word.
    """
    # columns are held by position, since names may differ in case alone, which Spark does not tell apart
    given = df.columns
    df = df.toDF(*[f"_{i}" for i in range(len(given))])
    names, used = [], set()
    at = [i for i in range(len(given)) if i > 0 or given[0] != "ID"]
    for i in at:
        n = re.sub(r"(_sra|_biosample|_x|_y)$", "", re.sub(r"^(Sample_|Experiment_|Run_)", "", given[i]))
        k, again = n, 2
        while k in used:
            k, again = f"{n}_{again}", again + 1
        used.add(k)
        names.append(k)
    content = detect_accession_columns(df.select(*[f"_{i}" for i in at]))
    found = [content.get(f"_{i}") for i in at]
    names = [f if f and (f == n or f not in names) else n for n, f in zip(names, found, strict=True)]
    for standard, variants in (dictionary or {}).items():
        if standard not in names:
            known = {v.strip().lower() for v in variants}
            names = _renamed(names, next((n for n in names if n.strip().lower() in known), None), standard)
    if "DesignDescription" not in names:
        names = _renamed(names, next((a for a in aliases if a in names), None), "DesignDescription")
    groups: dict[str, list[Column]] = {}
    for i, n in zip(at, names, strict=True):
        groups.setdefault(_camel(n), []).append(F.col(f"_{i}"))
    merged = {n: reduce(merge_columns, [c.cast("string") for c in g]) if len(g) > 1 else g[0] for n, g in groups.items()}
    return df.select(*[merged[n].alias(n) for n in column_order(list(merged), core or CORE)])


def _renamed(names: list[str], old: str | None, new: str) -> list[str]:
    return [new if n == old else n for n in names]


def column_order(names: list[str], core: list[str]) -> list[str]:
    """Priority columns, other core columns, then the rest grouped by first word: groups of two or more sorted, singletons last."""
    first = [c for c in PRIORITY if c in names]
    first += [c for c in core if c in names and c not in first]
    groups: dict[str, list[str]] = {}
    for c in names:
        if c not in first:
            groups.setdefault(re.split(r"(?<=[a-z])(?=[A-Z])|[\s_\-.]+", c)[0].lower(), []).append(c)
    shared = [c for k in sorted(k for k, g in groups.items() if len(g) > 1) for c in sorted(groups[k])]
    return [*first, *shared, *sorted(g[0] for g in groups.values() if len(g) == 1)]


def secondary_columns(names: list[str]) -> list[str]:
    """Columns between Submission and Source_Database; none unless both exist in that order."""
    if "Submission" in names and "Source_Database" in names:
        return names[names.index("Submission") + 1 : names.index("Source_Database")]
    return []


def clear_repeated_cells(df: DataFrame, secondary: list[str], core: list[str]) -> DataFrame:
    """Null the cells of secondary columns that repeat, trimmed, a core cell of their row."""
    own = F.array(*[F.trim(_c(c).cast("string")) for c in core if c in df.columns])
    new = {c: F.when(F.coalesce(F.array_contains(F.array_compact(own), F.trim(_c(c).cast("string"))), F.lit(False)), None).otherwise(_c(c)) for c in secondary}
    return df.withColumns(new) if new else df


def column_profile(df: DataFrame, key: str, dataset: str, core: list[str], secondary: list[str], n: int = 5) -> DataFrame:
    """For each column: values, fill rate, datasets with a value, most frequent values and its kind (core, cncb, rare)."""
    total = df.count()
    cols = [c for c in df.columns if c != key]
    cells = df.select(_c(dataset).alias("_d"), F.explode(F.array(*[F.struct(F.lit(c).alias("col"), blank_to_null(_c(c).cast("string")).alias("value")) for c in cols])).alias("x")).select("_d", "x.*")
    base = cells.groupBy("col").agg(F.count("value").alias("n_values"), F.countDistinct(F.when(F.col("value").isNotNull(), F.col("_d"))).alias("n_datasets"))
    top = top_values(cells, "col", "value", n).groupBy("col").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda x: x["text"]), "; ").alias("top"))
    kind = F.when(F.col("col").isin(core), "core").when(F.col("col").isin(secondary), "cncb").otherwise("rare")
    rate = F.format_string("%.1f%%", 100.0 * F.col("n_values") / max(total, 1))
    return base.join(top, "col", "left").select("col", "n_values", rate.alias("fill_rate"), "n_datasets", F.coalesce("top", F.lit("")).alias("top"), kind.alias("kind"))


def top_values(df: DataFrame, by: str, col: str, n: int = 5) -> DataFrame:
    """(by, rank, value, count, text ``value(count)``) of the ``n`` most frequent values; ties by value."""
    counts = df.where(F.col(col).isNotNull()).groupBy(by, F.col(col).alias("value")).count()
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("count"), "value")))
    return ranked.where(F.col("rank") <= n).withColumn("text", F.concat("value", F.lit("("), F.col("count").cast("string"), F.lit(")")))


def upsert(target: DataFrame, new: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """``target`` with the rows of ``new`` put in by key: inserted or replaced, null cells as ''.

    Of repeated keys the last by ``order`` counts, and without an order the greatest by its other columns, so that reruns agree.
    """
    rows = keep_last(new, keys, order or [])
    cols = target.columns
    fresh = rows.select(*[(_c(c).cast("string") if c in rows.columns else F.lit(None).cast("string")).alias(c) for c in cols])
    kept = target.join(fresh.select(*keys), keys, "left_anti").select(*[_c(c).cast("string").alias(c) for c in cols])
    return kept.unionByName(fresh).select(*[F.coalesce(F.when(F.lower(_c(c)) == "nan", "").otherwise(_c(c)), F.lit("")).alias(c) for c in cols])


# status


def status_tally(log: DataFrame) -> DataFrame:
    """(status, n) of the rows after the last header; ``log``: (line, status, is_header)."""
    return last_run(log).groupBy("status").agg(F.count("*").alias("n"))


def last_run(log: DataFrame) -> DataFrame:
    """Rows after the last header line; the header's line is one number, found first."""
    header = log.agg(F.coalesce(F.max(F.when(F.col("is_header"), F.col("line"))), F.lit(-1)).alias("_h"))
    return log.join(F.broadcast(header), F.col("line") > F.col("_h")).where(~F.col("is_header")).drop("_h")


def route(df: DataFrame, rules: DataFrame) -> DataFrame:
    """(dataset_id, action, reason): the first rule that fits, by order; a null in a rule fits anything, no rule runs.

    ``df``: (dataset_id, mode, platform, quality, length); ``rules``: (ord, mode, platform, quality, min_length, max_length,
    action, reason), a short list: more than MAX_RULES are refused, since every dataset meets all of them.
    """
    if rules.limit(MAX_RULES + 1).count() > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    r = rules.select(*[F.col(c).alias(f"r_{c}") for c in rules.columns])
    fits = reduce(lambda a, b: a & b, [F.coalesce(F.col(f"r_{c}") == F.col(c), F.col(f"r_{c}").isNull()) for c in ("mode", "platform", "quality")])
    fits = fits & F.coalesce(F.col("length") >= F.col("r_min_length"), F.col("r_min_length").isNull()) & F.coalesce(F.col("length") <= F.col("r_max_length"), F.col("r_max_length").isNull())
    hit = df.join(F.broadcast(r), fits, "left").groupBy("dataset_id").agg(F.min_by(F.struct("r_action", "r_reason"), "r_ord").alias("b"))
    return hit.select("dataset_id", F.coalesce("b.r_action", F.lit("run")).alias("action"), F.coalesce("b.r_reason", F.lit("")).alias("reason"))
