"""Queries over the driver's tables, each with the SQL of its result where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import scalars as sc
from .functions import sequences as sq
from .operators import features as ft
from .operators import longreads as lr
from .operators import metadata as md
from .operators import profiles as pf
from .operators import reads as rd
from .operators import similarity as sm
from .plans import pipelines
from .plans.fixtures import CTE_M, CTE_Q, CTE_R, FULL, full_reads, long_reads as long_fixture, reads, runs, table
from .plans.stages import stage_folder, staged, unstage
from .sources import fastq as fq
from .sources import files as fl

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return put


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# metadata


@query(rf"""WITH {CTE_M}, ids AS (SELECT project AS id FROM m UNION ALL SELECT biosample FROM m UNION ALL SELECT coalesce(run, 'x') FROM m)
SELECT CASE WHEN regexp_matches(id, '^SAM[CEDN][A-Z]?\d+$') THEN 'biosample' WHEN regexp_matches(id, '^[CEDS]R[RSXP]\d+$') THEN 'sra'
 WHEN regexp_matches(id, '^PRJC[A-Z]\d+$') THEN 'cncb' WHEN regexp_matches(id, '^PRJ[EDN][A-Z]\d+$') THEN 'ncbi' ELSE 'unknown' END AS kind, count(*) AS n FROM ids GROUP BY 1""")
def accession_classify(spark, d):
    ids = runs(spark, d).select(F.explode(F.array("project", "biosample", F.coalesce("run", F.lit("x")))).alias("id"))
    return md.classify_accessions(ids, "id").groupBy("kind").agg(F.count("*").alias("n"))


@query(f"WITH {CTE_M} SELECT ok, translate(concat(' ', run, chr(9), ' '), concat(' ', chr(10), chr(9)), '') AS id FROM m WHERE run IS NOT NULL")
def id_clean(spark, d):
    return runs(spark, d).where("run is not null").select("ok", sc.clean_id(F.concat(F.lit(" "), "run", F.lit("\t "))).alias("id"))


@query(rf"WITH {CTE_M} SELECT project AS dataset, bool_or(coalesce(regexp_matches(run, '^[CEDS]RR\d+$'), false)) AS valid FROM m GROUP BY 1")
def project_valid(spark, d):
    return md.has_valid_run(runs(spark, d), "project", "run")


@query(f"WITH {CTE_M} SELECT DISTINCT biosample AS id FROM m WHERE biosample NOT IN (SELECT biosample FROM m WHERE ok % 7 = 0)")
def pending_ids(spark, d):
    m = runs(spark, d)
    return md.pending(m.select(F.col("biosample").alias("id")).distinct(), m.where("ok % 7 = 0").select(F.col("biosample").alias("id")).distinct())


@query(f"WITH {CTE_M} SELECT ok, biosample, 'with' AS side FROM m WHERE run IS NOT NULL UNION ALL SELECT ok, biosample, 'without' FROM m WHERE run IS NULL")
def split_runs(spark, d):
    a, b = md.split_without_run(runs(spark, d), "run")
    return a.select("ok", "biosample", F.lit("with").alias("side")).unionByName(b.select("ok", "biosample", F.lit("without").alias("side")))


@query(f"WITH {CTE_M} SELECT m.run AS \"Run\", m.biosample AS \"Biosample\", m.project AS organism, c_mktsegment AS organism_biosample, c_acctbal AS balance FROM m LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) c ON m.biosample = concat('SAMN', c.c_custkey)")
def sample_join(spark, d):
    m = runs(spark, d).select(F.col("run").alias("Run"), F.col("biosample").alias("Biosample"), F.col("project").alias("organism"))
    s = table(spark, d, "customer").where("c_custkey % 3 <> 0").select(F.concat(F.lit("SAMN"), "c_custkey").alias("Biosample"), F.col("c_mktsegment").alias("organism"), F.col("c_acctbal").alias("balance"))
    return md.join_samples(m, s)


@query("""SELECT l_orderkey AS run, l_linenumber AS line, o_orderstatus AS status, c_name AS sample FROM lineitem
LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 5 <> 0) o ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey""")
def run_exp_sample(spark, d):
    r = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("Experiment accession"), F.col("l_orderkey").alias("Accession"), F.col("l_linenumber").alias("line"))
    e = table(spark, d, "orders").where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("Accession"), F.col("o_custkey").alias("BioSample accession"), F.col("o_orderstatus").alias("status"))
    s = table(spark, d, "customer").select(F.col("c_custkey").alias("Accession"), F.col("c_name").alias("name"))
    j = md.join_sheets(r, e, s)
    return j.select(F.col("Run_Accession").alias("run"), F.col("Run_line").alias("line"), F.col("Experiment_status").alias("status"), F.col("Sample_name").alias("sample"))


@query(f"WITH {CTE_M} SELECT ok, coalesce(n_name, '') AS description FROM m LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 4 <> 0) n ON project = concat('PRJNA', 1000 + n_nationkey)")
def lookup_description(spark, d):
    n = table(spark, d, "nation").where("n_nationkey % 4 <> 0").select(F.concat(F.lit("PRJNA"), F.col("n_nationkey") + 1000).alias("project"), F.col("n_name").alias("description"))
    return md.lookup(runs(spark, d).select("ok", "project"), n, "project", "description").select("ok", "description")


@query("SELECT o_orderkey AS id, row_number() OVER (ORDER BY o_orderkey) AS pos, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END, 'unknown') AS status FROM (SELECT DISTINCT o_orderkey, o_orderstatus FROM orders)")
def status_report(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status")).distinct()
    counted = _rank_by_key(o.select("id"), "id")
    return md.status_report(counted, o.where("id % 3 = 0"))


def _rank_by_key(df: DataFrame, key: str) -> DataFrame:
    """``df`` with pos, its rank by a unique integer key: ranks inside buckets of keys plus the counts of lower buckets."""
    from pyspark.sql import Window

    b = df.withColumn("_b", F.floor(F.col(key) / 4096))
    low = b.groupBy("_b").count().withColumn("_s", F.coalesce(F.sum("count").over(Window.partitionBy(F.lit(0)).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = b.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy(key)))
    return inside.join(low.select("_b", "_s"), "_b").select(*df.columns, (F.col("_r") + F.col("_s")).alias("pos"))


@query("SELECT c_custkey AS id, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) OR c_custkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 8 = 0) THEN 'has_data' ELSE 'no_data' END AS status FROM customer")
def found_any(spark, d):
    ids = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"))
    o = table(spark, d, "orders").select("o_custkey", F.when(F.col("o_orderkey") % 8 == 0, F.col("o_orderkey")).alias("other"))
    return md.found_status(ids, o, ["o_custkey", "other"]).select(F.col("id").cast("bigint").alias("id"), "status")


_PROFILE = """WITH cells AS (SELECT o_custkey % 10 AS d, 'status' AS col, o_orderstatus AS v FROM orders UNION ALL SELECT o_custkey % 10, 'priority', o_orderpriority FROM orders
 UNION ALL SELECT o_custkey % 10, 'rare', CASE WHEN o_orderkey % 50 = 0 THEN concat('v', o_orderkey % 7) END FROM orders UNION ALL SELECT o_custkey % 10, 'dataset', CAST(o_custkey % 10 AS VARCHAR) FROM orders),
top AS (SELECT col, v, count(*) AS n, row_number() OVER (PARTITION BY col ORDER BY count(*) DESC, v) AS k FROM cells WHERE v IS NOT NULL GROUP BY col, v)
SELECT c.col, count(v) AS n_values, printf('%.1f%%', 100.0 * count(v) / count(*)) AS fill_rate, count(DISTINCT CASE WHEN v IS NOT NULL THEN d END) AS n_datasets,
 (SELECT string_agg(concat(v, '(', n, ')'), '; ' ORDER BY k) FROM top t WHERE t.col = c.col AND k <= 5) AS top,
 CASE c.col WHEN 'status' THEN 'core' WHEN 'priority' THEN 'cncb' ELSE 'rare' END AS kind FROM cells c GROUP BY c.col"""


@query(_PROFILE)
def column_profile(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), F.when(F.col("o_orderkey") % 50 == 0, F.concat(F.lit("v"), F.col("o_orderkey") % 7)).alias("rare"), (F.col("o_custkey") % 10).cast("string").alias("dataset"))
    return md.column_profile(o, "o_orderkey", "dataset", ["status"], ["priority"])


@query("""SELECT * FROM (SELECT 'blank' AS col, count(*) AS n_rows FROM orders UNION ALL SELECT 'nan', count(*) FROM orders) t""")
def empty_columns(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.lit(" ").alias("blank"), F.lit("nan").alias("nan"))
    gone = md.empty_columns(o)
    return o.agg(F.count("*").alias("n_rows")).select(F.explode(F.array(*map(F.lit, gone))).alias("col"), "n_rows")


@query("SELECT 'again' AS col, count(o_orderstatus) AS n FROM orders")
def duplicate_columns(spark, d):
    o = table(spark, d, "orders").groupBy("o_orderkey").agg(F.min("o_orderstatus").alias("status"), F.min("o_orderpriority").alias("priority")).withColumn("again", F.col("status"))
    gone = md.duplicate_columns(o, "o_orderkey")
    return md.to_long(o, "o_orderkey").where(F.col("col").isin(gone)).groupBy("col").agg(F.count("value").alias("n"))


@query(f"WITH {CTE_M} SELECT run AS \"Run\", project AS \"Bioproject\", biosample AS \"Biosample\", experiment AS \"Experiment\", platform_text AS \"PlatformText\" FROM m")
def standard_columns(spark, d):
    m = runs(spark, d).select(F.col("experiment").alias("Experiment_a"), F.col("run").alias("Run_b"), F.col("platform_text"), F.col("biosample").alias("c_biosample"), F.col("project").alias("d_x"))
    return md.standardize_columns(m)


@query(f"WITH {CTE_M} SELECT ok, CASE WHEN a IS NULL THEN b WHEN b IS NULL OR lower(a) = lower(b) THEN a ELSE concat(a, '_', b) END AS merged FROM (SELECT ok, run AS a, CASE ok % 4 WHEN 0 THEN NULL WHEN 1 THEN lower(run) WHEN 2 THEN biosample ELSE nullif(trim(' '), '') END AS b FROM m) t")
def camel_merge(spark, d):
    b = F.when(F.col("ok") % 4 == 1, F.lower("run")).when(F.col("ok") % 4 == 2, F.col("biosample")).when(F.col("ok") % 4 == 3, F.lit(" "))
    return runs(spark, d).select("ok", md.merge_columns(F.col("run"), b).alias("merged"))


@query(f"WITH {CTE_M} SELECT ok, CASE WHEN ok % 3 = 0 THEN NULL ELSE concat(' ', experiment) END AS extra, CASE WHEN ok % 2 = 0 AND run IS NOT NULL THEN NULL WHEN ok % 2 = 0 THEN NULL ELSE lat_lon END AS place FROM m")
def cell_dedup(spark, d):
    m = runs(spark, d).select("ok", F.col("run").alias("Run"), F.col("biosample").alias("Biosample"), F.when(F.col("ok") % 3 == 0, F.concat(F.lit(" "), "biosample")).otherwise(F.concat(F.lit(" "), "experiment")).alias("extra"), F.when(F.col("ok") % 2 == 0, F.col("run")).otherwise(F.col("lat_lon")).alias("place"))
    return md.clear_repeated_cells(m, ["extra", "place"], ["Run", "Biosample"]).select("ok", "extra", "place")


@query(f"WITH {CTE_M} SELECT ok, CAST(concat(ok % 90, '.', ok % 7) AS DOUBLE) * CASE WHEN ok % 2 = 0 THEN 1 ELSE -1 END AS lat, CAST(ok % 180 AS DOUBLE) * CASE WHEN ok % 3 = 0 THEN 1 ELSE -1 END AS lon FROM m")
def latlon(spark, d):
    return runs(spark, d).withColumn("p", sc.parse_latlon(F.col("lat_lon"))).select("ok", (F.col("p.lat") + 0.0).alias("lat"), (F.col("p.lon") + 0.0).alias("lon"))


@query(f"WITH {CTE_M} SELECT ok, CAST(round_even((ok * 524288 + CASE WHEN ok % 5 = 0 THEN ok * 1024 ELSE 0 END) / 1048576.0, 0) AS BIGINT) AS mb FROM m")
def filesize_mb(spark, d):
    return runs(spark, d).select("ok", sc.filesize_to_mb(F.col("file_size")).alias("mb"))


@query(f"WITH {CTE_M} SELECT CASE ok % 4 WHEN 0 THEN 'ILLUMINA' WHEN 1 THEN 'PACBIO_SMRT' WHEN 2 THEN 'OXFORD_NANOPORE' ELSE 'ION_TORRENT' END AS platform, count(*) AS n FROM m GROUP BY 1")
def platforms(spark, d):
    return runs(spark, d).select(sc.normalize_platform(F.lit(" "), F.col("platform_text")).alias("platform")).groupBy("platform").agg(F.count("*").alias("n"))


@query("SELECT page_id, url AS cell FROM pages")
def html_cell(spark, d):
    html = F.concat(F.lit("<table><tr><td>Title</td><td> </td></tr><tr><TH> Description: </TH><td> <b>"), "url", F.lit("</b>\n</td></tr></table>"), "html")
    return table(spark, d, "pages").select("page_id", sc.html_cell(html, ["Title", "Description"], 3).alias("cell"))


@query("SELECT concat('PRJNA', o_orderkey) AS accession, concat('Study of ', o_orderstatus) AS title, o_orderpriority AS description, CASE WHEN o_orderkey % 2 = 0 THEN 'soil metagenome' END AS organism FROM orders")
def project_xml(spark, d):
    xml = F.concat(F.lit('<R><Project><Project><ProjectID><ArchiveID accession="PRJNA'), "o_orderkey", F.lit('"/></ProjectID><ProjectDescr><Title>Study of '), "o_orderstatus", F.lit("</Title><Description> "), "o_orderpriority", F.lit("</Description></ProjectDescr>"), F.when(F.col("o_orderkey") % 2 == 0, F.lit("<Organism><OrganismName>soil metagenome</OrganismName></Organism>")).otherwise(""), F.lit("</Project></Project></R>"))
    return fl.parse_project_xml(table(spark, d, "orders").select(xml.alias("xml")), "xml")


@query("""SELECT concat('PRJ', n_nationkey % 7) AS accession, min(n_nationkey * 2) AS query_ix, 0 AS source_ix FROM nation GROUP BY 1""")
def keyword_union(spark, d):
    n = table(spark, d, "nation").select(F.concat(F.when(F.col("n_nationkey") % 2 == 0, "PRJ").otherwise("PRJ"), F.col("n_nationkey") % 7).alias("accession"), (F.col("n_nationkey") * 2).alias("query_ix"), F.lit(0).alias("source_ix"))
    other = n.select("accession", (F.col("query_ix") + 1).alias("query_ix"), F.lit(1).alias("source_ix")).unionByName(n.select(F.lit("XYZ").alias("accession"), "query_ix", "source_ix"))
    return md.combine_results([n, other])


@query("""SELECT concat('("', r_name, '") AND ("', n_name, '")') AS query FROM region, nation""")
def expand_keywords(spark, d):
    return md.expand_queries(table(spark, d, "region").select(F.col("r_name").alias("keyword")), table(spark, d, "nation").select(F.col("n_name").alias("keyword")))


@query(f"WITH {CTE_M} SELECT project, ok FROM (SELECT project, ok, row_number() OVER (PARTITION BY project ORDER BY ok) AS k FROM m) t WHERE k <= 2")
def first_n_per_group(spark, d):
    return md.first_n(runs(spark, d).select("project", "ok"), ["project"], [F.col("ok")], 2)


@query("SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS status, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1")
def keep_last(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.col("o_orderstatus").alias("status"))
    return md.keep_last(o, ["o_custkey"], ["o_orderkey"])


@query("""SELECT CAST(coalesce(b.c_custkey, a.c_custkey) AS VARCHAR) AS id, CASE WHEN b.c_custkey IS NULL THEN a.c_mktsegment WHEN b.c_custkey % 4 = 0 THEN '' ELSE 'new' END AS segment
FROM (SELECT * FROM customer WHERE c_custkey % 2 = 0) a FULL JOIN (SELECT * FROM customer WHERE c_custkey % 3 = 0) b ON a.c_custkey = b.c_custkey""")
def upsert(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_mktsegment").alias("segment"), "c_custkey")
    new = c.where("c_custkey % 3 = 0").select("id", F.when(F.col("c_custkey") % 4 == 0, None).otherwise("new").alias("segment"))
    return md.upsert(c.where("c_custkey % 2 = 0").select("id", "segment"), new, ["id"])


@query("SELECT event_type AS status, count(*) AS n FROM events WHERE event_id > (SELECT max(event_id) FROM events WHERE event_id % 1000 = 0) GROUP BY 1")
def run_tally(spark, d):
    log = table(spark, d, "events").select(F.col("event_id").alias("line"), F.col("event_type").alias("status"), (F.col("event_id") % 1000 == 0).alias("is_header"))
    return md.status_tally(log)


@query("""SELECT concat('D', o_orderkey) AS dataset_id, CASE WHEN o_orderkey % 4 = 3 AND o_orderkey % 2 = 1 THEN 'skip' WHEN o_orderkey % 500 < 100 THEN 'skip' ELSE 'run' END AS action,
CASE WHEN o_orderkey % 4 = 3 THEN 'platform' WHEN o_orderkey % 500 < 100 THEN 'short' ELSE '' END AS reason FROM (SELECT DISTINCT o_orderkey FROM orders)""")
def routing(spark, d):
    rules = spark.createDataFrame([(1, "asv", "ION_TORRENT", None, None, None, "skip", "platform"), (2, None, None, None, None, 99, "skip", "short")], "ord int, mode string, platform string, quality string, min_length int, max_length int, action string, reason string")
    k = F.col("o_orderkey")
    ds = table(spark, d, "orders").select("o_orderkey").distinct().select(F.concat(F.lit("D"), k).alias("dataset_id"), F.lit("asv").alias("mode"), F.when(k % 4 == 3, "ION_TORRENT").otherwise("ILLUMINA").alias("platform"), F.lit(None).cast("string").alias("quality"), (k % 500).cast("int").alias("length"))
    return md.route(ds, rules)


# reads


#: The reads with short, poor and monotonous ones among them, and what each is discarded for.
_FILTER_SQL = f"""{CTE_Q}, s AS (SELECT sample_id, ok, CASE WHEN ok % 11 = 1 THEN substr(seq, 1, CAST(30 + ok % 40 AS INT)) WHEN ok % 11 = 3 THEN repeat('A', 60) WHEN ok % 11 = 4 THEN repeat('AAAAAAAAAAAAAAAAAAAAAAAACGTCAG', CAST(1 + ok % 3 AS INT)) ELSE seq END AS seq,
 CASE WHEN ok % 11 = 2 THEN bad_qual ELSE qual END AS qual FROM q),
mm AS (SELECT *, list_sum(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33)) / length(qual) AS mq, len(list_distinct(list_transform(range(1, length(seq)), lambda i: substr(seq, i, 2)))) / 16.0 AS cx,
 list_sum(list_transform(['A', 'C', 'G', 'T'], lambda b: CASE WHEN contains(seq, b) THEN -(length(seq) - length(replace(seq, b, ''))) / length(seq) * log2((length(seq) - length(replace(seq, b, ''))) / length(seq)) ELSE 0.0 END)) AS en FROM s),
fr AS (SELECT *, CASE WHEN length(seq) < 50 THEN 'length' WHEN mq < 20 THEN 'quality' WHEN cx < 0.3 THEN 'complexity' WHEN en < 1.0 THEN 'entropy' END AS discard_reason FROM mm)"""


def _mixed_reads(spark, d) -> DataFrame:
    k = F.col("ok") % 11
    seq = F.when(k == 1, F.substr(F.col("seq"), F.lit(1), (30 + F.col("ok") % 40).cast("int"))).when(k == 3, F.lit("A" * 60)).when(k == 4, F.repeat(F.lit("AAAAAAAAAAAAAAAAAAAAAAAACGTCAG"), (1 + F.col("ok") % 3).cast("int"))).otherwise(F.col("seq"))
    return full_reads(spark, d, "sample_id", "ok", "ln", "seq", "qual", "bad_qual").select("sample_id", "ok", "ln", seq.alias("seq"), F.when(k == 2, F.col("bad_qual")).otherwise(F.col("qual")).alias("qual"))


@query(f"WITH {_FILTER_SQL} SELECT discard_reason, count(*) AS n FROM fr GROUP BY 1")
def read_filter(spark, d):
    return rd.prefilter(_mixed_reads(spark, d)).groupBy("discard_reason").agg(F.count("*").alias("n"))


@query(f"WITH {CTE_Q}, e AS (SELECT ok, ln, round(list_sum(list_transform(string_split(qual, ''), lambda c: power(10.0, -(ascii(c) - 33) / 10.0))), 6) AS ee, round(list_sum(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33)) / 113.0, 6) AS mq FROM q WHERE ok % 10 = 1 OR ok % 10 <> 1) SELECT ok, ln, ee, mq FROM e")
def expected_errors(spark, d):
    return full_reads(spark, d, "ok", "ln", "qual").select("ok", "ln", F.round(sq.expected_errors(F.col("qual")), 6).alias("ee"), F.round(sq.mean_phred(F.col("qual")), 6).alias("mq"))


@query(f"WITH {CTE_Q}, s AS (SELECT sample_id, substr(seq_tail_n, 16, 95) AS seq FROM q) SELECT sample_id, count(*) AS n, CAST(sum(length(seq)) AS BIGINT) AS bases FROM s WHERE length(seq) >= 95 AND length(seq) - length(replace(seq, 'N', '')) <= 1 GROUP BY 1")
def trim_truncate(spark, d):
    q = full_reads(spark, d).withColumn("seq", F.col("seq_tail_n"))
    return rd.trim_truncate(q, 15, 95).groupBy("sample_id").agg(F.count("*").alias("n"), F.sum(F.length("seq")).alias("bases"))


@query(f"WITH {CTE_R} SELECT ok, ln, regexp_matches(seq, '^CCTACGGG[ACGT]GGC[AT]GCAG') AS trimmed, substr(seq, 18) AS seq FROM r")
def primer_trim(spark, d):
    return rd.trim_primer(reads(spark, d), "CCTACGGGNGGCWGCAG").select("ok", "ln", "trimmed", "seq")


@query(f"WITH {CTE_Q} SELECT ok, ln, substr(seq, 18, 76) AS seq FROM q")
def amplicon(spark, d):
    q = full_reads(spark, d, "ok", "ln", "seq")
    ends = F.concat("seq", F.lit("GATTACAGATTACA"))
    seq = F.when(F.col("ok") % 4 == 0, sq.revcomp(ends)).otherwise(ends)
    return rd.extract_amplicon(q.withColumn("seq", seq), "CCTACGGGNGGCWGCAG", "TGTAATCTGTAATC", 90, 100).select("ok", "ln", F.substring("seq", 1, 76).alias("seq"))


# profiles

_PROFILE_SQL = """p AS (SELECT pos, count(*) AS n, count_if(substr(seq, pos + 1, 1) = 'A') / count(*) AS a, count_if(substr(seq, pos + 1, 1) = 'C') / count(*) AS c, count_if(substr(seq, pos + 1, 1) = 'G') / count(*) AS g, count_if(substr(seq, pos + 1, 1) = 'T') / count(*) AS t
 FROM r, (SELECT unnest(range(60)) AS pos) x GROUP BY pos),
st AS (SELECT pos, CASE WHEN f[1] >= 0.80 THEN 'C' WHEN f[1] + f[2] >= 0.80 AND f[2] >= 0.10 THEN 'D' ELSE 'V' END AS state,
 CASE f[1] WHEN a THEN 'A' WHEN c THEN 'C' WHEN g THEN 'G' ELSE 'T' END AS base FROM (SELECT *, list_reverse_sort([a, c, g, t]) AS f FROM p) y)"""


@query(f"WITH {CTE_R}, {_PROFILE_SQL} SELECT CAST(pos AS INT) AS pos, n, round(a, 6) AS a, round(c, 6) AS c, round(g, 6) AS g, round(t, 6) AS t FROM p")
def base_profile(spark, d):
    return pf.base_profile(reads(spark, d)).select("pos", "n", *[F.round(b, 6).alias(b) for b in "acgt"])


@query(f"WITH {CTE_R}, {_PROFILE_SQL} SELECT CAST(pos AS INT) AS pos, state, base FROM st")
def cdv_states(spark, d):
    return pf.position_states(pf.base_profile(reads(spark, d)))


@query(f"WITH {CTE_R}, {_PROFILE_SQL} SELECT string_agg(CASE WHEN state = 'C' THEN base ELSE 'N' END, '' ORDER BY pos) AS consensus FROM st WHERE pos < 30")
def consensus(spark, d):
    return pf.consensus(pf.position_states(pf.base_profile(reads(spark, d))))


#: From the states: runs of V and of others, what is tolerated, and where the prefix ends; then primers against the consensus.
_BOUNDARY_SQL = """ch AS (SELECT pos, state = 'V' AS v, coalesce(CAST((state = 'V') <> lag(state = 'V') OVER (ORDER BY pos) AS INT), 0) AS c FROM st),
rn AS (SELECT v, run, min(pos) AS s, count(*) AS len FROM (SELECT *, sum(c) OVER (ORDER BY pos) AS run FROM ch) x GROUP BY v, run),
ok AS (SELECT *, len <= 2 AND lag(len, 1, 0) OVER (ORDER BY run) >= 3 AND lead(len, 1, 0) OVER (ORDER BY run) >= 3 AS ok FROM rn),
bd AS (SELECT CAST(least(coalesce(min(CASE WHEN v AND NOT ok AND s < 30 THEN s END), greatest(30, coalesce(max(CASE WHEN v AND ok AND s < 30 THEN s + len END), 0))), sum(len)) AS INT) AS b FROM ok),
bo AS (SELECT CASE WHEN b < 10 THEN 0 ELSE b END AS boundary FROM bd)"""
_CONSENSUS_SQL = "co AS (SELECT string_agg(CASE WHEN state = 'C' THEN base ELSE 'N' END, '' ORDER BY pos) AS consensus FROM st WHERE pos < 30)"
_PRIMERS_SQL = f"""db(ord, name, fwd) AS (VALUES {", ".join(f"({i}, '{n}', '{p}')" for i, (n, p) in enumerate(pf.FORWARD))}),
pr AS (SELECT ord, 0 AS rc, name, fwd AS p FROM db UNION ALL SELECT ord, 1, concat(name, '_RC'), reverse(translate(fwd, 'ACGTRYSWKMBDHVN', 'TGCAYRSWMKVHDBN')) FROM db),
pl AS (SELECT *, unnest(range(31 - length(p))) AS off FROM pr, co),
sc AS (SELECT *, list_sum(list_transform(range(1, length(p) + 1), lambda i: CAST(substr(consensus, off + i, 1) <> 'N' AS INT))) AS told,
 list_sum(list_transform(range(1, length(p) + 1), lambda i: CAST(substr(consensus, off + i, 1) <> 'N' AND (instr('ACMGRSVTWYHKDBN', substr(consensus, off + i, 1)) & instr('ACMGRSVTWYHKDBN', substr(p, i, 1))) > 0 AS INT))) AS fit FROM pl),
hit AS (SELECT name, CAST(off + length(p) AS INT) AS trim, fit / told AS identity FROM sc WHERE told > 0 AND told >= 0.5 * length(p) AND fit / told >= 0.85 ORDER BY fit / told DESC, ord, rc, off LIMIT 1)"""


@query(f"WITH {CTE_R}, {_PROFILE_SQL}, {_BOUNDARY_SQL} SELECT boundary FROM bo")
def primer_boundary(spark, d):
    return pf.primer_boundary(pf.position_states(pf.base_profile(reads(spark, d))))


@query(f"WITH {CTE_R}, {_PROFILE_SQL}, {_CONSENSUS_SQL}, {_PRIMERS_SQL} SELECT name, trim, CAST(identity AS DECIMAL(2,1)) AS identity FROM hit")
def primer_match(spark, d):
    return pf.match_primers(pf.consensus(pf.position_states(pf.base_profile(reads(spark, d)))), pf.FORWARD).select("name", F.col("trim").cast("int").alias("trim"), F.col("identity").cast("decimal(2,1)").alias("identity"))


@query(f"""WITH {CTE_R}, {_PROFILE_SQL}, {_CONSENSUS_SQL}, {_BOUNDARY_SQL}, {_PRIMERS_SQL},
de AS (SELECT coalesce(avg(CASE WHEN state = 'D' THEN 1.0 ELSE 0.0 END), 0) AS d FROM st, bo WHERE pos < boundary),
tr AS (SELECT consensus, name, CASE WHEN name IS NOT NULL THEN trim WHEN boundary >= 30 OR d > 0.25 THEN 0 ELSE boundary END AS trim FROM co, bo, de LEFT JOIN hit ON true)
SELECT trim > 0 AS detected, coalesce(name, CASE WHEN trim > 0 THEN 'unknown' ELSE 'none' END) AS name, trim, substr(consensus, 1, trim) AS consensus FROM tr""")
def primer_decision(spark, d):
    return pf.detect_primer(reads(spark, d)).select("detected", "name", "trim", "consensus")


@query(f"""WITH {CTE_Q}, m AS (SELECT CASE WHEN ok % 3 = 0 THEN translate(seq, 'ACGT', 'TGCA') ELSE seq END AS seq FROM q),
l AS (SELECT pos, substr(seq, pos + 1, 1) AS b FROM m, (SELECT unnest(range(15)) AS pos) x), f AS (SELECT pos, b, count(*) / sum(count(*)) OVER (PARTITION BY pos) AS f FROM l GROUP BY pos, b),
k AS (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY f DESC, b) AS k FROM f), two AS (SELECT pos, max(CASE WHEN k = 1 THEN f END) AS f1, coalesce(max(CASE WHEN k = 2 THEN f END), 0) AS f2, max(CASE WHEN k = 1 THEN b END) AS b1, max(CASE WHEN k = 2 THEN b END) AS b2 FROM k GROUP BY pos),
bi AS (SELECT *, f1 + f2 > 0.85 AND f2 > 0.15 AND f1 < 0.85 AS bimodal FROM two), n AS (SELECT count_if(bimodal) AS n_bimodal, count_if(bimodal) / count(*) > 0.5 AS mixed FROM bi),
top AS (SELECT pos, b1, b2 FROM bi WHERE bimodal ORDER BY f2 DESC, pos LIMIT 1), sh AS (SELECT avg(CASE WHEN substr(seq, pos + 1, 1) = b2 THEN 1.0 ELSE 0.0 END) AS share FROM m, top)
SELECT mixed, n_bimodal, CASE WHEN mixed THEN CAST(pos AS INT) END AS best_pos, CASE WHEN mixed THEN b1 END AS majority, CASE WHEN mixed THEN b2 END AS minority, CASE WHEN mixed THEN share END AS ratio FROM n LEFT JOIN top ON true LEFT JOIN sh ON true""")
def mixed_orientation(spark, d):
    q = full_reads(spark, d).withColumn("seq", F.when(F.col("ok") % 3 == 0, F.translate("seq", "ACGT", "TGCA")).otherwise(F.col("seq")))
    return pf.mixed_orientation(q, pf.base_profile(q))


@query(f"""WITH {CTE_Q}, p AS (SELECT unnest(range(50)) AS pos), f AS (SELECT pos, avg(CASE WHEN substr(seq_tail_n, length(seq_tail_n) - pos, 1) = 'N' THEN 1.0 ELSE 0.0 END) AS f FROM q, p GROUP BY pos),
l AS (SELECT greatest(3 * avg(CASE WHEN pos BETWEEN 25 AND 44 THEN f END), 0.01) AS l FROM f), t AS (SELECT least(coalesce(min(CASE WHEN f <= l THEN pos END), 50), 30) AS t FROM f, l)
SELECT CAST(t AS INT) AS trim_length, CAST(trunc(quantile_cont(length(c) - length(replace(c, 'N', '')), 0.95)) AS INT) AS max_ambiguous FROM (SELECT t, substr(seq_tail_n, 1, length(seq_tail_n) - t) AS c FROM q, t) x GROUP BY t""")
def tail_trim(spark, d):
    q = full_reads(spark, d).select(F.col("seq_tail_n").alias("seq"), F.col("ln").alias("read_no"))
    return pf.tail_profile(q)


@query(f"WITH {CTE_Q}, x AS (SELECT unnest(range(113)) AS pos), c AS (SELECT pos, ascii(substr(qual, pos + 1, 1)) - 33 AS s FROM q, x) SELECT CAST(pos AS INT) AS pos, count(*) AS n, quantile_cont(s, 0.02) AS p02, quantile_cont(s, 0.09) AS p09, quantile_cont(s, 0.25) AS p25, quantile_cont(s, 0.5) AS p50, quantile_cont(s, 0.75) AS p75, quantile_cont(s, 0.91) AS p91, quantile_cont(s, 0.98) AS p98 FROM c GROUP BY pos")
def quality_profile(spark, d):
    return pf.quality_profile(full_reads(spark, d))


@query()
def quality_window(spark, d):
    return pf.trim_positions(pf.quality_profile(full_reads(spark, d)), q=20)


@query(f"WITH {CTE_Q}, c AS (SELECT DISTINCT unnest(string_split(bad_qual, '')) AS c FROM q) SELECT count(*) AS n_chars, CASE WHEN count(*) < 5 THEN 'degraded_binned' ELSE 'normal' END AS status FROM c")
def quality_diversity(spark, d):
    return pf.quality_status(full_reads(spark, d).withColumn("qual", F.col("bad_qual")))


@query(f"WITH {CTE_R}, l AS (SELECT 60 + ok % 300 AS len FROM r), b AS (SELECT len // 50 AS b, count(*) AS n FROM l GROUP BY 1), t AS (SELECT b AS top FROM b ORDER BY n DESC, b LIMIT 1), s AS (SELECT top, sum(CASE WHEN abs(b - top) <= 1 THEN n END) / sum(n) AS share FROM b, t GROUP BY top), c AS (SELECT share, CASE WHEN share >= 0.25 THEN top * 50 + 25 ELSE CAST(trunc((SELECT quantile_cont(len, 0.5) FROM l)) AS BIGINT) END AS center FROM s), w AS (SELECT share, center, greatest(200, CAST(round_even(center * 0.85, 0) AS INT)) AS lo, CAST(round_even(center * 1.15, 0) AS INT) AS hi FROM c) SELECT CAST(center AS INT) AS center, round(share, 6) AS share, lo, CASE WHEN hi <= lo THEN lo + 50 ELSE hi END AS hi FROM w")
def length_window(spark, d):
    q = reads(spark, d).select(F.repeat(F.lit("A"), (60 + F.col("ok") % 300).cast("int")).alias("seq"), F.col("ln").alias("read_no"))
    return pf.length_window(q).withColumn("share", F.round("share", 6))


# features


@query(f"WITH {CTE_R} SELECT seq, count(*) AS size FROM r GROUP BY 1")
def derep(spark, d):
    return ft.dereplicate(reads(spark, d))


@query(f"WITH {CTE_R} SELECT sample_id, seq, count(*) AS size FROM r GROUP BY ALL HAVING count(*) >= 3")
def derep_by_sample(spark, d):
    return ft.min_size(ft.dereplicate(reads(spark, d), ("sample_id",)), 3)


@query(f"WITH {_FILTER_SQL}, g AS (SELECT sample_id, seq FROM fr WHERE discard_reason IS NULL), t AS (SELECT seq FROM g GROUP BY seq HAVING count(*) >= 2) SELECT md5(seq) AS feature_id, sample_id, count(*) AS n FROM g WHERE seq IN (SELECT seq FROM t) GROUP BY ALL")
def feature_counts(spark, d):
    kept = rd.prefilter(_mixed_reads(spark, d)).where("discard_reason is null")
    return ft.min_frequency(ft.feature_counts(kept), 2)


@query(f"WITH {CTE_R} SELECT md5(seq) AS feature_id, sample_id, CAST(count(*) + count_if(ok % 2 = 0) AS BIGINT) AS n FROM r GROUP BY ALL")
def merge_tables(spark, d):
    r = reads(spark, d)
    return ft.merge_tables([ft.feature_counts(r), ft.feature_counts(r.where("ok % 2 = 0"))])


@query(f"WITH {CTE_R}, raw AS (SELECT sample_id, count(*) // 2 AS raw FROM r GROUP BY 1), fin AS (SELECT sample_id, count(*) AS final FROM r WHERE tpl < 30 AND sample_id <> 'S3' GROUP BY 1) SELECT sample_id, raw, coalesce(final, 0) AS final FROM raw LEFT JOIN fin USING (sample_id)")
def sample_summary(spark, d):
    r = reads(spark, d)
    return ft.sample_summary(r.select("sample_id").distinct(), ft.raw_read_counts(r), ft.feature_counts(r.where("tpl < 30 and sample_id <> 'S3'")), paired=True)


@query(f"WITH {CTE_R}, a AS (SELECT count(*) AS raw, count_if(tpl > 20) AS final FROM r) SELECT CAST(raw AS BIGINT) AS raw, CAST(final AS BIGINT) AS final, round(final / (raw // 2), 6) AS pct, CASE WHEN final / (raw // 2) < 0.5 THEN 'forward_reads' ELSE 'keep' END AS decision FROM a")
def retention(spark, d):
    r = reads(spark, d)
    return ft.retention(ft.raw_read_counts(r), ft.feature_counts(r.where("tpl > 20"))).withColumn("pct", F.round("pct", 6))


@query(f"WITH {CTE_R} SELECT count(*) AS n, count(DISTINCT seq) AS n_unique, CAST(count(DISTINCT seq) * 1000 // count(*) AS BIGINT) AS ppt, count(DISTINCT sample_id) = 1 AND count(DISTINCT seq) * 1000 // count(*) > 950 AS untrustworthy FROM r")
def abundance_check(spark, d):
    return ft.abundance_check(reads(spark, d))


def _marked_counts(spark, d) -> DataFrame:
    """Counts with the mark of features of every third template, from one pass over the reads; only distinct sequences are hashed."""
    found = ft.dereplicate(reads(spark, d), ("sample_id",), F.bool_or(F.expr("tpl % 3 = 0")).alias("listed"))
    return staged(found.select(F.md5("seq").alias("feature_id"), "sample_id", F.col("size").alias("n"), "listed"))


@query(f"WITH {CTE_R} SELECT md5(seq) AS feature_id, sample_id, count(*) AS n, tpl % 3 = 0 AS kept FROM r GROUP BY ALL")
def filter_features(spark, d):
    marked = _marked_counts(spark, d)
    counts, ids = marked.drop("listed"), marked.where("listed").select("feature_id").distinct()
    return ft.keep_features(counts, ids).withColumn("kept", F.lit(True)).unionByName(ft.removed_features(counts, ids).withColumn("kept", F.lit(False)))


@query(f"WITH {CTE_R} SELECT 'feature_without_sequence' AS issue, 'error' AS level, count(DISTINCT seq) AS n FROM r WHERE tpl % 3 <> 0 UNION ALL SELECT 'sample_not_in_manifest', 'warning', count(DISTINCT sample_id) FROM r WHERE sample_id IN ('S1', 'S2')")
def referential_check(spark, d):
    counts = _marked_counts(spark, d)
    return ft.check_references(counts, counts.where("listed").select("feature_id").distinct(), counts.where("sample_id not in ('S1', 'S2')").select("sample_id").distinct())


@query(f"WITH {CTE_R}, l AS (SELECT 60 + ok % 300 AS len FROM r), o AS (SELECT len, row_number() OVER (ORDER BY len) AS k, count(*) OVER () AS n FROM l) SELECT *, n >= 20 AND p95 / p05 > 1.5 AS warn FROM (SELECT max(n) AS n, CAST(min(CASE WHEN k = floor(n * 0.05) + 1 THEN len END) AS INT) AS p05, CAST(min(CASE WHEN k >= floor(n * 0.95) THEN len END) AS INT) AS p95 FROM o) x")
def length_spread(spark, d):
    return ft.length_spread(reads(spark, d).select(F.repeat(F.lit("A"), (60 + F.col("ok") % 300).cast("int")).alias("seq"))).select("n", "p05", "p95", "warn")


@query(f"WITH {CTE_R}, s AS (SELECT sample_id, count(*) AS n FROM r GROUP BY 1), f AS (SELECT seq, count(*) AS n FROM r GROUP BY 1) SELECT * FROM (SELECT count(*) AS samples, CAST(sum(n) AS BIGINT) AS total, min(n) AS sample_min, median(n) AS sample_median, max(n) AS sample_max FROM s) a, (SELECT count(*) AS features, median(n) AS feature_median FROM f) b")
def summarize_table(spark, d):
    return ft.summarize_table(ft.feature_counts(reads(spark, d)))


_REGION_SQL = "CASE WHEN len(c) = 0 THEN 'unclassified' WHEN len(c) = 9 THEN 'V1-V9' WHEN len(c) = 1 THEN c[1] ELSE concat(c[1], '-', c[-1]) END"
_COVERED = "list_transform(list_filter([" + ", ".join(f"{{'n': '{n}', 's': {s}, 'e': {e}}}" for n, s, e in ft.REGIONS) + "], lambda v: greatest(0, least(hi, v.e) - greatest(lo, v.s)) >= 0.5 * (v.e - v.s)), lambda v: v.n)"
_SPANS = "SELECT l_orderkey AS ok, l_linenumber AS ln, l_suppkey % 20 AS dataset_id, CAST(l_partkey * 13 % 900 AS INT) AS lo, CAST(l_partkey * 13 % 900 + l_orderkey * 7 % 650 AS INT) AS hi FROM lineitem"


def _spans(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("ok"), F.col("l_linenumber").alias("ln"), (F.col("l_suppkey") % 20).alias("dataset_id"), (F.col("l_partkey") * 13 % 900).cast("int").alias("lo"), (F.col("l_partkey") * 13 % 900 + F.col("l_orderkey") * 7 % 650).cast("int").alias("hi"))


@query(f"WITH s AS (SELECT *, {_COVERED} AS c FROM ({_SPANS}) t) SELECT ok, ln, lo, hi, {_REGION_SQL} AS region FROM s")
def region_call(spark, d):
    return ft.call_regions(_spans(spark, d)).select("ok", "ln", "lo", "hi", "region")


@query(f"""WITH s AS (SELECT *, {_COVERED} AS c FROM ({_SPANS}) t), x AS (SELECT dataset_id, {_REGION_SQL} AS own FROM s),
m AS (SELECT dataset_id, CAST(trunc(quantile_cont(lo, 0.5)) AS INT) AS lo, CAST(trunc(quantile_cont(hi, 0.5)) AS INT) AS hi FROM s GROUP BY 1), k AS (SELECT *, {_COVERED} AS c FROM m), r AS (SELECT dataset_id, lo, hi, {_REGION_SQL} AS region FROM k)
SELECT dataset_id, region, lo, hi, round_even(avg(CASE WHEN own = region THEN 1.0 ELSE 0.0 END), 2) AS confidence, count(*) AS n FROM x JOIN r USING (dataset_id) GROUP BY ALL""")
def region_consensus(spark, d):
    return ft.region_consensus(_spans(spark, d))


@query("WITH f AS (SELECT o_custkey % 10 AS dataset_id, o_orderkey AS s, CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS mates FROM (SELECT DISTINCT o_custkey, o_orderkey FROM orders)) SELECT dataset_id, count_if(mates < 2) AS n_se, count_if(mates = 2) AS n_pe, CASE WHEN count_if(mates = 2) >= count_if(mates < 2) THEN 'PE' ELSE 'SE' END AS layout FROM f GROUP BY 1")
def layout(spark, d):
    f = table(spark, d, "orders").select((F.col("o_custkey") % 10).alias("dataset_id"), F.col("o_orderkey").alias("sample_id"), F.explode(F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("mate"))
    return ft.layout(f)


@query("WITH n AS (SELECT DISTINCT c_nationkey % 20 AS k FROM customer) SELECT concat('S', a.k) AS sample_id, concat('S', b.k) AS other FROM n a JOIN n b ON a.k <> b.k AND starts_with(concat('S', b.k), concat('S', a.k))")
def prefix_collisions(spark, d):
    return ft.prefix_collisions(table(spark, d, "customer").select(F.concat(F.lit("S"), F.col("c_nationkey") % 20).alias("sample_id")))


# similarity


def _features(spark, d) -> DataFrame:
    """Written once: what compares features reads them many times."""
    return staged(ft.dereplicate(reads(spark, d)).withColumn("feature_id", F.md5("seq")))


@query(f"WITH {CTE_R}, f AS (SELECT DISTINCT seq FROM r) SELECT md5(a.seq) AS query, md5(b.seq) AS ref, CAST(levenshtein(a.seq, b.seq) AS INT) AS d FROM f a, f b WHERE a.seq <> b.seq AND levenshtein(a.seq, b.seq) <= 3")
def similarity_join(spark, d):
    f = _features(spark, d)
    return sm.similarity_join(f, f, 0.97).where("query <> ref").select("query", "ref", "d")


@query(f"WITH {CTE_R}, f AS (SELECT tpl, seq, count(*) AS size FROM r GROUP BY ALL), c AS (SELECT tpl, arg_max(seq, size * 100000 - k) AS seq, CAST(sum(size) AS BIGINT) AS size FROM (SELECT *, row_number() OVER (PARTITION BY tpl ORDER BY seq) AS k FROM f) x GROUP BY tpl) SELECT md5(seq) AS feature_id, seq, size FROM c")
def cluster_97(spark, d):
    f = _features(spark, d).select("feature_id", "seq", "size")
    return sm.cluster_sizes(f, sm.greedy_cluster(f, 0.97))


@query(f"WITH {CTE_R}, f AS (SELECT tpl, seq, count(*) AS size FROM r GROUP BY ALL), c AS (SELECT tpl, arg_max(seq, size * 100000 - k) AS seq FROM (SELECT *, row_number() OVER (PARTITION BY tpl ORDER BY seq) AS k FROM f) x GROUP BY tpl) SELECT md5(c.seq) AS feature_id, sample_id, count(*) AS n FROM r JOIN c USING (tpl) GROUP BY ALL")
def map_back(spark, d):
    f = _features(spark, d).select("feature_id", "seq", "size")
    otus = staged(sm.cluster_sizes(f, sm.greedy_cluster(f, 0.97)))
    return sm.map_back(reads(spark, d), otus, 0.97)


@query()
def denoise(spark, d):
    return sm.denoise_by_skew(_features(spark, d).select("feature_id", "seq", "size"), 2)


@query(f"""WITH {CTE_R}, f AS (SELECT md5(upper(seq)) AS feature_id, upper(seq) AS seq, count(*) AS size FROM r GROUP BY upper(seq)),
pairs AS (
  SELECT q.feature_id, p.feature_id AS parent, length(q.seq) AS len, len(list_filter(range(1, least(length(q.seq), length(p.seq)) + 1), lambda i: substr(q.seq, 1, i) = substr(p.seq, 1, i))) AS a,
    len(list_filter(range(1, least(length(q.seq), length(p.seq)) + 1), lambda i: right(q.seq, i) = right(p.seq, i))) AS b
  FROM f q JOIN f p ON p.size >= 16 * q.size AND p.feature_id <> q.feature_id),
gone AS (
  SELECT feature_id FROM pairs x JOIN pairs y USING (feature_id) WHERE x.parent <> y.parent AND x.a + y.b >= x.len
  EXCEPT SELECT feature_id FROM pairs WHERE a = len OR b = len)
SELECT feature_id, seq, size FROM f WHERE feature_id NOT IN (SELECT feature_id FROM gone)""")
def chimeras(spark, d):
    return sm.remove_chimeras(_features(spark, d).select("feature_id", "seq", "size"))


@query()
def otu_table(spark, d):
    return pipelines.otu_pipeline(reads(spark, d)).counts


@query(f"WITH {CTE_Q}, f AS (SELECT DISTINCT seq_mixed, seq FROM q) SELECT md5(seq_mixed) AS feature_id, seq FROM f")
def orient(spark, d):
    q = full_reads(spark, d)
    f = q.select(F.col("seq_mixed").alias("seq")).distinct().withColumn("feature_id", F.md5("seq"))
    return sm.orient(f, q.select("seq").distinct())[0].select("feature_id", "seq")


@query(f"""WITH {CTE_R}, f AS (SELECT DISTINCT md5(upper(seq)) AS feature_id, upper(seq) AS seq FROM r),
named AS (SELECT concat('g', CAST(tpl % 4 AS VARCHAR), ';t', CAST(tpl AS VARCHAR)) AS lineage, min(seq) AS seq FROM r GROUP BY tpl),
grams AS (SELECT lineage, kmer, count(*) AS c FROM (SELECT lineage, unnest(list_transform(range(1, length(seq) - 5), lambda i: substr(seq, i, 7))) AS kmer FROM named) GROUP BY 1, 2),
size AS (SELECT lineage, sum(c) + (SELECT count(DISTINCT kmer) FROM grams) AS total, ln(1.0 / (SELECT count(*) FROM named)) AS prior FROM grams GROUP BY 1),
asked AS (SELECT feature_id, kmer, count(*) AS c FROM (SELECT feature_id, unnest(list_transform(range(1, length(seq) - 5), lambda i: substr(seq, i, 7))) AS kmer FROM f) WHERE kmer IN (SELECT kmer FROM grams) GROUP BY 1, 2),
score AS (
  SELECT feature_id, lineage, max(prior) + sum(a.c * ln((coalesce(g.c, 0) + 1) / total)) AS s
  FROM asked a CROSS JOIN size LEFT JOIN grams g USING (lineage, kmer) GROUP BY 1, 2),
post AS (SELECT feature_id, lineage, exp(s - max(s) OVER w) / sum(exp(s - m)) OVER w AS p FROM (SELECT *, max(s) OVER (PARTITION BY feature_id) AS m FROM score) WINDOW w AS (PARTITION BY feature_id)),
taxa AS (SELECT feature_id, 1 AS depth, string_split(lineage, ';')[1] AS taxon, sum(p) AS p FROM post GROUP BY 1, 3 UNION ALL SELECT feature_id, 2, lineage, p FROM post),
best AS (SELECT *, row_number() OVER (PARTITION BY feature_id ORDER BY depth DESC, p DESC, taxon DESC) AS k FROM taxa WHERE p >= 0.7)
SELECT f.feature_id, coalesce(taxon, 'Unassigned') AS lineage, round(coalesce(p, 0), 6) AS confidence FROM f LEFT JOIN best ON best.feature_id = f.feature_id AND k = 1""")
def kmer_naive_bayes(spark, d):
    """Reads assigned to the group and number of their template, by 7-mers learned from one read of each."""
    r = reads(spark, d)
    named = r.groupBy("tpl").agg(F.min("seq").alias("seq")).select(F.concat(F.lit("g"), (F.col("tpl") % 4).cast("string"), F.lit(";t"), F.col("tpl").cast("string")).alias("lineage"), "seq")
    return sm.classify(_features(spark, d).select("feature_id", "seq"), sm.train_classifier(named)).withColumn("confidence", F.round("confidence", 6))


@query(f"WITH {CTE_Q} SELECT sample_id, ok AS read_no, length(min(seq)) AS len, min(seq) AS seq FROM q GROUP BY sample_id, ok")
def merge_pairs(spark, d):
    r = full_reads(spark, d, "sample_id", "ok", "seq", "qual").groupBy("sample_id", F.col("ok").alias("read_no")).agg(F.min(F.struct("seq", "qual")).alias("r"))
    pairs = r.select("sample_id", "read_no", F.substring("r.seq", 1, 80).alias("seq1"), F.substring("r.qual", 1, 80).alias("qual1"), F.substring(sq.revcomp(F.col("r.seq")), 1, 80).alias("seq2"), F.substring(F.reverse("r.qual"), 1, 80).alias("qual2"))
    return sm.merge_pairs(pairs).select("sample_id", "read_no", F.length("seq").alias("len"), "seq")


# datasets, files and reports


@query("WITH u AS (SELECT concat('R', o_orderkey) AS run FROM orders WHERE o_orderkey % 40 <> 0), r AS (SELECT DISTINCT concat('D', o_custkey) AS dataset_id, concat('R', o_orderkey) AS run FROM orders) SELECT dataset_id, count_if(u.run IS NULL) AS n_gap, CASE WHEN count_if(u.run IS NULL) > 0 THEN 'other' ELSE 'first' END AS source FROM r LEFT JOIN (SELECT DISTINCT run FROM u) u USING (run) GROUP BY 1")
def source_gap(spark, d):
    o = table(spark, d, "orders").select(F.concat(F.lit("D"), "o_custkey").alias("dataset_id"), F.concat(F.lit("R"), "o_orderkey").alias("run"), "o_orderkey").distinct()
    return md.source_gap(o.select("dataset_id", "run"), o.where("o_orderkey % 40 <> 0").select("run", F.concat(F.lit("ftp://"), "run").alias("url")).distinct())


def _files(spark, d) -> DataFrame:
    o = table(spark, d, "orders").select((F.col("o_custkey") % 50).alias("dataset_id"), F.col("o_orderkey").alias("sample_id")).distinct()
    k = F.col("sample_id") % 4
    return o.select("dataset_id", "sample_id", F.explode(F.when(k == 0, F.array(F.lit(1), F.lit(2))).when(k == 1, F.array(F.lit(1))).when(k == 2, F.array(F.lit(None).cast("int"), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(None).cast("int")))).alias("mate"))


@query("SELECT dataset_id, sample_id, mate FROM (SELECT DISTINCT o_custkey % 50 AS dataset_id, o_orderkey AS sample_id FROM orders) o, (SELECT unnest([1, 2, NULL]) AS mate) m WHERE CASE WHEN mate IS NULL THEN sample_id % 4 = 3 ELSE sample_id % 4 IN (0, 2) END")
def orphan_files(spark, d):
    return ft.drop_orphans(_files(spark, d))


@query("WITH o AS (SELECT DISTINCT o_custkey % 50 AS dataset_id, o_orderkey AS s FROM orders), c AS (SELECT dataset_id, count(*) AS n_runs, CAST(sum(CASE s % 4 WHEN 0 THEN 2 WHEN 2 THEN 3 ELSE 1 END) AS BIGINT) AS n_files, count_if(s % 4 IN (0, 1, 2)) AS r1, count_if(s % 4 IN (0, 2)) AS r2 FROM o GROUP BY 1) SELECT dataset_id, n_runs, n_files, n_files = n_runs OR n_files = 2 * n_runs AS complete, CASE WHEN r2 > 0 AND 10 * r2 >= 9 * r1 THEN 'PE' ELSE 'SE' END AS layout FROM c")
def completeness(spark, d):
    f = _files(spark, d)
    return ft.completeness(f, f.select("dataset_id", "sample_id").distinct())


@query(f"WITH {CTE_R} SELECT sample_id, count(*) AS n_pairs, count_if(ok % 3 = 0) AS n_merged, round(count_if(ok % 3 = 0) / count(*), 6) AS rate, CASE WHEN count_if(ok % 3 = 0) / count(*) < 0.5 THEN 'forward' ELSE 'merged' END AS use FROM r GROUP BY 1")
def merge_rate(spark, d):
    r = reads(spark, d)
    return ft.merge_rate(r, r.where("ok % 3 = 0")).withColumn("rate", F.round("rate", 6))


@query("""WITH t AS (SELECT o_custkey AS project, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 2 END AS tier, o_orderkey AS pos, concat('P', o_orderkey) AS pmid FROM (SELECT DISTINCT o_custkey, o_orderkey FROM orders)),
b AS (SELECT *, row_number() OVER (PARTITION BY project ORDER BY pos) AS k FROM (SELECT *, min(tier) OVER (PARTITION BY project) AS best FROM t) x WHERE tier = best),
d AS (SELECT project, string_agg(doi, ';' ORDER BY p) AS dois FROM (SELECT project, concat('10.', pos % 3) AS doi, min(pos) AS p FROM b WHERE pos % 4 > 0 GROUP BY 1, 2) y GROUP BY 1)
SELECT b.project, best AS tier, string_agg(pmid, ';' ORDER BY pos) AS pmids, string_agg(CASE WHEN k <= 2 THEN concat('T', pos) END, ' || ' ORDER BY pos) AS titles,
 coalesce(string_agg(CASE WHEN k <= 2 AND pos % 5 > 0 THEN concat('On ', pos % 11) END, ' || ' ORDER BY pos), '') AS abstracts, coalesce(max(dois), '') AS dois
FROM b LEFT JOIN d ON b.project = d.project GROUP BY b.project, best""")
def publications(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("project"), F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(2).alias("tier"), F.col("o_orderkey").alias("pos"), F.concat(F.lit("P"), "o_orderkey").alias("pmid")).distinct()
    text = lambda here, head, n: F.when(F.col("pos") % here > 0, F.concat(F.lit(head), F.col("pos") % n))
    a = o.select("pmid", F.concat(F.lit("T"), "pos").alias("title"), text(5, "On ", 11).alias("abstract"), text(4, "10.", 3).alias("doi")).distinct()
    return md.associate_publications(o, a)


@query("""WITH t AS (SELECT c_nationkey AS dataset_id, count(*) AS samples, CAST(sum(c_custkey) AS BIGINT) AS raw FROM customer GROUP BY 1)
SELECT dataset_id, samples, raw, CASE WHEN dataset_id % 2 = 0 THEN 'ILLUMINA' ELSE 'NA' END AS platform, CASE WHEN dataset_id % 3 = 0 THEN 'normal' ELSE 'NA' END AS quality_status, CASE WHEN dataset_id % 5 = 0 THEN 'V4' ELSE 'NA' END AS region FROM t""")
def dataset_summary(spark, d):
    c = table(spark, d, "customer").withColumnRenamed("c_nationkey", "dataset_id")
    t = c.groupBy("dataset_id").agg(F.count("*").alias("samples"), F.sum("c_custkey").alias("raw"))
    ids = t.select("dataset_id")
    return ft.dataset_summary(ids.where("dataset_id % 5 = 0").select("dataset_id", F.lit("V4").alias("region"), F.lit(1).alias("lo"), F.lit(2).alias("hi"), F.lit(1.0).alias("confidence")), ids.where("dataset_id % 3 = 0").withColumn("quality_status", F.lit("normal")), ids.where("dataset_id % 2 = 0").withColumn("platform", F.lit("ILLUMINA")), t).select("dataset_id", "samples", "raw", "platform", "quality_status", "region")


@query("SELECT c_nationkey AS dataset_id, count(*) AS samples, CAST(coalesce(sum(CASE WHEN c_custkey % 7 <> 0 THEN c_custkey END), 0) AS BIGINT) AS raw, CAST(0 AS BIGINT) AS final FROM customer GROUP BY 1")
def dataset_totals(spark, d):
    c = table(spark, d, "customer")
    return ft.dataset_totals(c.select(F.col("c_nationkey").alias("dataset_id"), F.when(F.col("c_custkey") % 7 == 0, "n/a").otherwise(F.col("c_custkey").cast("string")).alias("raw"), F.lit("x").alias("final")))


@query("SELECT c_nationkey AS dataset_id, count(*) AS samples, CAST(sum(c_custkey) AS BIGINT) AS raw, CAST(sum(c_custkey % 9) AS BIGINT) AS final FROM customer GROUP BY ROLLUP (c_nationkey)")
def summary_rollup(spark, d):
    c = table(spark, d, "customer")
    return ft.summary_rollup(c.select(F.col("c_nationkey").alias("dataset_id"), F.col("c_custkey").alias("raw"), (F.col("c_custkey") % 9).alias("final")))


@query("SELECT concat('f', o_orderkey) AS file, count(l_orderkey) AS n_lines, count(l_orderkey) > 0 AND count(l_orderkey) % 4 = 0 AS valid FROM (SELECT DISTINCT o_orderkey FROM orders) o LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_linenumber % 3 > 0 GROUP BY o_orderkey")
def fastq_integrity(spark, d):
    lines = table(spark, d, "lineitem").where("l_linenumber % 3 > 0").select(F.concat(F.lit("f"), "l_orderkey").alias("file"), F.col("l_comment" if "l_comment" in table(spark, d, "lineitem").columns else "l_linenumber").cast("string").alias("value"))
    return fl.fastq_integrity(lines, table(spark, d, "orders").select(F.concat(F.lit("f"), "o_orderkey").alias("file")))


@query(f"WITH {CTE_R} SELECT count_if(60 + ok % 300 > 250) / count(*) AS share, count_if(60 + ok % 300 > 250) / count(*) > 0.5 AS long FROM r")
def long_reads(spark, d):
    return pf.long_read_share(reads(spark, d).select(F.repeat(F.lit("A"), (60 + F.col("ok") % 300).cast("int")).alias("seq"), F.col("ln").alias("read_no")), 250)


@query(f"WITH {CTE_R}, l AS (SELECT 60 + ok % 300 - 15 AS n FROM r) SELECT CAST(trunc(quantile_cont(n, 0.1)) AS INT) AS length FROM l WHERE n > 0")
def truncation_length(spark, d):
    return pf.truncation_length(reads(spark, d).select(F.repeat(F.lit("A"), (60 + F.col("ok") % 300).cast("int")).alias("seq")))


@query("WITH o AS (SELECT min(o_orderkey) AS k FROM orders WHERE o_orderstatus = 'F') SELECT k AS o_orderkey, 'F' AS o_orderstatus FROM o")
def match_or_first(spark, d):
    return md.match_or_first(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", "F", "o_orderkey")


@query(f"WITH {CTE_R} SELECT tpl, seq AS label FROM (SELECT tpl, concat('>', sample_id, '_', row_number() OVER (PARTITION BY sample_id ORDER BY ok, ln, pk, seq), ';sample=', sample_id, ';', chr(10), seq) AS seq FROM (SELECT DISTINCT * FROM r) r) x")
def labelled_fasta(spark, d):
    r = reads(spark, d, distinct=True)
    file = F.concat(F.lpad(F.col("ok").cast("string"), 12, "0"), F.lpad(F.col("ln").cast("string"), 4, "0"), F.lpad(F.col("pk").cast("string"), 12, "0"))
    rows = r.select("sample_id", "tpl", "seq", file.alias("file"), F.col("seq").alias("read_no"))
    return rd.label_reads(rows, "tpl").select("tpl", F.col("value").alias("label"))


# filters and trims of reads


@query(f"WITH {_FILTER_SQL}, t AS (SELECT ok, substr(seq, 6) AS seq, substr(qual, 6) AS qual FROM fr), e AS (SELECT *, list_sum(list_transform(string_split(qual, ''), lambda c: power(10.0, -(ascii(c) - 33) / 10.0))) AS ee FROM t) SELECT ok % 11 AS kind, count(*) AS n FROM e WHERE ee <= 0.3 AND ee / length(qual) <= 0.002 AND length(seq) BETWEEN 20 AND 110 GROUP BY 1")
def expected_error_filter(spark, d):
    """Reads within an expected error, an error rate and a length window, by kind of read."""
    kept = rd.filter_expected_error(_mixed_reads(spark, d), 0.3, 0.002, 20, 110, 5)
    return kept.groupBy((F.col("ok") % 11).alias("kind")).agg(F.count("*").alias("n"))


@query(f"WITH {_FILTER_SQL}, e AS (SELECT ok, length(seq) AS len, -10 * log10(list_sum(list_transform(string_split(qual, ''), lambda c: power(10.0, -(ascii(c) - 33) / 10.0))) / length(qual)) AS mq FROM fr) SELECT ok % 11 AS kind, count(*) AS n FROM e WHERE mq >= 10 AND len BETWEEN 55 AND 400 GROUP BY 1")
def mean_quality_filter(spark, d):
    return rd.filter_mean_quality(_mixed_reads(spark, d), 10, 55, 400).groupBy((F.col("ok") % 11).alias("kind")).agg(F.count("*").alias("n"))


@query(f"WITH {CTE_Q}, c AS (SELECT seq, length(regexp_extract(bad_qual, '^(.*?)(#{{4}}|$)', 1)) AS cut FROM q) SELECT length(substr(seq, 1, cut)) AS len, count(*) AS n FROM c WHERE cut >= 0.02 * length(seq) GROUP BY 1")
def length_fraction_filter(spark, d):
    """Reads cut before their first four poor scores, by what is left of them."""
    kept = rd.filter_length_fraction(full_reads(spark, d, "seq", "bad_qual").select("seq", F.col("bad_qual").alias("qual")), 0.02)
    return kept.groupBy(F.length("seq").alias("len")).agg(F.count("*").alias("n"))


@query(f"WITH {_FILTER_SQL}, g AS (SELECT sample_id, ok, min(length(seq)) AS least, count(*) AS n FROM fr WHERE ok % 2 = 0 GROUP BY ALL) SELECT 'pairs' AS kind, CAST(sum(n) AS BIGINT) AS n FROM g WHERE least >= 50 UNION ALL SELECT 'reads', count(*) FROM fr WHERE length(seq) >= 50")
def length_filter(spark, d):
    r = _mixed_reads(spark, d).withColumn("read_no", F.col("ok"))
    pairs, single = rd.min_length(r.where("ok % 2 = 0"), 50, True), rd.min_length(r, 50)
    return pairs.agg(F.count("*").alias("n")).select(F.lit("pairs").alias("kind"), "n").unionByName(single.agg(F.count("*").alias("n")).select(F.lit("reads").alias("kind"), "n"))


@query(f"WITH {CTE_Q}, t AS (SELECT sample_id, CASE WHEN length(seq) > 9 THEN substr(seq, 1, length(seq) - 9) ELSE seq END AS seq FROM q), f AS (SELECT sample_id, substr(seq, 1 + CASE WHEN sample_id = 'S7' THEN 0 ELSE CAST(substr(sample_id, 2) AS INT) END) AS seq FROM t) SELECT sample_id, count(DISTINCT seq) AS n_unique, CAST(sum(length(seq)) AS BIGINT) AS bases FROM f GROUP BY 1")
def trims(spark, d):
    """Reads without their last nine bases and their dataset's primer length."""
    r = rd.trim_tail(full_reads(spark, d).withColumn("dataset_id", F.col("sample_id")), 9)
    lengths = r.select("dataset_id").distinct().where("dataset_id <> 'S7'").withColumn("trim", F.substring("dataset_id", 2, 9).cast("int"))
    return rd.trim_fixed(r, lengths).groupBy("sample_id").agg(F.countDistinct("seq").alias("n_unique"), F.sum(F.length("seq")).alias("bases"))


@query(f"WITH {CTE_R}, p AS (SELECT sample_id, ok, ln, seq AS a, reverse(translate(seq, 'ACGT', 'TGCA')) AS b FROM r), f AS (SELECT *, substr(a, 9, 1) <> 'A' AS swapped FROM p) SELECT ok, ln, swapped, substr(CASE WHEN swapped THEN b ELSE a END, 4) AS seq1, substr(CASE WHEN swapped THEN a ELSE b END, 6) AS seq2 FROM f")
def orientation_repair(spark, d):
    r = reads(spark, d)
    pairs = r.select("sample_id", F.struct("ok", "ln").alias("read_no"), F.col("seq").alias("seq1"), F.col("seq").alias("qual1"), sq.revcomp(F.col("seq")).alias("seq2"), F.col("seq").alias("qual2"))
    return rd.repair_orientation(pairs, 8, "A", 3, 5).select("read_no.ok", "read_no.ln", "swapped", "seq1", "seq2")


@query(f"WITH {CTE_Q}, c AS (SELECT DISTINCT sample_id, unnest(string_split(CASE WHEN sample_id IN ('S1', 'S4') THEN repeat('I', length(qual)) ELSE qual END, '')) AS c FROM q) SELECT sample_id, count(*) <= 1 AS dummy FROM c GROUP BY 1")
def dummy_quality(spark, d):
    q = full_reads(spark, d).withColumn("read_no", F.col("ln")).withColumn("qual", F.when(F.col("sample_id").isin("S1", "S4"), F.repeat(F.lit("I"), F.length("qual"))).otherwise(F.col("qual")))
    return rd.has_dummy_quality(q)


@query(f"WITH {CTE_R} SELECT concat('r', ok, '_', ln) AS id, seq, false AS residual, count(*) AS n FROM r GROUP BY ALL")
def fasta_ids(spark, d):
    r = reads(spark, d).select(F.concat(F.lit("r"), "ok", F.lit("_"), "ln", F.lit(";size="), "pk", F.lit("; x")).alias("id"), F.lower("seq").alias("seq"))
    return rd.clean_fasta_ids(r).groupBy("id", "seq", "residual").agg(F.count("*").alias("n"))


# metadata that other queries leave out


@query(f"WITH {CTE_M} SELECT m.run AS \"Run\", m.project AS project, o_orderstatus AS status, CASE WHEN o_orderkey IS NOT NULL THEN concat('x', m.ok) END AS project_sheet FROM m LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 3 <> 0) o ON m.run = concat('SRR', o_orderkey)")
def join_runs(spark, d):
    sheets = table(spark, d, "orders").where("o_orderkey % 3 <> 0").select(F.concat(F.lit("SRR"), "o_orderkey").alias("Run_Accession"), F.col("o_orderstatus").alias("status"), F.concat(F.lit("x"), "o_orderkey").alias("project"))
    return md.join_runs(runs(spark, d).select(F.col("run").alias("Run"), "project"), sheets).select("Run", "project", "status", "project_sheet")


@query(f"""WITH {CTE_M} SELECT ok, concat_ws('_', project, coalesce(nullif(trim(CASE WHEN ok % 3 = 0 THEN ' ' ELSE biosample END), ''), run)) AS sample, coalesce(nullif(trim(CASE WHEN ok % 2 = 0 THEN ' ' ELSE run END), ''), experiment) AS text,
 substr(regexp_replace(regexp_replace(trim(lat_lon), '[^A-Za-z0-9_.-]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 9) AS name, printf('%.1f%%', ok % 1000 / 1000.0 * 100) AS pct,
 CASE ok % 4 WHEN 0 THEN 'invalid_format' WHEN 1 THEN 'no_run' WHEN 2 THEN 'no_data' ELSE 'download_error' END AS status, 'src' AS source FROM m""")
def small_texts(spark, d):
    """Sample names, first texts, file names, shares, stage statuses and provenance of all runs."""
    k = F.col("ok")
    m = md.tag_provenance(runs(spark, d), "P", "src", "text")
    return m.select("ok", sc.run_sample_name(F.col("project"), F.when(k % 3 == 0, F.lit(" ")).otherwise(F.col("biosample")), F.col("run")).alias("sample"), sc.first_text(F.when(k % 2 == 0, F.lit(" ")).otherwise(F.col("run")), F.col("experiment")).alias("text"), sc.safe_name(F.col("lat_lon"), 9).alias("name"), sc.fmt_pct((k % 1000) / 1000).alias("pct"), sc.stage_status(F.element_at(F.array(*map(F.lit, ["validation", "no_run", "no_data", "other"])), (k % 4 + 1).cast("int"))).alias("status"), F.col("Source_Database").alias("source"))


@query(f"WITH {CTE_M} SELECT project, ok FROM (SELECT project, ok, row_number() OVER (PARTITION BY project ORDER BY ok) AS k FROM m) t WHERE k > 2")
def after_first(spark, d):
    return md.after_first(runs(spark, d).select("project", "ok"), ["project"], [F.col("ok")], 2)


@query(f"WITH {CTE_M} SELECT DISTINCT project AS dataset, upper(platform_text) AS platform FROM m")
def dataset_list(spark, d):
    m = runs(spark, d).withColumns({"project": F.concat(F.lit(" "), "project", F.lit("\n")), "platform": F.upper("platform_text"), "DownloadPath": F.lit("/x")})
    return md.datasets(md.drop_path_columns(m), "project", "platform")


@query("""WITH f AS (SELECT DISTINCT o_custkey % 50 AS dataset_id, o_orderkey AS s, CASE o_orderkey % 4 WHEN 0 THEN 2 WHEN 2 THEN 2 ELSE 1 END AS mates FROM orders), l AS (SELECT dataset_id, count_if(mates = 2) >= count_if(mates = 1) AS pe FROM f GROUP BY 1)
SELECT dataset_id, pe, CAST(sum(CASE WHEN pe AND mates = 2 THEN 2 WHEN NOT pe AND mates = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_kept, CAST(sum(CASE WHEN pe AND mates = 1 THEN 0 ELSE mates END) AS BIGINT) AS n_merged FROM f JOIN l USING (dataset_id) GROUP BY ALL""")
def layout_majority(spark, d):
    """Files that stay when the minority layout is dropped, or merged into single-end datasets."""
    o = table(spark, d, "orders").select((F.col("o_custkey") % 50).alias("dataset_id"), F.col("o_orderkey").alias("sample_id")).distinct()
    f = o.select("dataset_id", "sample_id", F.explode(F.when(F.col("sample_id") % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("mate"))
    n = lambda rows, name: rows.groupBy("dataset_id").agg(F.count("*").alias(name))
    base = ft.layout(f).select("dataset_id", (F.col("layout") == "PE").alias("pe"))
    return base.join(n(ft.keep_layout(f), "n_kept"), "dataset_id", "left").join(n(ft.keep_layout(f, True), "n_merged"), "dataset_id", "left").select("dataset_id", "pe", F.coalesce("n_kept", F.lit(0)).alias("n_kept"), F.coalesce("n_merged", F.lit(0)).alias("n_merged"))


# whole pipelines and regions


@query(f"WITH {CTE_R}, f AS (SELECT DISTINCT seq, tpl FROM r WHERE seq NOT IN (SELECT seq FROM r WHERE tpl % 3 = 0)) SELECT md5(seq) AS feature_id, seq, tpl FROM f")
def merge_and_classify(spark, d):
    """Two datasets merged, features outside a given list left out, the others oriented against all reads and classified by template."""
    r = reads(spark, d)
    known = staged(r.select("tpl", "seq").distinct())
    named = staged(known.groupBy("tpl").agg(F.min("seq").alias("seq")).select(F.col("tpl").cast("string").alias("lineage"), "seq"))
    parts = [r.where("ok % 2 = 0"), r.where("ok % 2 = 1")]
    seqs = [ft.dereplicate(p).select(F.md5("seq").alias("feature_id"), "seq") for p in parts]
    keep = known.where("tpl % 3 <> 0").select(F.md5("seq").alias("feature_id")).distinct()
    counts, taxonomy, _ = pipelines.merge_and_classify([ft.feature_counts(p) for p in parts], seqs, known.select("seq").distinct(), sm.train_classifier(named), keep)
    named = known.select(F.md5("seq").alias("feature_id"), "seq").distinct()
    return counts.select("feature_id").distinct().join(taxonomy, "feature_id").join(named, "feature_id").select("feature_id", "seq", F.col("lineage").try_cast("int").alias("tpl"))


@query(f"WITH {CTE_R}, t AS (SELECT min(seq) AS ref FROM r), f AS (SELECT DISTINCT substr(ref, 1 + CAST(ok % 30 AS INT), CAST(40 + ok % 50 AS INT)) AS seq, CAST(1 + ok % 30 AS INT) AS lo, CAST(least(113, ok % 30 + 40 + ok % 50) AS INT) AS hi FROM r, t) SELECT md5(seq) AS feature_id, lo, hi FROM f")
def region_spans(spark, d):
    """Where pieces of a reference, half of them reversed, lie on it."""
    r = reads(spark, d)
    ref = r.agg(F.min("seq").alias("ref"))
    piece = F.substr(F.col("ref"), (1 + F.col("ok") % 30).cast("int"), (40 + F.col("ok") % 50).cast("int"))
    p = r.select("ok").crossJoin(F.broadcast(ref)).select(piece.alias("s")).distinct()
    f = p.select(F.md5("s").alias("feature_id"), F.when(F.length("s") % 2 == 0, sq.revcomp(F.col("s"))).otherwise(F.col("s")).alias("seq"))
    return sm.detect_region(f, ref.withColumnRenamed("ref", "seq"), band=1)


@query()
def ont_table(spark, d):
    """Counts of the long-read pipeline over all reads."""
    q = full_reads(spark, d, "sample_id", "seq", "qual")
    return pipelines.ont_pipeline(q.select("sample_id", "seq", "qual"), 10, 50, 400).counts


@query(f"""WITH {CTE_Q}
SELECT concat('r', ok, '.', ln) AS header, seq, qual, count(*) AS n, 0 AS misnumbered FROM q GROUP BY 1, 2, 3""")
def fastq_scan(spark, d):
    """Reads written as FASTQ files, a folder for each sample, and read back in ranges of 1 MB; misnumbered: files whose numbers are not 1 to n.

    Most reads differ: only those that may have an equal are shuffled to be counted.
    """
    path, read = stage_folder(spark), ["header", "seq", "qual"]
    q = spark.sql(FULL.replace("FROM r", "FROM {r}"), r=reads(spark, d))
    fq.write_fastq(q.select("sample_id", F.concat(F.lit("r"), "ok", F.lit("."), "ln").alias("header"), "seq", "qual"), path, "sample_id")
    rows = fq.read_fastq(spark, path, 1 << 20).coalesce(table(spark, d, "lineitem").count() // 100_000 + 8)  # some ranges a task
    table_ = rd.repeats(rows, *read)
    marked = rd.may_repeat(rows, table_, *read)
    seen = staged(marked.select("file", "read_no", F.when(F.col("again"), F.struct(*read)).alias("r")))
    # numbers told apart by bits: some 4,000 bytes for each 32,768 of them
    bits = seen.groupBy("file", F.bitmap_bucket_number("read_no").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("read_no")).alias("bits"), F.count("*").alias("n"), F.max("read_no").alias("last"), F.min("read_no").alias("first"))
    numbers = bits.groupBy("file").agg(F.sum("n").alias("n"), F.sum(F.bitmap_count("bits")).alias("k"), F.max("last").alias("last"), F.min("first").alias("first"))
    wrong = numbers.agg(F.count_if((F.col("n") != F.col("k")) | (F.col("n") != F.col("last")) | (F.col("first") != 1)).cast("int").alias("misnumbered"))
    once = marked.where("not again").select(*read, F.lit(1).cast("bigint").alias("n"))
    more = seen.where("r is not null").groupBy(*[F.col(f"r.{c}").alias(c) for c in read]).agg(F.count("*").alias("n"))
    return once.unionByName(more).crossJoin(F.broadcast(wrong))


@query(f"WITH {CTE_R} SELECT concat('t', CAST(tpl AS VARCHAR)) AS feature_id, sample_id, count(*) AS n FROM r GROUP BY 1, 2")
def map_long_reads(spark, d):
    """Long reads on both strands counted at the template that they are at least 90 % like; every read has one."""
    rows, templates = long_fixture(spark, d, "sample_id", "seq")
    out = lr.map_long(rows, templates, 0.9)
    unstage(rows)
    return out


@query(f"""WITH {CTE_Q}, p AS (SELECT sample_id, ok AS read_no, min(seq) AS seq FROM q GROUP BY sample_id, ok)
SELECT sample_id, read_no, CASE WHEN sample_id IN ('S1', 'S4', 'S7') THEN substr(seq, 1, 80) ELSE seq END AS seq, CASE WHEN sample_id IN ('S1', 'S4', 'S7') THEN 'forward' ELSE 'merged' END AS use FROM p""")
def merge_or_forward(spark, d):
    """Read pairs of which three samples do not overlap: those give their forward reads."""
    r = full_reads(spark, d, "sample_id", "ok", "seq", "qual").groupBy("sample_id", F.col("ok").alias("read_no")).agg(F.min(F.struct("seq", "qual")).alias("r"))
    size = F.when(F.col("sample_id").isin("S1", "S4", "S7"), 20).otherwise(80)
    back = lambda c: F.substr(c, F.lit(1), size)
    pairs = r.select("sample_id", "read_no", F.substring("r.seq", 1, 80).alias("seq1"), F.substring("r.qual", 1, 80).alias("qual1"), back(sq.revcomp(F.col("r.seq"))).alias("seq2"), back(F.reverse("r.qual")).alias("qual2"))
    return pipelines.merge_or_forward(pairs).select("sample_id", "read_no", "seq", "use")
