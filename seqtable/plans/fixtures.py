"""Reads and run metadata derived from the driver's tables, by SQL that gives the same rows in Spark and in DuckDB."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sequences import ascii_bytes
from .stages import staged

#: Long reads that a task makes.
MADE = 20_000

#: Reads: 40 templates of skewed abundance behind a degenerate primer, one substitution in every eighth.
READS = """
SELECT concat('S', l_suppkey % 10) AS sample_id, l_orderkey AS ok, l_linenumber AS ln, l_partkey AS pk, tpl,
 concat('CCTACGGG', substr('ACGT', 1 + h % 4, 1), 'GGC', substr('AT', 1 + h % 2, 1), 'GCAG',
   CASE WHEN h % 8 = 0 THEN concat(substr(t,1,20 + h % 40), translate(substr(t,21 + h % 40,1),'ACGT','CGTA'), substr(t,22 + h % 40)) ELSE t END) AS seq
FROM (SELECT *, translate(concat(md5(concat('t',tpl)), md5(concat('u',tpl)), md5(concat('v',tpl))),'0123456789abcdef','ACGTACGTACGTACGT') AS t
 FROM (SELECT *, CAST(floor(h*h*h/25000000) AS INT) AS tpl FROM
  (SELECT l_orderkey,l_linenumber,l_suppkey,l_partkey, CAST((l_orderkey*7919 + l_partkey*31 + l_linenumber*104729) % 1000 AS INT) AS h FROM lineitem) a) b) c
"""
#: What a read's sequence and template follow from: one of 1,999 remainders.
REMAINDER = "CAST((l_orderkey*7919 + l_partkey*31 + l_linenumber*104729) % 1000 AS INT)"
#: The same with qualities, degraded qualities, a tail of N and mixed strands.
FULL = """
SELECT sample_id, ok, ln, tpl, seq,
 substr(repeat(translate(md5(concat('q', ok, ln)), '0123456789abcdef', '?@ABCDEFGHIIIIII'), 4), 1, length(seq)) AS qual,
 substr(repeat(translate(md5(concat('q', ok, ln)), '0123456789abcdef', '##########IIIIII'), 4), 1, length(seq)) AS bad_qual,
 concat(substr(seq, 1, length(seq) - CAST(ok % 7 AS INT)), repeat('N', CAST(ok % 7 AS INT))) AS seq_tail_n,
 CASE WHEN ok % 4 = 0 THEN reverse(translate(seq, 'ACGT', 'TGCA')) ELSE seq END AS seq_mixed
FROM r
"""
#: Templates of 47 pieces of 32 letters.
LONG_TEMPLATES = "SELECT tpl, translate(concat(" + ", ".join(f"md5(concat('L', tpl, '_', {i}))" for i in range(47)) + "), '0123456789abcdef', 'ACGTACGTACGTACGT') AS t FROM (SELECT DISTINCT tpl FROM r) x"


def _pieces() -> str:
    """A template with two letters of each piece drawn anew, of which the second may be missing."""
    drawn = lambda s, of: f"substr('ACGT', CAST(1 + CAST({s} AS BIGINT) % {of} AS INT), 1)"
    one = lambda i: [f"substr(t, {32 * i + 1}, 15)", drawn(f"floor(ok / {i + 1}) + ln * {i + 3} + pk * {i % 5}", 4), f"substr(t, {32 * i + 17}, 15)", drawn(f"floor(pk / {i + 2}) + ok * {i % 7 + 1} + ln", 6)]
    return f"concat({', '.join(x for i in range(47) for x in one(i))})"


#: Reads of some 1,490 letters, about 5 % of the letters wrong or missing, every fourth on the other strand.
LONG = f"""
SELECT sample_id, ok, ln, tpl, CASE WHEN ok % 4 = 0 THEN reverse(translate(seq, 'ACGT', 'TGCA')) ELSE seq END AS seq
FROM (SELECT sample_id, ok, ln, r.tpl, {_pieces()} AS seq FROM r JOIN templates ON r.tpl = templates.tpl) x
"""
RUNS = """
SELECT concat('PRJNA', 1000 + c_nationkey) AS project, concat('SAMN', c_custkey) AS biosample, concat('SRX', o_orderkey) AS experiment,
 CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE concat('SRR', o_orderkey) END AS run, o_orderkey AS ok,
 concat(CAST(o_orderkey % 90 AS varchar(9)), '.', CAST(o_orderkey % 7 AS varchar(9)), CASE WHEN o_orderkey % 2 = 0 THEN ' N ' ELSE ' S ' END,
        CAST(o_orderkey % 180 AS varchar(9)), CASE WHEN o_orderkey % 3 = 0 THEN ' E' ELSE ' W' END) AS lat_lon,
 CASE WHEN o_orderkey % 5 = 0 THEN concat(CAST(o_orderkey * 524288 AS varchar(20)), '|', CAST(o_orderkey * 1024 AS varchar(20)))
      ELSE CAST(o_orderkey * 524288 AS varchar(20)) END AS file_size,
 CASE o_orderkey % 4 WHEN 0 THEN 'Illumina MiSeq' WHEN 1 THEN 'PacBio Sequel II' WHEN 2 THEN 'MinION' ELSE 'Ion Torrent S5 XL' END AS platform_text
FROM orders JOIN customer ON o_custkey = c_custkey
"""


#: The letters of substr('ACGT', 1 + x, 1) for x from -5 to 5, a blank where there is none; and their complements.
_DRAWN = np.frombuffer(b"ACGTAACGT  ", np.uint8)
_COMPLEMENT = np.arange(256, dtype=np.uint8)
_COMPLEMENT[list(b"ACGT")] = list(b"TGCA")


@F.arrow_udf(T.StringType())
def _long_read(t: pa.Array, ok: pa.Array, ln: pa.Array, pk: pa.Array) -> pa.Array:
    """The seq of LONG: two letters of each piece of a template drawn anew, then the strand."""
    read = ascii_bytes(t)[0].reshape(len(t), -1).copy()
    ok, ln, pk = (c.cast(pa.int64()).to_numpy(zero_copy_only=False) for c in (ok, ln, pk))
    for i in range(read.shape[1] // 32):
        first = np.floor(ok / (i + 1)).astype(np.int64) + ln * (i + 3) + pk * (i % 5)
        second = np.floor(pk / (i + 2)).astype(np.int64) + ok * (i % 7 + 1) + ln
        read[:, 32 * i + 15] = _DRAWN[np.fmod(first, 4) + 5]
        read[:, 32 * i + 31] = _DRAWN[np.fmod(second, 6) + 5]
    back = ok % 4 == 0
    read[back] = _COMPLEMENT[read[back, ::-1]]
    there = read != ord(" ")
    ends = np.concatenate([[0], np.cumsum(there.sum(1))]).astype(np.int32)
    return pa.StringArray.from_buffers(len(t), pa.py_buffer(ends), pa.py_buffer(read[there]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reads(spark: SparkSession, sf_dir: str, distinct: bool = False) -> DataFrame:
    """The rows of READS. Sequences are made once for each remainder, by the same SQL over rows that have each of them, and
    met by a broadcast of that fixed size. ``distinct``: equal rows once, told apart before they get their sequence."""
    keys = spark.range(-999, 1000, 1, 1).selectExpr("id AS l_orderkey", "0 AS l_linenumber", "0 AS l_suppkey", "0 AS l_partkey")
    made = spark.sql(READS.replace("FROM lineitem", "FROM {keys}"), keys=keys).selectExpr("CAST(ok * 7919 % 1000 AS INT) AS _h", "tpl", "seq")
    rows = table(spark, sf_dir, "lineitem").selectExpr("concat('S', l_suppkey % 10) AS sample_id", "l_orderkey AS ok", "l_linenumber AS ln", "l_partkey AS pk", f"{REMAINDER} AS _h")
    return (rows.distinct() if distinct else rows).join(F.broadcast(made), "_h", "left").select("sample_id", "ok", "ln", "pk", "tpl", "seq")


def full_reads(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The rows of FULL, or these columns of them. Written once: a filter on a derived column would otherwise derive it again
    for each of its uses."""
    rows = spark.sql(FULL.replace("FROM r", "FROM {r}"), r=reads(spark, sf_dir))
    return staged(rows.select(*columns) if columns else rows)


def long_reads(spark: SparkSession, sf_dir: str, *columns: str) -> tuple[DataFrame, DataFrame]:
    """The rows of LONG, or these columns of them, written once, and the (feature_id, seq, size) rows of their templates.

    Letters are drawn in numpy, batch by batch, after the short rows that they follow from are dealt out.
    """
    r = reads(spark, sf_dir).select("sample_id", "ok", "ln", "pk", "tpl")
    templates = staged(spark.sql(LONG_TEMPLATES.replace("FROM r)", "FROM {r})"), r=r))
    dealt = r.repartition(max(1, table(spark, sf_dir, "lineitem").count() // MADE))
    rows = dealt.join(F.broadcast(templates), "tpl").select("sample_id", "ok", "ln", "tpl", _long_read("t", "ok", "ln", "pk").alias("seq"))
    return staged(rows.select(*columns) if columns else rows), templates.select(F.concat(F.lit("t"), "tpl").alias("feature_id"), F.col("t").alias("seq"), F.lit(1).alias("size"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RUNS.replace("FROM orders JOIN customer", "FROM {orders} JOIN {customer}"), orders=table(spark, sf_dir, "orders"), customer=table(spark, sf_dir, "customer"))


#: The same as common table expressions of an oracle.
CTE_R = f"r AS ({READS})"
CTE_Q = f"{CTE_R}, q AS ({FULL})"
CTE_M = f"m AS ({RUNS})"
