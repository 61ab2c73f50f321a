import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from seqtable import queries as q
from seqtable.operators import longreads
from seqtable.operators import reads as rd
from seqtable.operators import similarity as sm
from seqtable.plans import fixtures, stages


def scans(df, name):
    return df._jdf.queryExecution().optimizedPlan().toString().count(name)


def written(monkeypatch):
    """The schemas and plans of the stage tables that are written from here on."""
    made, write = [], stages.staged

    def staged(df):
        made.append((df.columns, df._jdf.queryExecution().optimizedPlan().toString()))
        return write(df)

    for module in (stages, fixtures, q, sm, rd):
        monkeypatch.setattr(module, "staged", staged)
    return made


def test_reads_are_those_of_the_sql(spark, data):
    want = spark.sql(fixtures.READS.replace("FROM lineitem", "FROM {lineitem}"), lineitem=fixtures.table(spark, data, "lineitem"))
    got = fixtures.reads(spark, data)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    assert Counter(map(tuple, fixtures.reads(spark, data, distinct=True).collect())) == Counter(map(tuple, want.distinct().collect()))


def test_features_are_derived_once_for_their_clusters(spark, data, monkeypatch):
    made = written(monkeypatch)
    out = q.cluster_97(spark, data)
    assert sum(plan.count("l_orderkey") > 0 for _, plan in made) == 1 and scans(out, "l_orderkey") == 0


def test_counts_and_ids_are_derived_once_for_both_filters(spark, data):
    assert scans(q.filter_features(spark, data), "l_orderkey") == 0


def test_counts_and_ids_come_from_one_pass_over_the_reads(spark, data, monkeypatch):
    made = written(monkeypatch)
    out = q.filter_features(spark, data)
    assert sum(plan.count("l_orderkey") > 0 for _, plan in made) == 1 and scans(out, "l_orderkey") == 0
    r = fixtures.reads(spark, data)
    want = Counter((x.feature_id, x.sample_id, x.kept) for x in r.select(F.md5("seq").alias("feature_id"), "sample_id", F.expr("tpl % 3 = 0 AS kept")).collect())
    assert Counter({(x.feature_id, x.sample_id, x.kept): x.n for x in out.collect()}) == want


def test_references_are_checked_from_one_pass_over_the_reads(spark, data, monkeypatch):
    made = written(monkeypatch)
    out = q.referential_check(spark, data)
    assert sum(plan.count("l_orderkey") > 0 for _, plan in made) == 1 and scans(out, "l_orderkey") == 0
    r = fixtures.reads(spark, data)
    lost = r.where("tpl % 3 <> 0").select("seq").distinct().count()
    assert {tuple(x) for x in out.collect()} == {("feature_without_sequence", "error", lost), ("sample_not_in_manifest", "warning", 2)}


def test_reads_are_mapped_in_one_pass(spark, data, monkeypatch):
    made = written(monkeypatch)
    reads = fixtures.reads(spark, data)
    out = sm.map_back(reads, spark.createDataFrame([("a", "ACGT", 1)], "feature_id string, seq string, size long"))
    assert sum(plan.count("l_orderkey") > 0 for _, plan in made) == 1 and scans(out, "l_orderkey") == 0


def test_a_filter_writes_the_columns_that_it_reads(spark, data, monkeypatch):
    made = written(monkeypatch)
    q.length_fraction_filter(spark, data)
    q.amplicon(spark, data)
    assert [c for c, _ in made] == [["seq", "bad_qual"], ["ok", "ln", "seq"]]


def test_low_runs_are_those_of_a_plain_loop(spark):
    quals = ["IIII", "####IIII", "II####II", "###I###I####", "###", "", None, "I$$$$", "I%%%%", "II!\"#$I"]
    rows = [("ACGTACGTACGT"[: len(s or "AC")], s) for s in quals]

    def cut(s, n, min_q, window):
        return next((i for i in range(len(s) - window) if all(ord(c) - 33 < min_q for c in s[i : i + window + 1])), n)

    for min_q, window in ((4, 3), (4, 0), (3, 1), (0, 1)):
        got = rd.filter_length_fraction(spark.createDataFrame(rows, "seq string, qual string"), 0.0, min_q, window)
        want = [(t[:k], s[:k]) for t, s in rows if s is not None for k in [cut(s, len(t), min_q, window)]]
        assert sorted(map(tuple, got.collect())) == sorted(want)


def test_an_amplicon_is_looked_for_once(spark):
    rows = [(1, "AAACCGGTTTTT"), (2, "AAAAACCGGTTT"), (3, "GGGG"), (4, None)]
    out = rd.extract_amplicon(spark.createDataFrame(rows, "id int, seq string"), "AAA", "AAA", 2, 9)
    assert {tuple(x) for x in out.collect()} == {(1, "CCGG"), (2, "AACCGG")}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") <= 2, plan


def test_numbered_parts_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(rd, "NUMBERED", 10)
    rows = [("s", f"f{n:04d}", "A") for n in range(300)]
    made = written(monkeypatch)
    got = rd.label_reads(spark.createDataFrame(rows, "sample_id string, file string, read_no string").withColumn("seq", F.col("read_no")), "file")
    assert {tuple(x) for x in got.collect()} == {(f">s_{n + 1};sample=s;\nA", f"f{n:04d}") for n in range(300)}
    assert "RepartitionByExpression" in made[1][1] and ", 30" in made[1][1]


def test_pairs_are_joined_by_batches_as_one_by_one():
    r = random.Random(3)
    rows, overlap = [], []
    for _ in range(300):
        m, n = r.randint(0, 30), r.randint(0, 30)
        text = lambda k, of: "".join(r.choices(of, k=k))
        rows.append((text(m, "ACGTN"), text(m, "!#5I"), text(n, "ACGTN"), text(n, "!#5I")))
        overlap.append(r.randint(0, min(m, n)))
    for some, o in ((rows, overlap), (rows[:1], overlap[:1]), ([], []), ([("A\u00e9G", "III", "GT", "II")], [1])):
        columns = [pa.array([x[k] for x in some], pa.string()) for k in range(4)]
        seq, qual = sm._joined_all(columns, np.array(o, np.int64))
        assert list(zip(seq.to_pylist(), qual.to_pylist(), strict=True)) == [sm._joined(*x, k) for x, k in zip(some, o, strict=True)]


def test_plain_pairs_are_not_joined_one_by_one(monkeypatch):
    monkeypatch.setattr(sm, "_joined", None)
    columns = [pa.array([x, x]) for x in ("ACGT", "IIII", "GTAA", "##II")]
    seq, qual = sm._joined_all(columns, np.array([2, 0]))
    assert seq.to_pylist() == ["ACGTAA", "ACGTGTAA"] and qual.to_pylist() == ["IIIIII", "IIII##II"]


def test_reads_are_written_as_fastq_by_all_tasks(spark, data, monkeypatch):
    fixed = []
    kind = type(spark.range(1))
    monkeypatch.setattr(kind, "repartition", lambda df, *a: fixed.append(a) or df)
    assert q.fastq_scan(spark, data).agg(F.sum("misnumbered")).first()[0] == 0 and not fixed


def test_distances_of_a_block_are_those_one_by_one():
    r = random.Random(6)
    pairs = [("", ""), ("A", ""), ("AC\u00e9GTACGTACGT", "ACGTACGTACGT"), ("ACGT\x01ACGTACGT", "ACGTACGTACGT"), ("A" * 40, "A" * 40), ("A" * 40, "A" * 31 + "C" * 9)]
    for _ in range(400):
        a = r.choices("ACGT" if r.random() < 0.7 else "AC", k=r.choice([20, 90, 300]))
        b = list(a)
        for _ in range(r.randint(0, 40)):
            i = r.randrange(len(b) + 1)
            b[i : i + r.randint(0, 2)] = r.choices("ACGTN", k=r.randint(0, 2))
        pairs.append(("".join(a), "".join(b)))
    for most in (0, 3, 12, 19, 60, 200):
        got = longreads.distances([a for a, _ in pairs], [b for _, b in pairs], [most] * len(pairs))
        assert got == [longreads.distance(a, b, most) for a, b in pairs], most
    mixed = [r.randint(0, 60) for _ in pairs]
    assert longreads.distances(*map(list, zip(*pairs)), mixed) == [longreads.distance(a, b, m) for (a, b), m in zip(pairs, mixed)]
    assert longreads.distances([], [], []) == []


def test_long_reads_are_not_compared_one_by_one(monkeypatch):
    monkeypatch.setattr(longreads, "distance", None)
    a = "".join(random.Random(7).choices("ACGT", k=1500))
    assert longreads.distances([a, a, a], [a, a[:700] + a[710:], a[::-1]], [150] * 3) == [0, 10, None]
