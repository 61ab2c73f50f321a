import gzip
import random
import re

import pytest
from pyspark.sql import functions as F

from seqtable.operators import features as ft
from seqtable.operators import metadata as md
from seqtable.operators import profiles as pf
from seqtable.operators import reads as rd
from seqtable.operators import similarity as sm
from seqtable.sources import fastq, files


def boundary_by_runs(states, lo=10, hi=30):
    """The rule on maximal runs: short V runs between three or more others count as others; the first V left ends the prefix."""
    marked = re.sub("(?<=[CD]{3})V{1,2}(?=[CD]{3})", lambda m: "v" * len(m[0]), states)
    first = marked.find("V")
    over = max([m.end() for m in re.finditer("v+", marked) if m.start() < hi], default=0)
    end = first if 0 <= first < hi else min(max(hi, over), len(states))
    return end if end >= lo else 0


def test_primer_boundary(spark):
    r = random.Random(3)
    for _ in range(6):
        states = "".join(r.choices("CDV", [8, 2, 1], k=60))
        df = spark.createDataFrame(list(enumerate(states)), "pos int, state string")
        assert pf.primer_boundary(df).first()[0] == boundary_by_runs(states), states


def test_primer_match_prefers_first_and_skips_n(spark):
    row = spark.createDataFrame([("NNTACGGGAGGCAGCAGTTTTTTTTTTTTT",)], "consensus string")
    hit = pf.match_primers(row, [("a", "TACGGRNGGCWGCAG"), ("b", "TACGGRNGGCWGCAG")]).first()
    assert (hit["name"], hit["trim"], hit["identity"]) == ("a", 17, 1.0)
    assert pf.match_primers(spark.createDataFrame([("N" * 30,)], "consensus string"), pf.FORWARD).count() == 0


def test_greedy_clusters_equal_sequential(spark):
    r = random.Random(5)
    base = ["".join(r.choices("ACGT", k=40)) for _ in range(4)]
    seqs = {}
    for b in base:
        for _ in range(12):
            s = list(b)
            for _ in range(r.randint(0, 4)):
                s[r.randrange(40)] = r.choice("ACGT")
            seqs["".join(s)] = r.randint(1, 50)
    rows = [(f"f{i}", s, n) for i, (s, n) in enumerate(sorted(seqs.items()))]

    def dist(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    centroids = []
    for f, s, n in sorted(rows, key=lambda x: (-x[2], x[1])):
        if not any(dist(s, c) <= 2 for c in centroids):
            centroids.append(s)
    got = sm.greedy_cluster(spark.createDataFrame(rows, "feature_id string, seq string, size long"), 0.95)
    names = {f: s for f, s, _ in rows}
    assert {names[x["centroid_id"]] for x in got.collect()} == set(centroids)
    assert got.count() == len(rows)


def test_similarity_join_finds_all_lengths(spark):
    r = random.Random(8)
    rows = []
    for i in range(30):
        s = "".join(r.choices("ACGT", k=r.randint(28, 32))) if i % 3 == 0 else rows[-1][1][: r.randint(26, 40)] + r.choice("ACGT")
        rows.append((f"f{i}", s))
    df = spark.createDataFrame(rows, "feature_id string, seq string")
    got = {(x["query"], x["ref"]) for x in sm.similarity_join(df, df, 0.85).collect()}
    lev = df.alias("a").crossJoin(df.alias("b")).where(F.levenshtein("a.seq", "b.seq") <= F.floor(F.greatest(F.length("a.seq"), F.length("b.seq")) * 0.15 + 1e-9)).select(F.col("a.feature_id"), F.col("b.feature_id"))
    assert got == {tuple(x) for x in lev.collect()}


def test_similarity_join_has_no_cartesian_product(spark):
    df = spark.createDataFrame([("a", "ACGT" * 10)], "feature_id string, seq string")
    assert "CartesianProduct" not in sm.similarity_join(df, df, 0.97)._jdf.queryExecution().toString()


def test_chimera(spark):
    r = random.Random(2)
    a, b = ("".join(r.choices("ACGT", k=60)) for _ in range(2))
    df = spark.createDataFrame([("a", a, 100), ("b", b, 90), ("x", a[:30] + b[30:], 2)], "feature_id string, seq string, size long")
    assert {x["feature_id"] for x in sm.remove_chimeras(df).collect()} == {"a", "b"}


def test_denoise_by_sample_equals_brute_force(spark):
    r = random.Random(14)
    rows = {}
    for sample in ("s1", "s2", None):
        for _ in range(3):
            base = "".join(r.choices("ACGT", k=40))
            rows[sample, base] = r.choice([64, 300, 900])
            for _ in range(15):
                t = list(base)
                for _ in range(r.randint(1, 3)):
                    t[r.randrange(40)] = r.choice("ACGT")
                rows.setdefault((sample, "".join(t)), r.choice([1, 2, 5, 20, 60]))
        rows.setdefault((sample, "ACGT" * 10), 7)
    f = [(k[0], s_, k[1], n) for (k, n) in rows.items() for s_ in ["f" + k[1]]]
    got = sm.denoise_by_skew(spark.createDataFrame(f, "sample_id string, feature_id string, seq string, size long"), 1, by=("sample_id",))

    def dist(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    want = {}
    for sample in ("s1", "s2", None):
        centroids = []
        for _, i, s, n in sorted((x for x in f if x[0] == sample), key=lambda x: (-x[3], x[2])):
            near = [(d, -cn, c, ci) for c, ci, cn in centroids if (d := dist(s, c)) <= 4 and n <= cn * 2.0 ** -(2 * d + 1)]
            want[sample, i] = min(near)[3] if near else i
            if not near:
                centroids.append((s, i, n))
    assert {(x["sample_id"], x["feature_id"]): x["centroid_id"] for x in got.collect()} == want and len(set(want.values())) < len(want)


def test_chimeras_equal_brute_force(spark):
    r = random.Random(12)
    primer = "ACGTACGTAC"
    parents = [primer + "".join(r.choices("ACGT", k=30)) for _ in range(6)]
    rows = {p: r.choice([40, 60, 400]) for p in parents}
    for _ in range(60):
        a, b, k = r.choice(parents), r.choice(parents), r.randint(5, 39)
        s = list(a[:k] + b[k:])
        for _ in range(r.choice([0, 0, 1])):
            s[r.randrange(40)] = r.choice("ACGT")
        rows.setdefault("".join(s), r.randint(1, 5))
    rows[parents[0][:25]] = 1  # a cut copy stays
    f = [(f"f{i}", s, n) for i, (s, n) in enumerate(rows.items())]

    def shared(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    gone = set()
    for i, s, n in f:
        pre = [(j, shared(s, t)) for j, t, m in f if m >= 16 * n and j != i]
        suf = [(j, shared(s[::-1], t[::-1])) for j, t, m in f if m >= 16 * n and j != i]
        if not any(k == len(s) for _, k in pre + suf) and any(a != b and x + y >= len(s) for a, x in pre for b, y in suf):
            gone.add(i)
    got = {x["feature_id"] for x in sm.remove_chimeras(spark.createDataFrame(f, "feature_id string, seq string, size long")).collect()}
    assert got == {i for i, _, _ in f} - gone and 10 < len(gone) < 60


def test_similarity_join_of_reads_with_one_primer(spark):
    r = random.Random(9)
    primer = "CCTACGGGAGGCAGCAG"
    seqs = {primer + "".join(r.choices("ACGT", k=96)) for _ in range(2000)}
    near = {s[:60] + "A" + s[61:] for s in list(seqs)[:50]}
    df = spark.createDataFrame([(s, s) for s in seqs | near], "feature_id string, seq string")
    joined = sm.similarity_join(df, df, 0.97)
    got = {(x["query"], x["ref"]) for x in joined.collect()}
    assert {(s, s[:60] + "A" + s[61:]) for s in list(seqs)[:50] if s[60] != "A"} <= got and len(got) < 2400
    # candidates, before their distance is taken: not all pairs of reads, though all begin with the primer
    assert sm.candidate_pairs(df, df, 0.97).count() < 20_000


def test_merge_pairs(spark):
    r = random.Random(4)
    whole = "".join(r.choices("ACGT", k=120))
    rc = whole[::-1].translate(str.maketrans("ACGT", "TGCA"))
    df = spark.createDataFrame([("s", 1, whole[:80], "I" * 80, rc[:80], "5" * 80), ("s", 2, "A" * 80, "I" * 80, "C" * 40 + "A" * 40, "I" * 80)], "sample_id string, read_no long, seq1 string, qual1 string, seq2 string, qual2 string")
    got = {x["read_no"]: x for x in sm.merge_pairs(df).collect()}
    assert got[1]["seq"] == whole and len(got[1]["qual"]) == 120 and 2 not in got


def test_map_back_conserves_counts(spark):
    rows = [("s1", "ACGT" * 10)] * 3 + [("s2", "ACGT" * 10)] + [("s1", "TTTT" * 10)]
    reads = spark.createDataFrame(rows, "sample_id string, seq string")
    otus = spark.createDataFrame([("o", "ACGT" * 10, 4)], "feature_id string, seq string, size long")
    assert {(x["sample_id"], x["n"]) for x in sm.map_back(reads, otus).collect()} == {("s1", 3), ("s2", 1)}


def test_columns(spark):
    df = spark.createDataFrame([("SRR1", "PRJNA1", "a", "A", " ", "a"), ("SRR2", "PRJNA1", "b", None, None, "b")], "Run_id string, p_x string, Geo_Loc string, `geo loc` string, blank string, again string")
    out = md.standardize_columns(df)
    assert out.columns[:2] == ["Run", "Bioproject"] and "GeoLoc" in out.columns
    assert md.empty_columns(df) == ["blank"]
    assert md.duplicate_columns(df, "Run_id") == ["again"]
    assert md.column_order(["z", "libraryLayout", "Run", "libraryName", "a"], ["Run"]) == ["Run", "libraryLayout", "libraryName", "a", "z"]


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    new = spark.createDataFrame([("2", "c"), ("3", None)], "id string, v string")
    once = md.upsert(old, new, ["id"])
    assert sorted(map(tuple, once.collect())) == [("1", "a"), ("2", "c"), ("3", "")]
    assert sorted(once.collect()) == sorted(md.upsert(once, new, ["id"]).collect())


def test_publications_take_the_first_tier(spark):
    tiers = spark.createDataFrame([("p", 2, 1, "9"), ("p", 1, 1, "5"), ("p", 1, 2, "6"), ("p", 1, 3, "7")], "project string, tier int, pos int, pmid string")
    art = spark.createDataFrame([("5", "t5", "a5", "d"), ("6", "t6", "a6", "d"), ("7", "t7", "a7", "e")], "pmid string, title string, abstract string, doi string")
    x = md.associate_publications(tiers, art).first()
    assert (x["pmids"], x["titles"], x["dois"]) == ("5;6;7", "t5 || t6", "d;e")


def test_reads(spark):
    df = spark.createDataFrame([("s", 1, 1, "ACGTACGTAC", "IIII###III"), ("s", 1, 2, "ACG", "III")], "sample_id string, read_no long, mate int, seq string, qual string")
    assert rd.min_length(df, 5).count() == 1 and rd.min_length(df, 5, paired=True).count() == 0
    assert rd.trim_tail(df, 4).where("mate = 1").first()["seq"] == "ACGTAC"
    assert rd.filter_length_fraction(df, 0.3, 4, 2).where("mate = 1").first()["seq"] == "ACGT"
    assert rd.pair_mates(df).first()["seq2"] == "ACG"
    assert rd.trim_primer(df.where("mate = 1"), "RCGT").first()["seq"] == "ACGTAC"
    swapped = rd.repair_orientation(rd.pair_mates(df), 0, "C", 0, 0).first()
    assert swapped["swapped"] and swapped["seq1"] == "ACG"


def test_abundance_and_regions(spark):
    df = spark.createDataFrame([("s", str(i)) for i in range(20)], "sample_id string, seq string")
    assert ft.abundance_check(df).first()["untrustworthy"]
    spans = spark.createDataFrame([("d", 500, 700), ("d", 510, 690), ("d", 70, 1500)], "dataset_id string, lo int, hi int")
    x = ft.region_consensus(spans).first()
    assert (x["region"], x["confidence"], x["n"]) == ("V4", 0.67, 3)


def test_tables_and_orphans(spark):
    f = spark.createDataFrame([("d", "a", 1), ("d", "b", 1), ("d", "b", 2), ("d", "b", None)], "dataset_id string, sample_id string, mate int")
    assert sorted((x["sample_id"], x["mate"]) for x in ft.drop_orphans(f).collect()) == [("b", 1), ("b", 2)]


def test_fastq_source(spark, tmp_path):
    record = "@r{0} x\nACGT\n+\n@III\n"
    (tmp_path / "a_1.fastq").write_text("".join(record.format(i) for i in range(5)))
    with gzip.open(tmp_path / "b.fq.gz", "wt") as f:
        f.write("".join(record.format(i) for i in range(3)))
    fastq.register(spark)
    df = spark.read.format("fastq").load(str(tmp_path))
    assert df.count() == 8 and df.where("read_no = 5").first()["header"] == "r4 x"
    assert spark.read.format("fastq").option("maxReadsPerFile", 2).load(str(tmp_path)).count() == 4
    (tmp_path / "a_1.fastq").write_text("@r\nACGT\n+\n")
    with pytest.raises(Exception, match="ends within a record"):
        spark.read.format("fastq").load(str(tmp_path)).count()
    assert {(x["sample_id"], x["mate"]) for x in files.discover_samples(spark, str(tmp_path)).collect()} == {("a", 1), ("b", None)}


def test_text_sources(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("# head\nPRJNA1\n\n PRJNA2 \nPRJNA1\n")
    assert {x["id"] for x in files.read_id_lists(spark, str(tmp_path)).collect()} == {"PRJNA1", "PRJNA2"}
    (tmp_path / "x.fasta").write_text(">a;size=3;sample=s;\nAC\nGT\n>b\nTT\n")
    assert {tuple(x) for x in files.read_fasta(spark, str(tmp_path / "x.fasta")).collect()} == {("a", 3, "s", "ACGT"), ("b", 1, None, "TT")}
    (tmp_path / "t.tsv").write_text("#OTU ID\ts1\ts2\nf1;size=2\t1.0\t0\n")
    assert [tuple(x) for x in files.read_count_table(spark, str(tmp_path / "t.tsv")).collect()] == [("f1", "s1", 1)]
    text = "1: MIGS\nIdentifiers: BioSample: SAMN1; Sample name: x\nOrganism: soil\nAttributes:\n    /depth=\"3\"\n    /lat=\"1\"\nAccession: SAMN1\tID: 77\n\n2: Other\nAccession: SAMN2 ID: 78\n"
    rows = files.parse_sample_text(spark.createDataFrame([(text,)], "t string"), "t").collect()
    assert rows[0]["attrs"] == {"depth": "3", "lat": "1"} and rows[0]["uid"] == "77" and rows[1]["biosample"] == "SAMN2"


def test_xml(spark):
    x = '<A><EXPERIMENT_PACKAGE><EXPERIMENT accession="SRX1"><PLATFORM><ILLUMINA/></PLATFORM><DESIGN><DESIGN_DESCRIPTION>d</DESIGN_DESCRIPTION></DESIGN></EXPERIMENT><RUN accession="SRR1"/><RUN accession="SRR2"/></EXPERIMENT_PACKAGE></A>'
    got = files.parse_experiment_xml(spark.createDataFrame([(x,)], "x string"), "x").collect()
    assert [tuple(r) for r in got] == [("SRX1", "SRR1", "ILLUMINA", "d"), ("SRX1", "SRR2", "ILLUMINA", "d")]
    a = '<PubmedArticle><PMID>5</PMID><Article><ArticleTitle>T</ArticleTitle><Abstract><AbstractText Label="AIM">x</AbstractText><AbstractText>y</AbstractText></Abstract></Article><PubmedData><ArticleIdList><ArticleId IdType="doi">10.1</ArticleId></ArticleIdList></PubmedData></PubmedArticle>'
    assert tuple(files.parse_article_xml(spark.createDataFrame([(a,)], "x string"), "x").first()) == ("5", "T", "AIM: x y", "10.1")


def test_streams(spark, tmp_path):
    from seqtable.streaming.tables import latest, stream_tally, stream_upsert

    src, out = tmp_path / "in", str(tmp_path / "out")
    batches = [[("1", "a"), ("2", "b")], [("2", "c"), ("3", "d")], [("4", None)]]
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, "id string, v string").coalesce(1).write.mode("append").parquet(str(src))
        q = stream_upsert(spark.readStream.schema("id string, v string").parquet(str(src)), out, ["id"], str(tmp_path / "cp"))
        q.awaitTermination()
    assert sorted(tuple(r) for r in latest(spark, out, 2).collect()) == [("1", "a"), ("2", "c"), ("3", "d"), ("4", "")]
    assert sorted(tuple(r) for r in latest(spark, out, 0).collect()) == [("1", "a"), ("2", "b")]
    assert latest(spark, str(tmp_path / "none"), 0) is None
    assert spark.read.parquet(f"{out}/seqtable_version=2").count() <= 2  # only the part of the new key is written again
    tally = stream_tally(spark.readStream.schema("id string, v string").parquet(str(src)).selectExpr("'r' as run_id", "v as status"))
    s = tally.writeStream.outputMode("complete").format("memory").queryName("tally").trigger(availableNow=True).start()
    s.awaitTermination()
    assert spark.table("tally").count() == 5


def test_count_table_with_comments_and_integrity_of_empty_files(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("# Constructed from a table\n#OTU ID\ts1\ts2\nf1;size=3\t2.0\t0\n\nf2\t\t7\n")
    (tmp_path / "u.tsv").write_text("# a comment\nid\ts1\nf1\t4\n")
    (tmp_path / "v.tsv").write_text("")
    got = [sorted(tuple(r) for r in files.read_count_table(spark, str(tmp_path / f"{n}.tsv")).collect()) for n in "tuv"]
    assert got == [[("f1", "s1", 2), ("f2", "s2", 7)], [("f1", "s1", 4)], []]
    lines = spark.createDataFrame([("a", x) for x in "1234"] + [("b", "1")], "file string, value string")
    listed = spark.createDataFrame([("a",), ("b",), ("c",)], "file string")
    assert {r["file"]: (r["n_lines"], r["valid"]) for r in files.fastq_integrity(lines, listed).collect()} == {"a": (4, True), "b": (1, False), "c": (0, False)}


def test_upsert_without_order_is_defined(spark):
    old = spark.createDataFrame([("k", "x")], "id string, v string")
    new = spark.createDataFrame([("k", "b"), ("k", "c"), ("k", None)], "id string, v string")
    assert [tuple(r) for r in md.upsert(old, new.repartition(3), ["id"]).collect()] == [("k", "c")]


def test_run_tables_manifests_and_sinks(spark, tmp_path):
    (tmp_path / "runs.csv").write_text("P,R,Plat\n PRJNA1 ,SRR1,ILLUMINA\nNA,SRR2,x\nPRJNA2,N/A,\n")
    got = files.read_runs(spark, str(tmp_path / "runs.csv"), "P", "R", "Plat").collect()
    assert [(r["project"], r["run"], r["platform"]) for r in got] == [("PRJNA1", "SRR1", "ILLUMINA"), ("PRJNA2", None, None)]
    (tmp_path / "found.tsv").write_text("Accession\tTitle\nPRJNA1\tsoil\n")
    assert [tuple(r) for r in files.read_search_results(spark, str(tmp_path / "found.tsv"), "\t", {"Accession": "accession", "Title": "title", "None": "none"}).collect()] == [("PRJNA1", "soil")]
    f = spark.createDataFrame([("s1", 1, "a_1.fastq"), ("s1", 2, "a_2.fastq"), ("s2", 1, "b_1.fastq"), ("s3", None, "c.fastq")], "sample_id string, mate int, path string")
    assert [tuple(r) for r in files.manifest_paired(f).collect()] == [("s1", "a_1.fastq", "a_2.fastq")]
    assert sorted(tuple(r) for r in files.manifest_single(f).collect()) == [("s1", "a_1.fastq"), ("s2", "b_1.fastq"), ("s3", "c.fastq")]
    big, small = f, f.limit(1)
    assert files.largest_sheet({"x": small, "y": big}) is big
    files.write_report(f, str(tmp_path / "report"))
    assert spark.read.csv(str(tmp_path / "report"), header=True).count() == 4
    files.write_per_dataset(f, str(tmp_path / "parts"), "sample_id")
    assert spark.read.parquet(str(tmp_path / "parts")).where("sample_id = 's1'").count() == 2


def test_reports_and_empty_samples(spark):
    one = spark.createDataFrame([(True, "341F")], "detected boolean, name string")
    assert pf.primer_report(one, pf.report_mode(True, True)).first()[0] == '{"mode":"PE_mixed","detected":true,"name":"341F"}'
    s = spark.createDataFrame([("a",), ("b",)], "sample_id string")
    assert [r[0] for r in rd.empty_samples(s, s.limit(1)).collect()] in (["a"], ["b"])
    assert [r["size"] for r in ft.by_abundance(spark.createDataFrame([("x", 1), ("y", 3)], "seq string, size long")).collect()] == [3, 1]
    with pytest.raises(ValueError):
        md.route(one, spark.range(md.MAX_RULES + 1))
