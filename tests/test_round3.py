import gzip
import math
import random
import struct
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from seqtable.functions.sequences import revcomp
from seqtable.operators import longreads, metadata, profiles, similarity
from seqtable.operators import reads as reads_
from seqtable.plans import pipelines
from seqtable.sources import fastq, files


def bgzip(data, r):
    """A blocked gzip file of blocks of random sizes."""
    out, at = b"", 0
    while at < len(data) or not out:
        text = data[at : at + r.randint(1, 400)]
        at += len(text)
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = c.compress(text) + c.flush()
        out += b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(text), len(text))
    return out + bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def fastq_text(r, n, end="\n"):
    """Reads of many lengths, also none, whose quality lines often look like headers or separators."""
    rows = []
    for i in range(n):
        size = r.choice([0, 1, 2, 5, 30, 90])
        qual = "".join(r.choice("@+@+IA") for _ in range(size))
        rows.append((f"r{i} {'x' * r.randint(0, 9)}", "".join(r.choice("ACGTN") for _ in range(size)), qual))
    return rows, "".join(f"@{h}{end}{s}{end}+{r.choice(['', h])}{end}{q}{end}" for h, s, q in rows)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_fastq_ranges_own_each_record_once(tmp_path, end):
    """The rows of a serial read for every size of range, without Spark."""
    r = random.Random(len(end))
    rows, text = fastq_text(r, 60, end)
    for name, content in (("a.fastq", text.encode()), ("b.fastq", text.encode().rstrip()), ("c.fastq.gz", bgzip(text.encode(), r)), ("d.fq.gz", gzip.compress(text.encode()))):
        (tmp_path / name).write_bytes(content)
        for size in [*range(1, 60, 7), 97, 250, 1000, 10**6]:
            reader = fastq.FastqReader({"path": str(tmp_path / name), "bytesPerPartition": str(size)})
            parts = reader.partitions()
            assert len(parts) == (1 if name[0] == "d" else -(-len(content) // size))
            got = [tuple(x) for p in parts for b in reader.read(p) for x in zip(*[b.column(c).to_pylist() for c in ("header", "seq", "qual")], strict=True)]
            assert got == rows, (name, size)
        (tmp_path / name).unlink()


def test_fastq_in_many_tasks(spark, tmp_path):
    r = random.Random(8)
    want = []
    for name in ("s1_1.fastq", "s1_2.fq.gz", "deep/s2.fastq", "s3.fastq.gz"):
        rows, text = fastq_text(r, 300)
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(bgzip(text.encode(), r) if name == "s1_2.fq.gz" else gzip.compress(text.encode()) if name.endswith("gz") else text.encode())
        want += [(name, i, *x) for i, x in enumerate(rows, 1)]
    (tmp_path / "empty.fastq").write_text("")
    df = fastq.read_fastq(spark, str(tmp_path), 3000)
    assert df.rdd.getNumPartitions() > 10
    named = lambda xs: sorted((x["file"].removeprefix(f"file://{tmp_path}/"), *x[1:]) for x in xs)
    assert named(df.collect()) == sorted(want)
    assert named(spark.read.format("fastq").load(str(tmp_path)).collect()) == sorted(want)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "bad.fastq").write_text("@r\nACGT\n+\nIIII\n@s\nAC\n")
    with pytest.raises(Exception, match="ends within a record"):
        fastq.read_fastq(spark, str(tmp_path / "bad"), 8).count()


def test_fastq_filters_are_pushed_down(spark, tmp_path):
    rows, text = fastq_text(random.Random(9), 2000)
    (tmp_path / "a.fastq").write_text(text)
    # what lies behind the first reads, or in another file, is never read: it is no FASTQ
    (tmp_path / "b.fastq").write_text(text + "nothing\n" * 400_000)
    fastq.register(spark)
    df = spark.read.format("fastq").load(str(tmp_path))
    with pytest.raises(Exception, match="FASTQ"):
        df.count()
    some = df.where("read_no <= 3")
    assert sorted(x["read_no"] for x in some.collect()) == [1, 1, 2, 2, 3, 3]
    assert df.where("read_no < 3").count() == 4 and df.where("read_no <= 0").count() == 0
    whole = df.where(f"file = 'file://{tmp_path}/a.fastq' and read_no >= 2")
    assert whole.count() == 1999 and df.where("endswith(file, 'a.fastq')").count() == 2000
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and "Filter " not in plan


def test_letter_counts(spark):
    r = random.Random(1)
    rows = ["".join(r.choice("ACGTN") for _ in range(r.choice([0, 1, 40, 300]))) for _ in range(500)] + [None, "", "A" * 200_000]
    got = {(x["pos"], chr(x["code"])): x["n"] for x in profiles.letter_counts(spark.createDataFrame([(s,) for s in rows], "seq string").repartition(5)).collect()}
    assert got == Counter((i, c) for s in rows for i, c in enumerate(s or ""))
    assert profiles.letter_counts(spark.createDataFrame([], "seq string")).count() == 0


def test_classifier_equals_its_formula(spark, monkeypatch):
    """Posteriors of 1,000 classes of three ranks, and the taxa chosen, against the formula in plain Python."""
    r = random.Random(7)
    genus = {g: "".join(r.choices("ACGT", k=60)) for g in range(25)}
    change = lambda s, n: "".join(r.choice("ACGT") if r.random() < n else c for c in s)
    ref = [(f"k{i % 5};g{i % 25};s{i}", change(genus[i % 25], 0.1)) for i in range(1000)] + [("k0;g0;s0", genus[0])] * 3
    seqs = [(f"q{i}", change(r.choice(ref)[1], 0.02)[: r.randint(20, 60)]) for i in range(40)] + [("short", "ACG"), ("none", None), ("n", "N" * 30), ("twice", genus[3].lower() * 2)]
    model = similarity.train_classifier(spark.createDataFrame(ref, "lineage string, seq string"))
    df = spark.createDataFrame(seqs, "feature_id string, seq string")
    grams = lambda s: [s[i : i + 7] for i in range(len(s) - 6)]
    counts, classes = {}, Counter(l for l, _ in ref)
    for lineage, s in ref:
        counts.setdefault(lineage, Counter()).update(grams(s))
    words = {w for c in counts.values() for w in c}
    want, taxa = {}, {}
    for i, s in seqs:
        asked = Counter(g for g in grams((s or "").upper()) if g in words)
        score = {c: math.log(n / len(ref)) + sum(k * math.log((counts[c][w] + 1) / (sum(counts[c].values()) + len(words))) for w, k in asked.items()) for c, n in classes.items()}
        top = max(score.values())
        total = math.fsum(math.exp(x - top) for x in score.values())
        want.update({(i, c): math.exp(x - top) / total for c, x in score.items()})
        ranks = Counter()
        for c in score:
            for d in (1, 2, 3):
                ranks[d, ";".join(c.split(";")[:d])] += want[i, c]
        taxa[i] = max(((d, p, t) for (d, t), p in ranks.items() if p >= 0.7), default=(0, 0.0, "Unassigned"))
    monkeypatch.setattr(similarity, "MAX_SCORES", 5000)  # blocks of five sequences
    got = {(x["feature_id"], x["lineage"]): x["p"] for x in similarity.class_scores(df, model).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    named = similarity.classify(df, model)
    assert {x["feature_id"]: x["lineage"] for x in named.collect()} == {i: t for i, (_, _, t) in taxa.items()}
    assert all(abs(x["confidence"] - taxa[x["feature_id"]][1]) < 1e-9 for x in named.collect())
    assert len({d for d, _, _ in taxa.values()}) >= 3
    plan = named._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Exchange" not in plan
    none = similarity.classify(df, model.limit(0)).collect()
    assert {x["lineage"] for x in none} == {"Unassigned"} and len(none) == len(seqs)


def test_longest_shared_ends_over_parts(spark):
    """The two longest common prefixes and suffixes with abundant others, for several numbers of parts."""
    r = random.Random(13)
    primer = "ACGTACGTACGGTTAC"
    parents = [primer + "".join(r.choices("ACGT", k=24)) for _ in range(12)]
    rows = {}
    for _ in range(400):
        a, b, k = r.choice(parents), r.choice(parents), r.randint(0, 40)
        rows.setdefault(a[:k] + b[k:] if r.random() < 0.8 else a[:k] + r.choice("ACGT") + b[k + 1 :], r.choice([1, 1, 2, 3, 5, 9, 40, 100, 700]))
    rows = [(f"f{i}", s, n) for i, (s, n) in enumerate(rows.items())] + [("none", None, 5), ("empty", "", 5), ("nosize", "ACGT", None)]
    df = spark.createDataFrame(rows, "feature_id string, seq string, size long")
    given = [x for x in rows if x[1] and x[2]]
    shared = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    for parts in (1, 3, 17):
        got = {}
        for x in similarity.shared_ends(df, 4.0, parts).collect():
            got.setdefault((x["feature_id"], x["end"]), {})[x["parent"]] = x["n"]
        for name, s, n in given:
            for end in (0, 1):
                turn = lambda t: t[::-1] if end else t
                want = {p: shared(turn(s), turn(t)) for p, t, m in given if p != name and m >= 4 * n}
                mine = got.get((name, end), {})
                assert all(want[p] == k for p, k in mine.items())
                assert sorted(mine.values(), reverse=True)[:2] == sorted(want.values(), reverse=True)[:2]
    plan = similarity.remove_chimeras(df, 4.0, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Cartesian" not in plan
    kept = [{x["feature_id"] for x in similarity.remove_chimeras(df, 4.0, p).collect()} for p in (1, 5)]
    assert kept[0] == kept[1] and {"none", "empty", "nosize"} < kept[0] and len(kept[0]) < len(rows)
    assert similarity.remove_chimeras(df.limit(0)).count() == 0


def test_minimizers_depend_on_their_text_alone():
    r = random.Random(3)
    texts = ["".join(r.choices("ACGT", k=n)) for n in (0, 5, 15, 16, 40, 300, 301)] + [None, "N" * 50, "acgtnACGT" * 9]
    rows = {}
    for i, p, h in zip(*longreads.minimizers(texts), strict=True):
        rows.setdefault(int(i), []).append((int(p), int(h)))
    for i, t in enumerate(texts):
        assert rows.get(i, []) == [(int(p), int(h)) for _, p, h in zip(*longreads.minimizers([t]), strict=True)]
        if t and "n" not in t.lower() and len(t) >= 38:  # a minimizer in every window
            at = [p for p, _ in rows[i]]
            assert at[0] < 24 and all(b - a <= 24 for a, b in zip(at, at[1:])) and len(t) - 15 - at[-1] < 24
    alike = dict(zip(*longreads.minimizers([texts[5], "ACGT" + texts[5]])[1:], strict=True))
    assert len(alike) > 0


def test_long_reads_find_what_all_comparisons_find(spark):
    """Recall at 90 % identity against all pairs: references of families that share a primer, reads with edits of all kinds."""
    r = random.Random(21)
    primer = "".join(r.choices("ACGT", k=40))

    def edited(s, share):
        out = []
        for c in s:
            x = r.random()
            out.append(c if x >= share else r.choice(["", r.choice("ACGT"), c + r.choice("ACGT")]))
        return "".join(out)

    roots = [primer + "".join(r.choices("ACGT", k=600)) for _ in range(10)]
    refs = [(f"r{i}", edited(s, share), 10 - i % 3) for i, (s, share) in enumerate((s, x) for s in roots for x in (0, 0.05, 0.2))]
    reads = []
    for i in range(150):
        s = edited(r.choice(refs)[1], r.choice([0, 0.02, 0.05, 0.08]))
        reads.append((f"q{i}", s.translate(str.maketrans("ACGT", "TGCA"))[::-1] if i % 3 == 0 else s))
    reads += [("none", None), ("short", "ACGT"), ("other", "".join(r.choices("ACGT", k=640))), ("n", "N" * 640)]
    q, f = spark.createDataFrame(reads, "feature_id string, seq string"), spark.createDataFrame(refs, "feature_id string, seq string, size long")
    all_pairs = q.crossJoin(f.selectExpr("feature_id as ref", "seq as rseq")).selectExpr("feature_id", "ref", "seq", "rseq").withColumn("back", revcomp(F.col("seq")))
    far = all_pairs.selectExpr("feature_id", "ref", "1 - least(levenshtein(seq, rseq), levenshtein(back, rseq)) / greatest(length(seq), length(rseq)) as identity").where("identity >= 0.9")
    want = {(x["feature_id"], x["ref"]): x["identity"] for x in far.collect()}
    got = {(x["query"], x["ref"]): x["identity"] for x in longreads.long_join(q, f, 0.9).collect()}
    assert all(abs(want[k] - v) < 1e-12 for k, v in got.items())
    assert len(want) > 150 and len(got) >= 0.97 * len(want)
    best = {}
    for (i, _), v in want.items():
        best[i] = max(v, best.get(i, 0))
    found = {x["query"]: x["identity"] for x in similarity.top_hit(longreads.long_join(q, f, 0.9), f).collect()}
    assert sum(abs(found.get(i, 0) - v) < 1e-12 for i, v in best.items()) >= 0.99 * len(best)
    assert longreads.long_join(q.limit(0), f, 0.9).count() == 0 and longreads.long_join(q, f.limit(0), 0.9).count() == 0
    # counts of samples, equal reads once
    named = q.withColumn("sample_id", F.lit("s")).union(q.withColumn("sample_id", F.lit("t")))
    assert sum(x["n"] for x in longreads.map_long(named, f).collect()) == 2 * len(found)


def test_distance():
    r = random.Random(2)

    def slow(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    for _ in range(600):
        a, b = ("".join(r.choices("ACGTé", k=r.choice([0, 1, 5, 20, 70]))) for _ in range(2))
        if r.random() < 0.5:
            b = "".join(c for c in a if r.random() < 0.9) + b[:3]
        d = slow(a, b)
        assert [longreads.distance(a, b, m) for m in (d, d + 3, 10**6)] == [d] * 3 and (d == 0 or longreads.distance(a, b, d - 1) is None)


def test_greedy_settles_long_chains_in_few_rounds(spark, monkeypatch):
    """A chain of 1,000 dependent features, and random graphs, as one after the other."""
    r = random.Random(5)
    chain = [(i + 1, i, 1) for i in range(1000)]
    graph = {(2000 + max(a, b), 2000 + min(a, b)) for a, b in ((r.randrange(300), r.randrange(300)) for _ in range(500)) if a != b}
    links = chain + [(a, b, r.randint(1, 3)) for a, b in sorted(graph)]
    nodes = [*range(1001), *range(2000, 2300)]
    centroid, earlier = {}, {}
    for a, b, d in links:
        earlier.setdefault(a, []).append((d, b))
    for n in nodes:
        near = min(((d, b) for d, b in earlier.get(n, []) if centroid[b] == b), default=None)
        centroid[n] = near[1] if near else n
    made = []
    monkeypatch.setattr(similarity, "staged", lambda df, f=similarity.staged: made.append(1) or f(df))
    ranks = spark.createDataFrame([(f"n{n}", n) for n in nodes], "node string, rank long")
    edges = spark.createDataFrame([(f"n{a}", f"n{b}", d) for a, b, d in links], "later string, earlier string, d int").cache()
    got = {x["node"]: x["centroid"] for x in similarity._greedy(ranks, edges, 5).collect()}
    assert got == {f"n{n}": f"n{c}" for n, c in centroid.items()} and len(made) < 10


def test_count_table_of_many_samples(spark, tmp_path):
    n = 20_000
    rows = {f"f{i}": {(i * 7919 + k * 104_729) % n: k + 1 for k in range(50)} for i in range(6)}
    with open(tmp_path / "wide.tsv", "w") as out:
        out.write("#OTU ID\t" + "\t".join(f"s{j}" for j in range(n)) + "\n")
        for f, cells in rows.items():
            out.write(f + ";size=9\t" + "\t".join(str(float(cells.get(j, 0))) for j in range(n)) + "\n")
    got = {tuple(x) for x in files.read_count_table(spark, str(tmp_path / "wide.tsv")).collect()}
    assert got == {(f, f"s{j}", k) for f, cells in rows.items() for j, k in cells.items()}


def test_trim_positions_equal_the_rule_one_by_one(spark):
    """Stable start and end of quality profiles, against the rule in plain Python."""
    r = random.Random(6)

    def slow(rows, q, retain=50):
        p25, n = [x[1] for x in rows], [x[2] for x in rows]
        smooth = [sum(p25[i : i + 5]) / 5 if i + 5 <= len(p25) else None for i in range(len(p25))]
        ok = [x is not None and x >= q for x in smooth]
        start = next((i for i in range(len(ok) - 4) if all(ok[i : i + 5])), 0)
        thin = next((i for i in range(len(n)) if n[i] < min(9000, 0.7 * max(n))), len(n))
        limit = max(40, thin)
        end = next((i for i in range(len(ok) - 1, 3, -1) if i < limit and all(ok[i - 4 : i + 1])), 0)
        return start, max(end, start + retain)

    for _ in range(6):
        size, depth = r.choice([30, 90, 160]), r.choice([500, 20_000])
        rows = [(i, float(r.choice([10, 24, 26, 30, 38]) if r.random() < 0.5 else 33 - i // 9), depth - depth * i // (size * 2) - r.randint(0, 30)) for i in range(size)]
        got = profiles.trim_positions(spark.createDataFrame(rows, "pos int, p25 double, n long")).first()
        assert tuple(got) == slow(rows, 25)


def test_samples_that_merge_rarely_keep_their_forward_reads(spark):
    r = random.Random(3)
    rows, want = [], set()
    for sample, share in (("good", 0.9), ("half", 0.5), ("bad", 0.4), ("none", 0.0)):
        for i in range(20):
            s = "".join(r.choices("ACGT", k=50))
            overlaps = i < 20 * share
            back = s[20:] if overlaps else "".join(r.choices("ACGT", k=30))
            rows.append((sample, i, s[:40], "I" * 40, back.translate(str.maketrans("ACGT", "TGCA"))[::-1], "I" * 30))
            if share < 0.5:
                want.add((sample, i, s[:40], "forward"))
            elif overlaps:
                want.add((sample, i, s, "merged"))
    df = spark.createDataFrame(rows, "sample_id string, read_no int, seq1 string, qual1 string, seq2 string, qual2 string")
    got = pipelines.merge_or_forward(df, 15, 0.0)
    assert {(x["sample_id"], x["read_no"], x["seq"], x["use"]) for x in got.collect()} == want
    assert got.where("length(seq) <> length(qual)").count() == 0 and pipelines.merge_or_forward(df.limit(0)).count() == 0


def test_xml_dumps_are_read_in_several_tasks(spark, tmp_path):
    r = random.Random(8)
    one = lambda i: f"<DocumentSummary uid='{i}'>\n<ArchiveID accession=\"PRJ{i}\"/><ProjectDescr><Title>Study {i} é{'x' * r.randrange(200)}</Title></ProjectDescr>\n</DocumentSummary{' ' * (i % 5 == 0)}>"
    text = "<?xml version='1.0'?>\n<DocumentSummarySet>" + "\n ".join(one(i) for i in range(300)) + "</DocumentSummarySet>"
    (tmp_path / "a.xml").write_text(text)
    (tmp_path / "cut.xml").write_text(one(300) + "<DocumentSummary uid='301'><ArchiveID acc")
    (tmp_path / "empty.xml").write_text("")
    sizes = [spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")]
    try:
        for size in (997, 4096, 1 << 20):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            got = files.read_project_xml(spark, str(tmp_path))
            assert sorted(x["accession"] for x in got.collect()) == sorted(f"PRJ{i}" for i in range(301))
            assert size > 4096 or files.xml_records(spark, str(tmp_path), "DocumentSummary").rdd.getNumPartitions() > 5
    finally:
        for k, v in zip(("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"), sizes, strict=True):
            spark.conf.set(k, v)
    titles = {x["accession"]: x["title"] for x in files.read_project_xml(spark, str(tmp_path / "a.xml")).collect()}
    assert titles["PRJ7"].startswith("Study 7 é")


def test_sample_text_by_records(spark, tmp_path):
    block = "{i}: Title\nIdentifiers: BioSample: SAMN{i}; Sample name: n{i}\nOrganism: soil\nAttributes:\n    /depth=\"{i}\"\nAccession: SAMN{i}\tID: {i}\n"
    text = "\n".join(block.format(i=i) for i in range(1, 60))
    (tmp_path / "s.txt").write_text(text)
    whole = files.parse_sample_text(spark.createDataFrame([(text,)], "t string"), "t")
    got = files.read_sample_text(spark, str(tmp_path / "s.txt"))
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect())) and got.count() == 59


def test_publications_equal_brute_force(spark):
    r = random.Random(3)
    tiers = [(r.choice(["p", "q", "s", None]), r.randrange(1, 4), n, r.choice([f"{n}", f"{n}", None])) for n in range(60)] + [("only null", 1, 1, None), ("unknown", 2, 1, "x")]
    art = [(f"{n}", r.choice([f"t{n}", None]), r.choice([f"a{n}", None]), r.choice([f"d{n % 4}", None])) for n in range(60)]
    by = {a[0]: a for a in art}
    want = {}
    for p in {t[0] for t in tiers if t[3] is not None}:
        mine = [t for t in tiers if t[0] == p and t[3] is not None]
        best = min(t[1] for t in mine)
        ids = [t[3] for t in sorted(mine, key=lambda t: t[2]) if t[1] == best]
        rows = [by.get(i, (i, None, None, None)) for i in ids]
        join = lambda xs, sep: sep.join(x for x in xs if x is not None)
        want[p] = (best, ";".join(ids), join([x[1] for x in rows[:2]], " || "), join([x[2] for x in rows[:2]], " || "), join(dict.fromkeys(x[3] for x in rows), ";"))
    got = metadata.associate_publications(spark.createDataFrame(tiers, "project string, tier int, pos int, pmid string"), spark.createDataFrame(art, "pmid string, title string, abstract string, doi string"))
    assert {x["project"]: tuple(x)[1:] for x in got.collect()} == want


def test_reads_of_one_sample_are_numbered_in_runs(spark, monkeypatch):
    monkeypatch.setattr(reads_, "NUMBERED", 7)
    r = random.Random(5)
    rows = [("hot", f"f{i % 3}", n) for i in range(3) for n in r.sample(range(1, 400), 100)] + [("hot", None, n) for n in (3, 9, 20)] + [("s", "f0", 5), (None, "f0", 1), (None, "f0", 2)]
    df = spark.createDataFrame(rows, "sample_id string, file string, read_no long").withColumn("extra", F.lit(1))
    got = reads_.number_reads(df.repartition(3))
    want, seen = set(), Counter()
    for s, f, n in sorted(rows, key=lambda x: (x[0] or "", x[1] is not None, x[1] or "", x[2])):
        seen[s] += 1
        want.add((s, f, n, 1, seen[s]))
    assert {tuple(x) for x in got.collect()} == want and got.columns == [*df.columns, "n"]


def test_streams_leave_a_bounded_number_of_files(spark, tmp_path):
    from seqtable.streaming.tables import latest, stream_upsert

    src, out, cp = tmp_path / "in", tmp_path / "out", tmp_path / "cp"
    rows, folders = {}, []

    def put():
        stream_upsert(spark.readStream.schema("id string, v string").parquet(str(src)), str(out), ["id"], str(cp), buckets=3, keep=2).awaitTermination()

    for n in range(7):
        new = {f"{(5 * n + k) % 17}": f"{n}" for k in range(4)}
        rows |= new
        spark.createDataFrame(list(new.items()), "id string, v string").coalesce(1).write.mode("append").parquet(str(src))
        put()
        folders.append((len(list(out.glob("*/seqtable_part=*"))), len(list(out.glob("*")))))
        assert {tuple(x) for x in latest(spark, str(out), n).collect()} == set(rows.items())
        if n == 4:
            at_4 = set(rows.items())
        if n == 5:
            at_5 = set(rows.items())
    assert max(folders) <= (3 * 3, 3 + 2) and max(n for _, n in folders) <= 3 + 2
    assert {tuple(x) for x in latest(spark, str(out), 5).collect()} == at_5
    assert {tuple(x) for x in latest(spark, str(out), 4).collect()} == at_4
    for f in (cp / "commits").glob("*6*"):
        f.unlink()
    put()  # the last batch is replayed
    assert {tuple(x) for x in latest(spark, str(out), 6).collect()} == set(rows.items())
