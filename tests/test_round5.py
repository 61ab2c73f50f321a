import gzip
import random
from collections import Counter
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seqtable import queries as q
from seqtable.operators import longreads
from seqtable.operators import reads as rd
from seqtable.plans import fixtures
from seqtable.sources import fastq


def edited(r, s, share):
    return "".join(c if r.random() >= share else r.choice(["", r.choice("ACGT"), c + r.choice("ACGT")]) for c in s)


def back(s):
    return s.translate(str.maketrans("ACGT", "TGCA"))[::-1]


def test_long_reads_are_those_of_the_sql(spark, data):
    r = fixtures.reads(spark, data)
    templates = spark.sql(fixtures.LONG_TEMPLATES.replace("FROM r)", "FROM {r})"), r=r)
    want = spark.sql(fixtures.LONG.replace("FROM r JOIN templates", "FROM {r} r JOIN {templates} templates"), r=r, templates=templates)
    got, named = fixtures.long_reads(spark, data)
    assert got.columns == want.columns and got.dtypes == want.dtypes and got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and named.count() == templates.count()
    assert fixtures.long_reads(spark, data, "sample_id", "seq")[0].columns == ["sample_id", "seq"]


def test_drawn_letters_are_those_of_the_sql():
    t = "".join(random.Random(3).choices("ACGT", k=64))
    keys = [(-7, 2, -9), (0, 0, 0), (5, 1, 3), (8, 7, -100), (-4, 3, 11)]
    got = fixtures._long_read.func(pa.array([t] * len(keys)), *(pa.array(c) for c in zip(*keys, strict=True))).to_pylist()

    def drawn(x):  # substr('ACGT', 1 + x, 1)
        return "ACGT"[x : x + 1] if x >= 0 else "A" if x == -1 else "ACGT"[5 + x]

    rest = lambda x, n: abs(x) % n * (1 if x >= 0 else -1)
    for (ok, ln, pk), seq in zip(keys, got, strict=True):
        want = "".join(t[32 * i : 32 * i + 15] + drawn(rest(ok // (i + 1) + ln * (i + 3) + pk * i, 4)) + t[32 * i + 16 : 32 * i + 31] + drawn(rest(pk // (i + 2) + ok * (i + 1) + ln, 6)) for i in range(2))
        assert seq == (back(want) if ok % 4 == 0 else want)


def test_references_sent_and_joined_give_the_same(spark, monkeypatch):
    r = random.Random(5)
    roots = ["".join(r.choices("ACGT", k=500)) for _ in range(6)]
    refs = [(f"r{i}", edited(r, s, x), 1) for i, (s, x) in enumerate((s, x) for s in [*roots, roots[0][:20] * 25] for x in (0, 0.04))]
    reads = [(f"q{i}", edited(r, r.choice(refs)[1], r.choice([0, 0.03, 0.06]))) for i in range(80)]
    reads = [(i, back(s) if n % 3 == 0 else s) for n, (i, s) in enumerate(reads)] + reads[:5] + [("none", None), ("short", "ACGT"), ("empty", "")]
    a, b = spark.createDataFrame(reads, "feature_id string, seq string"), spark.createDataFrame(refs, "feature_id string, seq string, size long")
    for strand in ("both", "plus"):
        sent = sorted(map(tuple, longreads.long_join(a, b, 0.85, strand).collect()))
        monkeypatch.setattr(longreads, "MAX_SEEDS", 0)
        joined = sorted(map(tuple, longreads.long_join(a, b, 0.85, strand).collect()))
        monkeypatch.undo()
        assert sent == joined and len(sent) > 50
    named = a.withColumn("sample_id", F.substring("feature_id", 2, 1))
    sent = sorted(map(tuple, longreads.map_long(named, b).collect()))
    monkeypatch.setattr(longreads, "MAX_LETTERS", 0)
    assert sent == sorted(map(tuple, longreads.map_long(named, b).collect())) and sent


def test_long_reads_stay_where_they_are(spark):
    """With few references only (query, ref, d) is shuffled, never a sequence."""
    r = random.Random(8)
    refs = [(f"r{i}", "".join(r.choices("ACGT", k=400)), 1) for i in range(3)]
    a = spark.createDataFrame([(f"q{i}", r.choice(refs)[1]) for i in range(9)], "feature_id string, seq string")
    out = longreads.long_join(a, spark.createDataFrame(refs, "feature_id string, seq string, size long"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == 9 and "Join" not in plan and "Repartition" not in plan and plan.count("Aggregate") == 1


def test_wide_bands_and_bounds():
    r = random.Random(9)
    pairs = [(a, edited(r, a, x)) for a in ("".join(r.choices("ACGT", k=700)) for _ in range(3)) for x in (0, 0.02, 0.1, 0.2, 0.35, 0.6, 1)]
    pairs += [(a, a[200:] + b[:n]) for a, b in pairs[:6] for n in (0, 90, 200)] + [(a[:300] + "N" + a[300:], a) for a, _ in pairs[:2]] + [(a + "#x y", "z" + a) for a, _ in pairs[:2]]
    left, right = map(list, zip(*pairs, strict=True))
    for most in (60, 130, 260, 500):
        want = [longreads.distance(a, b, most) for a, b in pairs]
        assert longreads.distances(left, right, [most] * len(pairs)) == want
        bound = longreads.distances(left, right, [most] * len(pairs), [True] * len(pairs))
        assert all((x is None) == (d is None) and (d is None or d <= x <= most) for x, d in zip(bound, want, strict=True))


def test_a_longer_way_is_enough_for_an_only_candidate(monkeypatch):
    asked = []
    monkeypatch.setattr(longreads, "_in_band", lambda left, right, words, run=longreads._in_band: asked.append(words) or run(left, right, words))
    a = "".join(random.Random(10).choices("ACGT", k=1500))
    b = "".join(c if i % 18 else "ACGT"["CGTA".index(c)] for i, c in enumerate(a))
    assert longreads.distances([a], [b], [150], [True]) == [84] and asked == [1]
    assert longreads.distances([a], [b], [150]) == [84] and asked == [1, 2]


def test_every_long_read_has_its_template(spark, data):
    want = fixtures.reads(spark, data).groupBy(F.concat(F.lit("t"), "tpl").alias("feature_id"), "sample_id").agg(F.count("*").alias("n"))
    got = q.map_long_reads(spark, data)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_written_fastq_is_blocked_and_read_back(spark, tmp_path, monkeypatch):
    r = random.Random(11)
    rows = [(f"r{i}", "".join(r.choices("ACGT", k=n)), "I" * n, r.choice(["S1", "S 2/x", None])) for i, n in enumerate(r.choices([0, 5, 120], k=3000))]
    df = spark.createDataFrame(rows, "header string, seq string, qual string, sample string").repartition(3)
    for open_ in (64, 1):
        monkeypatch.setattr(fastq, "OPEN", open_)
        path = tmp_path / str(open_)
        fastq.write_fastq(df, str(path), "sample")
        files = [f for f in path.rglob("*") if f.is_file()]
        assert {f.parent.name for f in files} == {"sample=S1", "sample=S+2%2Fx", "sample=__HIVE_DEFAULT_PARTITION__"} and all(f.name.endswith(".fastq.gz") for f in files)
        for f in files:
            assert fastq._block_size(f.read_bytes()[:18]) and f.read_bytes().endswith(fastq.bgzip_block(b""))
        text = b"".join(gzip.decompress(f.read_bytes()) for f in files).decode()
        assert sorted(text.split("@")[1:]) == sorted(f"{h}\n{s}\n+\n{x}\n" for h, s, x, _ in rows)
        got = fastq.read_fastq(spark, str(path), 2000).collect()
        assert Counter((x["header"], x["seq"], x["qual"]) for x in got) == Counter(x[:3] for x in rows)
        assert all(sorted(x["read_no"] for x in got if x["file"] == f) == list(range(1, n + 1)) for f, n in Counter(x["file"] for x in got).items())
    fastq.write_fastq(df.limit(0), str(tmp_path / "none"), "sample")
    assert fastq.read_fastq(spark, str(tmp_path / "none")).count() == 0


def test_a_failed_write_names_no_file(spark, tmp_path):
    df = spark.range(0, 200, 1, 2).select(F.lit("h").alias("header"), F.lit("A").alias("seq"), F.when(F.col("id") == 199, F.raise_error(F.lit("stop"))).otherwise(F.lit("I")).alias("qual"), F.lit("s").alias("sample"))
    with pytest.raises(Exception, match="stop"):
        fastq.write_fastq(df, str(tmp_path / "x"), "sample")
    assert not [f for f in (tmp_path / "x").rglob("*.gz")]


def test_what_may_repeat_holds_all_that_does(spark, monkeypatch):
    r = random.Random(12)
    rows = [(f"h{r.randrange(4000)}", r.choice("AC")) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a string, b string")
    n = Counter(rows)
    for places, most in ((rd.PLACES, 0), (1 << 6, 3000)):  # a full table only asks for more
        monkeypatch.setattr(rd, "PLACES", places)
        out = rd.may_repeat(df, rd.repeats(df, "a", "b"), "a", "b")
        assert out.columns == ["a", "b", "again"]
        got = [(tuple(x[:2]), x["again"]) for x in out.collect()]
        assert Counter(x for x, _ in got) == n and all(again for x, again in got if n[x] > 1)
        assert sum(again and n[x] == 1 for x, again in got) <= most


def test_fastq_scan_takes_less_room_than_its_letters(spark, data, monkeypatch):
    made, folder = [], q.stage_folder
    monkeypatch.setattr(q, "stage_folder", lambda s: made.append(folder(s)) or made[-1])
    monkeypatch.setattr(q, "staged", lambda df, write=q.staged: (made.append((out := write(df)).staged_to), out)[1])
    out = q.fastq_scan(spark, data)
    room = sum(f.stat().st_size for p in made for f in Path(p.removeprefix("file:")).rglob("*") if f.is_file())
    letters = out.agg(F.sum(F.col("n") * (F.length("header") + F.length("seq") + F.length("qual") + 6))).first()[0]
    assert len(made) == 2 and 0 < room < letters / 2
    # whole reads are shuffled from the written table of those that may repeat, not from the files
    tree = out._jdf.queryExecution().optimizedPlan().toString()
    below = [t.split("Join")[0] for t in tree.split("Aggregate [")[1:] if " AS header#" in t.split("\n")[0]]
    assert below and not any("fastq" in t for t in below), tree


@pytest.mark.parametrize("number", ["read_no + 1", "CASE WHEN read_no = 2 THEN 1 ELSE read_no END", "CASE WHEN read_no = 2 THEN 0 ELSE read_no END"])
def test_wrong_numbers_are_seen(spark, data, monkeypatch, number):
    read = fastq.read_fastq
    monkeypatch.setattr(fastq, "read_fastq", lambda *a, **k: read(*a, **k).withColumn("read_no", F.expr(number)))
    assert q.fastq_scan(spark, data).first()["misnumbered"] > 0
