"""Whole pipelines against the same steps one after the other in plain Python."""

import functools
import os
import random
from collections import Counter

import pytest

from seqtable.operators import features as ft
from seqtable.operators import longreads
from seqtable.operators import metadata as md
from seqtable.operators import reads as rd
from seqtable.operators import similarity as sm
from seqtable.plans import pipelines
from seqtable.plans.stages import scope, stage_folder, staged
from seqtable.sources import files


@functools.cache
def dist(a, b):
    """Levenshtein distance by the bits of one column at a time."""
    at = Counter()
    for i, x in enumerate(a):
        at[x] |= 1 << i
    mask, top, score = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    up, down = mask, 0
    for x in b:
        eq = at[x]
        v = eq | down
        h = (((eq & up) + up) ^ up) | eq
        more, less = (down | ~(h | up)) & mask, up & h
        score += bool(more & top) - bool(less & top)
        more, less = (more << 1) | 1, less << 1
        up, down = (less | ~(v | more)) & mask, more & v & mask
    return score


def rc(s):
    return s.translate(str.maketrans("ACGT", "TGCA"))[::-1]


def far(a, b, both):
    return min(dist(a, b), dist(rc(a), b)) if both else dist(a, b)


def grouped(sizes, linked):
    """Centroid of each sequence: in order of size, those without a linked centroid before them; the nearest, then first."""
    centroid, out = [], {}
    for s in sorted(sizes, key=lambda s: (-sizes[s], s)):
        near = min(((d, i) for i, c in enumerate(centroid) if (d := linked(s, c)) is not None), default=None)
        out[s] = centroid[near[1]] if near else s
        if not near:
            centroid.append(s)
    return out


def summed(sizes, centroid):
    out = Counter()
    for s, c in centroid.items():
        out[c] += sizes[s]
    return out


def clustered(sizes, identity, both=False):
    def linked(s, c):
        d = far(s, c, both)
        return d if d <= int(max(len(s), len(c)) * (1 - identity) + 1e-9) else None

    return summed(sizes, grouped(sizes, linked))


def denoised(sizes, both=False):
    def linked(s, c):
        d = far(s, c, both)
        return d if d <= int(max(len(s), len(c)) * 0.1 + 1e-9) and sizes[s] <= sizes[c] * 2.0 ** -(2 * d + 1) else None

    return summed(sizes, grouped(sizes, linked))


def shared(a, b):
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def without_chimeras(sizes):
    out = {}
    for s, n in sizes.items():
        parents = [t for t, m in sizes.items() if m >= 16 * n and t != s]
        pre, suf = ([(t, shared(s[::w], t[::w])) for t in parents] for w in (1, -1))
        cut = any(k == len(s) for _, k in pre + suf)
        if cut or not any(a != b and x + y >= len(s) for a, x in pre for b, y in suf):
            out[s] = n
    return out


def mapped(reads, otus, identity, both=False):
    """Counts of (feature, sample) of features with two reads or more."""
    best = {}
    for s in {s for _, s in reads}:
        hits = [(far(s, o, both) / max(len(s), len(o)), -n, o) for o, n in otus.items() if far(s, o, both) <= int(max(len(s), len(o)) * (1 - identity) + 1e-9)]
        best[s] = min(hits)[2] if hits else None
    counts = Counter((best[s], sample) for sample, s in reads if best[s])
    total = Counter()
    for (o, _), n in counts.items():
        total[o] += n
    return {k: n for k, n in counts.items() if total[k[0]] >= 2}


def changed(r, s, n):
    t = list(s)
    for _ in range(n):
        i = r.randrange(len(t))
        t[i] = r.choice(["", *"ACGT", t[i] + r.choice("ACGT")])
    return "".join(t)


def left_in(spark):
    folder = os.path.dirname(stage_folder(spark)).removeprefix("file://")
    return {x for x in os.listdir(folder) if x.startswith("stage-")} if os.path.isdir(folder) else set()


def by_sequence(tables):
    names = {x["feature_id"]: x["seq"] for x in tables.features.collect()}
    counts = tables.counts.collect()
    assert {x["feature_id"] for x in counts} == set(names)
    return {(names[x["feature_id"]], x["sample_id"]): x["n"] for x in counts}


@pytest.mark.parametrize("strand", ["plus", "both"])
def test_otu_pipeline_equals_its_steps(spark, strand):
    r = random.Random(21)
    both = strand == "both"
    base = ["".join(r.choices("ACGT", k=100)) for _ in range(4)]
    base.append(changed(r, base[0], 3))
    reads = [(f"s{r.randrange(3)}", b) for b, n in zip(base, (160, 90, 120, 60, 70), strict=True) for _ in range(n)]
    for b in base:
        for _ in range(12):
            s = changed(r, b, r.randint(1, 5))
            reads += [(f"s{r.randrange(3)}", s)] * r.choice([1, 1, 2, 3, 9])
    for _ in range(6):
        a, b = r.sample(base[:4], 2)
        reads += [(f"s{r.randrange(3)}", a[: (k := r.randint(30, 70))] + b[k:])] * r.randint(2, 3)
    if both:
        reads = [(p, rc(s) if r.random() < 0.4 else s) for p, s in reads]
    close = clustered({s: n for s, n in Counter(s for _, s in reads).items() if n >= 2}, 0.99, both)
    clean = denoised(close, both)
    whole = without_chimeras(clean)
    otus = clustered(whole, 0.97, both)
    want = mapped(reads, otus, 0.97, both)
    assert len(clean) < len(close) and len(otus) < len(whole) and sum(want.values()) < len(reads) and (both or len(whole) < len(clean))
    before = left_in(spark)
    got = pipelines.otu_pipeline(spark.createDataFrame([*reads, ("s0", None)], "sample_id string, seq string"), strand=strand)
    assert by_sequence(got) == want
    assert {x["seq"]: x["size"] for x in got.features.collect()} == {s: otus[s] for s, _ in want}
    assert got.guard.first()["untrustworthy"] is False and got.guard.first()["n"] == len(reads)
    assert len(left_in(spark) - before) == 3  # the results


def test_reads_that_cannot_be_trusted_give_no_tables(spark):
    r = random.Random(4)
    one = [("s", "".join(r.choices("ACGT", k=60))) for _ in range(40)]
    schema = "sample_id string, seq string"
    got = pipelines.otu_pipeline(spark.createDataFrame(one + one[:1], schema))
    assert got.guard.first()["untrustworthy"] is True and got.counts.count() == got.features.count() == 0
    assert got.counts.columns == ["feature_id", "sample_id", "n"]
    two = pipelines.otu_pipeline(spark.createDataFrame([*one, ("t", one[0][1])], schema))
    assert two.guard.first()["untrustworthy"] is False and {tuple(x)[1:] for x in two.counts.collect()} == {("s", 1), ("t", 1)}
    none = pipelines.otu_pipeline(spark.createDataFrame([], schema))
    assert none.guard.first()["n"] == 0 and none.counts.count() == 0


def test_ont_pipeline_equals_its_steps(spark):
    r = random.Random(31)
    base = ["".join(r.choices("ACGT", k=300)) for _ in range(3)]
    rows = []
    for i in range(90):
        s = r.choice(base)
        s = s if i % 3 == 0 else changed(r, s, r.randint(1, 12))
        s = rc(s) if r.random() < 0.5 else s
        rows.append((r.choice(["a", "b", None]), i, s, r.choice("5II(") * len(s)))
    rows += [("a", 90 + i, "".join(r.choices("ACGT", k=n)), "I" * n) for i, n in enumerate([20, 150, 700, 900])]
    rows += [("b", 20_000 + i, "".join(r.choices("ACGT", k=650)), "I" * 650) for i in range(100)]  # beyond the first 10,000
    mean = [sum(10 ** -((ord(c) - 33) / 10) for c in q) / len(q) for *_, q in rows]
    center = 325 if Counter(len(s) // 50 for _, i, s, _ in rows if i <= 10_000).most_common(1)[0][0] == 6 else 275
    lo, hi = round(center * 0.85), round(center * 1.15)
    kept = [(p, s) for (p, _, s, _), m in zip(rows, mean, strict=True) if m <= 0.1 and max(200, lo) <= len(s) <= hi]
    merged = Counter()
    for p in ("a", "b", None):
        merged.update(denoised(Counter(s for q, s in kept if q == p), True))
    otus = clustered(merged, 0.97, True)
    want = mapped(kept, otus, 0.90, True)
    assert 0 < len(want) and len(kept) < 90 and len(otus) < len(merged)
    df = spark.createDataFrame(rows, "sample_id string, read_no int, seq string, qual string")
    before = left_in(spark)
    got = pipelines.ont_pipeline(df)
    assert by_sequence(got) == want and tuple(got.guard.first()) == (max(200, lo), hi)
    assert {x["seq"]: x["size"] for x in got.features.collect()} == {s: otus[s] for s, _ in want}
    assert len(left_in(spark) - before) == 3
    fast = pipelines.ont_pipeline(df, mapping=longreads.map_long)
    assert sum(by_sequence(fast).values()) >= 0.97 * sum(want.values())
    assert pipelines.ont_pipeline(df.limit(0)).counts.count() == 0


def test_merge_and_classify_takes_each_step(spark):
    r = random.Random(9)
    base = ["".join(r.choices("ACGT", k=80)) for _ in range(3)]
    seqs = {f"f{i}": base[i % 3][: 80 - i % 5] for i in range(24)} | {f"g{i}": base[0][:30] for i in range(6)}
    seqs = {f: rc(s) if f in ("f1", "f4") else s for f, s in seqs.items()} | {"odd": "A" * 80}
    counts = [(f, r.choice("xy"), r.randint(1, 9)) for f in seqs for _ in range(2)]
    parts = [[c for c in counts if len(c[0]) == k or k == 2] for k in (2, 3)]
    frame = lambda rows: spark.createDataFrame(rows, "feature_id string, sample_id string, n long").groupBy("feature_id", "sample_id").sum("n").withColumnRenamed("sum(n)", "n")
    of = lambda names: spark.createDataFrame([(f, seqs[f]) for f in names], "feature_id string, seq string")
    reference = spark.createDataFrame([(f"l{i}", s) for i, s in enumerate(base)], "lineage string, seq string")
    keep = of([f for f in seqs if f != "f0"])
    before = left_in(spark)
    got = pipelines.merge_and_classify([frame(p) for p in parts], [of(sorted({c[0] for c in p})) for p in parts], reference.select("seq"), sm.train_classifier(reference), keep)
    want = Counter()
    for p in parts:
        for f, s, n in p:
            want[f, s] += n
    assert {(x["feature_id"], x["sample_id"]): x["n"] for x in got.counts.collect()} == {k: n for k, n in want.items() if k[0] not in ("odd", "f0")}
    taxa = {x["feature_id"]: x["lineage"] for x in got.features.collect()}
    assert set(taxa) == set(seqs) - {"odd", "f0"} and all(taxa[f] == f"l{int(f[1:]) % 3}" for f in taxa if f[0] == "f")
    lengths = sorted(len(s) for f, s in seqs.items() if f != "odd")
    p05, p95 = lengths[int(len(lengths) * 0.05)], lengths[int(len(lengths) * 0.95) - 1]
    row = got.guard.first()
    assert (row["n"], row["p05"], row["p95"], row["warn"]) == (len(lengths), p05, p95, p95 / p05 > 1.5) and row["warn"]
    assert len(left_in(spark) - before) >= 3 and {"x", "y"} == {x["sample_id"] for x in got.counts.collect()}


def test_scopes_delete_what_is_not_kept(spark):
    df = spark.range(3)
    before = left_in(spark)
    with scope() as outer:
        staged(df)
        with scope() as inner:
            staged(df)
            mid = inner(df)
            assert len(left_in(spark) - before) == 3
        assert len(left_in(spark) - before) == 2 and mid.count() == 3
        last = outer(mid.where("id > 0"))
    assert len(left_in(spark) - before) == 1 and last.count() == 2
    with pytest.raises(ZeroDivisionError), scope() as keep:
        keep(df), staged(df), 1 // 0
    assert len(left_in(spark) - before) == 1


def test_derep_check_equals_the_check_of_reads(spark):
    for rows in ([("a", "AC")] * 3 + [("a", "GT")], [("a", f"A{i}") for i in range(30)], [("a", f"A{i}") for i in range(30)] + [(None, "A1")], []):
        reads = spark.createDataFrame(rows, "sample_id string, seq string")
        assert ft.derep_check(ft.dereplicate(reads), reads).collect() == ft.abundance_check(reads).collect()


def test_reads_beyond_the_first_ones_are_left_out(spark):
    rows = [(i, i % 3) for i in range(1, 2501)]
    df = spark.createDataFrame(rows, "read_no int, x int")
    for n in (1, 1000, 2000, 9999):
        assert sorted(tuple(x) for x in rd.head_reads(df, n).collect()) == [x for x in rows if x[0] <= n]


def test_synonyms_and_aliases_rename_columns(spark):
    df = spark.createDataFrame([("1", "2", "3", "4", "5")], ["  Geo Loc ", "country", "host_age", "DESIGN_DESCRIPTION", "Design Description"])
    out = md.standardize_columns(df, {"Country": ["geo loc", "COUNTRY"], "Age": ["HOST_AGE"], "Depth": ["deep"]}).first().asDict()
    assert (out["Country"], out["country"], out["Age"], out["DesignDescription"]) == ("1", "2", "3", "4_5")
    kept = md.standardize_columns(df.withColumnRenamed("host_age", "Age"), {"Age": ["country"]}).first().asDict()
    assert kept["Age"] == "3" and "Depth" not in out  # a standard name that is there already stays


def test_reports_with_byte_order_mark(spark, tmp_path):
    df = spark.createDataFrame([("é", 'a"b,c'), ("x\ty", None)], "a string, b string")
    for sep, name in ((",", "c"), ("\t", "t")):
        files.write_report(df.repartition(2), str(tmp_path / name), sep, byte_order_mark=True)
        parts = [(tmp_path / name / x).read_bytes() for x in os.listdir(tmp_path / name) if x.startswith("part-")]
        assert parts and all(p.startswith(b"\xef\xbb\xbf") and p.count(b"\xef\xbb\xbf") == 1 for p in parts)
        assert sorted(map(str, spark.read.csv(str(tmp_path / name), header=True, sep=sep, escape='"').collect())) == sorted(map(str, df.collect()))
