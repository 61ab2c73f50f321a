import itertools
import os
import random
import re
import unicodedata
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from seqtable.llm import embedding_dedup, hard_negatives, spelling, token_ids, toxicity, url_filter
from seqtable.llm import queries as q

SMALL = "/root/testdata/sf0.01"


def sql_rows(name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    r = con.execute(q.oracle_sql()[name])
    return [c[0] for c in r.description], r.fetchall()


def equals_sql(spark, name):
    if not os.path.isdir(SMALL):
        pytest.skip("no driver tables")
    columns, want = sql_rows(name)
    got = q.queries()[name](spark, SMALL).select(*columns).collect()
    assert len(got) == len(want) and len(want) > 0
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


@pytest.mark.parametrize("m,k,n", [(1, 1, 1), (40, 64, 33), (37, 65, 70), (20, 0, 3), (129, 31, 18)])
def test_strassen(m, k, n):
    r = np.random.default_rng(m)
    a, b = r.integers(-(2**62), 2**62, (m, k)), r.integers(-9, 9, (k, n))
    with np.errstate(over="ignore"):
        assert (hard_negatives.strassen(a, b, leaf=4) == a @ b).all()


def mined(rows, n_pos=5, n_neg=5):
    """The contract in plain Python, whole."""
    v = []
    for i, e, l in rows:
        if l is None or e is None or any(x is None or not np.isfinite(x) for x in e):
            continue
        v.append((i, (l + 1) % 10 if i is not None and i % 7 == 0 else l, [int(np.floor(256 * float(np.float32(x)))) for x in e]))
    out, last = [], float("inf")
    for a in v:
        if a[0] is None or a[0] % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(a[2], b[2], strict=True)), last if b[0] is None else b[0], b[1]) for b in v if b is not a and len(b[2]) == len(a[2])]
        scored.sort()
        for s, p, _ in [x for x in scored if x[2] == a[1]][:n_pos]:
            near = [(t, x) for t, x, l in scored if l != a[1] and 80 * -s <= 100 * -t <= 100 * -s][:n_neg]
            out += [(a[0], None if p == last else p, k, None if x == last else x, -s, -t) for k, (t, x) in enumerate(near, 1)]
    return sorted(map(repr, out))


def test_hard_negatives(spark, monkeypatch):
    r = np.random.default_rng(5)
    base = r.normal(size=(6, 9))
    rows = [(i, [float(np.float32(x)) for x in base[i % 6] + r.normal(size=9) * 0.3], int(r.integers(0, 4))) for i in range(0, 900, 2)]
    rows += [(200, rows[3][1], 2), (1000, None, 1), (1001, rows[0][1], None), (1002, [float("nan")] * 9, 1), (1003, [1.0] * 8 + [None], 1), (1100, [], 1), (1102, [], 2), (None, rows[1][1], 1), (None, rows[2][1], 3), (1200, [1.0, 2.0], 1), (1202, [1.0, 2.0], 1), (1204, [0.9, 2.0], 2)]
    rows += [(2000 + i, rows[0][1], i % 3) for i in range(60)]  # copies: ties by vec_id
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as row", "2 as dim", "3 as k")
    monkeypatch.setattr(hard_negatives, "TILE", 50)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 4)
    got = sorted(repr(tuple(x)) for x in hard_negatives.mine(df).collect())
    assert got == mined(rows) and len(got) > 50
    assert hard_negatives.mine(df.limit(0)).count() == 0
    assert hard_negatives.mine(df.where("vec_id % 100 <> 0")).count() == 0


def test_op12_equals_sql(spark):
    equals_sql(spark, "op12_hard_negatives")


def variants(docs):
    """The contract in plain Python: words, near pairs by comparing all, forms and roots."""
    n = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{doc}:{w}".encode())
            if h % 31 == 0 and doc is not None:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    form, count = {}, {}
    for a in n:
        other = [b for b in n if near(a, b)]
        count[a] = len(other)
        best = min(other, key=lambda b: (-n[b], b), default=None)
        form[a] = best if best and n[best] >= 10 * n[a] else None
    out = []
    for a in n:
        root = a
        while form[root]:
            root = form[root]
        out.append((a, form[a], root, n[a], count[a], n[form[a]] if form[a] else None))
    return sorted(map(repr, out))


def test_spelling(spark, monkeypatch):
    r = random.Random(3)
    base = ["".join(r.choice("abcdenoäß") for _ in range(r.randint(7, 10))) for _ in range(12)]
    words = []
    for i, w in enumerate(base):
        words += [w] * (300 if i % 3 == 0 else 30)
        for _ in range(40):
            k = r.randrange(len(w))
            v = r.choice([w[:k] + w[k + 1 :], w[:k] + r.choice("abxeäÄ") + w[k:], w[:k] + r.choice("abxneÿ") + w[k + 1 :]])
            words += [v.upper() if r.random() < 0.1 else v] * r.choice([1, 2, 3])
    words += ["abcdefg", "gfedcba", "abcdegf"] * 3 + ["short", "a" * 3000, "a" * 3000, "a" * 3001, "a" * 3001]
    r.shuffle(words)
    docs = [(i, " ".join(words[i::40])) for i in range(40)] + [(50, None), (51, ""), (52, "12 34 ... !"), (None, "×÷abcdefgh abcdefgh×÷ Straße1Straßen"), (7, words[0])]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as word", "2 as n", "3 as key")
    want = variants(docs)
    counted = spelling.counted_words(df)
    assert sorted(repr(tuple(x)) for x in spelling.group_variants(counted).collect()) == want and len(want) > 100
    # deeper parts, and tiles where that is not enough, change nothing
    monkeypatch.setattr(spelling, "BLOCK", 64)
    pairs = {tuple(x) for x in spelling.near_words(counted).collect()}
    for part in (60, 1):
        again = [tuple(x) for x in spelling.near_words(counted, part=part).collect()]
        assert len(again) == len(set(again)) and {tuple(sorted(x)) for x in again} == {tuple(sorted(x)) for x in pairs}
    assert spelling.group_variants(spelling.counted_words(df.limit(0))).count() == 0


def test_op11_equals_sql(spark):
    equals_sql(spark, "op11_spelling")


def test_forward_backward_equals_enumeration():
    r = np.random.default_rng(2)
    lengths = [1, 3, 7, 2, 1, 9]
    scores = r.normal(size=sum(lengths)) * 3
    starts = np.concatenate([[True] + [False] * (n - 1) for n in lengths])
    transitions, start = np.exp(r.normal(size=(2, 2))), np.exp(r.normal(size=2))
    p, pairs = toxicity.forward_backward(scores, starts, transitions, start)
    want, want_pairs, low = [], [], 0
    for n in lengths:
        total, one, two = 0.0, np.zeros(n), np.zeros((n - 1, 4))
        for y in itertools.product((0, 1), repeat=n):
            w = start[y[0]] * np.exp(sum(s for s, k in zip(scores[low : low + n], y, strict=True) if k)) * np.prod([transitions[a, b] for a, b in itertools.pairwise(y)])
            total += w
            one += w * np.array(y)
            for k, (a, b) in enumerate(itertools.pairwise(y)):
                two[k, 2 * a + b] += w
        want.append(one / total)
        want_pairs.append(two / total)
        low += n
    assert np.allclose(p, np.concatenate(want), atol=1e-12) and np.allclose(pairs.T, np.concatenate(want_pairs), atol=1e-12)
    # many blocks give what one does
    long = r.normal(size=1000)
    cut = np.arange(1000) % 333 == 0
    whole = toxicity.forward_backward(long, cut, transitions, start)[0]
    apart = np.concatenate([toxicity.forward_backward(x, np.arange(len(x)) == 0, transitions, start)[0] for x in np.split(long, [333, 666, 999])])
    assert np.allclose(whole, apart, atol=1e-12)


def toxic_texts(r, n):
    """Texts of invented words; the toxic ones hold two to five forms of three stems."""
    words = ["".join(r.choice("abdeiklmnoprstuv") for _ in range(r.randint(2, 9))) for _ in range(600)]
    out = []
    for _ in range(n):
        text = [r.choice(words) for _ in range(r.randint(5, 120))]
        bad = r.random() < 0.2
        for _ in range(r.randint(2, 5) if bad else 0):
            text.insert(r.randrange(len(text)), r.choice(["grumph", "Ülfrek", "schnorz"]) + r.choice(["", "en", "ität", "s"]))
        out.append((" ".join(w.upper() if r.random() < 0.05 else w for w in text), int(bad)))
    return out


def test_toxicity(spark):
    rows = [(i, t, y) for i, (t, y) in enumerate(toxic_texts(random.Random(4), 900))]
    extra = [(2000, None), (2001, ""), (2002, "12 34 \n ..."), (None, rows[0][1]), (3, rows[3][1]), (2003, "gut " * 30000 + "Ülfrek schnorzität grumph")]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + extra, "doc_id long, text string").selectExpr("*", "1 as score", "2 as spans", "3 as toxic")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(5, None), (None, 1), (9999, 1), (7, 1 - rows[7][2])], "doc_id long, toxic int").selectExpr("*", "0 as quality", "'x' as text")
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == len(rows) + len(extra)
    by = {x["doc_id"]: x for x in got}
    held = [(by[i], y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(x["held_out"] for x, _ in held) and sum(x["held_out"] for x in got if x["doc_id"] is not None and x["doc_id"] < 900) in (len(held), len(held) + 1)
    assert sum(x["predicted"] == y for x, y in held) >= 0.97 * len(held) and sum(y for _, y in held) > 10
    assert all(0 <= x["score"] <= 1 and x["predicted"] == (x["score"] >= 0.5) for x in got)
    # spans are places of toxic words in code points
    texts = {i: t for i, t, _ in rows} | dict(extra[:3] + extra[5:])
    spans = [texts[i][s["begin"] : s["end"]].lower() for i, x in by.items() if i is not None for s in x["spans"]]
    bad = [s for s in spans if s.startswith(("grumph", "ülfrek", "schnorz"))]
    assert len(bad) > 200 and len(bad) >= 0.95 * len(spans)
    assert by[2003]["spans"][-1]["end"] == len(texts[2003])
    assert by[2000]["score"] == by[2001]["score"] == by[2002]["score"] < 0.5 and by[2000]["spans"] == []
    assert by[None]["score"] == by[0]["score"]
    # the sample does not depend on partitions; the held-out labels and the other columns do not matter
    other = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))).repartition(7)
    again = {x["doc_id"]: x["score"] for x in toxicity.score_documents(docs.repartition(5), other).collect()}
    assert again == {i: x["score"] for i, x in by.items()}
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0
    none = toxicity.score_documents(docs, labels.limit(0)).collect()
    assert len({x["score"] for x in none}) == 1 and none[0]["spans"] == []


def test_op13_on_held_out_documents(spark):
    if not os.path.isdir(SMALL):
        pytest.skip("no driver tables")
    sf = "/root/testdata/sf0.1"
    got = q.queries()["op13_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    toxic, clean = [x for x in got if x["toxic"] == 1], [x for x in got if x["toxic"] == 0]
    assert sum(x["predicted"] for x in toxic) >= 0.9 * len(toxic) and sum(x["predicted"] for x in clean) <= 0.01 * len(clean)


def test_every_letter_before_marks_is_encoded_as_in_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t, encoder = Tokenizer.from_file(path), token_ids.WordEncoder(path)
    r = random.Random(6)
    odd = [c for c in map(chr, range(0x20000)) if c.isalpha() and not unicodedata.normalize("NFC", c).lower()[-1].isalpha()]
    assert len(odd) >= 60
    words = [c + m for c in odd for m in encoder.MARKS]
    words += [f"x{c}" + "".join(r.choices(encoder.MARKS, k=r.randint(1, 3))) for c in map(chr, range(0x21, 0x20000)) if c.isalnum() or unicodedata.category(c)[0] == "M"]
    words += ["BELGESİ.", "ALİ,", "VELİ!", "İ!", "İ", "aİb.", "İİ..", "क़ख़.", "ড়!"]
    for low in range(0, len(words), 2000):
        some = words[low : low + 2000]
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder(some)]
        want = [e.ids for e in t.encode_batch(some, add_special_tokens=False)]
        assert got == want, [(w, g, x) for w, g, x in zip(some, got, want, strict=True) if g != x][:5]


def test_embeddings_of_extreme_sizes(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e200, 1.01e200]), (3, [1e-200, 1e-200]), (4, [1e-200, -1e-200]), (5, [1e308, 1.7e308]), (6, [5e-324, 5e-324]), (7, [-1.0, -1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = {x["vec_id"]: (x["n_links"], x["component_id"]) for x in embedding_dedup.near_duplicates(df).collect()}

    def cosine(a, b):
        a, b = (np.array(x) / max(map(abs, x)) for x in (a, b))
        return a @ b / np.sqrt((a @ a) * (b @ b))

    assert {i: n for i, (n, _) in got.items()} == {i: sum(j != i and cosine(v, w) >= 0.93 for j, w in rows) for i, v in rows}
    assert got[2] == (4, 1) and got[4] == (0, 4) and got[7] == (0, 7)


def test_url_entries_beyond_the_bound_are_met_by_joins(spark, monkeypatch):
    r = random.Random(11)
    label = lambda: r.choice(["a", "b", "cc", "example", "com", "net"])
    path = lambda: "".join("/" + r.choice(["en", "de", "x", "7", "", "article"]) for _ in range(r.randint(0, 3)))
    entries = list({(r.choice(["allow", "block"]), ".".join(label() for _ in range(r.randint(0, 3))), path()) for _ in range(300)})
    urls = [f"http://{'.'.join(label() for _ in range(r.randint(1, 4)))}{path()}?q" for _ in range(400)] + [None, "", "nothing", "://", "http://a." * 400 + "com/en"] + ["http://a.com/en"] * 3
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'h' as h", "'x' as rule")
    table = spark.createDataFrame(entries, "verdict string, host string, path string").selectExpr("*", "1 as n")
    want = sorted(map(str, url_filter.judge(pages, entries).collect()))
    plans = []
    for bound in (1 << 30, 10):
        monkeypatch.setattr(url_filter, "MAX_BYTES", bound)
        for given in (entries, table):
            df = url_filter.judge(pages, given)
            plans.append("MapInArrow" in df._jdf.queryExecution().executedPlan().toString())
            assert sorted(map(str, df.collect())) == want
    assert plans == [True, True, False, False] and "block" in " ".join(want)


def test_bound_of_a_trie_holds():
    import tracemalloc

    entries = [("block", f"h{i}.sub{i % 977}.example{i % 31}.com", f"/en/{i % 13}/article{i}/x") for i in range(20_000)]
    bound = sum(url_filter.trie_bytes(h, p) for _, h, p in entries)
    tracemalloc.start()
    trie = url_filter.Trie(entries)
    taken = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert taken <= bound and trie.find("h5.sub5.example5.com", "/en/5/article5/xyz")
