import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from seqtable.llm import embedding_dedup, html_text, minhash, quality_model, url_filter
from seqtable.llm import queries as q
from seqtable.llm.components import components


def test_components(spark):
    r = random.Random(1)
    edges = [(f"{r.randrange(80):03d}", f"{r.randrange(80):03d}") for _ in range(50)] + [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(40)]
    low = {}

    def find(x):
        low.setdefault(x, x)
        while low[x] != x:
            x = low[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            low[max(a, b)] = min(a, b)
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {x: find(x) for x in low}
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


@pytest.mark.parametrize("tile", [embedding_dedup.TILE, 4])
def test_embeddings(spark, monkeypatch, tile):
    # small tiles and blocks: cells of several blocks, each of several tiles
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 8 * tile)
    monkeypatch.setattr(embedding_dedup, "BLOCK_NUMBERS", 32 * tile)
    r = np.random.default_rng(1)
    base = r.normal(size=(20, 16))
    rows = []
    for i in range(120):
        v = base[i % 20] + r.normal(size=16) * (0.05 if i % 3 else 0.6)
        rows.append((i, [float(np.float32(x)) for x in v], i % 20 % 4))
    rows += [(500, rows[3][1], 3), (501, None, 1), (502, [0.0] * 16, 1), (503, [float("nan")] * 16, 1), (504, [1.0] * 15 + [None], 1), (505, rows[3][1], None), (506, [2 * x for x in rows[3][1]], 3), (507, [1.0, 2.0], 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {x["vec_id"]: x for x in embedding_dedup.near_duplicates(df).collect()}
    usable = [(i, np.array(v), l) for i, v, l in rows if l is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)]
    links = {i: set() for i, _, _ in rows}
    for i, v, l in usable:
        for j, w, m in usable:
            if i != j and l == m and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= 0.93:
                links[i].add(j)
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (len(links[i]), min(seen), min(seen) == i)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0
    # other types of numbers, labels and ids give the same groups
    other = df.selectExpr("concat('v', lpad(vec_id, 4, '0')) as vec_id", "cast(embedding as array<double>) as embedding", "concat('l', label) as label")
    named = {x["vec_id"]: (x["n_links"], x["component_id"], x["kept"]) for x in embedding_dedup.near_duplicates(other).collect()}
    assert named == {f"v{i:04d}": (x["n_links"], f"v{x['component_id']:04d}", x["kept"]) for i, x in got.items()}


def test_minhash_groups(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choices("abcdefgh", k=4))
    rows = []
    for g in range(12):
        text = [word() for _ in range(r.choice([6, 30, 200]))]
        for _ in range(r.randint(1, 6)):
            t = list(text)
            for _ in range(r.randint(0, 2)):
                t[r.randrange(len(t))] = word()
            rows.append(" ".join(t) if r.random() < 0.7 else "  ".join(t).upper())
    rows += [None, "", " \n", "two words", "Two  words", "x"] + ["copy of one text here"] * 40
    docs = [(i, t) for i, t in enumerate(rows)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    sets = {}
    for i, t in docs:
        w = "".join(c.lower() if c.isascii() else c for c in t or "").split()
        sets[i] = {tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())
    low = {i: i for i in sets}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for i in sets:
        for j in sets:
            k = len(sets[i] & sets[j])
            if i < j and k and 100 * k >= 80 * (len(sets[i]) + len(sets[j]) - k):
                a, b = find(i), find(j)
                low[max(a, b)] = min(a, b)
    got = {x["doc_id"]: x for x in minhash.near_duplicates(df, k=4).collect()}
    assert {i: (x["n_shingles"], x["component_id"], x["kept"]) for i, x in got.items()} == {i: (len(sets[i]), find(i), find(i) == i) for i in sets}
    assert minhash.near_duplicates(df.limit(0), k=4).count() == 0
    odd = spark.createDataFrame([(None, "a b c d e"), (4, "a b c d e"), (4, "a b c d e")], "doc_id long, text string")
    assert [(x["doc_id"], x["component_id"], x["kept"]) for x in minhash.near_duplicates(odd).collect() if x["doc_id"] is None] == [(None, None, True)]


def test_minhash_large_group_that_drifts(spark, monkeypatch):
    r = random.Random(5)
    word = lambda: "".join(r.choices("abcdefgh", k=5))
    base, texts = [word() for _ in range(90)], []
    chain = list(base)
    for i in range(240):
        t = list(base if i % 3 else chain)
        for _ in range(r.choice([1, 2, 3, 5, 8])):
            t[r.randrange(len(t))] = word()
        if i % 3 == 0:
            chain = t
        texts.append(" ".join(t))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{tuple(w[k : k + 4]) for k in range(len(w) - 3)} for w in map(str.split, texts)]
    low = list(range(len(texts)))

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            k = len(a & sets[j])
            if 100 * k >= 80 * (len(a) + len(sets[j]) - k):
                x, y = sorted((find(i), find(j)))
                low[y] = x
    assert len({find(i) for i in range(240)}) > 30  # some texts of the group stay alone
    for tile in (256, 7):  # one tile, and many that are compared across
        monkeypatch.setattr(minhash, "TILE", tile)
        got = {x["doc_id"]: x["component_id"] for x in minhash.near_duplicates(df, k=4).collect()}
        assert got == {i: find(i) for i in range(240)}


def test_deduplicated_keeps_columns_of_any_name(spark):
    names = ["set_key", "bands", "class", "bucket", "root", "component_id", "kept", "n_shingles"]
    rows = [(i, "the same seven words are in here", *[f"{n}{i}" for n in names]) for i in range(3)] + [(9, None, *[None] * len(names))]
    df = spark.createDataFrame(rows, ", ".join(["doc_id long, text string", *[f"`{n}` string" for n in names]]))
    got = minhash.deduplicated(df)
    assert got.columns == df.columns and sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [rows[0], rows[3]]))


def test_deduplicated_decides_by_row(spark):
    a, b, c = "one text of its own kind", "two copies of the other text", "a text that has no id"
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(3, b, "x"), (5, a, "x"), (5, b, "x"), (7, c, "x"), (7, c, "x"), (None, b, "x"), (None, "only rows without id", "y"), (None, "only rows without id", "y"), (None, near, "x"), (9, near + " more", "x"), (None, None, "x"), (None, None, "x"), (8, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row0 string")
    got = [tuple(x) for x in minhash.deduplicated(df).collect()]
    want = [rows[0], rows[1], rows[3], rows[6], rows[9], rows[10], rows[11], rows[12]]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert minhash.deduplicated(df.limit(0)).count() == 0


def test_registers_estimate():
    r = np.random.default_rng(4)
    common, a, b = (r.integers(0, 2**64, n, dtype=np.uint64) for n in (800, 100, 100))
    x, y = minhash.sketches([np.unique(np.concatenate([common, a])), np.unique(np.concatenate([common, b]))])
    assert abs((x == y).mean() - 0.8) < 0.15
    assert minhash.registers(np.array([1 << 63, 0], np.uint64)).tolist() == [0, 53 << 10]


def brute_rule(host, path):
    best = None
    for v, h, p in q.URL_ENTRIES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return best or (None, "allow")


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://A.Example.COM/en/77?x", "https://example.net/de/80#y", "http://example.net/de/9", "http://net", "http://xcom/en/", "https://org/es/a/b", "http://a.org?/es/", "http://com/en/", "ftp://x.example.com/en", "a://b://c.com/en/"]
    df = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    for x in url_filter.judge(df, q.URL_ENTRIES).collect():
        u = urls[x["page_id"]] or ""
        rest = u.split("://", 1)[1] if "://" in u else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        path = rest[cut:].split("?")[0].split("#")[0]
        assert (x["host"], x["path"]) == (rest[:cut].lower(), path)
        assert (x["rule"], x["verdict"]) == brute_rule(x["host"], x["path"])
    assert url_filter.judge(df.limit(0), q.URL_ENTRIES).count() == 0


def test_url_table_judges_like_the_trie(spark):
    r = random.Random(7)
    hosts = ["com", "a.com", "B.a.com", "net", "x.net", ""]
    entries = [(r.choice(["allow", "block"]), r.choice(hosts), r.choice(["", "/"]) + "/".join(r.choices(["a", "ab", "7"], k=r.randint(0, 3)))) for _ in range(60)]
    urls = [f"http://{r.choice(['c.', ''])}{r.choice(hosts)}/" + "/".join(r.choices(["a", "abc", "77", "x"], k=r.randint(0, 4))) for _ in range(300)] + [None, "", "x"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = spark.createDataFrame(entries, "verdict string, host string, path string")
    got = sorted(map(str, url_filter.judge_by_table(df, table).collect()))
    assert got == sorted(map(str, url_filter.judge(df, entries).collect())) and len(got) == 303
    assert url_filter.judge_by_table(df, table.limit(0)).where("rule is null and verdict = 'allow'").count() == 303


PAGE = "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=x>Home</a></li><li><a href=x>News</a></li></ul></nav><div class='cookie-notice'><p>We use cookies</p><button>Accept</button></div><article><h1>Head &amp; line</h1><p><b>First  para&nbsp;graph<br>goes on<p>Second one, of the article.</p><script>var t='</p>'</script></article><aside class=related><a href=y>Most read</a></aside><div class='comments'><p>Ann says great article thanks</p></div><footer>&copy; site</footer></body></html>"


@pytest.fixture(scope="module")
def labeller(spark, data):
    return html_text.train_labeller(spark.read.parquet(f"{data}/pages.parquet"))


def test_blocks_end_where_html_ends_them():
    got = [b.text for b in html_text.blocks("<p>a<b>b</b> c<p>d<ul><li>e<li>f</ul>g<!-- x --><h2>h")]
    assert got == ["ab c", "d", "e", "f", "g", "h"]


@pytest.mark.parametrize("piece", ["<a ", "<script ", "<div>x", "<p>x", "<", "<!--", "</b>", "<b>", '<a "', "<a '\">", "<svg>", "<noscript>", "<b><p>", "<li>", '<a href="<">', "&amp;"])
def test_malformed_pages_take_linear_time(piece):
    import time

    start = time.process_time()
    for end in ("", "'>", '">'):
        html_text.blocks(piece * ((1 << 20) // len(piece)) + end)
    assert time.process_time() - start < 30  # a few seconds; hours if it grew with the square


def test_ends_of_tags_equal_a_search_for_each():
    import random
    import re

    whole = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>")
    r = random.Random(4)
    for _ in range(300):
        text, known = "".join(r.choices("<>\"' a", [2, 2, 1, 1, 1, 1], k=r.randrange(60))), {}
        for at in r.sample(range(len(text) + 1), len(text) + 1):
            want = whole.match(text, at)
            assert html_text.far_end(text, at, known) == (want.end() if want else -1)
    # the same tag is cut alike at the start of a page and after a megabyte of tags whose quotes stay open
    tag, many = "<a title='1 < 2 > 0'>x</a>", "<i t='<'></i><p \"<u>" * 60_000
    assert [b.text for b in html_text.blocks(tag)] == ["x"] and html_text.blocks(many + tag)[-1].text == "x"


def test_paths_count_every_word_however_deep():
    model = html_text.Labeller()
    names = [f"{a}{b}" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrst"]  # 520 classes, one in another
    html = "".join(f"<div class={n}>{n}" for n in names) + "</div>" * 300 + "<section>tail</section>"
    got = model.inputs(html_text.described([html_text.blocks(html)])[0])[:, : html_text.TAG_SIZE]
    paths = [[w for n in names[: i + 1] for w in ("div", "." + n)] for i in range(520)]
    paths.append([w for n in names[:220] for w in ("div", "." + n)] + ["section"])
    want = np.array([model.p["tags"][[html_text._slot(w) for w in p]].mean(axis=0) for p in paths])
    assert len(got) == 521 and np.allclose(got, want)
    deep = html_text.blocks("<div class=q>x" * 100_000)
    assert len(deep) == 100_000 and sum(len(b.turns) for b in deep) == 200_000
    assert np.isfinite(model.inputs(html_text.described([deep])[0])).all()


def test_gradients_of_paths_equal_differences():
    model = html_text.Labeller()
    page = html_text.blocks("<div class=a><p>one<p>two <b>x</b></div><ul class=b><li>three<li>four</ul>five")
    s, y = html_text.described([page])[0], np.array([1, 0, 1, 0, 1], bool)

    def loss() -> float:
        x, mask = model.padded([model.inputs(s)])
        z = (np.concatenate([model._run(x, mask, k)[0] for k in "fb"], axis=2) @ model.p["out"] + model.p["bias"])[:, 0]
        return float(np.sum(np.logaddexp(0, z) - y * z) / len(y) * 20)

    got = model._gradients([s], [y])["tags"]
    for slot in {html_text._slot(w) for w in ("div", ".a", "p", "b", "ul", "li")}:
        model.p["tags"][slot, 3] += 1e-5
        up = loss()
        model.p["tags"][slot, 3] -= 2e-5
        down = loss()
        model.p["tags"][slot, 3] += 1e-5
        assert abs((up - down) / 2e-5 - got[slot, 3]) < 1e-4


def test_text_of_odd_markup():
    text = lambda h: [b.text for b in html_text.blocks(h)]
    assert text("<p>one <svg class=i/></p><p>two</p><object-card>x</object-card> <3 thanks") == ["one", "two", "x <3 thanks"]
    assert text("a <svg>hid</svg>b<noscript>c<p>d<!-->e<a title='x > y < z'>f</a><div class='") == ["a bc", "def"]
    assert text("a<script>x</scripty>y</script >b<style>p{}") == ["ab"] and text("1 < 2 <") == ["1 < 2 <"]


def test_both_directions_are_read_as_in_training():
    model = html_text.Labeller()
    pages = [html_text.described([html_text.blocks(h)])[0] for h in html_text.generated(["a", "b", "c d"], 12)]
    x, mask = model.padded([model.inputs(p) for p in pages])
    want = np.concatenate([model._run(x, mask, k)[0] for k in "fb"], axis=2)
    assert np.allclose(model._read(x, mask)[mask], want[mask])


def test_main_text(spark, labeller):
    df = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<p>" * 2000 + "x")], "page_id long, url string, html string")
    got = {x["page_id"]: x for x in html_text.extract(df, labeller).collect()}
    assert got[1]["text"] == "Head & line\nFirst para graph goes on\nSecond one, of the article."
    assert got[1]["n_chars"] == len(got[1]["text"]) and got[2]["text"] == "" and got[3]["n_chars"] == 0
    assert html_text.extract(df.limit(0), labeller).count() == 0


def test_labeller_on_layouts_it_has_not_seen(labeller, spark, data):
    words = sorted({w for r in spark.read.parquet(f"{data}/documents.parquet").limit(50).collect() for w in r["text"].lower().split()})
    pages = [html_text.blocks(h) for h in html_text.generated(words, 150, seed=77)]
    found = labeller.label(html_text.described(pages))
    want = [np.array([b.label for b in p], bool) for p in pages]
    assert (np.concatenate(found) == np.concatenate(want)).mean() > 0.98


def test_labeller_on_layouts_without_names(labeller, spark, data):
    words = sorted({w for r in spark.read.parquet(f"{data}/documents.parquet").limit(50).collect() for w in r["text"].lower().split()})
    made = list(html_text.generated(words, 200, seed=78, plain=1.0))
    assert not any(f"<{t}" in h.replace("<header", "") for h in made for t in ("article", "main", "nav", "aside", "footer"))
    pages = [html_text.blocks(h) for h in made]
    found, want = labeller.label(html_text.described(pages)), [np.array([b.label for b in p], bool) for p in pages]
    assert (np.concatenate(found) == np.concatenate(want)).mean() > 0.92
    page = "<div class=x1><a href=/>Home</a> <a href=/n>News</a></div><div class=x2><h1>On rivers</h1><p>The river rises in the hills, and runs for many miles to the sea.</p><p>In winter it floods the meadows, which farmers like.</p></div><div class=x3>Copyright 2024 Example Media. All rights reserved.</div>"
    got = html_text.extract(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string"), labeller).first()["text"]
    assert got.split("\n") == ["On rivers", "The river rises in the hills, and runs for many miles to the sea.", "In winter it floods the meadows, which farmers like."]


def test_main_text_of_given_pages(labeller, spark, data):
    pages = [html_text.blocks(r["html"]) for r in spark.read.parquet(f"{data}/pages.parquet").collect()]
    found = labeller.label(html_text.described(pages))
    right = [(a == html_text.silver(p)).all() for a, p in zip(found, pages, strict=True)]
    assert np.mean(right) > 0.99


def test_classifier_on_held_out_labels(spark, data):
    docs, labels = (spark.read.parquet(f"{data.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    out = quality_model.score_documents(docs, labels)
    rows = out.where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95 and len(rows) > 50
    assert out.count() == docs.count()
    # labels of held-out rows change nothing
    import pyspark.sql.functions as F

    flipped = labels.withColumn("quality", F.when(quality_model.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in quality_model.score_documents(docs, flipped).collect()}
    assert again == {r["doc_id"]: r["score"] for r in out.collect()}


def test_classifier_edges(spark):
    df = spark.createDataFrame([(None, None, "c"), (1, "", "c"), (2, "a b", "c"), (2, "a b", "c")], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(0 <= r["score"] <= 1 for r in quality_model.score_documents(df, none).collect())
    assert quality_model.keep_good(df, none).columns == df.columns


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_query_equals_sql(spark, data, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    r = con.execute(q.oracle_sql()[name])
    cols = [c[0] for c in r.description]
    df = q.queries()[name](spark, data).select(*cols)
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, r.fetchall()))


def brute_scores(texts, labelled):
    """Scores by density formulas with whole covariance matrices; ``labelled``: (place in texts, label)."""
    x = np.array([quality_model.statistics(t) for t in texts])
    rows, y = np.array([i for i, _ in labelled]), np.array([k for _, k in labelled])
    z = (x - x[rows].mean(axis=0)) / np.maximum(x[rows].std(axis=0), 1e-3)
    d, out = x.shape[1], []
    spread = lambda c: (c - c.mean(axis=0)).T @ (c - c.mean(axis=0))
    pooled = sum(spread(z[rows[y == k]]) for k in (0, 1)) / len(rows)
    for k in (0, 1):
        c = z[rows[y == k]]
        cov = 0.85 * spread(c) / len(c) + 0.15 * pooled
        cov = 0.95 * cov + 0.05 * np.trace(cov) / d * np.eye(d)
        gap = z - c.mean(axis=0)
        out.append(np.log((len(c) + 1) / (len(rows) + 2)) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * (gap * np.linalg.solve(cov, gap.T).T).sum(axis=1))
    return 1 / (1 + np.exp(np.clip(out[0] - out[1], -700, 700)))


def test_scores_equal_brute_force(spark, data):
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    rows, known = docs.select("doc_id", "text").collect(), {r["doc_id"]: r["quality"] for r in labels.collect()}
    learned = [(i, known[r["doc_id"]]) for i, r in enumerate(rows) if known.get(r["doc_id"]) in (0, 1) and zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1]
    want = dict(zip([r["doc_id"] for r in rows], brute_scores([r["text"] for r in rows], learned), strict=True))
    got = {r["doc_id"]: r for r in quality_model.score_documents(docs, labels).collect()}
    assert set(got) == set(want) and all(abs(got[i]["score"] - want[i]) < 1e-6 and got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in want)
    assert {r["doc_id"] for r in quality_model.keep_good(docs, labels).collect()} == {i for i, v in want.items() if v >= 0.5}


def test_pipeline_stages_equal_brute_force(spark, data):
    import collections

    import corpus_pipeline as cp
    import sentencepiece
    from pyspark.sql import functions as F

    from seqtable.llm.scratch import written

    docs = spark.read.parquet(f"{data}/documents.parquet")
    good = written(cp.quality(spark, docs, data))
    # near duplicates: five words, 0.8, one document of each group
    one = written(cp.near_duplicates(spark, good, data))
    rows = good.collect()
    sets = []
    for r in rows:
        w = "".join(c.lower() if c.isascii() else c for c in r["text"] or "").split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    low = list(range(len(rows)))

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            k = len(a & sets[j])
            if k and 100 * k >= 80 * (len(a) + len(sets[j]) - k):
                x, y = find(i), find(j)
                low[max(x, y)] = min(x, y)
    groups = collections.defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r["doc_id"])
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(min(g) for g in groups.values()) and one.count() < good.count()
    assert sorted(map(str, one.collect())) == sorted(str(r) for r in rows if r["doc_id"] in {min(g) for g in groups.values()})
    # pseudonyms: every row stays, only letters and digits change, and only in values that the query reports
    named = written(cp.pseudonyms(spark, one, data))
    before, after = ({r["doc_id"]: r for r in d.collect()} for d in (one, named))
    changed = {r["doc_id"] for r in q.op2_pseudonyms(spark, data).where("n_replaced > 0").collect()}
    keep = lambda t: re.sub(r"[^\W_]", "0", t or "")
    assert set(before) == set(after)
    for i, r in before.items():
        assert keep(r["text"]) == keep(after[i]["text"]) and (r["text"] != after[i]["text"]) == (i in changed)
        assert r.asDict() | {"text": 0} == after[i].asDict() | {"text": 0}
    # mixture: weighted fair queueing of the stage's rows
    mixed = written(cp.mixture(spark, named, data))
    plan = named.select("doc_id", "source", F.expr("size(array_remove(split(coalesce(text, ''), '[ \\\\x09-\\\\x0D]+'), ''))").alias("n"), F.xxhash64(F.lit(q.SEED), "doc_id", "text").alias("h")).collect()
    names = sorted({r["source"] for r in plan}, key=lambda s: (s is None, s or ""))
    size = {s: sum(r["n"] for r in plan if r["source"] == s) for s in names}
    weight, total, full = {s: 1 + i % 3 for i, s in enumerate(names)}, sum(size.values()), set()
    while True:
        rest, w = total - sum(3 * size[s] for s in full), sum(weight[s] for s in names if s not in full)
        above = {s for s in names if s not in full and rest * weight[s] / w > 3 * size[s]}
        if not above:
            break
        full |= above
    target = {s: 3 * size[s] if s in full else rest * weight[s] / w for s in names}
    plays = []
    for s in names:
        cum = 0
        for r in sorted((r for r in plan if r["source"] == s), key=lambda r: (r["h"], r["doc_id"])):
            cum += r["n"]
            plays += [((e * size[s] + cum) / target[s], r["h"], r["doc_id"], r["n"]) for e in range(3) if r["n"]]
    spent, want = 0, collections.Counter()
    for _, _, i, n in sorted(plays):
        spent += n
        if spent > total:
            break
        want[i] += 1
    assert collections.Counter(r["doc_id"] for r in mixed.collect()) == want and mixed.columns == docs.columns
    # piece ids: lossless, varied, and the same rows
    out = cp.piece_ids(spark, mixed, data).collect()
    model = sentencepiece.SentencePieceProcessor(model_file=q.tokenizer_path("piece_bpe_32k.model"))
    from seqtable.llm import pieces

    decode = pieces.PieceEncoder(q.tokenizer_path("piece_bpe_32k.model"), 0.0).decode
    assert collections.Counter(r["doc_id"] for r in out) == want
    assert all(decode(r["piece_ids"]) == (after[r["doc_id"]]["text"] or "") for r in out)
    assert sum(r["piece_ids"] != model.encode(after[r["doc_id"]]["text"] or "") for r in out) > len(out) / 2


def test_pipeline(spark, data):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{data}/documents.parquet")
    out = cp.run(spark, data)
    assert "piece_ids" in out.columns and 0 < out.count()
    good = cp.quality(spark, docs, data)
    assert good.columns == docs.columns and good.count() > 0.75 * docs.count()
    one = cp.near_duplicates(spark, good, data)
    assert one.columns == docs.columns and one.count() <= good.count()
