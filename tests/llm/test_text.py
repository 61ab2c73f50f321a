import datetime
import hashlib
import random
import string
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from seqtable.llm import mixing, pieces, pii, quality_rules, token_ids
from seqtable.llm.scratch import shared_folder, written

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
TEXTS = [None, "", " ", "one", "a b c d e", "x " * 3000, "Ünï cödé ▁ 日本語 😀\n\n\tz  ", "same text here", "same text here"]


def docs(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "en", "s", None) for i, t in enumerate(texts)], SCHEMA)


def test_block_round_trip():
    r = np.random.default_rng(0)
    blocks = [(r.integers(0, 2**32, n, dtype=np.uint32) >> r.integers(0, 32, n).astype(np.uint32)) for n in (1, 4, 7, 1000)]
    coded = [token_ids.encode_block(b) for b in blocks]
    back = token_ids.decode_block(b"".join(c for c, _ in coded), b"".join(d for _, d in coded), np.array([len(b) for b in blocks]))
    assert (back == np.concatenate(blocks)).all()
    assert len(token_ids.encode_block(np.arange(256))[1]) == 256  # one byte each


def test_token_ids(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    rows = token_ids.digest(docs(spark).withColumn("ids", F.lit("clash")), path).orderBy("doc_id").collect()
    at = 0
    for i, (row, text) in enumerate(zip(rows, TEXTS, strict=True)):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        assert tuple(row) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_words_are_encoded_as_in_whole_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t, encoder = Tokenizer.from_file(path), token_ids.WordEncoder(path)
    hard = "it's Don't 'll x'S. a<|endoftext|>b <|ENDOFTEXT|>. İstanbul. ΣΑΣ, straße! क़ क़. éá. ﬁn; a_b. a.b, a...! 3.5% $3 x² ½. don't.'s a'. (foo) \"bar\" - -- foo-- a/ a\u00a0b 　c \x0bd\x0c ABCé. ÀÉ: aＡ. !!! ...a <|startoftext|>. ǅ. 𝐀b ʰ. naïve### x##y##"
    for text in [hard, hard.upper(), *hard.split(" "), *hard.lower().split()]:
        for _ in range(2):  # the second time from memory
            assert np.frombuffer(encoder([text])[0], "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_token_ids_null_and_repeated_ids_and_empty(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    df = spark.createDataFrame([(None, "a"), (5, "b"), (5, "b c")], "doc_id long, text string")
    rows = token_ids.digest(df, path).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 5, 5] and sum(r["n_tokens"] for r in rows) == 7
    folder = shared_folder(spark)
    token_ids.write_ids(df.limit(0), path, folder)


def test_pieces(spark):
    import sentencepiece

    model = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    plain, varied = pieces.PieceEncoder(model, dropout=0.0), pieces.PieceEncoder(model, dropout=0.3)
    for t in TEXTS:
        if t and "▁" not in t:
            assert plain(t).tolist() == sp.encode(t)
        assert varied.decode(varied(t, 3).tolist()) == (t or "")
    long = "supercalifragilistic " * 40
    assert varied(long, 1).tolist() != plain(long).tolist() and varied(long, 1).tolist() == varied(long, 1).tolist()
    assert varied(long, 1).tolist() != varied(long, 2).tolist()
    clash = dict.fromkeys(["_text", "_key", "_ids", "own0", "OWN1", "ids"], F.lit("mine"))
    enc = pieces.encoded(docs(spark).withColumns(clash).withColumn("piece_ids", F.lit(0)), model)
    assert enc.columns == ["doc_id", "lang", "source", "n_chars", *clash, "piece_ids"]
    back = pieces.decoded(enc, model).collect()
    assert {r["doc_id"]: r["text"] for r in back} == {i: t or "" for i, t in enumerate(TEXTS)} and {r[c] for r in back for c in clash} == {"mine"}
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, piece_ids array<int>")
    assert {r["doc_id"]: r["text"] for r in pieces.decoded(none, model).collect()} == {1: None, 2: ""}
    assert enc.limit(0).count() == 0


def test_pieces_are_varied_at_every_occurrence():
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoder, plain = pieces.PieceEncoder(model, dropout=0.1), pieces.PieceEncoder(model, dropout=0.0)
    scores, r = encoder.scores, random.Random(1)

    def brute(sym):
        never = set()
        while True:
            pairs = [(-scores[x + y], i) for i, (x, y) in enumerate(zip(sym, sym[1:])) if x + y in scores and (sum(map(len, sym[:i])), x + y) not in never]
            if not pairs:
                return tuple(encoder._ids(sym))
            _, i = min(pairs)
            if r.random() < 0.1:
                never.add((sum(map(len, sym[:i])), sym[i] + sym[i + 1]))
            else:
                sym = [*sym[:i], sym[i] + sym[i + 1], *sym[i + 2 :]]

    want = [brute(list("▁international")) for _ in range(4000)]
    got = [tuple(encoder("international", k).tolist()) for k in range(4000)]
    assert len(set(got)) > 20  # two variants of a word gave two
    for x in set(want):
        assert abs(want.count(x) - got.count(x)) < 150
    inside = encoder("international " * 500, 1).tolist()
    assert abs(inside.count(plain("international").tolist()[0]) - want.count(tuple(plain("international").tolist())) / 8) < 60
    # each occurrence has what its own draws give when it is merged alone
    texts = ["the quick international brown fox " * 40, "naïve " + "x" * 40 + " pneumonoultramicroscopicsilicovolcanoconiosis the 日本語", ""] * 3
    for small in (encoder, pieces.PieceEncoder(model, dropout=0.1, remembered=5)):
        got = small.encode_many(texts, list(range(9)))
        for k, (t, ids) in enumerate(zip(texts, got, strict=True)):
            words = encoder._flat(t) if t else []
            want = [i for w, x in zip(words, encoder._places([k], [len(words)]).tolist(), strict=True) for i in encoder.merge(w, encoder._skips(x))[0]]
            assert ids.tolist() == want and encoder.decode(want) == t


PERSONAL = "pay 4111 1111 1111 1111 or 4785380592391139; not 9807915762804490. call +1 (017) 555-7713, mail Ann.34@mail7.example.com from 97.51.17.173 (not 999.1.1.1), born 1987-03-21, ssn 123-45-6789, v2.0"


def luhn(s):
    x = [int(c) for c in re.sub(r"\D", "", s)][::-1]
    return sum(x[::2]) + sum(sum(divmod(2 * v, 10)) for v in x[1::2])


def test_pseudonyms(spark):
    df = docs(spark, [PERSONAL, PERSONAL + " again", None, "", "clean 12 text 3.5"]).withColumn("_0", F.lit("clash"))
    rows = pii.pseudonymise(df, "k", found="n").orderBy("doc_id").collect()
    out = rows[0]["text"]
    assert len(out) == len(PERSONAL) and rows[1]["text"] == out + " again" and rows[0]["_0"] == "clash"
    assert [r["text"] for r in rows[2:]] == [None, "", "clean 12 text 3.5"] and [r["n"] for r in rows] == [7, 7, 0, 0, 0]
    for gone in ("4111 1111 1111 1111", "4785380592391139", "555-7713", "Ann.34@mail7", "97.51.17.173", "1987-03-21", "123-45-6789"):
        assert gone not in out
    assert "9807915762804490" in out and "999.1.1.1" in out
    assert re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "9", out))).replace("9", "") != ""
    card = re.search(r"pay ([\d ]{19})", out)[1]
    assert luhn(card) % 10 == 0 and re.fullmatch(r"\d{4} \d{4} \d{4} \d{4}", card)
    assert pii.pseudonymise(df, "other").where("doc_id = 0").first()["text"] != out
    assert "Python" not in pii.pseudonymise(df, "k")._jdf.queryExecution().toString()


def test_pseudonyms_in_very_long_texts(spark):
    n = 60_000
    texts = ["x@" + "a." * (n // 2) + "!", "a" * n + "@b.com", "1 " * (n // 2), "1" * n, "4111 1111 1111 1111 " * 2000, "a@b." * (n // 4), "x@a.bc " * 5000, "+1 555 123 4567 " * 2000, "1.2.3.4 " * 4000, "+" * n, "1.1." * 9]
    got = pii.pseudonymise(docs(spark, texts), "k", found="n").orderBy("doc_id").collect()
    assert [len(r["text"]) for r in got] == [len(t) for t in texts]
    assert [r["n"] for r in got][4:9] == [2000, 0, 5000, 2000, 4000] and got[0]["n"] == got[1]["n"] == 0


def test_pseudonyms_of_repeated_rows_and_empty_tables(spark):
    df = docs(spark, [PERSONAL, PERSONAL, None])
    rows = pii.pseudonymise(df.union(df), "k", found="n").collect()
    assert len(rows) == 6 and len({r["text"] for r in rows}) == 2
    assert pii.pseudonymise(df.limit(0), "k").columns == df.columns and pii.pseudonymise(df.limit(0), "k").count() == 0


def test_pseudonyms_beside_other_digits(spark):
    card, other = "4111 1111 1111 1111", "4242-4242-4242-4242"
    cases = {  # text: the values that must go, and what must stay
        f"{card} 12/27": ([card], " 12/27"), f"{card} 123": ([card], " 123"), "4111111111111111 5 items": (["4111111111111111"], " 5 items"), f"12 {card}": ([card], "12 "),
        f"1234 {card} 5678": ([card], "1234 "), f"{card} {other}": ([card, other], ""), f"{card} 1987-03-21": ([card, "1987-03-21"], ""), f"{card} 21/03/1987": ([card, "21/03/1987"], ""),
        f"{card} 123-45-6789 7": ([card, "123-45-6789"], " 7"), f"{card} 555-123-4567": ([card, "555-123-4567"], ""), f"{card} 77@mail.com": ([card, "77@mail"], ".com"), f"{card}@x": ([card], "@x"),
        "3782 822463 10005 99": (["3782 822463 10005"], " 99"), "1 2 " * 3000 + card: ([card], ""), f"7  {card}  8": ([card], "7  "),
        "+1 555 123 4567 2024 1234": (["555 123 4567"], " 1234"), "at 2024-01-02T10:00:00Z": (["2024-01-02"], "T10:00:00Z"),
    }
    rows = pii.pseudonymise(docs(spark, list(cases)), "k", found="n").orderBy("doc_id").collect()
    for (text, (gone, stays)), row in zip(cases.items(), rows, strict=True):
        assert len(row["text"]) == len(text) and stays in row["text"], text
        assert not any(g in row["text"] for g in gone), text
        assert row["n"] == len(gone) or text.startswith("1 2 1 2"), text


def test_permutations_are_bijections(spark):
    n = 731
    got = spark.range(n).select(pii.permute_number(F.col("id"), n, "k", "x").alias("p")).agg(F.countDistinct("p"), F.min("p"), F.max("p")).first()
    assert tuple(got) == (n, 0, n - 1)
    s = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("s")).select(pii.permute_chars(F.col("s"), "k", "x", ["0123456789"]).alias("p"))
    assert s.select("p").distinct().count() == 1000


def feistel(cells, key, kind):
    """Cells (x, radix) permuted by the rounds of the network, one number at a time."""
    half = -(-len(cells) // 2)
    left, right = cells[:half], cells[half:]
    for i in range(1, 9):
        other = ",".join(str(x) for x, _ in right)
        left, right = right, [((x + noise(key, kind, i, j, other)) % n, n) for j, (x, n) in enumerate(left)]
    return [x for x, _ in left + right]


def noise(*parts):
    return int(hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()[:8], 16)


def placed(s, key, kind, alphabets):
    own = [next((a for a in alphabets if c in a), None) for c in s]
    new = iter(feistel([(a.index(c), len(a)) for c, a in zip(s, own, strict=True) if a], key, kind))
    return "".join(a[next(new)] if a else c for c, a in zip(s, own, strict=True))


LOW, UP, DIGITS = string.ascii_lowercase, string.ascii_uppercase, string.digits


def plain_pseudonym(kind, s, key):
    """What stands in the place of ``s``, a value of the kind; itself if it is none by the checks of that kind."""
    d = re.sub(r"\D", "", s)
    if kind == "card":
        if luhn(s) % 10:
            return s
        head = placed(d[:-1], key, "card", [DIGITS])
        new = iter(head + next(c for c in DIGITS if luhn(head + c) % 10 == 0))
        return "".join(next(new) if c.isdigit() else c for c in s)
    if kind == "date":
        form = "%Y-%m-%d" if s[4] == "-" else f"%d{s[2]}%m{s[2]}%Y"
        first = datetime.date(1900, 1, 1)
        try:
            day = (datetime.datetime.strptime(s, form).date() - first).days
        except ValueError:
            return s
        span = 73049
        if not 0 <= day < span:
            return s
        side = 271  # the least whose square reaches the span
        while True:
            left, right = divmod(day, side)
            for i in range(1, 9):
                left, right = right, (left + noise(key, "date", i, right)) % side
            day = left * side + right
            if day < span:
                return (first + datetime.timedelta(day)).strftime(form)
    if kind == "ip":
        part = s.split(".")
        if any(int(x) > 255 or (len(x) > 1 and x[0] == "0") for x in part):
            return s
        low, size = ([{1: k[0], 2: k[1], 3: k[2]}[len(x)] for x in part] for k in ((0, 10, 100), (10, 90, 156)))
        return ".".join(str(o + x) for o, x in zip(low, feistel([(int(x) - o, n) for x, o, n in zip(part, low, size, strict=True)], key, "ip"), strict=True))
    if kind == "email":
        local, domain = s.split("@")
        head, last = domain.rsplit(".", 1)
        return placed(local, key, "local", [LOW, UP, DIGITS]) + "@" + placed(head + ".", key, "domain", [LOW, UP, DIGITS]) + last
    if kind == "national" and (s[:3] in ("000", "666") or s[0] == "9" or s[4:6] == "00" or s[7:] == "0000"):
        return s
    return placed(s, key, kind, [DIGITS, "abcdef", "ABCDEF"])


def test_pseudonyms_equal_a_plain_network(spark):
    r = random.Random(17)
    digits = lambda n: "".join(r.choices(DIGITS, k=n))

    def card():
        d = digits(15)
        d += next(c for c in DIGITS if luhn(d + c) % 10 == 0) if r.random() < 0.8 else r.choice(DIGITS)
        return r.choice([d, " ".join(d[i : i + 4] for i in (0, 4, 8, 12)), "-".join(d[i : i + 4] for i in (0, 4, 8, 12))])

    def date():
        y, m, d = r.choice([1899, 1900, 1987, 2024, 2099, 2100]), r.randint(1, 13), r.randint(1, 31)
        return r.choice([f"{y}-{m:02}-{d:02}", f"{d:02}.{m:02}.{y}", f"{d:02}/{m:02}/{y}"])

    make = {
        "card": card, "date": date, "ip": lambda: ".".join(str(r.choice([r.randint(0, 9), r.randint(10, 99), r.randint(100, 270)])) for _ in range(4)),
        "email": lambda: "".join(r.choices(LOW + UP + DIGITS + "._+", k=r.randint(1, 12))) + "@" + ".".join("".join(r.choices(LOW + DIGITS, k=r.randint(1, 6))) for _ in range(r.randint(1, 3))) + r.choice([".com", ".de", ".Org"]),
        "national": lambda: f"{r.choice(['000', '666', '900', digits(3), digits(3)])}-{r.choice(['00', digits(2)])}-{digits(4)}",
        "phone": lambda: r.choice([f"+{r.randint(1, 99)} ({digits(3)}) {digits(3)}-{digits(4)}", f"({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}.{digits(3)}.{digits(4)}", f"+1{digits(10)}"]),
        "secret": lambda: "".join(r.choices(DIGITS + r.choice(["abcdef", "ABCDEF", "abcdefABCDEF"]), k=r.choice([32, 40, 64]))),
    }
    texts, want = [], []
    for _ in range(150):
        found = [(k, make[k]()) for k in r.choices(list(make), k=r.randint(1, 6))]
        gaps = [r.choice([" and ", ", see ", "\n", " (of) "]) for _ in found]
        texts.append("word" + "".join(g + v for g, (_, v) in zip(gaps, found, strict=True)) + " end")
        new = [plain_pseudonym(k, v, "key") for k, v in found]
        want.append(("word" + "".join(g + v for g, v in zip(gaps, new, strict=True)) + " end", sum(n != v for n, (_, v) in zip(new, found, strict=True))))
    got = pii.pseudonymise(docs(spark, texts), "key", found="n").orderBy("doc_id").collect()
    for text, row, (new, n) in zip(texts, got, want, strict=True):
        assert (row["text"], row["n"]) == (new, n), text


def brute_statistics(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    c = {}
    for i in range(len(w) - 2):
        c.setdefault(tuple(w[i : i + 3]), []).append(i)
    pos = {i + k for v in c.values() if len(v) > 1 for i in v for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines), len(lines) - len(set(lines)), len(pos)


def test_statistics(spark, data):
    r = random.Random(1)
    texts = TEXTS + [" ".join(r.choices(["a", "b", "c#", "d\n"], k=r.randint(0, 60))) for _ in range(50)] + ["a b c a b c a b", "x\n\nx\n y\nx"]
    got = quality_rules.statistics(docs(spark, texts), ["doc_id"]).orderBy("doc_id").collect()
    assert [tuple(x)[1:] for x in got] == [brute_statistics(t) for t in texts]


def test_binomial(spark):
    from math import comb

    for k, n, p in ((0, 10, 0.1), (3, 40, 0.05), (40, 40, 0.05), (30, 500, 0.05)):
        want = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        got = spark.createDataFrame([(k, n)], "k long, n long").select(quality_rules.binomial_cdf(F.col("k"), F.col("n"), p)).first()[0]
        assert got == pytest.approx(want, rel=1e-9)


def test_rules_bound_false_rejection(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(60)) + (" ###" if i % 400 == 0 else ""), "en", "s", None) for i in range(1500)]
    rows += [(2000 + i, " ".join(f"w{i}y{j}###" for j in range(60)), "en", "s", None) for i in range(50)]
    labels = spark.createDataFrame([(i, 1) for i in range(1500)] + [(0, 1), (7, None)], "doc_id long, quality int")
    df = spark.createDataFrame(rows, SCHEMA)
    out = quality_rules.judge(df, labels)
    kept = {r["doc_id"] for r in out.where("kept").collect()}
    assert sum(i not in kept for i in range(1500)) <= 75 and not any(2000 + i in kept for i in range(50))
    # without labels nothing but the base checks rejects
    assert quality_rules.judge(df, labels.limit(0)).where("kept").count() == 1550
    assert quality_rules.judge(df.limit(0), labels).count() == 0


def test_cutoffs_equal_brute_force(spark):
    from math import comb

    r = random.Random(8)
    rows = [(i, " ".join(f"w{r.randrange(60) if r.random() < 0.1 else j}{'#' if r.random() < 0.02 * (i % 5) else 'x' * (i % 7)}" for j in range(r.randint(40, 90))), r.choice(["en", "en", "de", None]), "s", None) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 9 > 0)) for i in range(3000)], "doc_id long, quality int")
    stats = written(quality_rules.statistics(df, ["doc_id", "lang"]))
    got = {(x["stratum"], x["rule"]): (round(x["cutoff"], 9), x["n_good"], x["n_rejected"]) for x in quality_rules.certified_cutoffs(stats, labels, F.col("lang")).collect()}
    value = {"symbols": lambda x: x["n_symbols"] / max(1, x["word_chars"]), "dup_lines": lambda x: x["n_dup_lines"] / max(1, x["n_lines"]), "repeats": lambda x: x["n_repeat_words"] / max(1, x["n_words"]), "word_length": lambda x: x["word_chars"] / max(1, x["n_words"])}
    good = [x for x in stats.collect() if x["doc_id"] % 9 and x["n_words"] >= 50 and 2 * x["n_repeat_words"] <= x["n_words"]]
    want = {}
    for s in ("en", "de", None):
        own = [x for x in good if x["lang"] == s]
        for rule, (_, grid) in quality_rules.RULES.items():
            for c in grid:  # from loose to strict, up to the first failure
                k = sum(value[rule](x) > c for x in own)
                if sum(comb(len(own), i) * 0.0125**i * 0.9875 ** (len(own) - i) for i in range(k + 1)) > 0.05 / 12:
                    break
                want[s, rule] = (round(c, 9), len(own), k)
    assert got == want and len({s for s, _ in got}) == 3 and any(k for *_, k in got.values())
    out = quality_rules.judge(df, labels).collect()
    for x, y in zip(sorted(out, key=lambda x: x["doc_id"]), sorted(stats.collect(), key=lambda x: x["doc_id"]), strict=True):
        assert x["failed_rules"] == [rule for rule in value if value[rule](y) > got[y["lang"], rule][0] + 1e-12]


def brute_targets(sizes, weights):
    total, cap = sum(sizes), [3 * s for s in sizes]
    target, fixed = [0.0] * len(sizes), [False] * len(sizes)
    while True:
        rest = total - sum(c for c, f in zip(cap, fixed) if f)
        w = sum(x for x, f in zip(weights, fixed) if not f)
        target = [c if f else rest * x / w for c, f, x in zip(cap, fixed, weights)]
        above = [not f and t > c for t, c, f in zip(target, cap, fixed)]
        if not any(above):
            return target
        fixed = [f or a for f, a in zip(fixed, above)]


def test_mixing(spark):
    r = random.Random(2)
    rows = [(i, "w " * r.randint(0, 30), "en", r.choice(["b", "a", "c", "tiny" if i % 40 == 0 else "a", None]), None) for i in range(600)] + [(600, None, "en", "z", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mix(df).collect()
    sizes = {}
    for x in out:
        sizes[x["source"]] = sizes.get(x["source"], 0) + x["size"]
    names = sorted((s for s in sizes if s is not None)) + [None]
    want = dict(zip(names, brute_targets([sizes[s] for s in names], [1 + i % 3 for i in range(len(names))]), strict=True))
    for x in out:
        assert x["target"] == pytest.approx(want[x["source"]]) and x["taken"] <= 3 * x["size"] and x["source_size"] == sizes[x["source"]]
    for s in names:
        assert abs(sum(x["taken"] for x in out if x["source"] == s) - want[s]) <= 60
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix(df.repartition(7)).collect()))
    taken = mixing.mixed_documents(df)
    assert taken.count() == sum(x["n_taken"] for x in out) and taken.columns == df.columns
    assert mixing.mix(df.limit(0)).count() == 0
    twice = df.where("doc_id < 5").unionByName(df.where("doc_id < 5"))
    assert mixing.mix(twice).count() == 10


def test_mixing_order_and_cut(spark):
    r = random.Random(4)
    rows = [(r.choice([i, i, None]), "w " * r.randint(0, 30), "en", r.choice(["b", "a", "c", "a", None]), i) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mix(df, seed=5, keep=("n_chars",)).collect()
    h = {x["n_chars"]: x["h"] for x in df.select("n_chars", F.xxhash64(F.lit(5), "doc_id", "text").alias("h")).collect()}
    size = {x["n_chars"]: x["size"] for x in out}
    low = lambda v: (v is not None, v or 0)
    plays = []
    for s in {x["source"] for x in out}:
        own, cum = sorted((x for x in out if x["source"] == s), key=lambda x: (h[x["n_chars"]], low(x["doc_id"]), x["size"], x["n_chars"])), 0
        for x in own:
            cum += x["size"]
            plays += [((e * x["source_size"] + cum) / x["target"], h[x["n_chars"]], low(x["doc_id"]), (s is not None, s or ""), e, x["size"], x["n_chars"]) for e in range(3) if x["size"]]
    budget, total, n = sum(size.values()), 0, dict.fromkeys(size, 0)
    for p in sorted(plays):
        total += p[5]
        if total > budget:
            break
        n[p[6]] += 1
    assert {x["n_chars"]: x["n_taken"] for x in out} == n and 250 < sum(n.values())
    clash = df.withColumns(dict.fromkeys(["_key", "_i", "_n", "_g", "row0", "ROW1", "size", "taken", "target"], F.lit("mine")))
    got = mixing.mixed_documents(clash, seed=5)
    assert got.columns == clash.columns and {x[c] for x in got.collect() for c in got.columns[5:]} == {"mine"}
    assert sorted(x["n_chars"] for x in got.collect()) == sorted(k for k, v in n.items() for _ in range(v))


def test_many_words_are_merged_as_one_by_one():
    encoder = pieces.PieceEncoder(public_tokenizers.path("piece_bpe_32k.model"), dropout=0.1)
    r = random.Random(6)
    words = ["▁" * r.randint(0, 2) + "".join(r.choices("etaoinshrdluüé漢", k=r.randint(1, 40))) for _ in range(1500)]
    wanted = [(w, tuple(sorted(r.sample(range(60), r.randint(0, 4))))) for w in words]
    for (w, skips), node in zip(wanted, encoder.merge_many(wanted).tolist(), strict=True):
        ids, steps = encoder.merge(w, skips)
        at = int(encoder.starts[node])
        assert encoder.pool[at : at + int(encoder.sizes[node])].tolist() == ids and encoder.steps[node] == steps
