"""Format-preserving pseudonyms for personal data, in DataFrame expressions only.

Found values are validated, then permuted within their own format by a keyed Feistel network, so that equal values
get equal pseudonyms in every document and row order never matters:

* card and account numbers (13 to 19 digits, Luhn-valid): all digits but the last are permuted, the check digit is
  recomputed; numbers that fail the checksum are not personal data and stay. Among neighbouring numbers, the printed
  groupings are looked for first, then other runs of groups of 3 to 7 digits, and runs from either end;
* phone numbers (8 to 15 digits after ``+``, or the 3-3-4 form), national ids (3-2-4 form with a valid area, group and
  serial): digits permuted, punctuation kept;
* IPv4 addresses (each part at most 255): parts permuted among those of as many digits;
* calendar dates (``yyyy-mm-dd``, ``dd.mm.yyyy``, ``dd/mm/yyyy``, 1900 to 2099): permuted as day numbers;
* e-mail addresses (at most 64 characters before the ``@``, names of at most 63, as mail allows): letters and digits of
  the local part and of the domain (all but its last label) permuted, so that
  equal domains stay equal;
* hexadecimal secrets of 32, 40 or 64 digits: permuted as hexadecimal digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
AT_MOST_15 = r"(?<!" + r"\d[ .()-]{0,2}" * 15 + r"\d)"  # digits behind, as far as a plus sign
#: Patterns of candidate values; each is bounded by look-arounds so that no part of a longer run matches. Groups are
#: repeated a bounded number of times, since Java's matcher takes stack for each.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.){1,126}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)" + AT_MOST_15 + r"|(?<![\w.+-])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?![\w-])",
    "national": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "date": r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4})(?:(?=T\d)|(?![\w/-]|\.\d))",
    "ip": r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\w]|\.\d)",
    # numbers side by side, from one with 13 digits at single separators on; not the first digits of a date or an address
    "card": r"(?<![\w.+-])(?=\d(?:[ -]?\d){12})\d[\d -]*\d(?!\w|[-.]\d|/\d\d/\d{4}(?![\w/]))(?:(?!@)|(?<=\b\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\b\d{4}[ -]\d{6}[ -]\d{5}|\b\d{13,19}))",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-fA-F]{64}|[0-9a-fA-F]{40}|[0-9a-fA-F]{32})(?![0-9A-Za-z])",
}
#: Without e-mail addresses every value starts with one of few characters, which is tested first.
NUMBERS = r"(?=[0-9+(a-fA-F])(?:" + "|".join(v for k, v in PATTERNS.items() if k != "email") + ")"
FOUND = PATTERNS["email"] + "|" + NUMBERS
#: What ends a card among numbers side by side: values of other kinds, and wider gaps.
BESIDE = "|".join([*(PATTERNS[k] for k in ("phone", "national", "date")), "[ -]{2,}"])
FIRST_DAY, LAST_DAY = "1900-01-01", "2099-12-31"
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _noise(key: str, kind: str | Column, *parts: Column) -> Column:
    """A keyed 32-bit number of the parts."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), *[p.cast("string") for p in parts]), 256), 1, 8), 16, 10).cast("long")


def permute_cells(cells: Column, key: str, kind: str | Column) -> Column:
    """A keyed permutation of cells (x, r, o), x within 0 .. r - 1 each; r and o stay in place.

    An alternating Feistel network over the two halves of the cells, with the radix of each cell.
    """

    def round_(state: Column, i: Column) -> Column:
        left, right = state["l"], state["r"]

        def mixed(other: Column) -> Column:
            return F.transform(left, lambda c, j: F.struct(F.pmod(c["x"] + _noise(key, kind, i, j, other), c["r"]).alias("x"), c["r"].alias("r"), c["o"].alias("o")))

        other = F.array_join(F.transform(right, lambda c: c["x"].cast("string")), ",")
        return F.struct(right.alias("l"), _bind(other, mixed).alias("r"))

    def network(c: Column) -> Column:
        half = F.ceil(F.size(c) / 2).cast("int")
        start = F.struct(F.slice(c, F.lit(1), half).alias("l"), F.slice(c, half + 1, F.size(c)).alias("r"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, round_, lambda t: F.concat(t["l"], t["r"]))

    return _bind(cells, network)


def permute_chars(s: Column, key: str, kind: str | Column, alphabets: list[str]) -> Column:
    """Permute the characters of ``s`` that are in one of ``alphabets``, each within its alphabet.

    Other characters stay in place. One character alone is shifted by the key.
    """
    every = "".join(alphabets)
    starts = [sum(map(len, alphabets[:i])) for i in range(len(alphabets))]

    def cell(c: Column) -> Column:
        def of(at: Column) -> Column:
            origin, radix = F.lit(0), F.lit(len(alphabets[0]))
            for b, a in zip(starts[1:], alphabets[1:], strict=True):
                origin, radix = F.when(at >= b, b).otherwise(origin), F.when(at >= b, len(a)).otherwise(radix)
            return F.struct((at - origin).cast("long").alias("x"), radix.cast("long").alias("r"), origin.alias("o"))

        return _bind(F.instr(F.lit(every), c) - 1, of)

    def filled(parts: Column, done: Column) -> Column:
        """The characters in their places, taken from ``done`` where they were permuted."""

        def put(acc: Column, c: Column) -> Column:
            own = F.instr(F.lit(every), c) > 0
            new = F.when(own, F.substring(F.lit(every), (F.get(done, acc["at"])["o"] + F.get(done, acc["at"])["x"] + 1).cast("int"), F.lit(1))).otherwise(c)
            return F.struct(F.concat(acc["s"], new).alias("s"), (acc["at"] + own.cast("int")).alias("at"))

        return F.aggregate(parts, F.struct(F.lit("").alias("s"), F.lit(0).alias("at")), put, lambda acc: acc["s"])

    def permuted(parts: Column) -> Column:
        cells = F.transform(F.filter(parts, lambda c: F.instr(F.lit(every), c) > 0), cell)
        return _bind(permute_cells(cells, key, kind), lambda done: filled(parts, done))

    return _bind(F.filter(F.split(s, ""), lambda c: c != ""), permuted)


def permute_number(x: Column, bound: int, key: str, kind: str) -> Column:
    """A keyed permutation of 0 .. bound - 1: Feistel rounds over a square, walked until the result is in range again."""
    side = 1
    while side * side < bound:
        side += 1

    def once(v: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(ROUNDS)), F.struct(F.floor(v / side).cast("long").alias("l"), F.pmod(v, F.lit(side).cast("long")).alias("r")),
            lambda s, i: F.struct(s["r"].alias("l"), F.pmod(s["l"] + _noise(key, kind, i, s["r"]), F.lit(side).cast("long")).alias("r")),
            lambda s: s["l"] * side + s["r"],
        )

    # a square of the next whole side exceeds the bound by little: 64 steps outside it do not occur
    return F.aggregate(F.sequence(F.lit(1), F.lit(64)), F.struct(x.cast("long").alias("v"), F.lit(False).alias("ok")), lambda s, _: F.when(s["ok"], s).otherwise(F.transform(F.array(once(s["v"])), lambda v: F.struct(v.alias("v"), (v < bound).alias("ok")))[0]), lambda s: s["v"])


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column, double_last: bool) -> Column:
    """The Luhn sum; ``double_last`` for a number that still lacks its check digit."""
    shift = 0 if double_last else 1
    return F.aggregate(
        F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when((i + shift) % 2 == 0, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int"))),
        F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)),
    )


def _refill(s: Column, digits: Column) -> Column:
    """Put ``digits`` in the places of the digits of ``s``."""
    return F.aggregate(
        F.filter(F.split(s, ""), lambda c: c != ""), F.struct(F.lit("").alias("s"), F.lit(1).alias("at")),
        lambda a, c: F.when(c.rlike("[0-9]"), F.struct(F.concat(a["s"], F.substr(digits, a["at"], F.lit(1))).alias("s"), (a["at"] + 1).alias("at"))).otherwise(F.struct(F.concat(a["s"], c).alias("s"), a["at"].alias("at"))),
        lambda a: a["s"],
    )


def _card(s: Column, key: str) -> Column:
    def swap(d: Column) -> Column:
        return _bind(permute_chars(F.substr(d, F.lit(1), F.length(d) - 1), key, "card", [_DIGITS]), lambda head: _refill(s, F.concat(head, F.pmod(F.lit(10) - F.pmod(_luhn(head, True), F.lit(10)), F.lit(10)).cast("string"))))

    return _bind(_digits(s), swap)


def _date(s: Column, key: str) -> Column:
    iso = s.rlike(r"^\d{4}-")
    mark = F.substr(s, F.lit(3), F.lit(1))
    day = F.when(iso, F.try_to_date(s, "yyyy-MM-dd")).otherwise(F.try_to_date(F.translate(s, "/", "."), "dd.MM.yyyy"))
    days = (F.to_date(F.lit(LAST_DAY)), F.to_date(F.lit(FIRST_DAY)))
    span = 73049  # days from FIRST_DAY to LAST_DAY, both included

    def swap(d: Column) -> Column:
        new = F.date_add(days[1], permute_number(F.datediff(d, days[1]), span, key, "date").cast("int"))
        return F.when(d.between(days[1], days[0]), F.when(iso, F.date_format(new, "yyyy-MM-dd")).otherwise(F.replace(F.date_format(new, "dd.MM.yyyy"), F.lit("."), mark))).otherwise(s)

    return F.coalesce(_bind(day, swap), s)


def _ip(s: Column, key: str) -> Column:
    part = F.split(s, r"\.")
    # parts of one, two and three digits are permuted among themselves, so that the length stays
    low = lambda n: F.when(n < 10, 0).when(n < 100, 10).otherwise(100)
    size = lambda n: F.when(n < 10, 10).when(n < 100, 90).otherwise(156)
    cells = F.transform(F.transform(part, lambda p: p.cast("int")), lambda n: F.struct((n - low(n)).cast("long").alias("x"), size(n).cast("long").alias("r"), low(n).alias("o")))
    new = F.array_join(F.transform(permute_cells(cells, key, "ip"), lambda c: (c["o"] + c["x"]).cast("string")), ".")
    return F.when(F.forall(part, lambda p: (p.cast("int") <= 255) & ((F.length(p) == 1) | ~p.startswith("0"))), new).otherwise(s)


def _email(s: Column, key: str) -> Column:
    local, domain = F.substring_index(s, "@", 1), F.substring_index(s, "@", -1)
    last = F.substring_index(domain, ".", -1)
    head = F.substr(domain, F.lit(1), F.length(domain) - F.length(last))
    sides = F.array(F.struct(F.lit("local").alias("kind"), local.alias("s")), F.struct(F.lit("domain").alias("kind"), head.alias("s")))
    new = F.transform(sides, lambda x: permute_chars(x["s"], key, x["kind"], [_LOWER, _UPPER, _DIGITS]))
    return F.concat(F.array_join(new, "@"), last)


def _cards(s: Column, key: str) -> Column:
    """(s, n): numbers at single separators with the n card numbers among them replaced."""

    def among(tokens: Column, gaps: Column) -> Column:
        last = F.size(tokens) - 1

        def candidate(i: Column, j: Column) -> Column:
            part = F.slice(tokens, i + 1, j - i + 1)
            sizes = F.array_join(F.transform(part, lambda x: F.length(x).cast("string")), " ")
            known = sizes.isin("4 4 4 4", "4 6 5") | (i == j)
            usual = known | (i == 0) | (j == last) | F.forall(part, lambda x: F.length(x).between(3, 7))
            d = F.array_join(part, "")
            return F.struct(F.when(known, 0).otherwise(1).alias("rank"), (-F.length(d)).alias("short"), i.alias("i"), j.alias("j"), F.when(usual, d).alias("d"))

        # a run of more than 19 numbers has more than 19 digits
        every = F.flatten(F.transform(F.sequence(F.lit(0), last), lambda i: F.filter(F.transform(F.sequence(i, F.least(i + 18, last)), lambda j: candidate(i, j)), lambda c: (-c["short"]).between(13, 19) & c["d"].isNotNull())))
        valid = F.array_sort(F.filter(every, lambda c: F.pmod(_luhn(c["d"], False), F.lit(10)) == 0))
        taken = F.aggregate(
            F.transform(valid, lambda c: F.struct(c["i"].alias("i"), c["j"].alias("j"))), F.expr("cast(array() as array<struct<i: int, j: int>>)"),
            lambda t, c: F.when(F.exists(t, lambda x: (x["i"] <= c["j"]) & (c["i"] <= x["j"])), t).otherwise(F.concat(t, F.array(c))),
        )

        def replaced(t: Column) -> Column:
            def at(k: Column) -> Column:
                own = F.get(F.filter(t, lambda x: (x["i"] <= k) & (k <= x["j"])), F.lit(0))

                def written(x: Column) -> Column:
                    run = F.array_join(F.transform(F.sequence(x["i"], x["j"]), lambda m: F.concat(F.when(m == x["i"], "").otherwise(F.get(gaps, m)), F.get(tokens, m))), "")
                    return F.concat(F.get(gaps, k), _bind(run, lambda r: _card(r, key)))

                return F.when(own.isNull(), F.concat(F.get(gaps, k), F.get(tokens, k))).when(own["i"] == k, _bind(own, written)).otherwise("")

            return F.struct(F.concat(F.array_join(F.transform(F.sequence(F.lit(0), last), at), ""), F.get(gaps, last + 1)).alias("s"), F.size(t).cast("long").alias("n"))

        return _bind(taken, replaced)

    whole = F.length(_digits(s)) >= 13
    return F.when(whole, _bind(F.regexp_extract_all(s, F.lit("[0-9]+"), F.lit(0)), lambda t: _bind(F.split(s, "[0-9]+", -1), lambda g: among(t, g)))).otherwise(F.struct(s.alias("s"), F.lit(0).cast("long").alias("n")))


def _single(s: Column, key: str) -> Column:
    """The pseudonym of a value that is no card, or the value itself if it fails validation."""
    whole = {k: f"^(?:{v})$" for k, v in PATTERNS.items()}
    kind = (
        F.when(F.instr(s, "@") > 0, "email")
        .when(s.rlike(whole["secret"]) & ~s.rlike("^[0-9]+$"), "secret")
        .when(s.rlike(whole["national"]), F.when(~s.rlike(r"^(000|666|9)|-00-|-0000$"), "national"))
        .when(s.rlike(whole["date"]), "date")
        .when(s.rlike(whole["ip"]), "ip")
        .when(s.rlike(whole["phone"]) & F.length(_digits(s)).between(8, 15), "phone")
    )

    def of(k: Column) -> Column:
        # one network for all that have digits, or hexadecimal ones, in their own places
        placed = permute_chars(s, key, k, [_DIGITS, "abcdef", "ABCDEF"])
        return F.when(k == "email", _email(s, key)).when(k == "date", _date(s, key)).when(k == "ip", _ip(s, key)).when(k.isNotNull(), placed).otherwise(s)

    return _bind(kind, of)


def pseudonym(s: Column, key: str) -> Column:
    """(s, n): one found value with the n valid ones in it replaced; itself if it fails validation.

    Numbers side by side are cut at the values of other kinds among them, between which cards are looked for; any other
    value stands alone, between two empty texts.
    """
    side = s.rlike("^[0-9 -]+$") & (F.length(_digits(s)) >= 13)

    def both(alone: Column) -> Column:
        between = F.when(alone, F.array(F.lit(""), F.lit(""))).otherwise(F.split(s, BESIDE, -1))
        values = F.when(alone, F.array(s)).otherwise(F.regexp_extract_all(s, F.lit(BESIDE), F.lit(0)))
        gaps = F.transform(between, lambda p: _cards(p, key))
        others = F.transform(values, lambda m: _bind(_single(m, key), lambda p: F.struct(p.alias("s"), (p != m).cast("long").alias("n"))))
        nothing = F.struct(F.lit("").alias("s"), F.lit(0).cast("long").alias("n"))
        return F.flatten(F.zip_with(gaps, F.concat(others, F.array(nothing)), lambda a, b: F.array(a, b)))

    return _bind(_bind(~side, both), lambda x: F.struct(F.array_join(F.transform(x, lambda y: y["s"]), "").alias("s"), F.aggregate(x, F.lit(0).cast("long"), lambda n, y: n + y["n"]).alias("n")))


def pseudonymise(docs: DataFrame, key: str, text: str = "text", found: str | None = None) -> DataFrame:
    """``docs`` with every validated personal value in ``text`` replaced; ``found`` names an added count of changed values.

    Null texts stay null (count 0), empty ones empty; texts of any length are searched whole. Other columns, whatever
    their names, and repeated rows are untouched. The same ``key`` gives the same pseudonyms in every run.
    """
    free = iter(f"_{i}" for i in range(len(docs.columns) + 9))
    hits, fresh = [next(n for n in free if n not in docs.columns) for _ in range(2)]
    t = F.col(f"`{text}`")
    mail = F.instr(t, "@") > 0
    hit = F.when(t.rlike("[0-9@]"), F.when(mail, F.regexp_extract_all(t, F.lit(FOUND), F.lit(0))).otherwise(F.regexp_extract_all(t, F.lit(NUMBERS), F.lit(0))))
    some = F.size(F.coalesce(F.col(hits), F.array())) > 0
    # each array is a column of its own, so that the searches and permutations run once
    with_hits = docs.withColumn(hits, hit).withColumn(fresh, F.when(some, F.transform(F.col(hits), lambda m: pseudonym(m, key))))
    pieces = F.when(mail, F.split(t, FOUND, -1)).otherwise(F.split(t, NUMBERS, -1))
    ends = F.concat(F.transform(F.col(fresh), lambda x: x["s"]), F.array(F.lit("")))
    joined = F.array_join(F.flatten(F.zip_with(pieces, ends, lambda p, n: F.array(p, n))), "")
    changed = F.aggregate(F.col(fresh), F.lit(0).cast("long"), lambda n, x: n + x["n"])
    new = {text: F.when(some, joined).otherwise(t)} | ({found: F.when(some, changed).otherwise(F.lit(0).cast("long"))} if found else {})
    return with_hits.withColumns(new).drop(hits, fresh)
