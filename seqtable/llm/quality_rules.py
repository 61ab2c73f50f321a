"""Quality rules whose cutoffs are chosen from labelled documents with a bound on false rejection.

Each rule compares one document statistic with a cutoff. For every stratum and rule a fixed grid of cutoffs is tested:
with n labelled good documents of which k lie beyond the cutoff, P(Binomial(n, alpha) <= k) is the exact p-value of
"this cutoff rejects more than alpha of the good documents". The cutoffs of a rule are tested in fixed order from loose
to strict, each at delta divided by the number of strata and rules (Bonferroni over these alone), up to the first that
fails; the last certified one is used. Stricter cutoffs reject no fewer documents, so that p-values only rise on the way
and the last certified cutoff is the strictest whose p-value is small enough. The allowance for a document is split evenly over the rules, so that with probability 1 - delta no stratum loses more
than ``max_false_rejection`` of its good documents. A stratum without enough labels gets no cutoff and loses nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import written

BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Rule: (value of the statistics below, cutoffs from loose to strict). A document beyond the cutoff is rejected.
RULES = {
    "symbols": (lambda: F.col("n_symbols") / F.greatest("word_chars", F.lit(1)), [0.9 * 0.9**i for i in range(40)]),
    "dup_lines": (lambda: F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)), [1 - i / 40 for i in range(1, 40)]),
    "repeats": (lambda: F.col("n_repeat_words") / F.greatest("n_words", F.lit(1)), [0.5 - i / 80 for i in range(40)]),
    "word_length": (lambda: F.col("word_chars") / F.greatest("n_words", F.lit(1)), [40.0 - i for i in range(35)]),
}


def words(text: Column) -> Column:
    """The words of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK), "")


def statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long) of each whole text.

    Null and empty texts have zeros. The words of a text stay in its own row: no shuffle, no cut. Repeated windows are
    told by 64-bit hashes of their words.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(*keep, t.alias("_t"), words(F.col(text)).alias("_w"))
    base = base.select(
        *keep,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.regexp_replace("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"),
        F.transform(F.array(F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))), lambda a: F.struct(F.size(a).cast("long").alias("n"), (F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("dup")))[0].alias("_l"),
    )
    windows = F.slice(F.transform("_h", lambda x, i: F.struct(F.xxhash64(x, F.get("_h", i + 1), F.get("_h", i + 2)).alias("h"), i.alias("i"))), F.lit(1), F.greatest(F.size("_h") - 2, F.lit(0)))
    names = ["n_words", "word_chars", "n_symbols"]
    sorted_ = base.select(*keep, *names, "_l", F.sort_array(windows).alias("_s"))
    twice = F.transform(F.filter("_s", lambda x, k: F.coalesce(x["h"] == F.get("_s", k + 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get("_s", k - 1)["h"], F.lit(False))), lambda x: x["i"])
    found = sorted_.select(*keep, *names, F.col("_l.n").alias("n_lines"), F.col("_l.dup").alias("n_dup_lines"), twice.alias("_p"))
    covered = F.size(F.array_distinct(F.concat("_p", F.transform("_p", lambda p: p + 1), F.transform("_p", lambda p: p + 2))))
    return found.select(*keep, *names, "n_lines", "n_dup_lines", covered.cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), summed exactly from its logarithmic terms."""
    import math

    step = math.log(p) - math.log1p(-p)
    first = n.cast("double") * math.log1p(-p)
    return F.aggregate(
        F.sequence(F.lit(0).cast("long"), k), F.struct(first.alias("l"), F.lit(0.0).alias("sum")),
        lambda a, i: F.struct((a["l"] + F.when(i < n, F.ln((n - i).cast("double") / (i + 1).cast("double"))).otherwise(0.0) + step).alias("l"), (a["sum"] + F.exp(a["l"])).alias("sum")),
        lambda a: F.least(a["sum"], F.lit(1.0)),
    )


def certified_cutoffs(stats: DataFrame, labels: DataFrame, stratum: Column, max_false_rejection: float = 0.05, delta: float = 0.05) -> DataFrame:
    """(stratum, rule, cutoff, n_good, n_rejected, p_value): the strictest certified cutoff of each stratum and rule.

    ``labels``: (doc_id, quality); rows with quality 1 count, repeated labels of a document once. ``stats`` has doc_id
    and the columns of :func:`statistics`, as a written table since each is read many times. Documents that fail the base checks never reach the rules and aren't counted.
    Strata without certified cutoff have no row. Null strata form a stratum of their own.
    """
    alpha = max_false_rejection / len(RULES)
    good = labels.where("quality = 1").select("doc_id").distinct()
    held = stats.where(~base_failed()).join(good, "doc_id", "left_semi").select(stratum.alias("stratum"), *[F.size(F.filter(F.array(*[value() > float(c) for c in cuts]), lambda x: x)).alias(rule) for rule, (value, cuts) in RULES.items()])
    # a value beyond i of the cutoffs (loose to strict) is beyond exactly the last i of them
    long = held.select("stratum", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("beyond")) for r in RULES])).alias("x")).select("stratum", "x.*")
    counted = long.groupBy("stratum", "rule", "beyond").count()
    grid = F.explode(F.filter(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(len(c) - i).alias("at_least"), F.lit(float(x)).alias("cutoff")) for r, (_, c) in RULES.items() for i, x in enumerate(c)]), lambda g: g["rule"] == F.col("rule")))
    # at most one entry for each cutoff
    sums = written(counted.groupBy("stratum", "rule").agg(F.sum("count").alias("n_good"), F.collect_list(F.struct("beyond", "count")).alias("hist")))
    level = delta / max(1, sums.count())  # one sequence of tests for each stratum and rule
    tests = sums.select("stratum", "rule", "n_good", "hist", grid.alias("g")).select("stratum", "rule", "n_good", F.col("g.cutoff").alias("cutoff"), F.aggregate("hist", F.lit(0).cast("long"), lambda a, h: a + F.when(h["beyond"] >= F.col("g.at_least"), h["count"]).otherwise(0)).alias("n_rejected"))
    p = F.when(F.col("n_rejected") <= alpha * F.col("n_good"), binomial_cdf(F.col("n_rejected"), F.col("n_good"), alpha)).otherwise(F.lit(1.0))
    passed = tests.withColumn("p_value", p).where(F.col("p_value") <= level)
    return passed.groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"), F.max("n_good").alias("n_good"), F.max_by("n_rejected", -F.col("cutoff")).alias("n_rejected"), F.max_by("p_value", -F.col("cutoff")).alias("p_value"))


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", max_false_rejection: float = 0.05, delta: float = 0.05) -> DataFrame:
    """One row per document: doc_id, the statistics, base_failed, failed_rules (array) and kept.

    Null or empty texts fail the base check. Without labels only the base check rejects. Repeated rows give repeated
    results, an empty table an empty one; other columns of ``docs`` are ignored.
    """
    stats = written(statistics(docs.withColumn("_stratum", F.col(stratum)), ["doc_id", "_stratum"]))
    cuts = certified_cutoffs(stats, labels, F.col("_stratum"), max_false_rejection, delta)
    # one row for each stratum, with a map from rule to cutoff
    table = cuts.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cuts"))
    met = stats.join(table, stats["_stratum"].eqNullSafe(table["stratum"]), "left")
    failed = F.array_compact(F.array(*[F.when(value() > F.col("cuts")[rule], F.lit(rule)) for rule, (value, _) in RULES.items()]))
    out = met.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), F.coalesce(failed, F.array().cast("array<string>")).alias("failed_rules"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
