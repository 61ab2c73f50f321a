"""Spelling variants: words one edit apart, found in tries of letter-group counts, and the form that each stands for.

The letters are put into groups; a word is described by its length and by how many of its letters fall into each group.
One insertion raises one count, one replacement raises one and lowers another (or none, within a group). So words
arranged in a trie by successive counts are searched depth first with a budget of one surplus and one deficit, and only
the words of the leaves reached are compared letter by letter.

The first levels of the trie deal the words out: a word is stored below its own first counts and asks below all that the
budget allows. Each part is one small trie, in a task of its own. There are as many first levels as keep the largest
part small; what is large even then (words with the same counts) is cut into tiles by hash.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import probe
from .scratch import discard, written

#: Letters that count together; the last group takes all others. Frequent letters stand alone and come first.
GROUPS = ("e", "n", "a", "t", "i", "r", "s", "o", "hc", "dl", "um", "gpb", "fwvk", "yjxqz")
GROUP_OF = np.full(257, len(GROUPS), np.uint8)
for _i, _g in enumerate(GROUPS):
    GROUP_OF[[ord(c) for c in _g]] = _i
#: Words of a part of the trie, about, and of a tile.
PART = 8_000
#: States of the search that are held at a time.
BLOCK = 1 << 18
RUNS = r"[A-Za-zÀ-ÿ]{7,}"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def counted_words(docs: DataFrame, min_length: int = 7, min_count: int = 2, damage_every: int | None = 31) -> DataFrame:
    """(word, n): distinct words of at least ``min_length`` code points and ``min_count`` occurrences over all documents.

    Words are maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case. If ``damage_every``
    divides h, the unsigned crc32 of ``<doc_id>:<word>``, the code point at h modulo the length is left out first.
    Null texts have no words; words of a null doc_id are never damaged. Shorter runs cannot become long enough.
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUNS.replace("7", str(min_length))), F.lit(0))).alias("run"))
    runs = runs.select("doc_id", F.translate("run", UPPER, LOWER).alias("word"))
    if damage_every:
        h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("word")).cast("binary"))
        runs = runs.withColumn("h", F.when(h % damage_every == 0, h))
        at = (F.col("h") % F.length("word")).cast("int")
        cut = F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2))
        runs = runs.select(F.when(F.col("h").isNotNull(), cut).otherwise(F.col("word")).alias("word"))
    return runs.where(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _counts(word: Column) -> list[Column]:
    """The length of a word, then its letters of each group; those of no group are the rest of the length."""
    return [F.length(word), *[F.length(word) - F.length(F.translate(word, g, "")) for g in GROUPS]]


def _moves(levels: int) -> list[tuple[int, ...]]:
    """What one edit from a word to a longer or equal one can add to its length and first ``levels`` counts.

    A surplus is spent before a deficit: the other half of the replacements is found from the other word.
    """
    one = lambda at, by: [by if i == at else 0 for i in range(levels)]
    same = [one(0, 0), *[one(i, 1) for i in range(levels)], *[[x + y for x, y in zip(one(i, 1), one(j, -1), strict=True)] for i, j in itertools.combinations(range(levels), 2)]]
    more = [one(0, 0), *[one(i, 1) for i in range(levels)]]
    return [(0, *m) for m in same] + [(1, *m) for m in more]


class Trie:
    """Words by successive counts: for each level the sorted (node above, count) of its nodes; leaves hold words."""

    WIDE = 1 << 20

    def __init__(self, counts: np.ndarray) -> None:
        order = np.lexsort(counts.T[::-1])
        self.words, counts = order, counts[order]
        self.levels, node = [], np.zeros(len(order), np.int64)
        for level in range(counts.shape[1]):
            keys, node = np.unique(node * self.WIDE + counts[:, level], return_inverse=True)
            self.levels.append(keys)
        self.first = np.searchsorted(node, np.arange(node[-1] + 2)) if len(order) else np.zeros(1, np.int64)

    def leaves(self, asked: np.ndarray):
        """Yields (asked word, stored word) arrays of the leaves that the budget reaches; ``asked``: counts, a row a word.

        At the first level, the length, a stored word may be one longer: then one surplus and no deficit is to be spent.
        """
        n = len(asked)
        for low in range(0, n, BLOCK // 8):
            some = np.arange(low, min(n, low + BLOCK // 8))
            # level, asked word, node, surplus left, deficit left
            zero, one = np.zeros(len(some), np.int64), np.ones(len(some), np.int64)
            stack = [(0, some, zero, one, one)]
            while stack:
                level, word, node, surplus, deficit = stack.pop()
                if level == len(self.levels):
                    at = np.repeat(np.arange(len(word)), self.first[node + 1] - self.first[node])
                    start = np.concatenate([[0], np.cumsum(self.first[node + 1] - self.first[node])])[:-1]
                    yield word[at], self.words[self.first[node][at] + np.arange(len(at)) - start[at]]
                    continue
                if len(word) > BLOCK:  # the second half waits below
                    half = len(word) // 2
                    stack += [(level, *[x[half:] for x in (word, node, surplus, deficit)]), (level, *[x[:half] for x in (word, node, surplus, deficit)])]
                    continue
                found = [self._down(level, word, node, asked[word, level], surplus, deficit)]
                up = surplus > 0
                if level == 0:  # one longer: an insertion, which has no deficit
                    found.append(self._down(level, word, node, asked[word, level] + 1, surplus, np.zeros_like(deficit)))
                else:
                    found.append(self._down(level, word[up], node[up], asked[word[up], level] + 1, surplus[up] - 1, deficit[up]))
                    down = (surplus == 0) & (deficit > 0)
                    found.append(self._down(level, word[down], node[down], asked[word[down], level] - 1, surplus[down], deficit[down] - 1))
                stack.append((level + 1, *[np.concatenate(x) for x in zip(*found, strict=True)]))

    def _down(self, level: int, word: np.ndarray, node: np.ndarray, count: np.ndarray, surplus: np.ndarray, deficit: np.ndarray):
        keys = self.levels[level]
        want = node * self.WIDE + count
        at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        ok = keys[at] == want
        return word[ok], at[ok], surplus[ok], deficit[ok]


def one_edit(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Whether each b is its a with one letter replaced (equal lengths) or inserted. Rows of code points, filled up with 0."""
    width = max(a.shape[1], b.shape[1]) + 1
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    differ = a != b
    at = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    inserted = ((a[:, :-1] == b[:, 1:]) | (np.arange(width - 1) < at[:, None])).all(axis=1)
    return np.where(la == lb, differ.sum(axis=1) == 1, (la + 1 == lb) & inserted)


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of words, a row each filled up with 0; the lengths; and the counts, the length first."""
    size = pa.compute.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(1, int(size.max(initial=1)))
    text = np.array(words.to_pylist(), f"<U{width}").view(np.uint32).reshape(len(words), width)
    group = GROUP_OF[np.minimum(text, len(GROUP_OF) - 1)]
    return text, size, np.column_stack([size, *[(group == g).sum(axis=1) for g in range(len(GROUPS))]])


def _pairs(t: pa.Table) -> pa.Table:
    """(a, b) of the part's words: asked and stored words one edit apart. Their lengths differ by one at most."""
    asked, stored = (t.filter(pa.compute.equal(t["stored"], side))["word"].combine_chunks() for side in (False, True))
    out = [pa.table({"a": pa.array([], pa.string()), "b": pa.array([], pa.string())})]
    if len(asked) and len(stored):
        (a, la, ca), (b, lb, cb) = _letters(asked), _letters(stored)
        for i, j in Trie(cb).leaves(ca):
            for low in range(0, len(i), BLOCK):
                x, y = i[low : low + BLOCK], j[low : low + BLOCK]
                ok = one_edit(a[x], la[x], b[y], lb[y])
                x, y = x[ok], y[ok]
                one, other = asked.take(pa.array(x)), stored.take(pa.array(y))
                # words with equal counts find each other from both sides
                once = pa.compute.or_(pa.array((ca[x] != cb[y]).any(axis=1)), pa.compute.less(one.cast(pa.binary()), other.cast(pa.binary())))
                out.append(pa.table({"a": one.filter(once), "b": other.filter(once)}))
    return pa.concat_tables(out)


def near_words(words: DataFrame, part: int = PART) -> DataFrame:
    """(a, b): each pair of distinct words of ``words`` (word: not null, no repeats) one edit apart, once."""
    counted = written(words.select("word", F.array(*_counts(F.col("word"))).alias("counts")))
    levels, depth = 0, len(GROUPS)
    while True:  # as many levels as keep the largest part small
        key = F.xxhash64(F.slice("counts", 1, levels + 1))
        most = counted.groupBy(key.alias("key")).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= part or levels == depth:
            break
        levels = min(depth, levels + 2)
    moves = F.array(*[F.array(*[F.lit(x) for x in m]) for m in _moves(levels)])
    asked = F.transform(moves, lambda m: F.xxhash64(F.zip_with(F.slice("counts", 1, levels + 1), m, lambda x, y: x + y)))
    asks = counted.select(F.explode(F.array_distinct(asked)).alias("key"), "word", F.lit(False).alias("stored"))
    both = counted.select(key.alias("key"), "word", F.lit(True).alias("stored")).unionByName(asks)
    if most > part:
        # words with the same counts beyond the bound: stored words and questions are cut into tiles, all of which meet
        large = counted.groupBy(key.alias("_key")).agg(F.count("*").alias("_n")).where(F.col("_n") > part)
        both = both.join(large.select(F.bitwise_not("_key").alias("_key"), F.ceil(F.col("_n") / part).cast("int").alias("_tiles")), F.bitwise_not("key") == F.col("_key"), "left")
        tiles = F.coalesce("_tiles", F.lit(1))
        own = F.array(F.pmod(F.xxhash64("word"), tiles).cast("int"))
        every = F.sequence(F.lit(0), tiles - 1)
        both = both.withColumn("tile", F.explode(F.when(F.col("stored"), own).otherwise(every))).withColumn("piece", F.explode(F.when(F.col("stored"), every).otherwise(own)))
    else:
        both = both.withColumns({"tile": F.lit(0), "piece": F.lit(0)})
    return both.select("key", "tile", "piece", "word", "stored").groupBy("key", "tile", "piece").applyInArrow(_pairs, "a string, b string")


def group_variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (word, n; words distinct and not null).

    ``form`` is the near word with the largest n (the smallest in code-point order of equals) if its n is at least
    ``ratio`` times the word's, else null; ``root`` follows the forms to the last. Empty table: no rows. Every step to a
    form multiplies n by ``ratio``, so chains are short; pointers are doubled until none moves.
    """
    words = written(words.select("word", "n"))
    pairs = written(near_words(words))
    both = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near")), F.struct(F.col("b").alias("word"), F.col("a").alias("near")))).alias("x")).select("x.*")
    met = both.withColumn("k", F.reverse("near")).join(words.select(F.reverse("word").alias("k"), F.col("n").alias("near_n")), "k")
    best = met.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("b"))
    near = best.select(F.col("word").alias("_word"), "n_near", F.col("b.near").alias("near"), (-F.col("b.n")).alias("near_n"))
    ok = F.col("near_n") >= ratio * F.col("n")
    out = words.join(near, F.col("word") == F.col("_word"), "left").select("word", F.when(ok, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(ok, F.col("near_n")).alias("form_n"))
    out = written(out)
    step = written(out.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        ahead = step.select(probe(step, "word").alias("k"), F.col("root").alias("further"))
        moved = written(step.withColumn("k", probe(step, "root")).join(ahead, "k", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if not moved.where("moved").limit(1).count():
            break
        discard(step)
        step = moved.drop("moved")
        step.written_to = moved.written_to
    roots = moved.select(F.col("word").alias("_word"), "root")
    return out.join(roots, F.col("word") == F.col("_word"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
