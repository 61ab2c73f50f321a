"""URL filter: allow and block entries in a trie over reversed host labels, then path segments; the longest entry wins."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import small_batches

#: Entries are held in each task, so the bytes that they may take there are bounded before the trie is built; a longer list is
#: met by :func:`judge_by_table`. A node takes so many bytes at most, an entry so many besides, and each character four.
MAX_BYTES = 128 << 20
NODE_BYTES, ENTRY_BYTES, CHAR_BYTES = 420, 1000, 4


class Trie:
    """Nodes are dicts; a host label leads on by its name, a path segment by its name with a slash before it.

    An entry's path may end within a segment ("/en/7" also fits "/en/77"): the beginning of its last segment is kept at
    the node before it, under None, as the best entry of each beginning by its length, so that a segment is looked up
    once for each length however many entries there are.
    """

    def __init__(self, entries: Iterable[tuple[str, str, str]]) -> None:
        self.root: dict = {}
        for verdict, host, path in entries:
            if verdict not in ("allow", "block"):
                raise ValueError(f"no verdict: {verdict}")
            node = self.root
            for label in reversed(host.translate(LOWER).split(".")) if host else ():
                node = node.setdefault(label, {})
            *whole, last = path.split("/")
            for s in whole:
                node = node.setdefault("/" + s, {})
            own = node.setdefault(None, {}).setdefault(len(last), {})
            own[last] = max(own.get(last, (-1,)), (len(host) + len(path), verdict == "block", host + path, verdict))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(entry, verdict) of the longest entry that fits; of equally long ones block comes first, then the text's order."""
        best = None
        segments = path.split("/")

        def along_path(node: dict) -> None:
            nonlocal best
            for s in segments:
                for n, own in node.get(None, {}).items():
                    hit = own.get(s[:n]) if n <= len(s) else None
                    if hit and (best is None or hit > best):
                        best = hit
                node = node.get("/" + s)
                if node is None:
                    return

        node = self.root
        along_path(node)
        for label in reversed(host.split(".")) if host else ():
            node = node.get(label)
            if node is None:
                break
            along_path(node)
        return best and best[2:]


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path from there up to ``?`` or ``#``.

    Null urls and urls without ``://`` have both empty.
    """
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def trie_bytes(host: str, path: str) -> int:
    """A bound of the bytes that an entry adds to a trie: its nodes, its own rows and its characters."""
    return ENTRY_BYTES + NODE_BYTES * (host.count(".") + path.count("/") + 2) + CHAR_BYTES * (len(host) + len(path))


def _entries(entries: DataFrame | Iterable[tuple[str, str, str]]) -> list[tuple[str, str, str]] | None:
    """The entries as a list if a trie of them is small enough, else None; those of a table are summed up before they are collected."""
    if isinstance(entries, DataFrame):
        host, path = (F.coalesce(F.col(c), F.lit("")) for c in ("host", "path"))
        dots = lambda c, x: F.length(c) - F.length(F.replace(c, F.lit(x), F.lit("")))
        size = F.sum(ENTRY_BYTES + NODE_BYTES * (dots(host, ".") + dots(path, "/") + 2) + CHAR_BYTES * (F.length(host) + F.length(path)))
        if (entries.agg(size).first()[0] or 0) > MAX_BYTES:
            return None
        return [tuple(r) for r in entries.select("verdict", host, path).collect()]
    entries = list(entries)
    return entries if sum(trie_bytes(h, p) for _, h, p in entries) <= MAX_BYTES else None


def judge(pages: DataFrame, entries: DataFrame | Iterable[tuple[str, str, str]], default: str = "allow", url: str = "url", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``keep``, host, path, rule, verdict of every row; rule is null and verdict ``default`` where no entry fits.

    An entry (verdict, host, path) fits its host and all subdomains of it, and urls whose path starts with its path.
    Null and malformed urls get the default; repeated rows are judged alike; an empty table gives an empty result. Entries
    are given as tuples or as a table (verdict, host, path); where a trie of them could take more than MAX_BYTES in a task,
    they are met by joins, with the same result.
    """
    spark = pages.sparkSession
    small_batches(spark)
    some = _entries(entries)
    if some is None:
        table = entries if isinstance(entries, DataFrame) else spark.createDataFrame(entries, "verdict string, host string, path string")
        return judge_by_table(pages, table, default, url, keep)
    trie = spark.sparkContext.broadcast(Trie(some))
    host, path = url_parts(F.col(f"`{url}`"))
    cols = [F.col(f"`{c}`") for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = trie.value.find
        for b in batches:
            found = [find(h, p) for h, p in zip(b.column("host").to_pylist(), b.column("path").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([f and f[0] for f in found], pa.string()), pa.array([f[1] if f else default for f in found], pa.string())], names=[*b.schema.names, "rule", "verdict"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in pages.select(*cols).schema)
    return pages.select(*cols, host.alias("host"), path.alias("path")).mapInArrow(run, f"{kept}host string, path string, rule string, verdict string")


def judge_by_table(pages: DataFrame, entries: DataFrame, default: str = "allow", url: str = "url", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """The same from a table of entries (verdict, host, path) of any size, by joins instead of a trie in each task.

    Every distinct (host, path) offers the suffixes of its host, each of these the beginnings of its path whose length
    some entry of that host has, and meets entries by equality. Rows without entry keep their place by an outer join.
    """
    host, path = url_parts(F.col(f"`{url}`"))
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], host.alias("host"), path.alias("path"))
    lower = F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rules = entries.select("verdict", F.coalesce(lower, F.lit("")).alias("h"), F.coalesce("path", F.lit("")).alias("p"), F.concat(F.coalesce("host", F.lit("")), F.coalesce("path", F.lit(""))).alias("rule")).distinct()
    shapes = rules.select("h", F.length("p").alias("n")).distinct()
    urls = rows.select(F.col("host").alias("u"), F.col("path").alias("v")).distinct()
    labels = F.split("u", r"\.")
    suffixes = F.array_distinct(F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))))
    offers = urls.select("u", "v", F.explode(suffixes).alias("h")).join(shapes, "h").where(F.length("v") >= F.col("n"))
    met = offers.select("u", "v", "h", F.substr(F.col("v"), F.lit(1), F.col("n")).alias("p")).join(rules, ["h", "p"])
    best = met.groupBy("u", "v").agg(F.max(F.struct(F.length("rule").alias("n"), (F.col("verdict") == "block").alias("b"), "rule", "verdict")).alias("best"))
    out = rows.join(best, (F.col("host") == F.col("u")) & (F.col("path") == F.col("v")), "left")
    return out.select(*[F.col(f"`{c}`") for c in keep], "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
