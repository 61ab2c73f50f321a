"""Near-duplicate documents by HyperMinHash sketches, banding and exact verification.

Each word shingle is hashed once: the hash says which bucket of the sketch it belongs to and its value there. Of the
least value of each bucket the sketch stores the number of leading zeros and the next mantissa bits: 16 bits. Buckets
that no shingle of a short text falls into borrow from another one, chosen by a fixed random order of their own, so
that any bucket is equal in two texts with the chance of their Jaccard similarity. Four registers make a band of 64 bits.

Documents with equal shingle sets are collapsed first. The classes that share a band meet in tiles of bounded size:
there the share of equal registers, corrected for accidental collisions, estimates their similarity, and pairs near or
above the threshold are verified on their full sets in the same place. A tile emits a spanning forest of its links,
never pairs. Buckets of several tiles whose members are still in several components after that are compared once more
across tiles, without the tiles of one and the same component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import discard, small_batches, written

BANDS, LANES, MANTISSA = 24, 4, 10
REGISTERS = BANDS * LANES
#: The estimate's margin below the threshold, in standard deviations of the share of equal registers, whose variance
#: is at most twice that of independent registers (borrowing repeats some).
SIGMAS = 5.0
#: About as many members, and shingles of members, are in a tile; a longer text has one of its own.
TILE, WEIGHT = 256, 250_000
#: The first shingle hash of each bucket, and the order in which an empty one looks at the others.
BOUNDS = np.array([-(-i * 2**64 // REGISTERS) for i in range(REGISTERS)], np.uint64)
BORROW = np.stack([np.random.default_rng(20 + i).permutation(REGISTERS) for i in range(REGISTERS)])


class _Hashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < 200_000:
            self[word] = h
        return h


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(text: str | None, k: int, cache: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of a whole text, A-Z lower-cased; short texts have one, empty none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    k = min(k, len(words))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i]
    return np.unique(_mixed(out))


def registers(least: np.ndarray) -> np.ndarray:
    """Compress least values: leading zeros above the first MANTISSA bits after the leading one."""
    fraction, exponent = np.frexp((least >> np.uint64(11)).astype(np.float64))
    mantissa = np.maximum(fraction * 2 - 1, 0) * (1 << MANTISSA)
    return ((53 - exponent).astype(np.uint16) << np.uint16(MANTISSA)) | mantissa.astype(np.uint16)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Registers (rows: sets, all non-empty and sorted) of shingle sets."""
    sizes = np.array([len(x) for x in sets])
    ends = np.cumsum(sizes)
    every = np.concatenate(sets)
    first = np.stack([np.searchsorted(x, BOUNDS) for x in sets]) + (ends - sizes)[:, None]
    # the sets are sorted: the first shingle from a bucket's bound on is its least, if it is below the next bound
    after = np.concatenate([first[:, 1:], ends[:, None]], axis=1)
    filled = first < after
    values = every[np.minimum(first, len(every) - 1)] * np.uint64(REGISTERS)  # modulo 2**64: the place within the bucket
    short = np.flatnonzero(~filled.all(axis=1))
    for low in range(0, len(short), 256):
        rows = short[low : low + 256]
        source = BORROW[np.arange(REGISTERS), filled[rows][:, BORROW].argmax(axis=2)]
        own = np.where(filled[rows], np.arange(REGISTERS), source)
        values[rows] = np.take_along_axis(values[rows], own, axis=1)
    return registers(values)


def sketched(docs: DataFrame, k: int, keep: list[str]) -> DataFrame:
    """``keep``, n_shingles, set_key (a 128-bit hash of the set; null if empty) and bands (longs; null if empty)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Hashes()
        for b in batches:
            sets = [shingles(t, k, cache) for t in b.column("_text").to_pylist()]
            full = [i for i, s in enumerate(sets) if len(s)]
            bands: list = [None] * len(sets)
            if full:
                packed = np.ascontiguousarray(sketches([sets[i] for i in full])).view(np.int64)
                for i, row in zip(full, packed, strict=True):
                    bands[i] = row
            keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=[*keep, "n_shingles", "set_key", "bands"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, f"{kept}, n_shingles bigint, set_key binary, bands array<bigint>")


def full_sets(docs: DataFrame, k: int) -> DataFrame:
    """(set_key, items) of documents: the sorted hashes of their shingles. A task gives equal sets once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, seen = _Hashes(), set()
        for b in batches:
            sets = [shingles(t, k, cache) for t in b.column("text").to_pylist()]
            sets = [s for s in sets if len(s) and (h := xxhash.xxh3_128_digest(s.tobytes())) not in seen and not seen.add(h)]
            yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["set_key", "items"])

    return docs.select("text").mapInArrow(run, "set_key binary, items array<bigint>")


def collisions(sizes: np.ndarray) -> np.ndarray:
    """For each set size the chances of 0, 1, .. 53 leading zeros in a register; their products, summed and divided by the
    number of mantissas, give the chance that registers of unrelated sets are equal."""
    n = np.maximum(sizes / REGISTERS, 1.0)[:, None]
    i = np.arange(54)
    return (1 - 2.0 ** -(i + 1)) ** n - np.where(i > 0, 1 - 2.0**-i, 0.0) ** n


def estimate(equal: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimates from numbers of equal registers and the chances of accidental equality."""
    return (equal / REGISTERS - chance) / (1 - chance)


def _margin(threshold: float) -> float:
    return max(0.0, threshold - SIGMAS * (2 * threshold * (1 - threshold) / REGISTERS) ** 0.5)


class _Forest(dict):
    """Roots of what a task has joined so far."""

    def find(self, x: int) -> int:
        while (y := self.get(x, x)) != x:
            self[x] = x = self.get(y, y)
        return x


def _run_links(percent: int, node: np.ndarray, group: np.ndarray, reg: np.ndarray, starts: np.ndarray, items: np.ndarray, side: np.ndarray | None, first: np.ndarray | None, joined: _Forest) -> list[tuple[int, int]]:
    """Links of a run that join its members' components: a spanning forest, as pairs of ``node``.

    ``starts``: where each member's set begins in ``items``, and the end. ``side``: only members of different sides are
    compared. ``first``: only pairs are looked at whose first shared band is this one.
    """
    n, out = len(node), []
    size = np.diff(starts)
    label = np.array([joined.find(x) for x in group.tolist()])
    packed = np.ascontiguousarray(reg).view(np.uint64)
    chances = collisions(size)
    least = _margin(percent / 100)
    codes = None
    for x in range(n - 1):
        y = np.arange(x + 1, n)
        ok = (label[y] != label[x]) & (100 * np.minimum(size[y], size[x]) >= percent * np.maximum(size[y], size[x]))
        if side is not None:
            ok &= side[y] != side[x]
        y = y[ok]
        if not len(y):
            continue
        equal = (reg[y] == reg[x]).sum(axis=1)
        ok = estimate(equal, chances[y] @ chances[x] / (1 << MANTISSA)) >= least
        if first is not None:
            ok &= (packed[y] == packed[x]).argmax(axis=1) == first
        y = y[ok]
        if not len(y):
            continue
        own = items[starts[x] : starts[x + 1]]
        if len(y) <= 4:
            shared = np.array([len(np.intersect1d(own, items[starts[k] : starts[k + 1]], assume_unique=True)) for k in y])
        else:
            if codes is None:
                codes = np.unique(items, return_inverse=True)[1]
                mark = np.zeros(len(codes), bool)
            mine = codes[starts[x] : starts[x + 1]]
            mark[mine] = True
            ends = np.cumsum(size[y])
            at = np.arange(ends[-1]) + np.repeat(starts[y] - (ends - size[y]), size[y])
            shared = np.add.reduceat(mark[codes[at]].astype(np.int64), ends - size[y])
            mark[mine] = False
        for k in y[100 * shared >= percent * (size[y] + size[x] - shared)]:
            if label[k] != label[x]:
                out.append((int(node[x]), int(node[k])))
                a, b = sorted((int(label[x]), int(label[k])))
                joined[b] = a
                label[(label == a) | (label == b)] = a
    return out


def _linked(runs: DataFrame, percent: int) -> DataFrame:
    """(a, b): for each run of rows with one key (bucket, i, j, g, h) the links that join components, as pairs of roots.

    ``runs``: bucket, i, j (tiles), g, h (groups), side (whether a row is of the second tile), band, root, bands, items.
    """
    keys = ["bucket", "g", "h", "i", "j"]
    dealt = runs.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined = _Forest()

        def of_table(t: pa.Table, final: bool) -> tuple[list, pa.Table | None]:
            b = t.combine_chunks().to_batches()[0]
            code = np.stack([b.column(c).to_numpy() for c in keys])
            bounds = [0, *(np.flatnonzero((code[:, 1:] != code[:, :-1]).any(axis=0)) + 1).tolist(), b.num_rows]
            last = len(bounds) - 1 if final else len(bounds) - 2
            root, side, band = (b.column(c).to_numpy(zero_copy_only=False) for c in ("root", "side", "band"))
            reg = b.column("bands").flatten().to_numpy(zero_copy_only=False).view(np.uint16).reshape(-1, REGISTERS)
            lists = b.column("items")
            starts = lists.offsets.to_numpy()
            items = lists.values.to_numpy(zero_copy_only=False)
            out: list = []
            for s, e in zip(bounds[:last], bounds[1 : last + 1], strict=True):
                if e - s > 1:
                    apart = code[1, s] != code[2, s] or code[3, s] != code[4, s]
                    out += _run_links(percent, root[s:e], root[s:e], reg[s:e], starts[s : e + 1] - starts[s], items[starts[s] : starts[e]], side[s:e] if apart else None, None if band[s] < 0 else band[s], joined)
            return out, None if final or bounds[-2] == b.num_rows else pa.Table.from_batches([b.slice(bounds[-2])])

        held: list[pa.Table] = []
        for b in batches:
            if not b.num_rows:
                continue
            here = pa.Table.from_batches([b])
            if held and all(here[c][-1].equals(held[0][c][0]) for c in keys):
                held.append(here)  # a run that goes on
                continue
            out, rest = of_table(pa.concat_tables([*held, here]), False)
            held = [rest] if rest is not None else []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])
        if held:
            out, _ = of_table(pa.concat_tables(held), True)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _tiles(n: str, weight: str) -> Column:
    return F.ceil(F.greatest(F.col(n) / TILE, F.col(weight) / WEIGHT)).cast("int")


def _tile_of(tiles: str) -> Column:
    return F.pmod(F.xxhash64("class", "bucket"), F.col(tiles)).cast("int")


def _across(members: DataFrame, roots: DataFrame, payload: DataFrame, percent: int) -> DataFrame:
    """Links between tiles of the buckets (bucket, class, band, n_shingles) that hold several components, as pairs of roots.

    Components with many members in a bucket have tiles of their own, which are not compared with each other; all others
    of the bucket share tiles.
    """
    named = members.join(roots, F.col("class") == F.col("node"), "left").select("bucket", "class", "band", "n_shingles", F.coalesce("root", "class").alias("root"))
    sizes = named.groupBy("bucket", "root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("w"))
    grouped = sizes.withColumn("g", F.when(_tiles("n", "w") > 1, F.col("root")).otherwise(-1))
    open_ = grouped.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("bucket")
    groups = written(grouped.join(open_, "bucket").groupBy("bucket", "g").agg(F.sum("n").alias("n"), F.sum("w").alias("w")).select("bucket", "g", _tiles("n", "w").alias("tiles")))
    big = groups.where("g >= 0").select(F.bitwise_not("bucket").alias("k"), F.col("g").alias("big"))
    at = named.withColumn("k", F.bitwise_not("bucket"))
    placed = at.join(big, (at["k"] == big["k"]) & (F.col("root") == F.col("big")), "left").drop("k").withColumn("g", F.coalesce("big", F.lit(-1).cast("long")))
    own = groups.select(F.bitwise_not("bucket").alias("k"), F.col("g").alias("own_g"), F.col("tiles").alias("own_tiles"))
    other = groups.select(F.bitwise_not("bucket").alias("k2"), F.col("g").alias("other"), F.col("tiles").alias("others"))
    placed = placed.withColumn("k", F.bitwise_not("bucket")).join(own, ["k"]).where("g = own_g").withColumn("tile", _tile_of("own_tiles"))
    met = placed.join(other, F.col("k") == F.col("k2")).where("g <> other or g < 0").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    same, second = F.col("g") == F.col("other"), F.col("g") > F.col("other")
    low = F.when(same, F.least("tile", "o")).when(second, F.col("o")).otherwise(F.col("tile"))
    high = F.when(same, F.greatest("tile", "o")).when(second, F.col("tile")).otherwise(F.col("o"))
    runs = met.select("bucket", "class", "band", "root", F.least("g", "other").alias("g"), F.greatest("g", "other").alias("h"), low.alias("i"), high.alias("j"), F.when(same, F.col("tile") > F.col("o")).otherwise(second).alias("side"))
    return _linked(runs.join(payload, "class").drop("class", "n_shingles"), percent)


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least doc_id of its group), kept (whether it is that one).

    Links are pairs of documents with ``100 * shared shingles >= percent * all shingles`` that share a band (a pair at
    80 % is missed with a chance of about 3 in a million). Shingles are told apart by 64-bit hashes. Null and empty texts
    have no shingles and link with nothing; equal texts, and texts with equal shingle sets, are linked; rows without doc_id
    are linked with nothing, have a null component and are kept. Repeated doc_ids stand for one document of several texts.
    Other columns are not read.
    """
    all_rows = written(sketched(docs, k, ["doc_id"]))
    rows = all_rows.where("doc_id is not null and set_key is not null")
    # equal sets have equal sketches; repeated rows of a doc_id may stand in the payload twice, which links nothing new
    classes = written(rows.groupBy("set_key").agg(F.min("doc_id").alias("first_doc"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands")).withColumn("class", F.monotonically_increasing_id()))
    # the band stands in the first bits of a bucket's number: the least of equal buckets is that of the first band
    banded = classes.select("class", "n_shingles", F.posexplode("bands").alias("band", "value"))
    banded = banded.select(F.shiftleft(F.col("band").cast("long"), 58).bitwiseOR(F.shiftrightunsigned(F.xxhash64("value"), 6)).alias("bucket"), "class", "n_shingles")
    members = [F.count("*").alias("n"), F.sum("n_shingles").alias("w"), F.min("class").alias("low"), F.max("class").alias("high"), F.bit_xor(F.xxhash64("class")).alias("mixed")]
    filled = banded.groupBy("bucket").agg(*members).where("n > 1")
    # most groups of copies share many bands: of buckets with the same members one is enough
    buckets = filled.groupBy("n", "w", "low", "high", "mixed").agg(F.min("bucket").alias("bucket")).select(F.bitwise_not("bucket").alias("k"), _tiles("n", "w").alias("tiles"))
    shared = written(banded.withColumn("k", F.bitwise_not("bucket")).join(buckets, "k").drop("k").withColumn("band", F.shiftright("bucket", 58)))
    wanted = classes.join(shared.select("class"), "class", "left_semi").select("class", "first_doc", "set_key", "bands")
    texts = docs.select("doc_id", "text").join(wanted.select(F.col("first_doc").alias("doc_id")).distinct(), "doc_id", "left_semi")
    payload = written(full_sets(texts, k).join(wanted, "set_key").select("class", "bands", "items"))
    inside = shared.select("bucket", "class", F.col("class").alias("root"), F.lit(-1).cast("long").alias("band"), F.lit(0).cast("long").alias("g"), F.lit(0).cast("long").alias("h"), _tile_of("tiles").alias("i"), F.lit(False).alias("side"))
    links = written(_linked(inside.withColumn("j", F.col("i")).join(payload, "class").drop("class"), percent))
    roots = written(components(links))
    late = written(_across(shared.where("tiles > 1").drop("tiles"), roots, payload, percent))
    over = components(late).select(F.col("node").alias("was"), F.col("root").alias("top"))
    every = shared.select("class").distinct().join(roots, F.col("class") == F.col("node"), "left").select("class", F.coalesce("root", "class").alias("root"))
    grouped = written(every.join(over, F.col("root") == F.col("was"), "left").select("class", F.coalesce("top", "root").alias("root")))
    discard(payload, shared, links, late)
    met = grouped.join(classes.select("class", "first_doc"), "class")
    least = met.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    of_class = grouped.withColumn("k", F.bitwise_not("root")).join(least.select(F.bitwise_not("root").alias("k"), "component_id"), "k").select(F.col("class").alias("in_group"), "component_id")
    named_sets = classes.join(of_class, F.col("class") == F.col("in_group"), "left").select(F.col("set_key").alias("named"), F.coalesce("component_id", "first_doc").alias("component_id"))
    met = rows.select("doc_id", "n_shingles", "set_key").join(named_sets, F.col("set_key") == F.col("named")).select("doc_id", "n_shingles", "component_id")
    alone = all_rows.where("doc_id is null or set_key is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return met.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are kept: one of each group, with all its columns.

    It is a row with the least doc_id of the group, and of several texts with this doc_id the one with the least hash; of
    rows with equal doc_id and text one stays. Rows without doc_id are grouped like the others and come last. Texts without
    shingles are in no group and all stay.
    """
    row = next(n for n in (f"_row{i}" for i in range(len(docs.columns) + 1)) if n not in docs.columns)
    none = F.lit(0).cast(docs.schema["doc_id"].dataType)
    keyed = docs.withColumn(row, F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", none).alias("id"), F.md5(F.coalesce("text", F.lit(""))).alias("text")))
    judged = written(near_duplicates(keyed.select(F.col(row).alias("doc_id"), "text"), k, percent))
    gone = judged.where("not kept").select(F.col("doc_id").alias(row)).distinct()
    repeated = judged.where("kept and n_shingles > 0").groupBy(F.col("doc_id").alias(row)).agg(F.count("*").alias("n")).where("n > 1").select(row)
    left = keyed.join(gone.unionByName(repeated), row, "left_anti")
    return left.unionByName(keyed.join(repeated, row, "left_semi").dropDuplicates([row])).select(*[F.col(f"`{c}`") for c in docs.columns])
