"""Token ids as binary shards: frequency-ranked ids in byte-aligned variable-length code with separate control bytes.

Ids are replaced by their rank by corpus frequency, so that frequent ids take one byte. A shard file holds

* the magic ``SVB1`` and five little-endian int64: partition, ids before this shard in its partition, documents, ids,
  control bytes;
* doc_ids (int64 each; the least int64 stands for null) and ids per document (int64 each);
* the control bytes: two bits per id, the number of its data bytes less one, four ids to a byte; each document begins
  a byte of its own;
* the data bytes, little-endian, without padding.

The table from rank to id is a file of its own beside the shards. Decoding looks each control byte up in a table of 256
rows of four lengths and gathers the data bytes with numpy. Shard names follow from partition and number and files are
put in place by renaming, so a task that runs again replaces them by the same bytes.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import discard, shared_folder, small_batches, written

MAGIC = b"SVB1"
NULL_ID = np.iinfo(np.int64).min
#: Ids per shard, about: a document is never split, so a longer one has a shard of its own.
SHARD_IDS = 2_000_000
#: Bytes of texts that are encoded at a time; a longer text is one piece.
CHUNK = 1 << 20
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_ALPHABET = "abcdefghijklmnopqrstuvwxyz"
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def encode_block(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit ranks."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    size = 1 + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = size - 1
    four = codes.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode_block(control: bytes, data: bytes, lengths: np.ndarray) -> np.ndarray:
    """The ranks of blocks of the given lengths that stand one after the other; each begins a control byte of its own."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel().astype(np.int64)
    padded = -(-lengths // 4) * 4
    used = np.arange(len(size)) - np.repeat(np.cumsum(padded) - padded, padded) < np.repeat(lengths, padded)
    size = size[used]
    starts = np.cumsum(size) - size
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = raw[starts].astype(np.uint32)
    for i in (1, 2, 3):
        more = np.flatnonzero(size > i)
        out[more] |= raw[starts[more] + i].astype(np.uint32) << np.uint32(8 * i)
    return out


class WordEncoder:
    """Encodes texts with the tokenizers library, word by word: white space never joins tokens of these vocabularies.

    Words are found and told apart in numpy, by 64-bit polynomial hashes of their bytes. The ids of a word are remembered
    for the life of the worker process, up to a bound on the number of words; then memory begins anew. Where the vocabulary
    marks the ends of words, a word of letters is encoded without the marks behind it, ASCII in lower case, and many such
    words are sent as one text, whose ids are cut at the ends. A word whose last
    letter does not stay a letter of its own when it is normalised is encoded together with its marks.
    """

    #: Marks that may follow a word and then make one run; no apostrophes and no part of special tokens.
    MARKS = ".,!?;:#$%&*)]}\"-_/"

    def __init__(self, path: str, kind: str = "<u4", remembered: int = 900_000) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer, self.kind, self.remembered = Tokenizer.from_file(path), np.dtype(kind), remembered
        self._forget()
        self.cores: dict[str, bytes] = {"": b""}
        self.apart: dict[str, bool] = {}  # by last letter, so no larger than the alphabets
        # words are sent many to a text with a special token between them, which no word may hold
        special = [(i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not t.normalized]
        self.mark, self.between = special[0] if special else (None, None)
        # the letters a-z pass as they are, capitals as the same letters, and letters and marks are cut apart
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        pieces = self._pieces(_ALPHABET + self.MARKS + " " + _ALPHABET.upper())
        self.ends = None
        if suffix and pieces == [_ALPHABET, self.MARKS, _ALPHABET]:
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
            self.plain = Tokenizer.from_file(path)
            self.plain.normalizer, self.plain.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()

    def _pieces(self, text: str) -> list[str]:
        t = self.tokenizer
        text = t.normalizer.normalize_str(text) if t.normalizer else text
        return [p for p, _ in t.pre_tokenizer.pre_tokenize_str(text)] if t.pre_tokenizer else [text]

    def _forget(self) -> None:
        self.known: dict[int, int] = {}  # hash of a word to its place in starts and sizes
        self.starts, self.sizes = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.pool, self.pooled = np.zeros(4096, self.kind), 0

    def _add(self, keys: list[int], ids: list[bytes]) -> None:
        first, last = len(self.known), len(self.known) + len(ids)
        new = np.frombuffer(b"".join(ids), self.kind)
        while last > len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        if self.pooled + len(new) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.pooled], np.zeros(self.pooled + len(new), self.kind)])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.kind.itemsize
        self.starts[first:last], self.sizes[first:last] = self.pooled + np.cumsum(sizes) - sizes, sizes
        self.pool[self.pooled : self.pooled + len(new)] = new
        self.pooled += len(new)
        self.known.update(zip(keys, range(first, last), strict=True))

    def encode(self, texts: pa.Array, end: int | None = None) -> pa.Array:
        """The ids of each whole text (null: none) and ``end``, as a binary array of numbers of the encoder's kind."""
        texts = texts.cast(pa.large_string()).fill_null("")
        bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        parts, low = [], 0
        while low < len(texts):  # about a million bytes at a time
            high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + CHUNK, "right")) - 1)
            parts.append(self._chunk(raw[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low], end))
            low = high
        return pa.chunked_array(parts, pa.large_binary()).combine_chunks() if parts else pa.array([], pa.large_binary())

    def _chunk(self, raw: np.ndarray, bounds: np.ndarray, end: int | None) -> pa.Array:
        if len(self.known) > self.remembered:
            self._forget()
        inside = np.concatenate([~BLANK[raw], [False]])
        edge = np.concatenate([inside[:1], inside[1:] != inside[:-1]])
        edge[bounds[:-1][inside[bounds[:-1]]]] = True
        first = np.flatnonzero(edge & inside)
        # a word ends before the next blank, or at the end of its text
        stop = np.flatnonzero(edge & ~inside)
        last = stop[np.minimum(np.searchsorted(stop, first), max(len(stop) - 1, 0))] if len(first) else first
        last = np.minimum(last, bounds[np.searchsorted(bounds, first, "right")]) if len(first) else first
        powers, inverse = _powers(len(raw))
        total = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers[: len(raw)], dtype=np.uint64)])
        size = (last - first).astype(np.uint64)
        key = (total[last] - total[first]) * inverse[first] + size * np.uint64(0xD6E8FEB86659FD93)
        unique, where, which = np.unique(key, return_index=True, return_inverse=True)
        names = unique.tolist()
        missing = [k for k, h in enumerate(names) if h not in self.known]
        if missing:
            at = where[missing]
            words = [raw[a:b].tobytes().decode("utf-8", "surrogatepass") for a, b in zip(first[at].tolist(), last[at].tolist(), strict=True)]
            got = self._words(words) if self.ends is not None else self._encoded(words)
            self._add([names[k] for k in missing], [got[w] for w in words])
        node = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))[which]
        sizes = self.sizes[node]
        ends = np.cumsum(sizes)
        ids = self.pool[np.repeat(self.starts[node] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.concatenate([[0], ends])[np.searchsorted(first, bounds)]
        if end is not None:
            ids = np.insert(ids, cuts[1:], end)
            cuts = cuts + np.arange(len(cuts))
        ids = np.ascontiguousarray(ids, self.kind)
        return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(cuts.astype(np.int64) * self.kind.itemsize), pa.py_buffer(ids)])

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each whole text, as numbers of the encoder's kind."""
        return self.encode(pa.array(texts, pa.string())).to_pylist()

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """The ids of words from those of their letters and of the marks behind."""
        if len(self.cores) > self.remembered:
            self.cores = {"": b""}
        cores = [w.rstrip(self.MARKS) for w in words]
        whole = [c.isalpha() and (c.isascii() or c == w or self._ends_apart(c[-1])) for c, w in zip(cores, words, strict=True)]
        cores = [c.lower() if a and c.isascii() else c for c, a in zip(cores, whole, strict=True)]
        tails = [w[len(c) :] for w, c in zip(words, cores, strict=True)]
        odd = self._encoded([w for w, a in zip(words, whole, strict=True) if not a])
        need = set(cores for cores, a in zip(cores, whole, strict=True) if a).difference(self.cores)
        fresh = self._letters([c for c in need if c.isascii()], self.plain) | self._letters([c for c in need if not c.isascii()], self.tokenizer)
        fresh |= self._encoded(list(set(tails).difference(self.cores)))
        self.cores.update(fresh)
        find = self.cores.__getitem__
        return odd | {w: find(c) + find(t) for w, c, t, a in zip(words, cores, tails, whole, strict=True) if a}

    def _ends_apart(self, letter: str) -> bool:
        """Whether every mark behind this letter begins a piece of its own; not so where normalisation takes the letter
        apart, as with a capital I with a dot."""
        if letter not in self.apart:
            self.apart[letter] = all(self._pieces(letter + m)[-1] == m for m in self.MARKS)
        return self.apart[letter]

    def _letters(self, words: list[str], tokenizer) -> dict[str, bytes]:
        """The ids of words of letters alone, each of which has one end."""
        out: dict[str, bytes] = {}
        for low in range(0, len(words), 100):
            some = words[low : low + 100]
            ids = np.array(tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, self.kind)
            ends = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(ends) != len(some):  # a letter that is more than one after normalisation
                out.update(self._encoded(some))
                continue
            wide, raw = ids.itemsize, ids.tobytes()
            out.update(zip(some, [raw[wide * a : wide * b] for a, b in zip([0, *ends[:-1]], ends, strict=True)], strict=True))
        return out

    def _encoded(self, words: list[str]) -> dict[str, bytes]:
        one = [w for w in words if self.between is None or self.between in w]
        many = [w for w in words if self.between is not None and self.between not in w]
        out = {w: np.array(e.ids, self.kind).tobytes() for w, e in zip(one, self.tokenizer.encode_batch_fast(one, add_special_tokens=False), strict=True)}
        for low in range(0, len(many), 100):
            some = many[low : low + 100]
            ids = np.array(self.tokenizer.encode_batch_fast([self.between.join(some)], add_special_tokens=False)[0].ids, self.kind)
            cuts = np.flatnonzero(ids == self.mark)
            wide = ids.itemsize
            raw, ends = ids.tobytes(), (wide * cuts).tolist()
            out.update(zip(some, [raw[a:b] for a, b in zip([0, *[e + wide for e in ends]], [*ends, len(raw)], strict=True)], strict=True))
        return out


@lru_cache(maxsize=2)
def _some_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    out = np.full((2, n), [[base], [pow(base, -1, 2**64)]], np.uint64)
    out[:, 0] = 1
    return tuple(np.cumprod(out, axis=1, dtype=np.uint64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of an odd number and of its inverse, modulo 2**64."""
    return _some_powers(max(2 * CHUNK, 1 << max(n, 1).bit_length()))


@lru_cache(maxsize=2)
def word_encoder(path: str, kind: str = "<u4") -> WordEncoder:
    return WordEncoder(path, kind)


def tokenised(docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int) -> DataFrame:
    """(doc_id, ids): the ids of each whole text and the end id, as little-endian 16-bit numbers, or 32-bit for larger vocabularies."""
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer, kind)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), encoder.encode(b.column("text"), end_id).cast(pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, ids binary")


def _frequencies(coded: DataFrame, kind: str, vocabulary: int) -> np.ndarray:
    """How often each id occurs in the corpus; a vector of the vocabulary's size is all that reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), kind), minlength=vocabulary)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])

    counted = coded.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(vocabulary, np.int64)
    out[counted["id"].to_numpy()] = counted["n"].to_numpy()
    return out


def _put(folder: str, name: str, content: bytes) -> None:
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    temporary = f"{path}/.{name}.{np.random.default_rng().integers(2**62)}"
    with fs.open_output_stream(temporary) as f:
        f.write(content)
    fs.move(temporary, f"{path}/{name}")


def write_ids(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 1) -> None:
    """Encode every whole text of ``docs`` (doc_id, text), append ``end_id`` and write shards below ``folder`` (a URI).

    Documents stand in ascending doc_id order over all shards (null first; rows with equal ids in order of their text's
    hash). Null and empty texts have the end id only. An empty table writes the rank table only. Other columns are not
    read. ``folder`` must be reachable from every executor.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    small_batches(spark)
    vocabulary = max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1)
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
    coded = written(tokenised(docs, tokenizer, end_id, vocabulary))  # read three times, tokenised once
    by_rank = np.argsort(-_frequencies(coded, kind, vocabulary), kind="stable").astype("<u4")
    _put(folder, "ranks.u32", by_rank.tobytes())
    rank_of = np.empty(vocabulary, np.uint32)
    rank_of[by_rank] = np.arange(vocabulary, dtype=np.uint32)
    sent = spark.sparkContext.broadcast(rank_of)  # bounded by the vocabulary
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    unnamed = n if coded.where("doc_id is null").limit(1).count() else 0  # parts for rows without doc_id, by their hash
    bounds = np.array(sorted(set(coded.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.1 / n))) if n > 1 else [], np.float64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            blocks = [encode_block(sent.value[np.frombuffer(x, kind)]) for x in b.column("ids").to_pylist()]
            ids = b.column("doc_id").to_pylist()
            part = [-1 if d is None else unnamed + int(np.searchsorted(bounds, d, "right")) for d in ids]
            size = [x // np.dtype(kind).itemsize for x in pa.compute.binary_length(b.column("ids")).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(part, pa.int32()), pa.array(size, pa.int64()), pa.array([c for c, _ in blocks], pa.binary()), pa.array([x for _, x in blocks], pa.binary())], names=["doc_id", "part", "n", "control", "data"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, before, held = -1, 0, 0, 0
        rows: list[tuple] = []

        def flush() -> None:
            nonlocal shard, before, held
            docs_, sizes, control, data = zip(*rows, strict=True)
            control, data = b"".join(control), b"".join(data)
            head = np.array([part, before, len(rows), held, len(control)], "<i8")
            _put(folder, f"part-{part:06d}-{shard:06d}.svb", MAGIC + head.tobytes() + np.array(docs_, "<i8").tobytes() + np.array(sizes, "<i8").tobytes() + control + data)
            shard, before, held = shard + 1, before + held, 0
            rows.clear()

        for b in batches:
            for d, p, size, control, data in zip(*[b.column(c).to_pylist() for c in ("doc_id", "part", "n", "control", "data")], strict=True):
                part = p
                rows.append((NULL_ID if d is None else d, size, control, data))
                held += size
                if held >= SHARD_IDS:
                    flush()
        if rows:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([before], pa.int64())], names=["part", "n"])

    blocks = coded.mapInArrow(encode, "doc_id bigint, part int, n bigint, control binary, data binary")
    by_hash = F.floor((F.xxhash64("control", "data") / F.lit(2.0**64) + 0.5) * unnamed).cast("int")
    blocks = blocks.withColumn("part", F.when(F.col("part") < 0, F.least(by_hash, F.lit(unnamed - 1))).otherwise(F.col("part")))
    ordered = blocks.repartitionById(n + unnamed, F.col("part")).sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), F.xxhash64("control", "data"))
    ordered.mapInArrow(write, "part bigint, n bigint").agg(F.sum("n")).collect()
    discard(coded)


def read_ids(spark: SparkSession, folder: str, digest_only: bool = False) -> DataFrame:
    """(doc_id, start, ids) of the documents in the shards of ``folder``; ``start`` counts the ids of all documents before.

    ``digest_only``: (doc_id, start, n_tokens, ids_crc32) instead, the checksum being that of the decoded ids as
    little-endian unsigned 32-bit integers.
    """
    fs, path = pafs.FileSystem.from_uri(folder)
    with fs.open_input_stream(f"{path}/ranks.u32") as f:
        by_rank = spark.sparkContext.broadcast(np.frombuffer(f.read(), "<u4"))
    small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column("content"):
                blob = raw.as_py()
                part, before, n_docs, n_ids, n_control = np.frombuffer(blob, "<i8", 5, len(MAGIC)).tolist()
                at = len(MAGIC) + 40
                docs_ = np.frombuffer(blob, "<i8", n_docs, at)
                lengths = np.frombuffer(blob, "<i8", n_docs, at + 8 * n_docs)
                at += 16 * n_docs
                ids = by_rank.value[decode_block(blob[at : at + n_control], blob[at + n_control :], lengths)]
                ends = np.cumsum(lengths)
                starts = ends - lengths
                named = [pa.array(docs_, mask=docs_ == NULL_ID), pa.array(np.full(n_docs, part)), pa.array(before + starts)]
                if digest_only:
                    raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                    crc = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(starts.tolist(), ends.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([*named, pa.array(lengths), pa.array(crc, pa.int64())], names=["doc_id", "part", "start", "n_tokens", "ids_crc32"])
                    continue
                for s in range(0, n_docs, 512):
                    e = min(s + 512, n_docs)
                    low = starts[s]
                    offsets = np.append(starts[s:e], ends[e - 1]) - low
                    yield pa.RecordBatch.from_arrays([*[x[s:e] for x in named], pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids[low : ends[e - 1]].astype(np.int64)))], names=["doc_id", "part", "start", "ids"])

    rest = ["n_tokens", "ids_crc32"] if digest_only else ["ids"]
    kinds = "n_tokens bigint, ids_crc32 bigint" if digest_only else "ids array<bigint>"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.svb").schema("path string, modificationTime timestamp, length bigint, content binary").load(folder)
    decoded = files.select("content").mapInArrow(run, f"doc_id bigint, part bigint, start bigint, {kinds}")
    # one row for each partition of the writer: its ids, and those of the partitions before
    heads = files.select("content").mapInArrow(_heads, "part bigint, n bigint").groupBy("part").agg(F.sum("n").alias("n"))
    before = heads.select(F.col("part").alias("_part"), F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return decoded.join(F.broadcast(before), F.col("part") == F.col("_part")).select("doc_id", (F.col("start") + F.col("_before")).alias("start"), *rest)


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        heads = [np.frombuffer(raw.as_py(), "<i8", 5, len(MAGIC)) for raw in b.column("content")]
        yield pa.RecordBatch.from_arrays([pa.array([int(h[0]) for h in heads], pa.int64()), pa.array([int(h[3]) for h in heads], pa.int64())], names=["part", "n"])


def digest(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write the shards of ``docs`` in the shared folder and describe each document as read back from them."""
    folder = shared_folder(docs.sparkSession)
    write_ids(docs, tokenizer, folder, end_id)
    return read_ids(docs.sparkSession, folder, digest_only=True)
