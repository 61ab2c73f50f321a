"""FASTQ as a Spark data source: ``spark.read.format("fastq").load(folder)``, plain, gzip or blocked gzip.

``read_fastq`` reads large files in many tasks: plain files are cut into byte ranges, blocked gzip files (bgzip) into ranges
of blocks. A range owns the records that begin behind its first byte and up to the first byte of the next range; its
reader finds the first of them by the phase of the four lines, since a quality line may begin with ``@`` too. Plain gzip
cannot be cut and stays one task. ``write_fastq`` writes blocked gzip, a folder for each value of a column.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, StringEndsWith, StringStartsWith, WriterCommitMessage

from ..functions.sequences import ascii_bytes
from ..plans.stages import staged

SCHEMA = "file string, read_no bigint, header string, seq string, qual string"
#: With ``bytesPerPartition``: the range's first byte, and the record's number in it.
SPLIT_SCHEMA = "file string, part bigint, no bigint, header string, seq string, qual string"
#: With ``countOnly``: records, bytes of them, bytes of the range, blank bytes at its end.
COUNT_SCHEMA = "file string, part bigint, n bigint, owned bigint, inside bigint, blank bigint"
ENDINGS = (".fastq", ".fq", ".fastq.gz", ".fq.gz")
CHUNK = 1 << 20
BLOCK_HEAD = b"\x1f\x8b\x08\x04"
#: Ranges whose first numbers are broadcast; more are joined by a shuffle.
MAX_BROADCAST_RANGES = 200_000
#: Letters of a written block, and files that a task holds open.
BLOCK, OPEN = 0xFF00, 64
_SEQUENCE = re.compile(rb"[A-Za-z*.\-]*\r?\Z")


class _Range(InputPartition):
    def __init__(self, uri: str, low: int, high: int | None, blocked: bool = False) -> None:
        self.uri, self.low, self.high, self.blocked = uri, low, high, blocked


def _is_blocked(fs: pafs.FileSystem, path: str) -> bool:
    with fs.open_input_file(path) as f:
        return _block_size(f.read(18)) > 0


def _block_size(head: bytes) -> int:
    """Bytes of the gzip block that begins with ``head``, 0 if it is none of a blocked file."""
    return int.from_bytes(head[16:18], "little") + 1 if len(head) >= 18 and head[:4] == BLOCK_HEAD and head[10:16] == b"\x06\x00BC\x02\x00" else 0


def _plain_chunks(f, low: int, high: int | None) -> Iterator[tuple[bytes, bool]]:
    """Bytes from ``low`` on, and whether they are still before ``high``."""
    f.seek(low)
    while chunk := f.read(CHUNK if high is None or low >= high else min(CHUNK, high - low)):
        yield chunk, high is None or low < high
        low += len(chunk)


def _block_chunks(f, low: int, high: int | None) -> Iterator[tuple[bytes, bool]]:
    """The texts of the blocks that begin at ``low`` or later, and whether they begin before ``high``."""
    at, held = low, b""
    if low:  # find a block by its head and by the head of the next one
        f.seek(low)
        while True:
            new = f.read(CHUNK)
            held += new
            found = -1
            while (found := held.find(BLOCK_HEAD, found + 1)) >= 0:
                size = _block_size(held[found : found + 18])
                if size and (found + size + 18 <= len(held) and _block_size(held[found + size : found + size + 18]) or not new and found + size == len(held)):
                    break
            if found >= 0 or not new:
                break
        if found < 0:
            return
        at += found
    f.seek(at)
    held = b""
    while True:
        while len(held) < 18 or len(held) < _block_size(held[:18]):
            new = f.read(CHUNK)
            if not new:
                if held:
                    raise ValueError("the file ends within a block")
                return
            held += new
        size = _block_size(held[:18])
        if not size:
            raise ValueError(f"no block at byte {at}")
        yield zlib.decompress(held[:size], 31), high is None or at < high
        at, held = at + size, held[size:]


def _gzip_chunks(stream) -> Iterator[tuple[bytes, bool]]:
    while chunk := stream.read(CHUNK):
        yield chunk, True


def _record_start(data: bytes, at_end: bool) -> int | None:
    """Where the first whole record behind the first line end begins; None if more bytes are needed, -1 if there is none."""
    at = data.find(b"\n") + 1
    if not at:
        return -1 if at_end else None
    lines = data[at:].split(b"\n", 8) + [b""] * at_end
    if len(lines) < 8 and not at_end:
        return None
    for k in range(4):
        if len(lines) > k + 3 and lines[k].startswith(b"@") and _SEQUENCE.match(lines[k + 1]) and lines[k + 2].startswith(b"+") and len(lines[k + 1].rstrip(b"\r")) == len(lines[k + 3].rstrip(b"\r")):
            return at + sum(len(x) + 1 for x in lines[:k])
    if at_end:
        return -1
    raise ValueError("no FASTQ record within eight lines")


def records(chunks: Iterable[tuple[bytes, bool]], first: bool, where: str, seen: dict[str, int]) -> Iterator[list[bytes]]:
    """Lists of lines, four to a record, of the records that a range owns. ``first``: the range begins the file.

    ``seen`` gets the bytes inside the range and the blank ones at its end.
    """
    data, at, limit, synced = b"", 0, 0, first
    seen.update(inside=0, blank=0)
    for chunk, inside in chunks:
        data += chunk
        if inside:
            limit += len(chunk)
            blank = len(chunk) - len(chunk.rstrip())
            seen.update(inside=limit, blank=blank + (seen["blank"] if blank == len(chunk) else 0))
        if not synced:
            start = _record_start(data, False)
            if start is None:
                continue
            data, at, synced = data[start:], start, True
        *lines, rest = data.split(b"\n")
        n = len(lines) // 4 * 4
        if not inside:  # records that begin inside, or with the first byte behind, end here
            begins, k = at, 0
            while k < n and begins <= limit:
                begins += sum(len(x) + 1 for x in lines[k : k + 4])
                k += 4
            if k:
                yield lines[:k]
            if begins > limit:
                return
            data, at = b"\n".join([*lines[k:], rest]), begins
            continue
        if n:
            rest = b"\n".join([*lines[n:], rest])
            at, data = at + len(data) - len(rest), rest
            yield lines[:n]
    if not synced:
        start = _record_start(data, True)
        if start < 0:
            return
        data, at = data[start:], start
    lines = data.split(b"\n")
    while lines and not lines[-1].strip():
        lines.pop()
    if len(lines) % 4 == 3 and lines[-2] in (b"", b"\r"):
        lines.append(b"")  # a last record of no letters
    if len(lines) % 4:
        raise ValueError(f"{where} ends within a record")
    k = 0
    while k < len(lines) and at <= limit:
        at += sum(len(x) + 1 for x in lines[k : k + 4])
        k += 4
    if k:
        yield lines[:k]


def _text(lines: list[bytes]) -> pa.Array:
    raw = pa.array(lines, pa.binary())
    if pc.any(pc.ends_with(raw, b"\r")).as_py():
        raw = pa.array([x.rstrip(b"\r") for x in lines], pa.binary())
    try:
        return raw.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x.rstrip(b"\r").decode("ascii", "replace") for x in lines], pa.string())


class FastqReader(DataSourceReader):
    """Reads (file, read_no, header, seq, qual); read_no counts from 1 in each file.

    ``maxReadsPerFile`` stops early in each file. Filters ``read_no <= n``, ``read_no < n`` and conditions on ``file`` are pushed
    down: files are left out, and each is read no further than needed. With ``bytesPerPartition`` large files are read in
    ranges, as (file, part, no, header, seq, qual); with ``countOnly`` too, as (file, part, n). A file that ends within a
    record, or whose records do not begin with ``@``, raises.
    """

    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.most = int(options.get("maxReadsPerFile", 0)) or None
        self.split = int(options.get("bytesPerPartition", 0)) or None
        self.count_only = options.get("countOnly", "false") == "true"
        self.endings = tuple(options.get("endings", ",".join(ENDINGS)).split(","))
        self.wanted: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if f.attribute == ("read_no",) and isinstance(f, (LessThan, LessThanOrEqual)) and not self.split:
                most = f.value - isinstance(f, LessThan)
                self.most = most if self.most is None else min(self.most, most)
            elif f.attribute == ("file",) and isinstance(f, (EqualTo, In, StringStartsWith, StringEndsWith)):
                self.wanted.append(f)
            elif not isinstance(f, IsNotNull):  # nothing is null here
                yield f

    def _is_wanted(self, uri: str) -> bool:
        tests = {EqualTo: lambda f: uri == f.value, In: lambda f: uri in f.value, StringStartsWith: lambda f: uri.startswith(f.value), StringEndsWith: lambda f: uri.endswith(f.value)}
        return all(tests[type(f)](f) for f in self.wanted)

    def partitions(self) -> list[_Range]:
        fs, path = pafs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (pafs.LocalFileSystem(), self.path)
        info = fs.get_file_info(path)
        found = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(path, recursive=True))
        prefix = self.path.split("://")[0] + "://" if "://" in self.path else "file://" + ("" if path.startswith("/") else "/")
        out = []
        for f in sorted(found, key=lambda f: f.path):
            if not (f.is_file and f.path.endswith(self.endings) and self._is_wanted(prefix + f.path)):
                continue
            if self.most is not None and self.most <= 0:
                continue
            zipped = f.path.endswith(".gz")
            blocked = zipped and self.split is not None and f.size > 0 and _is_blocked(fs, f.path)
            if self.split and (blocked or not zipped):
                out += [_Range(prefix + f.path, low, low + self.split if low + self.split < f.size else None, blocked) for low in range(0, max(1, f.size), self.split)]
            else:
                out.append(_Range(prefix + f.path, 0, None))
        return out or [_Range("", 0, None)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        if not partition.uri:
            return
        fs, path = pafs.FileSystem.from_uri(quote(partition.uri, safe=":/@"))
        n, owned, seen = 0, 0, {}
        with fs.open_input_stream(path, compression="gzip") if path.endswith(".gz") and not partition.blocked else fs.open_input_file(path) as f:
            chunks = _gzip_chunks(f) if path.endswith(".gz") and not partition.blocked else (_block_chunks if partition.blocked else _plain_chunks)(f, partition.low, partition.high)
            for lines in records(chunks, partition.low == 0, partition.uri, seen):
                if self.most is not None:
                    lines = lines[: 4 * (self.most - n)]
                header, seq, _, qual = (lines[k::4] for k in range(4))
                bad = None
                if list(map(len, seq)) != list(map(len, qual)) or not all([h.startswith(b"@") for h in header]):
                    bad = next((k for k, (h, s, q) in enumerate(zip(header, seq, qual, strict=True)) if not h.startswith(b"@") or len(s.rstrip(b"\r")) != len(q.rstrip(b"\r"))), None)
                if bad is not None:
                    raise ValueError(f"no FASTQ record at read {n + bad + 1} of {partition.uri}" + f" from byte {partition.low}" * bool(partition.low))
                owned += sum(map(len, lines)) + len(lines)
                if not self.count_only:
                    size = len(header)
                    columns = {"file": pa.repeat(pa.scalar(partition.uri), size), **({"part": pa.repeat(pa.scalar(partition.low, pa.int64()), size), "no": pa.array(range(n + 1, n + size + 1), pa.int64())} if self.split else {"read_no": pa.array(range(n + 1, n + size + 1), pa.int64())}), "header": _text([h[1:] for h in header]), "seq": _text(seq), "qual": _text(qual)}
                    yield pa.RecordBatch.from_pydict(columns)
                n += len(header)
                if n == self.most:
                    break
        if self.count_only:
            yield pa.RecordBatch.from_pydict({"file": pa.array([partition.uri]), "part": pa.array([partition.low], pa.int64()), **{k: pa.array([v], pa.int64()) for k, v in (("n", n), ("owned", owned), ("inside", seen["inside"]), ("blank", seen["blank"]))}})


def bgzip_block(text: bytes) -> bytes:
    """A block of a blocked gzip file; that of no letters ends a file."""
    pack = zlib.compressobj(3, zlib.DEFLATED, -15)
    body = pack.compress(text) + pack.flush()
    head = BLOCK_HEAD + b"\0\0\0\0\0\xff\x06\0BC\x02\0" + (len(body) + 25).to_bytes(2, "little")
    return head + body + zlib.crc32(text).to_bytes(4, "little") + len(text).to_bytes(4, "little")


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]


class FastqWriter(DataSourceArrowWriter):
    """Writes (folder, text) rows, whole records, as blocked gzip files of these folders, and names them at the end.

    A task holds the blocks of at most OPEN folders; the one that it has not written to for longest is closed first, and has
    another file if it comes again.
    """

    def __init__(self, path: str) -> None:
        self.path = path

    def _fs(self) -> tuple[pafs.FileSystem, str]:
        fs, path = pafs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (pafs.LocalFileSystem(), self.path)
        return fs, path.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        fs, path = self._fs()
        files: list[str] = []
        open_: dict[str, tuple[pa.NativeFile, bytearray]] = {}

        def close(folder: str) -> None:
            out, held = open_.pop(folder)
            with out:
                out.write((bgzip_block(bytes(held)) if held else b"") + bgzip_block(b""))

        try:
            for b in iterator:
                folders, texts = b.column(0), b.column(1)
                for folder in folders.unique().to_pylist():
                    if folder in open_:
                        open_[folder] = open_.pop(folder)
                    else:
                        if len(open_) == OPEN:
                            close(next(iter(open_)))
                        fs.create_dir(f"{path}/{folder}")
                        files.append(f"{path}/{folder}/part-{uuid.uuid4().hex}.fastq.gz")
                        open_[folder] = fs.open_output_stream(files[-1] + ".tmp", compression=None), bytearray()
                    out, held = open_[folder]
                    held += ascii_bytes(texts.filter(pc.equal(folders, folder)))[0].tobytes()
                    whole = len(held) // BLOCK * BLOCK
                    for low in range(0, whole, BLOCK):
                        out.write(bgzip_block(bytes(held[low : low + BLOCK])))
                    del held[:whole]
            for folder in list(open_):
                close(folder)
        except BaseException:
            for out, _ in open_.values():
                out.close()
            for f in files:
                if fs.get_file_info(f + ".tmp").is_file:
                    fs.delete_file(f + ".tmp")
            raise
        return _Written(files)

    def commit(self, messages: list[_Written | None]) -> None:
        fs, path = self._fs()
        fs.create_dir(path)
        for f in [f for m in messages if m for f in m.files]:
            fs.move(f + ".tmp", f)

    def abort(self, messages: list[_Written | None]) -> None:
        fs, _ = self._fs()
        for f in [f for m in messages if m for f in m.files]:
            fs.delete_file(f + ".tmp")


class FastqSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return (COUNT_SCHEMA if self.options.get("countOnly") == "true" else SPLIT_SCHEMA) if self.options.get("bytesPerPartition") else SCHEMA

    def reader(self, schema) -> FastqReader:
        return FastqReader(self.options)

    def writer(self, schema, overwrite: bool) -> FastqWriter:
        return FastqWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make the format known, with its filters pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FastqSource)


def write_fastq(reads: DataFrame, path: str, by: str) -> None:
    """(header, seq, qual) rows as blocked gzip files below a folder ``by``=value of ``path`` for each value, some of each task."""
    register(reads.sparkSession)
    lines = F.concat(F.lit("@"), *[x for c, end in (("header", "\n"), ("seq", "\n+\n"), ("qual", "\n")) for x in (F.coalesce(F.col(c), F.lit("")), F.lit(end))])
    folder = F.concat(F.lit(f"{by}="), F.coalesce(F.url_encode(F.col(by).cast("string")), F.lit("__HIVE_DEFAULT_PARTITION__")))
    reads.select(folder.alias("folder"), lines.alias("text")).write.format("fastq").mode("append").save(path)


def read_fastq(spark: SparkSession, path: str, bytes_per_partition: int = 64 << 20, endings: tuple[str, ...] = ENDINGS) -> DataFrame:
    """(file, read_no, header, seq, qual) of all files below ``path``, large ones read in many tasks.

    read_no counts from 1 in each file. A first pass counts the records of every range, a row each; their running sums
    within a file give each range its first number, so that no task sees a whole file and nothing is sorted. It also finds files that end within a record, which raise. Empty files
    have no rows.
    """
    register(spark)
    source = spark.read.format("fastq").option("bytesPerPartition", bytes_per_partition).option("endings", ",".join(endings))
    counts = staged(source.option("countOnly", "true").load(path))
    ends = counts.groupBy("file").agg((F.sum("inside") - F.sum("owned")).alias("left"), F.max_by("blank", F.when(F.col("inside") > 0, F.col("part"))).alias("blank"))
    cut = ends.where("left > coalesce(blank, 0)").select("file").first()
    if cut:
        raise ValueError(f"{cut['file']} ends within a record")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    firsts = counts.select(F.col("file").alias("_file"), F.col("part").alias("_part"), before.alias("_before"))
    if counts.count() <= MAX_BROADCAST_RANGES:
        firsts = F.broadcast(firsts)
    rows = source.option("countOnly", "false").load(path)
    met = rows.join(firsts, (F.col("file") == F.col("_file")) & (F.col("part") == F.col("_part")))
    return met.select("file", (F.col("no") + F.col("_before")).alias("read_no"), "header", "seq", "qual")
