"""SentencePiece BPE encoding with seeded merge dropout, and decoding.

The merges of the model are applied from an agenda (best score first, then leftmost). With ``dropout`` above 0 each
candidate merge that comes up is skipped with that chance, by a draw of its own: a keyed hash of (seed, document, place of
the word in the document) gives how many candidates are applied before the next one is skipped, so every occurrence of a
word is varied anew, and all its segmentations decode to the same text. What a word becomes after given skips does not
depend on the draw; what comes up more than once in a batch is remembered, up to a bound, the rest is merged in one go with
all its skips. The model's own file is read, never trained.
"""

from __future__ import annotations

import heapq
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import small_batches

SPACE = "▁"
#: Words of up to so many characters are merged together, and their segmentations after skips are remembered.
WIDE = 32
#: A word of WIDE characters has fewer candidates than this.
STEPS = 128
#: Fewer words than this are merged one by one.
FEW = 32
#: An odd number that spreads pairs over their table.
SPREAD = 0x9E3779B97F4A7C15


class PieceEncoder:
    """Encode with the vocabulary of a SentencePiece BPE model with byte fallback and identity normalisation."""

    def __init__(self, model: str, dropout: float = 0.1, seed: int = 7, remembered: int = 300_000) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        self.seed, self.remembered = seed, remembered
        m = self.model
        plain = [i for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        self.ids = {m.id_to_piece(i): i for i in plain}
        self.scores = {m.id_to_piece(i): m.get_score(i) for i in plain}
        self.bytes = [m.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # a space mark or a line end in a text is written as bytes; a text is cut there unless a piece could span it
        alone = [SPACE, *["\n"] * (not any("\n" in t for t in self.ids))]
        self.marks = {c: "\n" + c for c in alone}  # no word holds a line end
        self.cut = re.compile("([" + "".join(alone) + "])")
        # a text is cut before each run of spaces, where no piece of the vocabulary can span
        self.texts = [b""] * m.get_piece_size()  # control pieces have no text
        for t, i in self.ids.items():
            self.texts[i] = t.replace(SPACE, " ").encode()
        for b, i in enumerate(self.bytes):
            self.texts[i] = bytes([b])
        # every way to make a piece of two: (left, right) as one number, at its place or the next free one, with the piece
        made = {(self.ids[t[:k]] << 32) | self.ids[t[k:]]: i for t, i in self.ids.items() for k in range(1, len(t)) if t[:k] in self.ids and t[k:] in self.ids}
        bits = max(8, (4 * len(made)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        free = np.iinfo(np.int64).min
        pairs, products = [free] * (1 << bits), [0] * (1 << bits)
        for k, i in made.items():
            at = (k * SPREAD & 0xFFFFFFFFFFFFFFFF) >> (64 - bits)
            while pairs[at] != free:
                at = (at + 1) & self.last
            pairs[at], products[at] = k, i
        self.pairs, self.products = np.array(pairs, np.int64), np.array(products, np.int64)
        # pieces in order of score, in steps of WIDE that leave room for a place in the word; no piece comes last
        score = np.full(m.get_piece_size(), -np.inf)
        score[list(self.ids.values())] = [self.scores[t] for t in self.ids]
        self.order = (WIDE * (1 + np.unique(score, return_inverse=True)[1])).astype(np.int32)
        self.order[0] = -2 * WIDE
        self.chars = np.full(0x110000, -1, np.int32)
        for t, i in self.ids.items():
            if len(t) == 1:
                self.chars[ord(t)] = i

        # chances, of 2**53, that at most so many candidates are applied before one is skipped
        keep, left = 2**24 - int(dropout * 2**24), 2**53
        self.gaps: list[int] = []
        while keep < 2**24 and left:
            left = left * keep >> 24
            self.gaps.append(2**53 - left)
        self.gap_table = np.array(self.gaps, np.uint64)
        # what is remembered: nodes, each a word after given skips, with its ids in the pool and how many candidates came up
        self.roots: dict[str, int] = {}
        self.words_of: dict[int, str] = {}
        self.children: dict[int, int] = {}  # node * STEPS + place of one skip more
        self.count = 0
        self.starts, self.born_of = np.zeros(1024, np.int64), np.zeros(1024, np.int64)  # of a child its number in children
        self.sizes, self.steps, self.wide = np.zeros(1024, np.int32), np.zeros(1024, np.int32), np.zeros(1024, bool)
        self.pool, self.pooled = np.zeros(4096, np.int32), 0
        for c, w in self.marks.items():
            raw = np.array([self.bytes[b] for b in c.encode()], np.int32)
            self.roots[w] = self._add([len(w)], raw, np.array([len(raw)]), np.array([0]))

    def _add(self, lengths: list[int] | np.ndarray, ids: np.ndarray, sizes: np.ndarray, steps: np.ndarray) -> int:
        """Append nodes of words of some lengths; the number of the first."""
        first, last, end = self.count, self.count + len(lengths), self.pooled + len(ids)
        while last > len(self.starts):
            for name in ("starts", "born_of", "sizes", "steps", "wide"):
                x = getattr(self, name)
                setattr(self, name, np.concatenate([x, np.zeros_like(x)]))
        if end > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.pooled], np.zeros(end, np.int32)])
        self.count = last
        self.sizes[first:last], self.steps[first:last], self.wide[first:last] = sizes, steps, np.asarray(lengths) > WIDE
        self.starts[first:last] = self.pooled + np.cumsum(sizes) - sizes
        self.pool[self.pooled : end] = ids
        self.pooled = end
        return first

    def _path(self, child: int) -> tuple[str, tuple[int, ...]]:
        """The word and the skips of a child, given as node * STEPS + place."""
        skips = [child % STEPS]
        node = child // STEPS
        while node not in self.words_of:
            child = int(self.born_of[node])
            skips.append(child % STEPS)
            node = child // STEPS
        return self.words_of[node], tuple(reversed(skips))

    def _drop(self, nodes: int) -> None:
        """Forget all nodes from this one on."""
        if nodes < self.count:
            self.pooled = int(self.starts[nodes])
            self.count = nodes

    def merge(self, word: str, skips: Iterable[int] = ()) -> tuple[list[int], int]:
        """Ids of one word (with its leading space marks), and how many candidates came up.

        The agenda holds the best score at each adjacent pair. The candidates at the places ``skips``, in the order in
        which they come up, are not applied, and never offered again.
        """
        sym = list(word)
        known, due, step, none = self.scores.get, iter(skips), 0, -1e30
        skip = next(due, -1)
        if len(sym) > 64:
            return self._merge_long(sym, due, skip)
        agenda = [known(sym[i] + sym[i + 1], none) for i in range(len(sym) - 1)]
        while agenda and (best := max(agenda)) > none:
            i = agenda.index(best)
            step += 1
            if step - 1 == skip:
                agenda[i], skip = none, next(due, -1)
                continue
            sym[i] += sym.pop(i + 1)
            agenda.pop(i)
            if i < len(agenda):
                agenda[i] = known(sym[i] + sym[i + 1], none)
            if i:
                agenda[i - 1] = known(sym[i - 1] + sym[i], none)
        return self._ids(sym), step

    def _merge_long(self, sym: list[str], due: Iterator[int], skip: int) -> tuple[list[int], int]:
        """The same from a heap, for runs of hundreds or thousands of characters without a space."""
        n, step = len(sym), 0
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[float, int, str, int]] = []

        def push(i: int) -> None:
            j = after[i]
            if j >= 0 and (s := self.scores.get(sym[i] + sym[j])) is not None:
                heapq.heappush(heap, (-s, i, sym[i] + sym[j], j))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, piece, j = heapq.heappop(heap)
            if not sym[i] or not sym[j] or after[i] != j or sym[i] + sym[j] != piece:
                continue
            step += 1
            if step - 1 == skip:
                skip = next(due, -1)
                continue
            sym[i], sym[j], after[i] = piece, "", after[j]
            if after[i] >= 0:
                before[after[i]] = i
                push(i)
            if before[i] >= 0:
                push(before[i])
        return self._ids([s for s in sym if s]), step

    def _ids(self, sym: list[str]) -> list[int]:
        out: list[int] = []
        for s in sym:
            k = self.ids.get(s)
            out.extend([k] if k is not None else [self.bytes[b] for b in s.encode("utf-8")])
        return out

    def words(self, text: str, first: bool = True) -> list[str]:
        """Cut a text before each run of spaces; the first word of a text has the model's own space mark."""
        parts = ((SPACE if first else "") + text.replace(" ", SPACE)).split(SPACE)
        if "" not in parts[1:]:
            return [*([parts[0]] if parts[0] else []), *[SPACE + p for p in parts[1:]]]
        out = [parts[0]] if parts[0] else []
        held = 0
        for p in parts[1:]:
            held += 1
            if p:
                out.append(SPACE * held + p)
                held = 0
        return [*out, SPACE * held] if held else out

    def _made(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The pieces that adjacent pieces make, 0 where they make none."""
        want = (left << 32) | right
        at = ((want.view(np.uint64) * np.uint64(SPREAD)) >> self.shift).view(np.int64)
        found = self.pairs[at]
        out = np.where(found == want, self.products[at], 0)
        open_ = np.flatnonzero((found != want) & (found >= 0) & (want >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.last
            found = self.pairs[at[open_]]
            hit = found == want[open_]
            out[open_[hit]] = self.products[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    def merge_many(self, wanted: list[tuple[str, tuple[int, ...]]]) -> np.ndarray:
        """Nodes of many (word, skips), merged at once."""
        most = max((len(x) for _, x in wanted), default=0)
        skips = np.full((len(wanted), most + 1), STEPS, np.int64)
        for k, (_, x) in enumerate(wanted):
            if x:
                skips[k, : len(x)] = x
        return self._merge_all([w for w, _ in wanted], skips[:, 0], lambda k, turn, step: skips[k, turn], lambda k: wanted[k][1])

    def _merge_drawn(self, words: list[str], places: np.ndarray) -> np.ndarray:
        """Nodes of single occurrences, each with all the skips that its place draws."""
        if not self.gaps:
            return self.merge_many([(w, ()) for w in words])
        return self._merge_all(words, self._gaps(places, 0), lambda k, turn, step: step + 1 + self._gaps(places[k], turn), lambda k: self._skips(int(places[k])))

    def _merge_all(self, words: list[str], due: np.ndarray, follow: Callable, one: Callable) -> np.ndarray:
        """Nodes of words with the skips that begin with ``due`` (see ``_rounds``), or that ``one`` lists for a word.

        Long words and words with characters outside the vocabulary are merged one by one.
        """
        nodes = np.zeros(len(words), np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes) - sizes
        chars = self.chars[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)]
        widths = -(-sizes // 4) * 4
        single = [np.flatnonzero(widths > WIDE)]
        for width in range(4, WIDE + 1, 4):
            group = np.flatnonzero(widths == width)
            if len(group) < FEW:
                single.append(group)
                continue
            for low in range(0, len(group), 8192):
                some = group[low : low + 8192]
                at = np.arange(width)
                ids = np.where(at < sizes[some, None], chars[np.minimum(starts[some, None] + at, len(chars) - 1)], -2)
                odd = (ids == -1).any(axis=1)
                if odd.any():
                    single.append(some[odd])
                    some, ids = some[~odd], ids[~odd]
                if len(some):
                    nodes[some] = self._add(sizes[some], *self._rounds(ids, due[some], lambda k, turn, step, some=some: follow(some[k], turn, step))) + np.arange(len(some))
        alone = np.concatenate(single)
        if len(alone):
            done = [self.merge(words[k], one(k)) for k in alone.tolist()]
            flat = np.array(list(chain.from_iterable(x for x, _ in done)), np.int32)
            nodes[alone] = self._add(sizes[alone], flat, np.array([len(x) for x, _ in done]), np.array([n for _, n in done])) + np.arange(len(alone))
        return nodes

    def _rounds(self, ids: np.ndarray, due: np.ndarray, follow: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words one after the other, how many each has, and how many candidates came up.

        Each round takes the best entry of every word's agenda. ``due`` is the first place that a word skips,
        ``follow(words, turns, place)`` the next ones of words that skip at a place for the first time, second, and so on.
        """
        n, width = ids.shape[0], ids.shape[1] + 2
        # the pieces of a word stand where they begin, between two ends that make no piece; each knows its neighbours
        sym = np.full((n, width), -2, np.int64)
        sym[:, 1:-1] = ids
        sym = sym.ravel()
        piece = self._made(sym, np.append(sym[1:], -2))
        # the agenda: order of the piece, then leftmost first
        agenda = np.ascontiguousarray((self.order[piece].reshape(n, width) + np.arange(WIDE, WIDE - width, -1, np.int32)).T)
        before, after = np.arange(-1, n * width - 1), np.arange(1, n * width + 1)
        rows, due, turn, steps = np.arange(n), due.copy(), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for step in range(STEPS):
            best = agenda.max(axis=0)
            here = np.flatnonzero(best > 0)
            if 4 * len(here) < 3 * len(rows):
                agenda, rows, best = agenda.take(here, axis=1), rows[here], best[here]
                here = np.arange(len(rows))
            if not len(here):
                break
            row, column = rows[here], WIDE - (best[here] & (WIDE - 1)).astype(np.int64)
            steps[row] = step + 1
            skip = due[row] == step
            if skip.any():
                agenda[column[skip], here[skip]] = -WIDE
                some = row[skip]
                turn[some] += 1
                due[some] = follow(some, turn[some], step)
                here, row, column = here[~skip], row[~skip], column[~skip]
            first = row * width
            at = first + column
            gone, left, new = after[at], before[at], piece[at]
            right = after[gone]
            sym[at], sym[gone], after[at], before[right] = new, -2, right, at
            agenda[gone - first, here] = -WIDE
            both, place, where = np.concatenate([at, left]), np.concatenate([column, left - first]), np.concatenate([here, here])
            piece[both] = made = self._made(np.concatenate([new, sym[left]]), np.concatenate([sym[right], new]))
            agenda[place, where] = self.order[made] + (WIDE - place)
        kept = sym >= 0
        return sym[kept].astype(np.int32), kept.reshape(n, width).sum(axis=1), steps

    def _gaps(self, places: np.ndarray, k: int | np.ndarray) -> np.ndarray:
        """How many candidates of each occurrence are applied between its skips k - 1 and k."""
        x = places + np.atleast_1d(k).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return np.searchsorted(self.gap_table, (x ^ (x >> np.uint64(31))) >> np.uint64(11), "right")

    def _skips(self, place: int) -> Iterator[int]:
        """The places of all skips of one occurrence, from the same draws."""
        at, k, most = -1, 0, 0xFFFFFFFFFFFFFFFF
        while True:
            x = (place + k * 0xD1B54A32D192ED03) & most
            x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & most
            x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & most
            at += 1 + bisect_right(self.gaps, (x ^ (x >> 31)) >> 11)
            yield at
            k += 1

    def _places(self, keys: list, counts: list[int]) -> np.ndarray:
        """One number for each occurrence, from the key of its document and its place there."""
        own = np.array([xxhash.xxh3_64_intdigest(str(k), self.seed) for k in keys], np.uint64)
        ends = np.cumsum(counts)
        at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
        return np.repeat(own, counts) + at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def encode_many(self, texts: list[str | None], keys: list) -> list[np.ndarray]:
        """Ids of whole texts; null and empty texts have none. ``keys`` name the documents.

        A space mark that a text itself holds is written as bytes, since the model would decode it as a space.
        """
        cut = [self._flat(t) if t else [] for t in texts]
        counts = [len(c) for c in cut]
        words = list(chain.from_iterable(cut))
        before = self.count
        places = self._places(keys, counts)
        node = np.fromiter(map(self.roots.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(node < 0)
        texts_of = list(map(words.__getitem__, unknown.tolist()))
        fresh = [w for w, n in Counter(texts_of).items() if n > 1]
        made = self.merge_many([(w, ()) for w in fresh]).tolist()
        self.roots.update(zip(fresh, made, strict=True))
        self.words_of.update(zip(made, fresh, strict=True))
        node[unknown] = np.fromiter(map(self.roots.get, texts_of, repeat(-1)), np.int64, len(unknown))
        born: list[int] = []
        alone = [unknown[node[unknown] < 0]]
        if self.gaps:
            # from each word to what it is after its first skip, its second, and so on
            some, k = np.flatnonzero(node >= 0), 0
            at = self._gaps(places[some], 0)
            while True:
                go = at < self.steps[node[some]]
                some, at = some[go], at[go]
                if k == 0:
                    wide = self.wide[node[some]]
                    alone.append(some[wide])
                    some, at = some[~wide], at[~wide]
                if not len(some):
                    break
                want, which, n = np.unique(node[some] * STEPS + at, return_inverse=True, return_counts=True)
                got = np.array([self.children.get(x, -1) for x in want.tolist()], np.int64)
                more = (got < 0) & (n > 1)
                new = want[more].tolist()
                if new:
                    got[more] = nodes = self.merge_many(list(map(self._path, new)))
                    self.born_of[nodes] = new
                    self.children.update(zip(new, nodes.tolist(), strict=True))
                    born += new
                node[some] = got = got[which]
                alone.append(some[got < 0])
                some = some[got >= 0]
                k += 1
                at = at[got >= 0] + 1 + self._gaps(places[some], k)
        after = self.count
        rest = np.concatenate(alone)
        node[rest] = self._merge_drawn(list(map(words.__getitem__, rest.tolist())), places[rest])
        sizes = self.sizes[node].astype(np.int64)
        ends = np.cumsum(sizes)
        flat = self.pool[np.repeat(self.starts[node] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)].tolist()
        self._drop(after)
        if after > self.remembered or self.pooled > 16 * self.remembered:
            for w in fresh:
                del self.words_of[self.roots.pop(w)]
            for x in born:
                del self.children[x]
            self._drop(before)
        return [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def _flat(self, text: str) -> list[str]:
        """The words of a text, and what is written as bytes between them."""
        first, *rest = self.cut.split(text)
        out = self.words(first) if first else [SPACE]
        for i in range(0, len(rest), 2):
            out.append(self.marks[rest[i]])
            if rest[i + 1]:
                out += self.words(rest[i + 1], False)
        return out

    def __call__(self, text: str | None, key: int = 0) -> np.ndarray:
        return self.encode_many([text], [key])[0]

    def decode(self, ids: list[int]) -> str:
        """The text of ids, however they were merged."""
        raw = b"".join(map(self.texts.__getitem__, ids))
        return (raw[1:] if raw.startswith(b" ") else raw).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def piece_encoder(model: str, dropout: float, seed: int) -> PieceEncoder:
    """One encoder for the life of a worker process, with what it remembers."""
    return PieceEncoder(model, dropout, seed)


def _free_names(columns: list[str], n: int) -> list[str]:
    """Names that no column has, in any case of letters."""
    taken = {c.lower() for c in columns}
    return [x for x in (f"own{i}" for i in range(len(taken) + n)) if x not in taken][:n]


def encoded(docs: DataFrame, model: str, dropout: float = 0.1, seed: int = 7, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without its text, with piece_ids (array of int) instead.

    Equal (key, text) rows get equal ids. Null and empty texts get an empty array. Whole texts are encoded; other
    columns pass through whatever their names, but a column called piece_ids, which is replaced.
    """
    small_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c not in (text, "piece_ids")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = piece_encoder(model, dropout, seed)
        for b in batches:
            ids = encode.encode_many(b.column(len(keep)).to_pylist(), b.column(len(keep) + 1).to_pylist())
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            values = np.concatenate(ids) if ids else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))], names=[*keep, "piece_ids"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[F.col(f"`{c}`") for c in keep]).schema)
    free = _free_names(docs.columns, 2)
    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(free[0]), F.col(f"`{key}`").alias(free[1])).mapInArrow(run, f"{fields + ', ' if keep else ''}piece_ids array<int>")


def decoded(rows: DataFrame, model: str, ids: str = "piece_ids", text: str = "text") -> DataFrame:
    """``rows`` with the text of ``ids`` instead of them; null ids give a null text."""
    small_batches(rows.sparkSession)
    keep = [c for c in rows.columns if c not in (ids, text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = piece_encoder(model, 0.0, 0).decode
        for b in batches:
            texts = [None if x is None else decode(x) for x in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], pa.array(texts, pa.string())], names=[*keep, text])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*[F.col(f"`{c}`") for c in keep]).schema)
    return rows.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{ids}`").alias(_free_names(rows.columns, 1)[0])).mapInArrow(run, f"{fields + ', ' if keep else ''}`{text}` string")


def round_trip(docs: DataFrame, model: str, dropout: float = 0.1, seed: int = 7) -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, lossless): every whole text encoded and decoded again in one pass.

    ids_crc32 is that of the ids as little-endian 32-bit integers; null texts count as empty.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(model, dropout, seed)
        for b in batches:
            texts = b.column("text").to_pylist()
            ids = encoder.encode_many(texts, b.column("doc_id").to_pylist())
            same = [encoder.decode(x.tolist()) == (t or "") for x, t in zip(ids, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()), pa.array([zlib.crc32(x.astype("<i4").tobytes()) for x in ids], pa.int64()), pa.array(same)], names=["doc_id", "n_pieces", "ids_crc32", "lossless"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, n_pieces bigint, ids_crc32 bigint, lossless boolean")
