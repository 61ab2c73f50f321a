"""Toxic spans and scores of documents: a linear-chain conditional random field over words.

Each word is toxic or not. Its evidence is the sum of weights of its whole form and of its beginnings, so that inflected
forms of a word are known by their stem; neighbouring words are tied by transition weights. The field learns from
labelled words: in a document labelled toxic, those whose form or beginning is much more common in toxic documents than
in others, tested beyond chance; all words of clean documents are not toxic. Forward-backward gives every
word's marginal; a document's score is a logistic of what its marginals add up to, fitted on documents that the field of
the other half of the sample has not seen. Words with a marginal of half or more make the offending spans.

A chain of two states is a product of 2 x 2 matrices, so many documents are run as one chain that starts anew at each;
products of blocks are taken first, then carried from block to block, then along all blocks at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import least_hashed, small_batches

#: Bounds of the labelled sample: documents of each label, and bytes of their texts; least keyed hashes first.
MAX_LABELLED, MAX_BYTES = 4_000, 8 << 20
#: Beginnings of so many bytes are evidence, beside the whole word.
PREFIXES = (3, 4, 5, 6, 7, 8)
#: Evidence counts if it stands in so many toxic documents; of more, the most frequent are kept.
MIN_DOCS, MAX_EVIDENCE = 3, 100_000
#: Bytes of text whose words are looked up at a time.
PIECE = 1 << 20
_STEP = 64
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _lower(raw: np.ndarray) -> np.ndarray:
    """Bytes of UTF-8 with A-Z and the capitals U+00C0 to U+00DE in lower case; lengths stay."""
    out = raw.copy()
    out[(raw >= 65) & (raw <= 90)] += 32
    latin = np.zeros(len(raw), bool)
    latin[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
    out[latin] += 32
    return out


@dataclass
class Words:
    """Words of a batch of texts: runs of ASCII letters and of all bytes beyond ASCII."""

    first: np.ndarray  # bytes, in the joined batch
    last: np.ndarray
    doc: np.ndarray
    bounds: np.ndarray  # where each text begins, and one past the end

    @classmethod
    def of(cls, raw: np.ndarray, bounds: np.ndarray) -> Words:
        letter = ((raw | 32) >= 97) & ((raw | 32) <= 122) | (raw >= 0x80)
        edge = np.diff(np.concatenate([[0], letter.view(np.int8), [0]]))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        return cls(first, last, np.searchsorted(bounds, first, "right") - 1, bounds)


def joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Texts as one run of bytes, a line end behind each, and where each begins."""
    parts = [(t or "").encode("utf-8", "surrogatepass") + b"\n" for t in texts]
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])


def evidence(raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hashes of the whole words (column 0) and of their beginnings; 0 where a word is no longer than that."""
    out = np.zeros((len(first), 1 + len(PREFIXES)), np.uint64)
    if not len(first):
        return out
    low, size = int(first[0]), last - first
    some = raw[low : int(last[-1])].astype(np.uint64) + np.uint64(1)
    inside = np.repeat(first - low - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    place = np.arange(size.sum()) - np.repeat(np.concatenate([[0], np.cumsum(size)[:-1]]), size)
    powers = np.cumprod(np.full(int(size.max()) + 1, _ODD), dtype=np.uint64)
    total = np.concatenate([[np.uint64(0)], np.cumsum(some[inside] * powers[place], dtype=np.uint64)])
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    for k, n in enumerate((0, *PREFIXES)):
        at = np.flatnonzero(size > n) if n else np.arange(len(first))
        end = start[at] + (n if n else size[at])
        h = (total[end] - total[start[at]]) * _ODD + np.uint64((k + 1) * 0xD6E8FEB86659FD93 % 2**64)
        h ^= h >> np.uint64(29)
        out[at, k] = np.maximum(h * np.uint64(0xBF58476D1CE4E5B9), np.uint64(1))
    return out


@dataclass
class Table:
    """Weights by 64-bit hash; a slot of the table holds one hash, the one added last."""

    bits: int = 20
    keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))

    def __post_init__(self) -> None:
        self.slot_key, self.slot_at = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, -1, np.int32)
        slot = self.keys >> np.uint64(64 - self.bits)
        self.slot_key[slot], self.slot_at[slot] = self.keys, np.arange(len(self.keys))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of hashes among the keys, -1 where there is none."""
        slot = hashes >> np.uint64(64 - self.bits)
        return np.where((self.slot_key[slot] == hashes) & (hashes != 0), self.slot_at[slot], -1)


def _times(p: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Products of 2 x 2 matrices, rows of (00, 01, 10, 11), scaled to a greatest entry of 1."""
    out = np.stack([p[0] * m[0] + p[1] * m[2], p[0] * m[1] + p[1] * m[3], p[2] * m[0] + p[3] * m[2], p[2] * m[1] + p[3] * m[3]])
    return out / out.max(axis=0)


def forward_backward(scores: np.ndarray, starts: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of state 1 and, for all words but the first of each text, of the pairs (00, 01, 10, 11) with the word before.

    ``scores``: evidence for state 1 of each word; ``starts``: whether a word is the first of its text; ``transitions``
    (2 x 2) and ``start`` are weights, not logarithms.
    """
    n = len(scores)
    if not n:
        return np.empty(0), np.empty((4, 0))
    rows = -(-n // _STEP)
    e1 = 1 / (1 + np.exp(-np.clip(scores, -40, 40)))
    first = np.concatenate([starts, np.ones(rows * _STEP - n, bool)]).reshape(rows, _STEP)
    one = np.concatenate([e1, np.full(rows * _STEP - n, 0.5)]).reshape(rows, _STEP)

    def step(k: int) -> np.ndarray:
        e, f = one[:, k], first[:, k]
        return np.stack([np.where(f, start[j], transitions[i, j]) * (e if j else 1 - e) for i in (0, 1) for j in (0, 1)])

    product = step(0)
    for k in range(1, _STEP):
        product = _times(product, step(k))
    ahead, behind = np.empty((2, rows)), np.empty((2, rows))
    a, p = (1.0, 1.0), product.T.tolist()
    for r in range(rows):
        ahead[:, r] = a
        m = p[r]
        x, y = a[0] * m[0] + a[1] * m[2], a[0] * m[1] + a[1] * m[3]
        a = (x / (x + y), y / (x + y))
    b = (1.0, 1.0)
    for r in range(rows - 1, -1, -1):
        behind[:, r] = b
        m = p[r]
        x, y = m[0] * b[0] + m[1] * b[1], m[2] * b[0] + m[3] * b[1]
        b = (x / (x + y), y / (x + y))
    alpha, beta = np.empty((2, rows, _STEP)), np.empty((2, rows, _STEP))
    before = np.empty((2, rows, _STEP))
    a = ahead
    for k in range(_STEP):
        before[:, :, k] = a
        m = step(k)
        a = np.stack([a[0] * m[0] + a[1] * m[2], a[0] * m[1] + a[1] * m[3]])
        a = a / a.sum(axis=0)
        alpha[:, :, k] = a
    b = behind
    for k in range(_STEP - 1, -1, -1):
        beta[:, :, k] = b
        m = step(k)
        b = np.stack([m[0] * b[0] + m[1] * b[1], m[2] * b[0] + m[3] * b[1]])
        b = b / b.sum(axis=0)
    alpha, beta, before = (x.reshape(2, -1)[:, :n] for x in (alpha, beta, before))
    both = alpha * beta
    e = np.stack([1 - e1, e1])
    pairs = np.stack([before[i] * transitions[i, j] * e[j] * beta[j] for i in (0, 1) for j in (0, 1)])
    return both[1] / both.sum(axis=0), (pairs / pairs.sum(axis=0))[:, ~starts]


@dataclass
class Model:
    """The field, and the logistic from a document's marginals to its score."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    transitions: np.ndarray  # logarithms, that of (0, 0) is 0
    start: float  # logarithm of the weight of a first word being toxic
    logistic: np.ndarray = field(default_factory=lambda: np.zeros(5))

    def __post_init__(self) -> None:
        self.table = Table(keys=self.keys)

    def scores(self, at: np.ndarray) -> np.ndarray:
        return self.bias + np.where(at >= 0, self.weights[at] if len(self.weights) else 0.0, 0.0).sum(axis=1)

    def chain(self, scores: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return forward_backward(scores, starts, np.exp(self.transitions), np.exp([0.0, self.start]))

    def tag(self, texts: list[str | None]) -> tuple[np.ndarray, Words, np.ndarray]:
        """Marginals of all words, the words, and the bytes of the batch. Words are looked up piece by piece."""
        raw, bounds = joined(texts)
        words = Words.of(raw, bounds)
        low_raw, parts, low = _lower(raw), [], 0
        while low < len(words.first):
            high = max(low + 1, int(np.searchsorted(words.last, words.first[low] + PIECE, "right")))
            parts.append(self.scores(self.table.find(evidence(low_raw, words.first[low:high], words.last[low:high]))))
            low = high
        scores = np.concatenate(parts) if parts else np.empty(0)
        return self.chain(scores, _starts(words.doc))[0], words, raw

    def score(self, marginals: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
        """The score of each of ``n_docs`` documents, between 0 and 1."""
        z = _aggregates(marginals, doc, n_docs) @ self.logistic
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _starts(doc: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], doc[1:] != doc[:-1]])[: len(doc)]


def _aggregates(p: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """What the marginals of each document add up to: expected toxic words, minus the logarithm of none, greatest, words."""
    total = np.bincount(doc, p, n)
    none = np.bincount(doc, -np.log1p(-np.minimum(p, 1 - 1e-6)), n)
    most = np.zeros(n)
    np.maximum.at(most, doc, p)
    return np.column_stack([np.ones(n), np.log(total + 1e-3) + 7, np.log(none + 1e-3) + 7, most, np.log1p(np.bincount(doc, minlength=n))])


def _fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weighted logistic regression by Newton's steps; the first column, of ones, is not penalised."""
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        g = x.T @ (weight * (p - y)) + penalty @ w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(h, g)
        w -= step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


def telling_evidence(n1: np.ndarray, of1: int, n0: np.ndarray, of0: int, least_ratio: float, tests: int, error: float = 0.05) -> np.ndarray:
    """Which evidence is more common in the ``of1`` toxic than in the ``of0`` clean documents: by ``least_ratio`` at least,
    and beyond chance by Chernoff's bound of the binomial tail, corrected for the number of ``tests``."""
    n, even = n1 + n0, of1 / (of1 + of0)
    share = n1 / np.maximum(n, 1)
    log = lambda x: np.log(np.maximum(x, 1e-300))
    surprise = n * (share * log(share / even) + (1 - share) * log((1 - share) / (1 - even)))
    return (n1 / of1 >= least_ratio * (n0 + 0.5) / (of0 + 1)) & (surprise >= np.log(max(1, tests) / error)) & (share > even)


@dataclass
class _Sample:
    """Labelled documents: for each word its document and label, and the evidence of those words that have any."""

    doc: np.ndarray
    toxic: np.ndarray
    where: np.ndarray  # words with evidence, ascending
    at: np.ndarray  # their evidence, -1 where there is none

    def part(self, which: np.ndarray) -> _Sample:
        """The documents for which ``which`` is true."""
        words, given = which[self.doc], which[self.doc[self.where]]
        return _Sample(self.doc[words], self.toxic[words], (np.cumsum(words) - 1)[self.where[given]], self.at[given])

    def scores(self, model: Model, low: int, high: int) -> tuple[np.ndarray, slice]:
        cut = slice(*np.searchsorted(self.where, [low, high]))
        out = np.full(high - low, model.bias)
        out[self.where[cut] - low] = model.scores(self.at[cut])
        return out, cut


def _batches(texts: list[str | None], size: int = PIECE) -> Iterator[slice]:
    low, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held > size or i + 1 == len(texts):
            yield slice(low, i + 1)
            low, held = i + 1, 0


def _hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    raw, bounds = joined(texts)
    words = Words.of(raw, bounds)
    return evidence(_lower(raw), words.first, words.last), words.doc


def _documents_with(texts: list[str | None], keys: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of evidence (only those of ``keys``, sorted, if given) and the number of documents that have each."""
    found, n = np.empty(0, np.uint64), np.empty(0, np.int64)
    for cut in _batches(texts):
        h, doc = _hashes(texts[cut])
        doc = np.repeat(doc, h.shape[1])
        h = h.ravel()
        ok = h != 0
        if keys is not None:
            ok &= keys[np.minimum(np.searchsorted(keys, h), len(keys) - 1)] == h
        h, doc = h[ok], doc[ok]
        order = np.lexsort((doc, h))
        u, c = np.unique(h[order][_changes(h[order], doc[order])], return_counts=True)
        found, inverse = np.unique(np.concatenate([found, u]), return_inverse=True)
        n = np.bincount(inverse, np.concatenate([n, c]), len(found)).astype(np.int64)
    return found, n


def _words_before(texts: list[str | None], keys: np.ndarray) -> np.ndarray:
    """How many different words stand before each of ``keys`` (sorted): copies of a document have the same."""
    pairs = np.empty((0, 2), np.uint64)
    for cut in _batches(texts):
        h, _ = _hashes(texts[cut])
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        row, column = np.nonzero(keys[at] == h)
        before = np.concatenate([[np.uint64(1)], h[:-1, 0]])[: len(h)]
        pairs = np.concatenate([pairs, np.column_stack([at[row, column].astype(np.uint64), before[row]])])
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        pairs = pairs[_changes(pairs[:, 0], pairs[:, 1])]
    return np.bincount(pairs[:, 0].astype(np.int64), minlength=len(keys))


def _changes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[: len(a)]


def _edges(doc: np.ndarray, block: int) -> list[int]:
    """Where blocks of whole documents, of ``block`` words or more, begin, and the end."""
    edges = [0]
    for c in [*np.flatnonzero(_starts(doc))[1:].tolist(), len(doc)]:
        if c - edges[-1] >= block or c == len(doc) > 0:
            edges.append(c)
    return edges


def _fit_field(model: Model, sample: _Sample, epochs: int = 8, rate: float = 0.25, ridge: float = 1e-4, block: int = 1 << 16) -> Model:
    """Maximise the likelihood of the labelled words by steps of Adam over blocks of whole documents."""
    starts, edges = _starts(sample.doc), _edges(sample.doc, block)
    theta = np.concatenate([model.weights, [model.bias, model.start], model.transitions.ravel()])
    k = len(model.weights)
    m, v, t = np.zeros_like(theta), np.zeros_like(theta), 0
    for epoch in range(epochs):
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            y, s = sample.toxic[low:high].astype(float), starts[low:high]
            model.weights, model.bias, model.start, model.transitions = theta[:k], theta[k], theta[k + 1], theta[k + 2 :].reshape(2, 2)
            scores, cut = sample.scores(model, low, high)
            p, pairs = model.chain(scores, s)
            off = p - y
            g = np.zeros_like(theta)
            at = sample.at[cut]
            given = at >= 0
            g[:k] = np.bincount(at[given], np.repeat(off[sample.where[cut] - low], given.sum(axis=1)), k)[:k]
            g[k], g[k + 1] = off.sum(), off[s].sum()
            before, here = np.concatenate([[0.0], y[:-1]])[~s], y[~s]
            seen = np.stack([(1 - before) * (1 - here), (1 - before) * here, before * (1 - here), before * here])
            g[k + 2 :] = pairs.sum(axis=1) - seen.sum(axis=1)
            g[k + 2] = 0
            g = g + ridge * (high - low) / max(1, len(sample.doc)) * len(edges) * theta
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            theta = theta - rate / (1 + 0.3 * epoch) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-6)
    model.weights, model.bias, model.start, model.transitions = theta[:k], float(theta[k]), float(theta[k + 1]), theta[k + 2 :].reshape(2, 2)
    return model


def fit(texts: list[str | None], toxic: list[int], class_sizes: tuple[int, int], least_ratio: float = 3.0) -> Model:
    """Fit field and logistic on labelled texts, a sample of ``class_sizes`` clean and toxic documents.

    Without documents of both labels, or without evidence, every score is the share of toxic documents.
    """
    y = np.array(toxic, np.int64)
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    share = (class_sizes[1] + 1) / (sum(class_sizes) + 2)
    empty = Model(np.empty(0, np.uint64), np.empty(0), -5.0, np.zeros((2, 2)), 0.0, np.array([np.log(share / (1 - share)), 0, 0, 0, 0]))
    bad = [t for t, l in zip(texts, y, strict=True) if l == 1]
    keys, df1 = _documents_with(bad)
    often = df1 >= MIN_DOCS
    keys, df1 = keys[often], df1[often]
    if not len(keys) or not n0:
        return empty
    seen, n = _documents_with([t for t, l in zip(texts, y, strict=True) if l == 0], keys)
    df0 = np.zeros(len(keys), np.int64)
    df0[np.searchsorted(keys, seen)] = n
    ok = np.flatnonzero(telling_evidence(df1, n1, df0, n0, least_ratio, len(keys)))
    apart = np.minimum(df1[ok], _words_before(bad, keys[ok])) if len(ok) else df1[ok]
    telling = keys[ok[telling_evidence(apart, n1, df0[ok], n0, least_ratio, len(keys))]]
    if not len(telling):
        return empty
    # words with telling evidence are labelled toxic; their other evidence may help and may not
    beside = [np.empty(0, np.uint64)]
    find = Table(keys=telling).find
    for cut in _batches(texts):
        if (y[cut] == 1).any():
            h, doc = _hashes(texts[cut])
            hit = (find(h) >= 0).any(axis=1) & (y[cut][doc] == 1)
            beside.append(np.unique(h[hit]))
    kept = np.isin(keys, np.concatenate(beside))
    keys, df1 = keys[kept], df1[kept]
    keys = keys[np.argsort(-df1, kind="stable")[:MAX_EVIDENCE]][::-1].copy()  # of two in one slot the more frequent is added last
    table = Table(keys=keys)
    parts, before = [], 0
    for cut in _batches(texts):
        h, doc = _hashes(texts[cut])
        at = table.find(h).astype(np.int32)
        where = np.flatnonzero((at >= 0).any(axis=1))
        parts.append(((doc + cut.start).astype(np.int32), (find(h) >= 0).any(axis=1) & (y[cut][doc] == 1), where + before, at[where]))
        before += len(doc)
    whole = _Sample(*[np.concatenate(x) for x in zip(*parts, strict=True)])
    # toxic documents none of whose words could be labelled would teach that all their words are clean
    labelled = np.bincount(whole.doc, whole.toxic, len(y)) > 0
    teaches = labelled | (y == 0)
    new = lambda: Model(keys, np.zeros(len(keys)), -4.0, np.zeros((2, 2)), 0.0)
    x = np.zeros((len(y), 5))
    fold = np.zeros(len(y), np.int64)
    for label in (0, 1):
        fold[y == label] = np.arange((y == label).sum()) % 2
    for other in (0, 1):
        half = _fit_field(new(), whole.part((fold != other) & teaches))
        rest = whole.part(fold == other)
        edges = _edges(rest.doc, 1 << 16)
        p = [half.chain(rest.scores(half, low, high)[0], _starts(rest.doc[low:high]))[0] for low, high in zip(edges[:-1], edges[1:], strict=True)]
        p = np.concatenate([np.empty(0), *p])
        x[fold == other] = _aggregates(p, rest.doc, len(y))[fold == other]
    model = _fit_field(new(), whole.part(teaches))
    weight = np.where(y == 1, class_sizes[1] / max(1, n1), class_sizes[0] / max(1, n0))
    model.logistic = _fit_logistic(x, y.astype(float), weight / weight.mean())
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_on(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_bytes: int = MAX_BYTES) -> Model:
    """Fit on at most ``max_labelled`` documents of each label, and ``max_bytes`` of whole texts of each.

    The documents with the least keyed hashes of doc_id are taken, those that no longer fit into the bytes passed over: a
    sample that does not depend on partitions. Held-out documents, null labels and null doc_ids do not count; a document
    with several labels counts with the least, and of rows that repeat a doc_id the ones with the least hashes of their text.
    """
    small_batches(docs.sparkSession)
    one = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in one.groupBy("toxic").count().collect()}
    rows = []
    for label in (0, 1):
        ids = least_hashed(one.where(F.col("toxic") == label), F.xxhash64("doc_id", F.lit(5)), max_labelled).select("doc_id")
        met = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # the bound is max_labelled ids
        met = met.withColumn("_h", F.xxhash64("doc_id", F.lit(5))).withColumn("_t", F.xxhash64("text"))
        sized = met.select("_h", "_t", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n")).distinct().orderBy("_h", "_t").limit(max_labelled).collect()
        left, kept = max_bytes, []
        for r in sized:
            if r["n"] <= left:
                left -= r["n"]
                kept.append((r["_h"], r["_t"]))
        chosen = F.broadcast(docs.sparkSession.createDataFrame(kept, "_h long, _t long"))
        rows += [(r["_h"], r["_t"], label, r["text"]) for r in met.join(chosen, ["_h", "_t"]).dropDuplicates(["_h", "_t"]).collect()]
    rows.sort(key=lambda r: r[:3])
    return fit([r[3] for r in rows], [r[2] for r in rows], (sizes.get(0, 0), sizes.get(1, 0)))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_labelled: int = MAX_LABELLED, span_threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted, spans of every row of ``docs`` (doc_id, text).

    ``predicted`` is 1 from ``threshold`` on. ``spans`` are the runs of words with marginals from ``span_threshold`` on:
    first code point (from 0), code point after the last, and the greatest marginal. Scores are rounded to nine digits, so
    that they do not depend on which documents share a batch. Rows whose crc32(doc_id as text) mod 5
    is 0 never lend their labels. Null and empty texts, and texts without letters, are scored as texts without words; a
    null doc_id is scored and never learned from; repeated rows are scored alike; an empty table gives no rows; other
    columns are not read.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(fit_on(docs, labels, max_labelled))  # at most MAX_EVIDENCE weights
    span = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType()), T.StructField("marginal", T.DoubleType())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for b in batches:
            p, words, raw = model.tag(b.column("_text").to_pylist())
            hit = np.flatnonzero(p >= span_threshold)
            new = np.concatenate([[True], (np.diff(hit) > 1) | (np.diff(words.doc[hit]) > 0)])[: len(hit)]
            run_of = np.cumsum(new) - 1
            n = int(new.sum())
            begin, end = words.first[hit[new]], words.last[hit[np.concatenate([new[1:], [True]])[: len(hit)]]]
            most = np.zeros(n)
            np.maximum.at(most, run_of, p[hit])
            points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            doc = words.doc[hit[new]]
            origin = points[words.bounds[doc]]
            structs = pa.StructArray.from_arrays([pa.array(points[begin] - origin), pa.array(points[end] - origin), pa.array(np.round(most, 9))], names=["begin", "end", "marginal"])
            offsets = np.searchsorted(doc, np.arange(b.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.round(model.score(p, words.doc, b.num_rows), 9)), pa.ListArray.from_arrays(pa.array(offsets), structs)], names=["doc_id", "score", "spans"])

    scored = docs.select("doc_id", F.col("text").alias("_text")).mapInArrow(run, docs.select("doc_id").schema.add("score", T.DoubleType()).add("spans", span))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
