"""Main text of web pages by a recurrent block labeller.

A page is cut into its leaf blocks, in page order. Each block is described by the bag of its tag path (tag names, words
of class and id attributes), the bag of its hashed words and a few numbers; a bidirectional LSTM in numpy reads the whole
sequence and decides for every block whether it belongs to the article. The network is trained here, with a fixed seed,
on a bounded sample of the given pages, labelled by their semantic elements, and on generated layouts in which menus,
notices, adverts, sidebars, forms and reader comments stand in other elements and under other class names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import least_hashed, small_batches

#: Pages of the table that the labeller may be trained on, least keyed hashes first.
SAMPLE_PAGES = 400
GENERATED_PAGES = 600
#: Share of the generated layouts without telling names, so that place, links and words have to be learned as well.
PLAIN_PAGES = 0.3
#: Distinct words of these pages that fill the generated layouts.
SAMPLE_WORDS = 5000
TAG_SLOTS, WORD_SLOTS, TAG_SIZE, WORD_SIZE, NUMBERS, HIDDEN = 1024, 1024, 12, 6, 8, 14

BLOCKS = frozenset("address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
INSIDE_P = BLOCKS - {"button", "option", "select", "textarea", "title", "head", "html", "body"}
#: Elements whose content is no text. Of those in RAW an end that never comes is the page's end; of others only the tag goes.
SILENT = frozenset("script style noscript template svg iframe object".split())
RAW = frozenset("script style iframe".split())
#: A tag up to ``>`` outside quotes, without looking past another ``<``.
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^<\"]*\"|'[^<']*')*+)>")
TAG_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
#: What decides where a tag that has a ``<`` in it ends.
MARK = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"\b(class|id|role|data-y)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME = re.compile(r"[a-z]+")


@dataclass
class Block:
    """A leaf block: its text (references decoded, white space single), characters in links, and labels for training.

    ``turns`` are the path words that open (their slot) or close (its complement) between the block before and this one:
    the words open at a block are what all turns up to it leave, so that paths of any depth take room in line with the page.
    """

    text: str
    turns: list[int]
    linked: int
    label: int = 0
    silver: bool = False


@dataclass
class _Open:
    tag: str
    slots: tuple[int, ...]
    label: str
    article: bool
    outside: bool


@lru_cache(maxsize=20_000)
def _slot(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % TAG_SLOTS


@lru_cache(maxsize=4096)
def _attributes(text: str) -> tuple[tuple[str, ...], str]:
    """(words of class, id and role; training label) of a tag's attributes."""
    words: list[str] = []
    label = ""
    for name, *values in ATTRIBUTE.findall(text):
        value = next((v for v in values if v), "")
        if name.lower() == "data-y":
            label = value
        else:
            words += ["." + w for w in NAME.findall(value.lower())]
    return tuple(words), label


HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def far_end(html: str, at: int, known: dict[int, int]) -> int:
    """Behind the first ``>`` outside quotes from ``at`` on, or -1 if a quote stays open.

    What follows a mark outside quotes is the same whichever tag it is read for, so it is kept in ``known`` by the
    mark's place: all calls for a page read every part of it once for each kind of quote.
    """
    passed = []
    end = -1
    while mark := MARK.search(html, at):
        q = mark.start()
        if q in known:
            end = known[q]
            break
        passed.append(q)
        if html[q] == ">":
            end = q + 1
            break
        at = html.find(html[q], q + 1) + 1
        if not at:
            break
    known.update(dict.fromkeys(passed, end))
    return end


def tags(html: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, whether it ends an element, attributes) of all tags and of what is no text (name empty).

    Comments, declarations and silent elements are no text, nor is a tag that the page breaks off. A ``<`` that begins
    none of these is text. Every page is read in time linear in its length: what may not end is looked for once.
    """
    at, last = 0, html.rfind(">")
    ends: dict[str, bool] = {}  # whether an end of a silent element may still come
    known: dict[int, int] = {}
    while (start := html.find("<", at)) >= 0:
        if near := TAG.match(html, start):
            slash, tag, attributes = near.groups()
            at = near.end()
        elif html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            short = next((start + len(x) for x in ("<!-->", "<!--->") if html.startswith(x, start)), 0)
            at = short or (len(html) if end < 0 else end + 3)
            yield start, at, "", False, ""
            continue
        else:
            name = TAG_NAME.match(html, start + 1)
            if not name and html[start + 1 : start + 2] not in ("!", "?", "/") or start == len(html) - 1:
                at = start + 1
                continue
            if start > last:  # broken off
                yield start, len(html), "", False, ""
                return
            if not name:
                at = html.index(">", start) + 1
                yield start, at, "", False, ""
                continue
            slash, tag = name.groups()
            end = far_end(html, name.end(), known)
            at = end if end >= 0 else html.index(">", name.end()) + 1
            attributes = html[name.end() : at - 1]
        tag = tag.lower()
        if tag in SILENT and not slash:
            found = None
            if ends.get(tag, True) and not (tag == "svg" and html.endswith("/>", start, at)):
                found = re.compile(f"</{tag}(?=[\\s/>])[^>]*>", re.I).search(html, at)
                ends[tag] = found is not None
                if not found and tag in RAW:
                    yield start, len(html), "", False, ""
                    return
            at = found.end() if found else at
            yield start, at, "", False, ""
            continue
        yield start, at, tag, bool(slash), attributes


def blocks(html: str | None) -> list[Block]:
    """The blocks of a whole page; unclosed elements end where HTML ends them. Scripts, styles and comments are no text."""
    html = html or ""
    root = _Open("", (), "", False, False)
    out: list[Block] = []
    stack: list[_Open] = [root]
    open_: Counter[str] = Counter()
    block_at = [0]  # where the open blocks stand in the stack
    texts: list[str] = []
    turns: list[int] = []
    linked = links = at = 0

    def flush() -> None:
        nonlocal linked, turns
        if texts:
            raw = "".join(texts)
            text = " ".join((unescape(raw) if "&" in raw else raw).split())
            if text:
                top = stack[-1]
                out.append(Block(text, turns, min(linked, len(text)), int(top.label == "1"), top.article and not top.outside))
                turns = []
            texts.clear()
        linked = 0

    def close_to(i: int) -> None:
        nonlocal links
        if block_at[-1] >= i:
            flush()
            while block_at[-1] >= i:
                block_at.pop()
        gone = stack[i:]
        open_.subtract(o.tag for o in gone)
        links -= sum(o.tag == "a" for o in gone)
        turns.extend(~w for o in gone for w in o.slots)
        del stack[i:]

    for start, end, tag, closing, attributes in tags(html):
        if start > at:
            texts.append(html[at:start])
            if links:
                linked += start - at
        at = end
        if not tag:
            continue
        block = tag in BLOCKS
        if closing:
            if open_[tag] > 0:
                close_to(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            elif block:
                flush()
            continue
        if block:
            flush()
            if tag in INSIDE_P:
                i = block_at[-1]
                if stack[i].tag == "p" or (tag in HEADINGS and stack[i].tag in HEADINGS):
                    close_to(i)
            if tag in CLOSES:
                while stack[i := block_at[-1]].tag in CLOSES[tag]:
                    close_to(i)
        if tag in VOID:
            if tag in ("br", "hr"):
                texts.append(" ")
            continue
        words, label = _attributes(attributes) if attributes else ((), "")
        top = stack[-1]
        own = (tag, *words)
        slots = tuple(map(_slot, own))
        turns.extend(slots)
        if block:
            block_at.append(len(stack))
        stack.append(_Open(tag, slots, label or top.label, top.article or tag in ("article", "main"), top.outside or not OUTSIDE.isdisjoint(own)))
        open_[tag] += 1
        links += tag == "a"
    texts.append(html[at:])
    flush()
    return out


@dataclass
class Sequence:
    """One page as arrays: turns of the path (slot, opened 1 or closed -1) and where those of each block end, slots of
    words with offsets, and numbers per block."""

    turns: np.ndarray
    signs: np.ndarray
    turn_end: np.ndarray
    words: np.ndarray
    word_at: np.ndarray
    numbers: np.ndarray


_POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)


def _word_slots(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all lower-cased words of non-empty texts (white space single), and where each text begins among them."""
    raw = np.frombuffer("\n".join(texts).lower().encode("utf-8", "surrogatepass"), np.uint8)
    line = raw == 10
    gap = line | (raw == 32)
    first = ~gap & np.concatenate([[True], gap[:-1]])
    starts = np.flatnonzero(first)
    place = np.arange(len(raw)) - starts[np.maximum(np.cumsum(first) - 1, 0)]
    h = np.add.reduceat(np.where(gap, np.uint64(0), (raw.astype(np.uint64) + np.uint64(1)) * _POWERS[place & 63]), starts)
    slots = (((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)) % np.uint64(WORD_SLOTS)
    return slots.astype(np.int64), np.searchsorted(np.cumsum(line)[starts], np.arange(len(texts)))


def described(pages: list[list[Block]]) -> list[Sequence]:
    """The arrays of pages; the words of all their blocks are hashed in one sweep."""
    every = [b for p in pages for b in p]
    if not every:
        return [Sequence(*(np.empty(0, np.int64),) * 5, np.empty((0, NUMBERS))) for _ in pages]
    words, word_at = _word_slots([b.text for b in every])
    word_end = np.append(word_at[1:], len(words))
    n = np.array([len(b.text) for b in every], float)
    own = (word_end - word_at).astype(float)
    shape = np.stack([np.log1p(n) / 6, np.log1p(own) / 4, np.array([b.linked for b in every]) / n, np.zeros(len(n)), np.zeros(len(n)), np.array([b.text[-1] in ".!?。" for b in every], float), np.array(["©" in b.text for b in every], float), np.array([b.text.count(",") for b in every]) / (own + 1)], axis=1)
    out, at = [], 0
    for p in pages:
        end = at + len(p)
        if at == end:
            out.append(Sequence(*(np.empty(0, np.int64),) * 5, np.empty((0, NUMBERS))))
            continue
        sizes = np.array([len(b.turns) for b in p])
        turns = np.fromiter(chain.from_iterable(b.turns for b in p), np.int64, sizes.sum())
        numbers = shape[at:end]
        numbers[:, 3] = np.arange(len(p)) / len(p)
        numbers[:, 4] = 1 - numbers[:, 3]
        low = word_at[at]
        out.append(Sequence(np.where(turns < 0, ~turns, turns), np.where(turns < 0, -1, 1), np.cumsum(sizes), words[low : word_end[end - 1]], word_at[at:end] - low, numbers))
        at = end
    return out


def _up_to(x: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sums of the first ``end`` rows of ``x``, for each end."""
    return np.concatenate([np.zeros_like(x[:1], shape=(1, *x.shape[1:])), np.cumsum(x, axis=0)])[end]


def _depth(s: Sequence) -> np.ndarray:
    """Path words open at each block, as a column; 1 where there are none, whose mean is 0."""
    return np.maximum(_up_to(s.signs, s.turn_end), 1)[:, None]


class Labeller:
    """The network. Parameters are plain arrays, so it travels to the tasks by itself."""

    def __init__(self, seed: int = 5) -> None:
        r = np.random.default_rng(seed)
        size = TAG_SIZE + WORD_SIZE + NUMBERS
        w = lambda *s: r.normal(0, 1 / np.sqrt(s[0]), s)
        self.p = {"tags": r.normal(0, 0.3, (TAG_SLOTS, TAG_SIZE)), "words": r.normal(0, 0.1, (WORD_SLOTS, WORD_SIZE)), "out": w(2 * HIDDEN, 1)[:, 0], "bias": np.zeros(1)}
        for k in "fb":
            self.p |= {f"{k}x": w(size, 4 * HIDDEN), f"{k}h": w(HIDDEN, 4 * HIDDEN), f"{k}0": np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])}

    def inputs(self, s: Sequence) -> np.ndarray:
        path = _up_to(self.p["tags"][s.turns] * s.signs[:, None], s.turn_end) / _depth(s)
        words = np.add.reduceat(self.p["words"][s.words], s.word_at, axis=0) / np.diff(np.append(s.word_at, len(s.words)))[:, None]
        return np.hstack([path, words, s.numbers])

    def _run(self, x: np.ndarray, mask: np.ndarray, k: str) -> tuple[np.ndarray, list]:
        """Hidden states (steps, pages, HIDDEN) of one direction, in reading order, and what training needs."""
        steps, pages, _ = x.shape
        h = c = np.zeros((pages, HIDDEN))
        out, tape = np.empty((steps, pages, HIDDEN)), []
        gates = x @ self.p[f"{k}x"] + self.p[f"{k}0"]
        for t in range(steps) if k == "f" else range(steps - 1, -1, -1):
            a = gates[t] + h @ self.p[f"{k}h"]
            s = 1 / (1 + np.exp(-np.clip(a[:, : 3 * HIDDEN], -30, 30)))
            i, f, o, g = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :], np.tanh(a[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            c2 = f * c + i * g
            th = np.tanh(c2)
            tape.append((t, i, f, o, g, c, th, h, m))
            c, h = np.where(m, c2, c), np.where(m, o * th, h)
            out[t] = h
        return out, tape

    @staticmethod
    def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        steps = max(map(len, pages))
        x, mask = np.zeros((steps, len(pages), pages[0].shape[1])), np.zeros((steps, len(pages)), bool)
        for j, p in enumerate(pages):
            x[: len(p), j], mask[: len(p), j] = p, True
        return x, mask

    def _read(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Hidden states (steps, pages, 2 * HIDDEN) of both directions, which are read side by side."""
        steps, pages, _ = x.shape
        # the sigmoid of z is (1 + tanh(z / 2)) / 2, so that one call serves all gates
        scale = np.repeat([0.5, 1.0], [3 * HIDDEN, HIDDEN])
        own = np.stack([self.p["fh"], self.p["bh"]]) * scale
        gates = np.stack([x @ self.p["fx"] + self.p["f0"], (x @ self.p["bx"] + self.p["b0"])[::-1]], axis=1) * scale
        full = mask.all()
        masks = np.stack([mask, mask[::-1]], axis=1)[..., None]
        h = c = np.zeros((2, pages, HIDDEN))
        out = np.empty((steps, 2, pages, HIDDEN))
        for t in range(steps):
            a = np.tanh(gates[t] + h @ own)
            s = a[..., : 3 * HIDDEN] * 0.5 + 0.5
            c2 = s[..., HIDDEN : 2 * HIDDEN] * c + s[..., :HIDDEN] * a[..., 3 * HIDDEN :]
            h2 = s[..., 2 * HIDDEN :] * np.tanh(c2)
            c, h = (c2, h2) if full else (np.where(masks[t], c2, c), np.where(masks[t], h2, h))
            out[t] = h
        return np.concatenate([out[:, 0], out[::-1, 1]], axis=2)

    def label(self, pages: list[Sequence]) -> list[np.ndarray]:
        """For each page whether its blocks are main text. Pages of like length are read side by side."""
        out: list[np.ndarray] = [np.empty(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i].numbers)), key=lambda i: len(pages[i].numbers))
        while order:
            longest = len(pages[order[-1]].numbers)
            some = order[-max(1, 20_000 // longest) :]
            del order[-len(some) :]
            x, mask = self.padded([self.inputs(pages[i]) for i in some])
            z = self._read(x, mask) @ self.p["out"] + self.p["bias"]
            for j, i in enumerate(some):
                out[i] = z[: len(pages[i].numbers), j] > 0
        return out

    def train(self, pages: list[Sequence], labels: list[np.ndarray], epochs: int = 9, batch: int = 32, rate: float = 0.012, seed: int = 6) -> Labeller:
        r = np.random.default_rng(seed)
        first, second, step = {k: np.zeros_like(v) for k, v in self.p.items()}, {k: np.zeros_like(v) for k, v in self.p.items()}, 0
        lengths = np.array([len(p.numbers) for p in pages])
        for epoch in range(epochs):
            # pages of like length share a batch
            order = np.argsort(lengths + r.uniform(0, 8, len(pages)))
            for b in r.permutation(-(-len(order) // batch)):
                some = order[b * batch : (b + 1) * batch]
                grads = self._gradients([pages[i] for i in some], [labels[i] for i in some])
                step += 1
                for k, g in grads.items():
                    g = np.clip(g, -1, 1)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    self.p[k] = self.p[k] - rate * (1 - 0.9 * epoch / epochs) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def _gradients(self, pages: list[Sequence], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        x, mask = self.padded([self.inputs(p) for p in pages])
        y, _ = self.padded([v[:, None].astype(float) for v in labels])
        runs = {k: self._run(x, mask, k) for k in "fb"}
        both = np.concatenate([runs[k][0] for k in "fb"], axis=2)
        z = both @ self.p["out"] + self.p["bias"]
        dz = np.where(mask, 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[:, :, 0], 0) / mask.sum() * 20
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["out"], g["bias"] = np.einsum("tb,tbh->h", dz, both), np.array([dz.sum()])
        dboth, dx = dz[:, :, None] * self.p["out"], np.zeros_like(x)
        for n, k in enumerate("fb"):
            part = dboth[:, :, n * HIDDEN : (n + 1) * HIDDEN]
            dh = dc = np.zeros((x.shape[1], HIDDEN))
            da_all = np.zeros((*x.shape[:2], 4 * HIDDEN))
            for t, i, f, o, gg, c, th, h, m in reversed(runs[k][1]):
                dh = dh + part[t]
                dc2 = np.where(m, dc + dh * o * (1 - th * th), 0)
                da = np.hstack([dc2 * gg * i * (1 - i), dc2 * c * f * (1 - f), np.where(m, dh * th * o * (1 - o), 0), dc2 * i * (1 - gg * gg)])
                da_all[t] = da
                g[f"{k}h"] += h.T @ da
                dh = np.where(m, 0, dh) + da @ self.p[f"{k}h"].T
                dc = np.where(m, dc2 * f, dc)
            flat = da_all.reshape(-1, 4 * HIDDEN)
            g[f"{k}x"] = x.reshape(-1, x.shape[2]).T @ flat
            g[f"{k}0"] = flat.sum(axis=0)
            dx += da_all @ self.p[f"{k}x"].T
        for j, s in enumerate(pages):
            d = dx[: len(s.numbers), j]
            # a turn is felt by its own block and all that follow
            felt = np.cumsum((d[:, :TAG_SIZE] / _depth(s))[::-1], axis=0)[::-1]
            np.add.at(g["tags"], s.turns, s.signs[:, None] * np.repeat(felt, np.diff(s.turn_end, prepend=0), axis=0))
            n = np.diff(np.append(s.word_at, len(s.words)))
            np.add.at(g["words"], s.words, np.repeat(d[:, TAG_SIZE : TAG_SIZE + WORD_SIZE] / n[:, None], n, axis=0))
        return g


#: Class names under which the parts of generated layouts stand.
PARTS = {
    "menu": "nav navbar navigation menu topnav breadcrumb breadcrumbs tabs pager pagination toc",
    "head": "header masthead banner top logo branding site",
    "foot": "footer bottom legal copyright colophon imprint",
    "side": "sidebar side aside widget related recommended trending rail teaser links tags",
    "notice": "cookie consent gdpr notice alert popup modal overlay newsletter subscribe signup paywall",
    "advert": "ad ads advert advertisement sponsored sponsor promo promoted banner affiliate",
    "form": "search login form contact register subscribe",
    "comment": "comments comment replies reply disqus discussion responses thread reader",
    "share": "share social sharing follow buttons",
}
ARTICLE = "article content main post entry story body text page prose single".split()
PHRASES = {
    "menu": "home news about contact sports world business login archive next previous",
    "head": "site name your daily source search menu subscribe",
    "foot": "copyright all rights reserved privacy policy terms of use imprint contact ©",
    "side": "related articles most read you may also like trending tags popular posts",
    "notice": "we use cookies to improve your experience accept all settings subscribe to our newsletter",
    "advert": "advertisement sponsored buy now special offer click here best price",
    "form": "name email password send search submit your message",
    "comment": "says reply posted by ago like report i think this great article thanks",
    "share": "share on facebook twitter email print",
}


def unnamed(page: str, r: np.random.Generator) -> str:
    """A page whose layout says nothing: sections are plain ``div`` elements under meaningless class names."""
    names: dict[str, str] = {}
    plain = re.sub(r" (?:class|id)=(?:\"[^\"]*\"|'[^']*')", lambda m: names.setdefault(m[0], f' class="x{r.integers(1, 99)}"'), page)
    return re.sub(r"<(/?)(?:article|main|nav|aside|header|footer|section)\b", r"<\1div", plain)


def generated(words: list[str], n: int, seed: int = 4, plain: float = 0.0) -> Iterator[str]:
    """Pages with marked main blocks, in many layouts, a share ``plain`` of them :func:`unnamed`, with words drawn from ``words``."""
    r = np.random.default_rng(seed)
    pick = lambda xs: xs[int(r.integers(len(xs)))]
    chance = lambda p: r.random() < p

    def say(low: int, high: int) -> str:
        out = " ".join(words[i] for i in r.integers(0, len(words), int(r.integers(low, high))))
        return out.capitalize() + (pick([".", ".", ".", "!", "?", ""]) if high > 8 else "")

    def noise(kind: str) -> str:
        names = PARTS[kind].split()
        phrases = PHRASES[kind].split()

        def short() -> str:
            k = int(r.integers(1, 7))
            return " ".join(pick(phrases) if chance(0.6) else pick(words) for _ in range(k))

        attribute = f' {pick(["class", "class", "id"])}="{pick(names)}{pick(["", "-" + pick(["box", "wrap", "inner", "list", "area"]), " " + pick(names)])}"'
        semantic = {"menu": "nav", "head": "header", "foot": "footer", "side": "aside", "form": "form"}.get(kind)
        tag = semantic if semantic and chance(0.6) else pick(["div", "section", "ul" if kind == "menu" else "div"])
        attribute = "" if tag == semantic and chance(0.5) else attribute
        if kind in ("menu", "share", "foot") and chance(0.7):
            inner = "".join(f"<li><a href='/x'>{short()}</a></li>" for _ in range(int(r.integers(2, 9))))
            inner = inner if tag == "ul" else f"<ul>{inner}</ul>"
        elif kind == "comment":
            inner = "".join(f"<div class='{pick(names)}'><b>{pick(words)}</b> <p>{say(3, 60)}</p></div>" for _ in range(int(r.integers(1, 6))))
        elif kind == "form":
            inner = f"<label>{short()}</label><input><button>{short()}</button>"
        elif kind in ("advert", "side", "notice"):
            inner = pick([f"{say(3, 25)}", f"<p>{say(3, 30)}</p><a href='/y'>{short()}</a>", f"<h3>{short()}</h3>" + "".join(f"<p><a href='/z'>{say(3, 10)}</a></p>" for _ in range(int(r.integers(1, 5))))])
        else:
            inner = pick([f"<p>{short()}</p>", f"<a href='/'>{short()}</a>", f"&copy; {short()} &middot; {say(2, 14)}", f"<h1>{short()}</h1>"])
        return f"<{tag}{attribute} data-y=0>{inner}</{tag}>"

    def main() -> str:
        out = [f"<h1>{say(2, 14)}</h1>"] if chance(0.7) else []
        for _ in range(int(r.integers(1, 24))):
            kind = r.random()
            text = say(1, int(r.choice([6, 40, 120])))
            if kind < 0.7:
                out.append(pick([f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br>", f"<p>{text} <a href='/q'>{pick(words)}</a> {say(1, 10)}</p>", f"<div>{text}</div>"]))
            elif kind < 0.78:
                out.append(f"<h2>{say(1, 8)}</h2>")
            elif kind < 0.86:
                out.append("<ul>" + "".join(f"<li>{say(2, 18)}</li>" for _ in range(int(r.integers(1, 6)))) + "</ul>")
            elif kind < 0.92:
                out.append(f"<blockquote>{text}</blockquote>")
            elif kind < 0.96:
                out.append(noise(pick(["advert", "side", "notice", "share", "form"])))
            else:
                out.append("<table>" + "".join(f"<tr><td>{say(1, 5)}</td><td>{say(1, 5)}</td></tr>" for _ in range(int(r.integers(1, 5)))) + "</table>")
        if chance(0.25):
            out.append(noise("comment"))
        tag = pick(["article", "article", "main", "div", "div", "section"])
        attribute = f' {pick(["class", "id"])}="{pick(ARTICLE)}{pick(["", "-" + pick(ARTICLE)])}"' if tag in ("div", "section") or chance(0.4) else ""
        body = f"<{tag}{attribute} data-y=1>{''.join(out)}</{tag}>"
        return f"<main>{body}</main>" if tag == "article" and chance(0.3) else body

    for _ in range(n):
        before = [noise(pick(["menu", "head", "notice", "advert", "form", "share"])) for _ in range(int(r.integers(0, 4)))]
        after = [noise(pick(["comment", "side", "share", "advert", "menu", "foot", "form", "notice"])) for _ in range(int(r.integers(0, 4)))]
        body = [*before, main(), *after, *([noise("foot")] if chance(0.8) else [])]
        page = "".join(body)
        page = f"<div class='{pick(['wrapper', 'container', 'layout', 'row'])}'>{page}</div>" if chance(0.4) else page
        page = unnamed(page, r) if plain and chance(plain) else page
        yield f"<html><head><title>{say(1, 12)}</title></head><body>{page}</body></html>"


OUTSIDE = frozenset({"nav", "header", "footer", "aside", "form", "title", "head", "button", "select", "textarea"} | {"." + w for k in PARTS.values() for w in k.split()})


def silver(page: list[Block]) -> np.ndarray:
    """Labels of a page with an article or main element: the blocks in it that are in no marked part; others have none."""
    return np.array([b.silver for b in page], bool)


def train_labeller(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, generated_pages: int = GENERATED_PAGES, sample_words: int = SAMPLE_WORDS) -> Labeller:
    """Train on at most ``sample_pages`` pages with silver labels, and on ``generated_pages`` layouts of at most
    ``sample_words`` of their words, those with the least hashes."""
    rows = least_hashed(pages.where("html is not null").select("page_id", "html"), F.xxhash64("page_id", F.lit(9)), sample_pages).collect()
    own = [p for p in (blocks(r["html"]) for r in sorted(rows, key=lambda r: (r["page_id"] is None, r["page_id"]))) if p]
    every = {w.strip(".,!?") for p in own for b in p for w in b.text.lower().split()} - {""}
    words = sorted(every, key=lambda w: (zlib.crc32(w.encode("utf-8", "surrogatepass")), w))[:sample_words] or ["word"]
    made = [blocks(h) for h in generated(words, generated_pages, plain=PLAIN_PAGES)]
    labelled = [(p, silver(p)) for p in own]
    train = [*[x for x in labelled if x[1].any()], *[(p, np.array([b.label for b in p], bool)) for p in made if p]]
    return Labeller().train(described([p for p, _ in train]), [y for _, y in train])


def main_text(page: list[Block], chosen: np.ndarray) -> str:
    return "\n".join(b.text for b, y in zip(page, chosen, strict=True) if y)


def extract(pages: DataFrame, labeller: Labeller | None = None, keep: tuple[str, ...] = ("page_id", "url"), html: str = "html") -> DataFrame:
    """``keep``, text (main text; empty if none) and n_chars (its code points) of every row.

    Null and empty html have no text. Whole pages are read, however long; repeated rows give repeated results; columns
    that are not kept are not read. An empty table gives an empty result.
    """
    labeller = labeller or train_labeller(pages)
    small_batches(pages.sparkSession)
    cols = [F.col(f"`{c}`") for c in keep]
    sent = pages.sparkSession.sparkContext.broadcast(labeller)  # some 30,000 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for b in batches:
            cut = [blocks(h) for h in b.column("_html").to_pylist()]
            texts = [main_text(p, y) for p, y in zip(cut, model.label(described(cut)), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in pages.select(*cols).schema)
    return pages.select(*cols, F.col(f"`{html}`").alias("_html")).mapInArrow(run, f"{kept}text string, n_chars bigint")
