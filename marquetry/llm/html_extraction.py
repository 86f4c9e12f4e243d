"""HTML extraction: a recurrent labeller decides for every block of a page whether it is main text.

A page is read into its leaf blocks: runs of text between block-level tags, each with the path of
elements it stands in. Every block becomes a vector of its tag path (hashed element and class words)
and of its words (hashed), and a bidirectional LSTM in numpy reads the page's blocks as one
sequence, so that each is judged by all of its page. The text is that of the blocks kept, in order.

The labeller is fitted on a bounded sample of pages (SAMPLE and SAMPLE_CHARS, parameters), whose blocks are labelled by the
elements and class words they stand in, and on rebuilt pages that put the sample's texts into other layouts, with
telling names and without.

Null and empty pages give an empty text; unfinished tags and comments at a page's end are markup;
repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquetry.llm.common import slices
from marquetry.llm.shingles import word_hashes

#: Pages that the labeller is fitted on, and the length in code points that each has at most.
SAMPLE, SAMPLE_CHARS = 240, 200_000
PATH_SIZE, WORD_SIZE, HIDDEN = 96, 24, 20
#: Padded blocks that are judged at once.
BATCH_BLOCKS = 20_000
SLICE = 4_000_000

#: Elements without an end tag, those whose inside is no text, and those that stand inside a line (fixed values).
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = set("script style title noscript template iframe svg math object canvas head".split())
RAW = set("script style title noscript template iframe textarea".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
#: What an element's own name or class says of the text in it (fixed values).
ASIDE_TAGS = set("nav header footer aside form menu dialog button select option textarea".split())
ASIDE_WORDS = set("ad ads advert advertisement sponsor sponsored promo banner nav navigation menu breadcrumb sidebar widget footer header masthead notice cookie consent alert popup newsletter subscribe login search form share social related comment comments reply discussion disqus respond copyright".split())
MAIN_TAGS = set("article main".split())
MAIN_WORDS = set("article content main post entry story body text".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|</?[A-Za-z][^>]*(?:>|\Z)|<\Z|[^<]+|<""", re.S)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")

class Node:
    """An element of a path from the page's root: equal paths are one node, so that their features are made once and a path takes no space."""

    __slots__ = ("children", "element", "fresh", "hidden", "label", "parent", "vector")

    def __init__(self, parent: Node | None, element: tuple[str, ...], fresh: tuple[str, ...]):
        """fresh: terms of this element that no element above it has."""
        self.parent, self.element, self.fresh, self.children = parent, element, fresh, {}
        self.vector: np.ndarray | None = None
        self.hidden, self.label = (parent.hidden, parent.label) if parent else (False, 0)
        if element:
            tag, words = element[0], set(element[1:])
            self.hidden |= tag in HIDDEN_TAGS
            if self.label == 2 or tag in ASIDE_TAGS or ASIDE_WORDS & words:
                self.label = 2
            elif tag in MAIN_TAGS or MAIN_WORDS & words:
                self.label = 1

    def __eq__(self, other: object) -> bool:
        return self is other or isinstance(other, tuple) and self.path() == other

    __hash__ = object.__hash__

    def path(self) -> tuple[tuple[str, ...], ...]:
        out, node = [], self
        while node.parent:
            out.append(node.element)
            node = node.parent
        return tuple(out[::-1])


class Paths:
    """The nodes seen so far, up to a bound, and the elements that are open now."""

    def __init__(self) -> None:
        self.root, self.size = Node(None, (), ()), 0

    def start(self) -> None:
        if self.size > 100_000:
            self.root, self.size = Node(None, (), ()), 0
        self.stack: list[Node] = [self.root]
        self.places: dict[str, list[int]] = {}  # of each tag's open elements
        self.terms: dict[str, int] = {}

    def last(self, tag: str) -> int:
        """The place of the innermost open element of this name, or 0."""
        found = self.places.get(tag)
        return found[-1] if found else 0

    def _terms(self, element: tuple[str, ...]) -> list[str]:
        terms = [x for x in element if x not in INLINE]
        if len(self.stack) > 1:
            terms.append(f"{self.stack[-1].element[0]}>{element[0]}")
        return terms

    def push(self, element: tuple[str, ...]) -> None:
        terms = self._terms(element)
        top = self.stack[-1]
        node = top.children.get(element)
        if node is None:
            node = Node(top, element, tuple(t for t in dict.fromkeys(terms) if not self.terms.get(t)))
            top.children[element] = node
            self.size += 1
        for t in terms:
            self.terms[t] = self.terms.get(t, 0) + 1
        self.places.setdefault(element[0], []).append(len(self.stack))
        self.stack.append(node)

    def cut(self, place: int) -> None:
        """Close the element at this place and all inside it."""
        while len(self.stack) > place:
            element = self.stack.pop().element
            for t in self._terms(element):
                self.terms[t] -= 1
            self.places[element[0]].pop()


Block = tuple[Node, str, float]
_BARRIERS = ("ul", "ol", "table", "dl", "select")
_ITEMS = set("li p td th tr dt dd option".split())
_paths = Paths()


def blocks_of(page: str) -> list[Block]:
    """(node of the element it stands in; text; share of the text in links) of every leaf block, in time linear in the page."""
    out: list[Block] = []
    parts: list[str] = []
    open_ = _paths
    open_.start()
    node = open_.root
    blank, linked, at = True, 0, 0

    def flush() -> None:
        nonlocal parts, linked, blank
        text = " ".join(html.unescape("".join(parts)).split()) if not blank else ""
        if text and not node.hidden:
            out.append((node, text, min(1.0, linked / len(text))))
        parts, linked, blank = [], 0, True

    while at < len(page):
        token = _TOKEN.match(page, at)
        at = token.end()
        tag = token[2]
        if tag is None:
            text = token[0]
            if text[0] != "<" or text == "<" and at < len(page):
                if blank and not text.isspace():
                    node, blank = open_.stack[-1], False
                parts.append(text)
                if open_.last("a"):
                    linked += len(text)
            continue
        tag = tag.lower()
        inline = tag in INLINE
        if tag == "br":
            parts.append(" ")
            continue
        if not inline:
            flush()
        if token[1]:
            if place := open_.last(tag):
                open_.cut(place)
            continue
        if tag in VOID:
            continue
        if tag in RAW and tag in HIDDEN_TAGS:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if not inline:
            # A block ends an open paragraph; an item or cell ends the one before it in its list or table.
            if place := open_.last("p"):
                open_.cut(place)
            if tag in _ITEMS and (place := open_.last(tag)) and place > max(map(open_.last, _BARRIERS)):
                open_.cut(place)
        words: list[str] = []
        if token[3] and not token[3].isspace():
            for value in _NAMED.findall(token[3]):
                words += _SPLIT.split(value.strip("\"'").lower())
        open_.push((tag, *filter(None, words)))
        if token[3].endswith("/") and tag not in INLINE:
            open_.cut(len(open_.stack) - 1)
    flush()
    return out


def taught(node: Node) -> bool:
    """What the elements around a block say: main text unless one of them is an aside; outside all content, too, it is none."""
    return node.label == 1


def _path_vector(node: Node) -> np.ndarray:
    """Signed hashes of the distinct terms of a path; each node adds its own to those above."""
    new = []
    while node.vector is None:
        new.append(node)
        if node.parent is None:
            node.vector = np.zeros(PATH_SIZE, np.float32)
        else:
            node = node.parent
    for below in reversed(new):
        if below.vector is None:
            below.vector = below.parent.vector.copy()
            for term in below.fresh:
                h = zlib.crc32(term.encode())
                for k in range(3):
                    below.vector[(h >> (8 * k)) % PATH_SIZE] += 1 if h >> (24 + k) & 1 else -1
    return new[0].vector if new else node.vector


FEATURES = PATH_SIZE + WORD_SIZE + 4


def vectors(pages: list[list[Block]]) -> np.ndarray:
    """One row for each block of all pages."""
    blocks = [b for page in pages for b in page]
    out = np.zeros((len(blocks), FEATURES), np.float32)
    if not blocks:
        return out
    for k, (node, _, _) in enumerate(blocks):
        out[k, :PATH_SIZE] = _path_vector(node)
    hashes, sizes = word_hashes(pa.array([b[1] for b in blocks], pa.large_string()))
    of = np.repeat(np.arange(len(blocks)), sizes)
    sign = np.where((hashes >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
    counts = np.bincount(of * WORD_SIZE + (hashes % np.uint64(WORD_SIZE)).astype(np.int64), sign, len(blocks) * WORD_SIZE)
    out[:, PATH_SIZE : PATH_SIZE + WORD_SIZE] = counts.reshape(-1, WORD_SIZE) / np.sqrt(np.maximum(sizes, 1))[:, None]
    out[:, -4] = np.log1p([len(b[1]) for b in blocks]) / 5
    out[:, -3] = [b[2] for b in blocks]
    out[:, -2] = [b[1][-1] in ".!?:" for b in blocks]
    out[:, -1] = np.concatenate([np.linspace(0, 1, len(p)) for p in pages if p])
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Lstm:
    """One direction: gates in the order input, forget, output, candidate."""

    def __init__(self, rng: np.random.Generator):
        self.p = [
            rng.normal(0, FEATURES**-0.5, (FEATURES, 4 * HIDDEN)).astype(np.float32),
            rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN)).astype(np.float32),
            np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype(np.float32),
        ]

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """x: steps, rows, features. Steps outside a row's mask leave its state as it is."""
        wx, wh, b = self.p
        inputs = x @ wx + b
        h = c = np.zeros((x.shape[1], HIDDEN), np.float32)
        out = np.empty((*x.shape[:2], HIDDEN), np.float32)
        for t in range(len(x)):
            z = inputs[t] + h @ wh
            gates, g = _sigmoid(z[:, : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            m = mask[t][:, None]
            fresh = f * c + i * g
            squashed = np.tanh(fresh)
            if keep is not None:
                keep.append((h, c, i, f, o, g, squashed))
            c = np.where(m, fresh, c)
            h = np.where(m, o * squashed, h)
            out[t] = h
        return out

    def backward(self, x: np.ndarray, mask: np.ndarray, kept: list, d_out: np.ndarray) -> list[np.ndarray]:
        wx, wh, _ = self.p
        d_z = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
        d_wh = np.zeros_like(wh)
        d_h = d_c = np.zeros((x.shape[1], HIDDEN), np.float32)
        for t in range(len(x) - 1, -1, -1):
            h, c, i, f, o, g, squashed = kept[t]
            m = mask[t][:, None]
            d_h = d_h + d_out[t]
            live = np.where(m, d_h, 0)
            d_fresh = np.where(m, d_c, 0) + live * o * (1 - squashed**2)
            d_z[t] = np.concatenate([d_fresh * g * i * (1 - i), d_fresh * c * f * (1 - f), live * squashed * o * (1 - o), d_fresh * i * (1 - g**2)], axis=1)
            d_wh += h.T @ d_z[t]
            d_c = np.where(m, d_fresh * f, d_c)
            d_h = np.where(m, d_z[t] @ wh.T, d_h)
        return [np.tensordot(x, d_z, ([0, 1], [0, 1])), d_wh, d_z.sum((0, 1))]


class Labeller:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.left, self.right = Lstm(rng), Lstm(rng)
        self.out = [rng.normal(0, 0.1, 2 * HIDDEN).astype(np.float32), np.zeros(1, np.float32)]

    @staticmethod
    def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        steps = max(map(len, rows))
        x, mask = np.zeros((steps, len(rows), FEATURES), np.float32), np.zeros((steps, len(rows)), bool)
        for k, r in enumerate(rows):
            x[: len(r), k], mask[: len(r), k] = r, True
        return x, mask

    def scores(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """The odds' logarithm of every block of these pages."""
        found: list[np.ndarray] = [np.zeros(0)] * len(rows)
        order = sorted((k for k in range(len(rows)) if len(rows[k])), key=lambda k: len(rows[k]))
        while order:
            # The longest pages first; no more of them than keep the padded batch in bounds.
            some = order[-max(1, BATCH_BLOCKS // len(rows[order[-1]])) :]
            del order[-len(some) :]
            x, mask = self._padded([rows[k] for k in some])
            both = np.concatenate([self.left.forward(x, mask), self.right.forward(x[::-1], mask[::-1])[::-1]], axis=2)
            z = both @ self.out[0] + self.out[1]
            for j, k in enumerate(some):
                found[k] = z[: len(rows[k]), j]
        return found

    def fit(self, rows: list[np.ndarray], labels: list[np.ndarray], epochs: int = 14, batch: int = 24, seed: int = 3) -> None:
        """Adam on the mean cross-entropy of blocks."""
        rng = np.random.default_rng(seed)
        params = [*self.left.p, *self.right.p, *self.out]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), batch):
                some = order[at : at + batch]
                x, mask = self._padded([rows[k] for k in some])
                y = np.zeros(mask.shape, np.float32)
                for j, k in enumerate(some):
                    y[: len(rows[k]), j] = labels[k]
                kept_l: list = []
                kept_r: list = []
                h = np.concatenate([self.left.forward(x, mask, kept_l), self.right.forward(x[::-1], mask[::-1], kept_r)[::-1]], axis=2)
                d = np.where(mask, _sigmoid(h @ self.out[0] + self.out[1]) - y, 0) / mask.sum()
                d_h = d[:, :, None] * self.out[0]
                grads = [*self.left.backward(x, mask, kept_l, d_h[:, :, :HIDDEN]), *self.right.backward(x[::-1], mask[::-1], kept_r, d_h[::-1, :, HIDDEN:])]
                grads += [np.tensordot(d, h, ([0, 1], [0, 1])), np.array([d.sum()])]
                step += 1
                rate = 0.01 * (1 if epoch < epochs - 4 else 0.2)
                for p, g, m, v in zip(params, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)


def _rebuilt(rng: random.Random, main: list[str], other: list[str]) -> str:
    """A page in another layout: these paragraphs as main text, others around it."""
    some = lambda n: [html.escape(rng.choice(other)[:200]) for _ in range(n)]
    wrap = lambda kinds, inner: (lambda k: f"<{k}>{inner}</{k.split()[0]}>")(rng.choice(kinds))
    paragraphs = lambda n, tag="p": "".join(f"<{tag}>{x}</{tag}>" for x in some(n))
    links = "<ul>" + "".join(f'<li><a href="#">{x[:20]}</a></li>' for x in some(rng.randint(2, 9))) + "</ul>"
    around = {
        "header": wrap(["header", 'div class="header"', 'div id="masthead"'], paragraphs(1, "h2") + links),
        "nav": wrap(["nav", 'div class="menu"', 'ul class="nav"', 'div class="breadcrumb"'], links),
        "notice": wrap(['div class="notice"', 'div class="cookie-consent"', 'div role="alert"'], paragraphs(1)),
        "ad": wrap(['div class="ad"', 'div class="advert"', 'div class="sponsored"', 'div class="promo"'], some(1)[0]),
        "side": wrap(["aside", 'div class="sidebar"', 'div class="widget"', 'div class="related"'], paragraphs(rng.randint(1, 4)) + links),
        "form": wrap(["form", 'div class="newsletter"'], "<label>" + some(1)[0][:30] + "</label><input><button>" + some(1)[0][:12] + "</button>"),
        "comments": wrap(['section class="comments"', 'div id="comments"', 'div class="discussion"'], "".join(f'<div class="comment">{paragraphs(1)}</div>' for _ in range(rng.randint(1, 6)))),
        "footer": wrap(["footer", 'div class="footer"', 'div id="copyright"'], paragraphs(1)),
    }
    inside = [f"<p>{html.escape(x)}</p>" for x in main]
    for name in ("ad", "side", "form"):
        if rng.random() < 0.25:
            inside.insert(rng.randint(1, len(inside)), around[name])
    body = wrap(["article", "main", 'div class="content"', 'div id="main-content"', 'section class="post"', 'div class="entry"', 'div class="story"'], "".join(inside))
    before = [around[n] for n in ("header", "nav", "notice", "ad", "side") if rng.random() < 0.6]
    after = [around[n] for n in ("side", "form", "comments", "ad", "footer") if rng.random() < 0.6]
    return f"<html><body>{''.join(before)}{body}{''.join(after)}</body></html>"


_CONTAINER = re.compile(r"(</?)(?:article|main|nav|header|footer|aside|section|form)\b")
_VALUE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)


def _renamed(rng: random.Random, page: str) -> str:
    """The same blocks without telling names: containers become plain ones and names are drawn anew, one for each that the page has."""
    names: dict[str, str] = {}

    def drawn(match: re.Match) -> str:
        name = names.setdefault(match[2].lower(), "".join(rng.choices("bcdfghjklmnpqrstvwxz", k=6)))
        return f'{match[1]}="{name}"'

    return _CONTAINER.sub(r"\1div", _VALUE.sub(drawn, page))


def fitted(pages: DataFrame, sample: int = SAMPLE, chars: int = SAMPLE_CHARS) -> Labeller:
    """A labeller fitted on `sample` pages of at most `chars` code points, chosen by a hash of page_id."""
    known = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html")).filter(F.col("page_id").isNotNull() & (F.length("html") <= chars))
    ids = [r["page_id"] for r in known.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample).collect()]
    rows = known.filter(F.col("page_id").isin(ids)).orderBy("page_id", "html").limit(sample).collect() if ids else []
    rng = random.Random(11)
    pages_read = [r["html"] for r in rows]
    found = [b for page in pages_read if (b := blocks_of(page))]
    texts = [b[1] for page in found for b in page]
    built = []
    for page in found:
        main = [b[1] for b in page if taught(b[0])] or texts[:3]
        built.append(_rebuilt(rng, main[: rng.randint(1, 30)], texts))
    found += map(blocks_of, built)
    labels = [np.array([taught(b[0]) for b in page], np.float32) for page in found]
    # Layouts without telling names teach the labeller to go by position, links and length as well.
    for page in built:
        named, plain = blocks_of(page), blocks_of(_renamed(rng, page))
        if len(named) == len(plain):
            found.append(plain)
            labels.append(np.array([taught(b[0]) for b in named], np.float32))
    model = Labeller()
    if found:
        ends = np.cumsum([len(p) for p in found])
        model.fit(np.split(vectors(found), ends[:-1]), labels)
    return model


def extract(pages: DataFrame, model: Labeller) -> DataFrame:
    """page_id, url, text, n_chars, n_blocks, n_kept; a row for each row of pages."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", SLICE):
            found = [blocks_of(x or "") for x in batch.column("html").to_pylist()]
            scores = shared.value.scores(np.split(vectors(found), np.cumsum([len(p) for p in found])[:-1]))
            kept = [[b[1] for b, z in zip(p, s, strict=True) if z > 0] for p, s in zip(found, scores, strict=True)]
            texts = [" ".join(k) for k in kept]
            counts = [[len(t) for t in texts], [len(p) for p in found], [len(k) for k in kept]]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), *(pa.array(c, pa.int64()) for c in counts)], names=["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long, n_kept long")
