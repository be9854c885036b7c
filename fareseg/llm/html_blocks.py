"""Main-text extraction: a recurrent block labeller over a page's leaf blocks.

A page is cut at block-level tags into leaf blocks (inline tags don't cut).
Each block becomes a vector: its tag path (tag names, class and id words, hashed)
and its words (hashed), with a few lengths and shares. A bidirectional LSTM in
NumPy reads the whole page's sequence both ways and gives every block the
probability of being article text; blocks from 0.5 on are joined in page order.

The network is trained here, on a bounded sample of pages (``MAX_TRAIN`` first
by hash of page_id). Their blocks are labelled by explicit structure
(``article``/``main`` against navigation, forms, adverts and the like) and
re-dressed in other page layouts, where the structure that gave the label is
often hidden, so that order, neighbours and wording must do.

Null, empty and tag-free pages: no page text but the labelled blocks, if any, of
what is there; a null html gives an empty text. Unclosed, stray and broken tags
are read leniently; a page of any length is read whole. Scripts, styles, titles,
controls, drawings and embedded objects are cut from their start to their own
end tag; one that is self-closed or never ends cuts nothing (a script, style,
textarea or comment takes the rest, as in browsers). A head needs no end tag.
Repeated rows repeat.
"""

from __future__ import annotations

import re
import zlib
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareseg.llm.words import ALNUM, LOWER, Hasher

MAX_TRAIN = 240
#: Bytes of pages that are labelled together (about).
SLICE = 4 << 20
PATH_DIM, WORD_DIM, EXTRA = 64, 24, 8
INPUT = PATH_DIM + WORD_DIM + EXTRA
HIDDEN = 16

# HTML's element kinds.
TEXT = "script style textarea title iframe".split()  # hold text, never tags
TO_END = {"script", "style", "textarea"}  # left open, they take the rest of the page, as in browsers
DROPPED = set("noscript template svg object select option button".split())
NESTS = {"template", "svg", "object"}
CUTS = {"title", "head", "button", "option", "select"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small "
             "span strike strong sub sup time tt u var wbr br".split())
CLOSES_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
               "section table ul".split())

#: What the structural labels of the training pages go by.
ARTICLE = {"article", "main", "articlebody"}
BOILER = set("nav header footer aside form menu dialog ad ads advert sponsored sidebar cookie notice banner promo related share "
             "social comment comments reply breadcrumb newsletter subscribe login popup".split())

_TAG = re.compile(r"<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)")
#: To a tag's end: a value may be quoted or bare (and then hold quotes); quotes elsewhere are plain characters. Nothing is tried twice.
_ATTRS = re.compile(r"(?>[^>\"'=]++|=\s*+(?>\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?|[\"'])*+>")
_END = {t: re.compile(rf"</{t}(?![a-z0-9:-])[^>]*>", re.I | re.A) for t in TEXT}
_AGAIN = {t: re.compile(rf"<(?:{t}{'|/head|body' * (t == 'title')})(?![a-z0-9:-])", re.I | re.A) for t in TEXT}
_BARE_VALUE = re.compile(r"=\s*[^\s\"'>]+/\Z")
_WORDY = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_SPLIT = re.compile(r"[a-z]+|[A-Z][a-z]*")


def _names(tag: str, attrs: str) -> tuple[str, ...]:
    """The tag and the words of its class, id, role and itemprop."""
    if not attrs or "=" not in attrs:
        return (tag,)
    return (tag, *(w.lower() for v in _WORDY.findall(attrs) for w in _SPLIT.findall(v)))


def _closed(attrs: str) -> bool:
    """Self-closed; a slash that ends a bare value belongs to the value."""
    return attrs.endswith("/") and not _BARE_VALUE.search(attrs)


def _tokens(html: str) -> list[tuple[str | None, str, str, str]]:
    """``(text, tag, end slash, attributes)`` in page order, without comments, declarations and what text elements hold."""
    out, at, ahead = [], 0, {}

    def upcoming(p: re.Pattern):
        # kept until it is passed, so that a page's searches together read it once
        if p not in ahead or ahead[p] and ahead[p].start() < at:
            ahead[p] = p.search(html, at)
        return ahead[p]

    final, quoted = html.rfind(">"), True  # behind the last tag end everything is text
    while at < len(html):
        lt = html.find("<", at)
        if lt != at:
            out.append((html[at:lt if lt > 0 else len(html)], "", "", ""))
            at = lt if lt > 0 else len(html)
            continue
        if html.startswith("<!--", at):
            shut = html.find("-->", at + 4)
            at = shut + 3 if shut >= 0 else len(html)
            continue
        m = _TAG.match(html, at)
        if at > final or not m and html[at + 1:at + 2] not in ("!", "?", "/"):
            out.append(("<", "", "", ""))
            at += 1
            continue
        if not m:
            at = html.find(">", at) + 1
            continue
        shut = _ATTRS.match(html, m.end()) if quoted else None
        if shut is None:  # a quote that never ends: from here on quotes hide no tag end
            quoted = False
        at = shut.end() if shut else html.find(">", m.end()) + 1
        tag, end, attrs = m["tag"].lower(), m["end"], html[m.end():at - 1]
        out.append((None, tag, end, attrs))
        if tag not in _END or end or _closed(attrs):
            continue
        last, again = upcoming(_END[tag]), upcoming(_AGAIN[tag])
        near = last and not (again and again.start() < last.start())
        if near or last and tag in TO_END and not attrs.endswith("/"):
            at = last.end()
        elif tag in TO_END and not attrs.endswith("/"):
            at = len(html)
        elif tag == "title":
            at = max(at, html.find("<", at))
    return out


def _dropped(tokens: list) -> dict[int, int]:
    """Start to end index of the dropped elements that do end; a start without an end is no range."""
    ends, opened, option = {}, {}, None
    for i, (_, tag, end, attrs) in enumerate(tokens):
        if not tag or tag in INLINE:
            continue
        if option is not None and (tag in ("option", "optgroup") and not end or tag in ("select", "datalist", "optgroup") and end):
            ends[option] = i - 1  # an option may leave its end tag out here
        option = None
        if tag not in DROPPED:
            continue
        if end:
            if opened.get(tag):
                ends[opened[tag].pop()] = i
        elif not _closed(attrs):
            if tag in NESTS:
                opened.setdefault(tag, []).append(i)
            else:
                opened[tag] = [i]
            option = i if tag == "option" else None
    return ends


def _part_vector(part: tuple[str, ...], memo: dict) -> np.ndarray:
    v = memo.get(part)
    if v is None:
        v = np.zeros(PATH_DIM)
        for n in part:
            h = zlib.crc32(n.encode())
            v[h % PATH_DIM] += 1.0 if h >> 16 & 1 else -1.0
        if len(memo) > 50_000:
            memo.clear()
        memo[part] = v
    return v


class Path:
    """An element's place in the page: its own names and the place around it, so that a deep page costs no more than a flat one.

    ``total`` sums the vectors of all its parts, ``own`` is the innermost one's.
    """

    __slots__ = ("around", "part", "depth", "total", "own", "article", "boiler")

    def __init__(self, around: Path | None, part: tuple[str, ...], memo: dict) -> None:
        self.around, self.part, self.own = around, part, _part_vector(part, memo)
        self.depth = around.depth + 1 if around else 1
        self.total = around.total + self.own if around else self.own
        self.article = bool(around and around.article) or not ARTICLE.isdisjoint(part)
        self.boiler = bool(around and around.boiler) or not BOILER.isdisjoint(part)

    def parts(self) -> list[tuple[str, ...]]:
        """All parts, outermost first."""
        out, p = [], self
        while p:
            out.append(p.part)
            p = p.around
        return out[::-1]

    def vector(self) -> np.ndarray:
        """The two innermost parts weigh more than those around them."""
        near = self.own + self.around.own if self.around else self.own
        return 0.7 * self.total + 0.3 * near


def path_of(parts, memo: dict) -> Path | None:
    p = None
    for part in parts:
        p = Path(p, part, memo)
    return p


def blocks(html: str, memo: dict | None = None) -> list[tuple[Path | None, str, int]]:
    """``(path, text, linked characters)`` of the non-empty leaf blocks in page order; the text is decoded, single-spaced and trimmed.

    The path is None outside of all elements. ``memo`` keeps part vectors from page to page.
    """
    out, stack, text, linked, in_link = [], [], [], 0, False
    memo = {} if memo is None else memo

    def flush() -> None:
        nonlocal linked
        if text:
            t = " ".join(unescape("".join(text)).split())
            if t:
                out.append((stack[-1] if stack else None, t, linked))
            text.clear()
            linked = 0

    tokens = _tokens(html)
    ends, skip, open_ = _dropped(tokens), -1, {}  # open_: how many elements of a name are open
    for i, (piece, tag, end, attrs) in enumerate(tokens):
        if i <= skip:
            continue
        if piece is not None:
            text.append(piece)
            if in_link:
                linked += len(piece)
            continue
        if tag in DROPPED or tag in _END or tag == "head":
            skip = ends.get(i, skip)
            if tag in CUTS:
                flush()
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = not end
            elif tag == "br":
                text.append(" ")
            continue
        flush()
        if end:
            if open_.get(tag):
                while True:
                    name = stack.pop().part[0]
                    open_[name] -= 1
                    if name == tag:
                        break
        elif tag not in VOID and not attrs.endswith("/"):
            inner = stack[-1].part[0] if stack else ""
            if tag in CLOSES_P and inner == "p" or tag in ("li", "td", "th", "tr", "dt", "dd") and inner == tag:
                open_[stack.pop().part[0]] -= 1
            stack.append(Path(stack[-1] if stack else None, _names(tag, attrs), memo))
            open_[tag] = open_.get(tag, 0) + 1
    flush()
    return out


def structural_label(path: Path | None) -> bool:
    return path is not None and path.article and not path.boiler


def page_vectors(pages: list, hasher: Hasher) -> list[np.ndarray]:
    """One (blocks, INPUT) array a page; all pages' words are hashed together."""
    flat = [b for p in pages for b in p]
    x = np.zeros((len(flat), INPUT))
    if flat:
        raw = [t.encode() for _, t, _ in flat]
        data = LOWER[np.frombuffer(b"".join(raw), np.uint8)]
        size = np.array([len(r) for r in raw])
        offs = np.concatenate([[0], np.cumsum(size)])
        s, e, at = hasher.spans(data, offs, ALNUM)
        h = hasher.hashes(data, s, e)
        n = np.bincount(at, minlength=len(flat)).astype(float)
        sign = np.where(h >> np.uint64(40) & np.uint64(1), 1.0, -1.0)
        slot = at * WORD_DIM + (h % np.uint64(WORD_DIM)).astype(np.int64)
        words = np.bincount(slot, sign, len(flat) * WORD_DIM).reshape(-1, WORD_DIM)
        x[:, PATH_DIM:PATH_DIM + WORD_DIM] = words / np.maximum(np.linalg.norm(words, axis=1), 1)[:, None]
        for row, (p, _, _) in zip(x, flat):
            if p is not None:
                row[:PATH_DIM] = p.vector()
        link = np.array([k for _, _, k in flat], float) / np.maximum([len(t) for _, t, _ in flat], 1)
        stops = np.bincount(np.searchsorted(offs, np.flatnonzero((data == 46) | (data == 44)), "right") - 1, minlength=len(flat))
        x[:, PATH_DIM + WORD_DIM:] = np.stack([
            np.log1p(n) / 3, np.minimum(link, 1), np.log1p(stops) / 2, (n < 4), (n >= 12), np.array([p.depth if p else 0 for p, _, _ in flat]) / 8,
            np.array([t[-1:] in ".!?\"”" for _, t, _ in flat]), np.ones(len(flat))], axis=1)
    cut = np.cumsum([len(p) for p in pages])[:-1]
    return np.split(x, cut) if len(pages) else []


def _batches(vectors: list[np.ndarray], cells: int = 60_000):
    """Indices of pages of like length, at most ``cells`` padded steps together (a longer page alone)."""
    order = sorted(range(len(vectors)), key=lambda i: len(vectors[i]))
    group: list[int] = []
    for i in order:
        if group and (len(group) + 1) * len(vectors[i]) > cells // 16:
            yield group
            group = []
        group.append(i)
    if group:
        yield group


def _padded(vectors: list[np.ndarray]):
    t = max(len(v) for v in vectors)
    x, seen = np.zeros((t, len(vectors), INPUT)), np.zeros((t, len(vectors)))
    for j, v in enumerate(vectors):
        x[:len(v), j], seen[:len(v), j] = v, 1.0
    return x, seen


def _sigmoid(a: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(a, -30, 30)))


class Labeller:
    """Two LSTMs (forward and backward over the page) and a logistic output on both states."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.w = {}
        for d in "fb":
            self.w["x" + d] = rng.normal(0, 0.15, (INPUT, 4 * HIDDEN))
            self.w["h" + d] = rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN))
            self.w["c" + d] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        self.w["o"], self.w["ob"] = rng.normal(0, 0.15, (2 * HIDDEN,)), np.zeros(1)

    def _run(self, x, seen, d: str, learn: bool = False):
        """States of one direction; padding keeps the state, so backward starts at each page's own end. ``learn`` keeps each step."""
        steps = range(len(x)) if d == "f" else range(len(x) - 1, -1, -1)
        pre = x @ self.w["x" + d] + self.w["c" + d]
        h, c = np.zeros((x.shape[1], HIDDEN)), np.zeros((x.shape[1], HIDDEN))
        out, trace = np.zeros((*x.shape[:2], HIDDEN)), []
        for t in steps:
            a = pre[t] + h @ self.w["h" + d]
            g = _sigmoid(a[:, :3 * HIDDEN])
            i, f, o, u = g[:, :HIDDEN], g[:, HIDDEN:2 * HIDDEN], g[:, 2 * HIDDEN:], np.tanh(a[:, 3 * HIDDEN:])
            m = seen[t][:, None]
            new = f * c + i * u
            th = np.tanh(new)
            if learn:
                trace.append((t, h, c, i, f, o, u, th, m))
            c = m * new + (1 - m) * c
            h = m * o * th + (1 - m) * h
            out[t] = h
        return out, trace

    def probability(self, x, seen):
        hf, _ = self._run(x, seen, "f")
        hb, _ = self._run(x, seen, "b")
        return _sigmoid(np.concatenate([hf, hb], 2) @ self.w["o"] + self.w["ob"])

    def gradient(self, x, seen, y):
        grads = {k: np.zeros_like(v) for k, v in self.w.items()}
        states = {d: self._run(x, seen, d, True) for d in "fb"}
        both = np.concatenate([states["f"][0], states["b"][0]], 2)
        err = (_sigmoid(both @ self.w["o"] + self.w["ob"]) - y) * seen / seen.sum()
        grads["o"], grads["ob"] = np.tensordot(err, both, 2), err.sum(keepdims=True).ravel()
        for k, d in enumerate("fb"):
            back = err[:, :, None] * self.w["o"][k * HIDDEN:(k + 1) * HIDDEN]
            dh, dc = np.zeros((x.shape[1], HIDDEN)), np.zeros((x.shape[1], HIDDEN))
            for t, h, c, i, f, o, u, th, m in reversed(states[d][1]):
                dh = dh + back[t]
                do, dn = m * dh * th, m * (dh * o * (1 - th ** 2) + dc)
                da = np.concatenate([dn * u * i * (1 - i), dn * c * f * (1 - f), do * o * (1 - o), dn * i * (1 - u ** 2)], 1)
                grads["x" + d] += x[t].T @ da
                grads["h" + d] += h.T @ da
                grads["c" + d] += da.sum(0)
                dh = (1 - m) * dh + da @ self.w["h" + d].T
                dc = (1 - m) * dc + dn * f
        return grads

    def train(self, vectors, labels, epochs: int = 24, rate: float = 0.01, size: int = 48, seed: int = 7) -> Labeller:
        """Adam over shuffled minibatches of like-sized pages."""
        rng, step = np.random.default_rng(seed), 0
        m1, m2 = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        order = [i for i in sorted(range(len(vectors)), key=lambda i: len(vectors[i])) if len(vectors[i])]
        groups = []
        for i in range(0, len(order), size):
            g = order[i:i + size]
            x, seen = _padded([vectors[j] for j in g])
            y = np.zeros(seen.shape)
            for c, j in enumerate(g):
                y[:len(labels[j]), c] = labels[j]
            groups.append((x, seen, y))
        for epoch in range(epochs):
            for b in rng.permutation(len(groups)):
                step += 1
                for k, g in self.gradient(*groups[b]).items():
                    g = np.clip(g, -1, 1)
                    m1[k] = 0.9 * m1[k] + 0.1 * g
                    m2[k] = 0.99 * m2[k] + 0.01 * g * g
                    lr = rate * (1 - 0.8 * epoch / epochs)
                    self.w[k] = self.w[k] - lr * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-8)
        return self

    def label(self, vectors: list[np.ndarray]) -> list[np.ndarray]:
        out: list = [np.zeros(0, bool)] * len(vectors)
        for g in _batches([v for v in vectors]):
            if len(vectors[g[-1]]):
                p = self.probability(*_padded([vectors[i] for i in g]))
                for j, i in enumerate(g):
                    out[i] = p[:len(vectors[i]), j] >= 0.5
        return out


#: Page parts of the re-dressed training pages: (wrapper names, article text or not, blocks at most).
_PARTS_AROUND = [
    (("nav",), 6), (("div", "menu"), 6), (("ul", "nav"), 6), (("header",), 3), (("div", "header"), 3), (("footer",), 3),
    (("div", "footer"), 3), (("aside",), 4), (("div", "sidebar"), 5), (("div", "cookie", "notice"), 2), (("div", "banner"), 2),
    (("div", "ad"), 2), (("div", "sponsored"), 2), (("form",), 4), (("form", "newsletter"), 3), (("div", "related"), 5),
    (("div", "share", "social"), 4), (("section", "comments"), 6), (("div", "comment"), 3), (("ol", "comments"), 6),
    (("div", "breadcrumb"), 3), (("div", "promo"), 2), (("dialog",), 2),
]
_ARTICLE_AS = [("article",), ("main",), ("div", "content"), ("div", "post", "body"), ("div", "entry"), ("section", "story"),
               ("div", "article", "text"), ("div", "main"), ("td",), ("div",)]
_TEXT_AS = [("p",), ("p",), ("p",), ("h", ), ("blockquote",), ("li",), ("pre",), ("td",), ("div",)]


def shortened(page, rng: np.random.Generator):
    """The page with some blocks cut to a few words or to one repeated word, so that length alone decides nothing."""
    out = []
    for path, text, linked in page:
        words = text.split()
        if rng.random() < 0.25:
            words = words[:rng.integers(1, 4)] * (1 if rng.random() < 0.6 else int(rng.integers(2, 30)))
        out.append((path, " ".join(words), linked and len(" ".join(words))))
    return out


def redressed(page, others: list, rng: np.random.Generator, memo: dict | None = None):
    """The page's article blocks in another layout, with other pages' texts as its boilerplate: ``(blocks, labels)``."""
    memo = {} if memo is None else memo
    own = [b for b in page if structural_label(b[0])]
    spare = lambda: others[rng.integers(len(others))]
    names = _ARTICLE_AS[rng.integers(len(_ARTICLE_AS))]
    out, labels = [], []

    def around(inside=()) -> None:
        part, most = _PARTS_AROUND[rng.integers(len(_PARTS_AROUND))]
        comments = any(n.startswith("comment") for n in part)
        for _ in range(rng.integers(1, most + 1)):
            words = spare()[1].split()
            n = len(words) if comments or rng.random() < 0.2 else int(rng.integers(1, 12))
            text = " ".join(words[:max(n, 1)])
            linked = len(text) if part[0] in ("nav", "ul") or rng.random() < 0.3 else 0
            inner = (("p",),) if comments or rng.random() < 0.4 else (("ul",), ("li",)) if linked else ()
            out.append((path_of((("html",), ("body",), *inside, part, *inner), memo), text, linked))
            labels.append(0.0)

    for _ in range(rng.integers(1, 4)):
        around()
    for k, (path, text, linked) in enumerate(own):
        part = path.part if rng.random() < 0.7 else _TEXT_AS[rng.integers(len(_TEXT_AS))]
        out.append((path_of((("html",), ("body",), names, part if part != ("h",) else ("h2",)), memo), text, linked))
        labels.append(1.0)
        if k and rng.random() < 0.08:
            around((names,))
    for _ in range(rng.integers(1, 4)):
        around((names,) if rng.random() < 0.15 else ())
    return out, labels


def fit(pages: DataFrame, max_rows: int = MAX_TRAIN, layouts: int = 4, seed: int = 7) -> Labeller:
    """A labeller trained on at most ``max_rows`` pages, each as it is and in ``layouts`` other layouts."""
    some = pages.where("html is not null and page_id is not null")
    pick = some.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(max_rows)  # ids first, then their html
    rows = some.join(F.broadcast(pick), "page_id").groupBy("page_id").agg(F.min("html").alias("html")).collect()
    rows.sort(key=lambda r: r["page_id"])
    rng, memo = np.random.default_rng(seed), {}
    read = [blocks(r["html"], memo) for r in rows]
    others = [b for p in read for b in p] or [(None, "none", 0)]
    data, labels = [], []
    for p in read:
        data.append(p)
        own = [float(structural_label(b[0])) for b in p]
        labels.append(own)
        for _ in range(layouts if any(own) else 0):
            data.append(shortened(p, rng))
            labels.append(own)
            b, y = redressed(p, others, rng, memo)
            data.append(shortened(b, rng) if rng.random() < 0.3 else b)
            labels.append(y)
    return Labeller(seed).train(page_vectors(data, Hasher()), labels)


def extract(pages: DataFrame, labeller: Labeller, html: str = "html", keep: list[str] | None = None, out: str = "text") -> DataFrame:
    """``keep`` columns and the main text of every row."""
    keep = [c for c in pages.columns if c not in (html, out)] if keep is None else keep

    def kernel(batches):
        hasher, memo = Hasher(), {}
        for whole in batches:
            size = pc.fill_null(pc.binary_length(whole.column(html)), 0).to_numpy(zero_copy_only=False).astype(np.int64).cumsum()
            lo = 0
            while lo < whole.num_rows:  # as many pages as fit in SLICE bytes, a longer one alone
                fit_in = int(np.searchsorted(size, (size[lo - 1] if lo else 0) + SLICE, "right"))
                b = whole.slice(lo, max(1, min(fit_in - lo, 256)))
                lo += b.num_rows
                read = [blocks(h.as_py() or "", memo) for h in b.column(html)]
                marks = labeller.label(page_vectors(read, hasher))
                texts = ["\n".join(t for (_, t, _), y in zip(p, m) if y) for p, m in zip(read, marks)]
                yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(texts, pa.string())], [*keep, out])

    schema = pages.select(*keep, F.lit("").alias(out)).schema
    return pages.select(*dict.fromkeys([*keep, html])).mapInArrow(kernel, schema)


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every page."""
    return extract(pages, fit(pages), keep=["page_id", "url"]).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
