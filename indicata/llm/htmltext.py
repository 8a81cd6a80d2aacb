"""Main text of web pages, block by block, by a bidirectional LSTM over the whole page.

A page is cut into leaf blocks: runs of text between block-level tags, each with the
open elements above it. The network reads hashed tag-path and word vectors of all leaves
in both directions and labels every block. It learns from generated page layouts, in
which the article's blocks are known.
"""

from __future__ import annotations

import functools
import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import packed, unpacked

# Fixed values of HTML: elements that do not break a block, and elements whose content is no text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
NO_TEXT = frozenset("script style noscript template svg math iframe object canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An element of the first kind ends an open element of the second, whose end tag may be left out.
IMPLIED_END = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^"'>]|"[^"]*+"|'[^']*+')*+)>|<[!?][^>]*+>""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.I)

TAG_WIDTH, WORD_WIDTH, NUMBERS = 96, 48, 6
WIDTH = TAG_WIDTH + WORD_WIDTH + NUMBERS


#: Elements whose content is read as text up to the end tag, or to the end of the page.
RAW = frozenset(("script", "style"))


@functools.cache
def _tags_of(tag: str) -> re.Pattern:
    return re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*>", re.I)


def _ends_of(page: str, tag: str) -> dict[int, int]:
    """Where the content of every such element that is closed ends, by the place of its start tag; elements may hold each other."""
    found, open_ = {}, []
    for m in _tags_of(tag).finditer(page):
        if not m.group(1):
            if not m.group().endswith("/>"):
                open_.append(m.start())
        elif open_:
            found[open_.pop()] = m.end()
    return found


@dataclass
class Block:
    path: tuple[str, ...]
    pieces: list[str] = field(default_factory=list)
    linked: int = 0

    @functools.cached_property
    def text(self) -> str:
        return " ".join(html.unescape("".join(self.pieces)).split())


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks with text, in page order. Broken markup ends at the next tag that can be read; nothing is cut off.

    The content of scripts, styles, media and the like is no text. One of these that is never closed hides nothing, except that
    a script or style goes on to the end of the page, as in a browser.
    """
    stack: list[tuple[str, str]] = []
    out: list[Block] = []
    now: Block | None = None
    links, at = 0, 0
    closed: dict[str, dict[int, int]] = {}

    def add(piece: str) -> None:
        nonlocal now
        if not piece or (now is None and not piece.strip()):
            return
        if now is None:
            now = Block(tuple(mark for _, mark in stack))
            out.append(now)
        now.pieces.append(piece)
        now.linked += len(piece) if links else 0

    while m := TAG.search(page, at):
        add(page[at : m.start()])
        tag, closing, at = (m.group(2) or "").lower(), bool(m.group(1)), m.end()
        if not tag:
            continue
        if tag in NO_TEXT:
            if not closing and tag in RAW:
                end = next((e for e in _tags_of(tag).finditer(page, at) if e.group(1)), None)
                at = end.end() if end else len(page)
            elif not closing and not m.group(3).endswith("/"):
                if tag not in closed:
                    closed[tag] = _ends_of(page, tag)
                at = closed[tag].get(m.start(), at)
            continue
        if tag in INLINE:
            links = max(0, links + (-1 if closing else 1)) if tag == "a" else links
            if tag == "br":
                add(" ")
            continue
        now = None
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            links = 0
            continue
        ends = IMPLIED_END.get(tag, ())
        if stack and (stack[-1][0] in ends or stack[-1][0] == "p"):
            stack.pop()
        if tag not in VOID:
            stack.append((tag, _mark(tag, m.group(3))))
    add(page[at:])
    return [b for b in out if b.text]


def _mark(tag: str, attributes: str) -> str:
    """The element with the words of its class, id and role."""
    if "=" not in attributes:
        return tag
    names = [a or b or c for _, a, b, c in ATTRIBUTE.findall(attributes)]
    return " ".join([tag, *re.findall(r"[a-z]+", " ".join(names).lower())])


def _slot(word: str, width: int) -> tuple[int, float]:
    code = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    return (code >> 1) % width, 1.0 if code & 1 else -1.0


@functools.lru_cache(maxsize=4096)
def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    """Signed hashed bag of the path's words; the element next to the text and the outer ones apart."""
    out = np.zeros(TAG_WIDTH, dtype=np.float32)
    for depth, mark in enumerate(reversed(path)):
        for word in mark.split():
            k, sign = _slot(f"{'own' if depth == 0 else 'above'}:{word}", TAG_WIDTH)
            out[k] += sign
            k, sign = _slot(word, TAG_WIDTH)
            out[k] += sign
    return out / max(1.0, float(np.linalg.norm(out)))


def vectors(blocks: list[Block]) -> np.ndarray:
    """One row per block: tag path, words, and length, links, punctuation and place."""
    out = np.zeros((len(blocks), WIDTH), dtype=np.float32)
    for k, block in enumerate(blocks):
        text = block.text
        words = text.lower().split()
        out[k, :TAG_WIDTH] = _path_vector(block.path)
        codes = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words], dtype=np.int64)
        bag = np.bincount((codes >> 1) % WORD_WIDTH, weights=1.0 - 2.0 * (codes & 1 == 0), minlength=WORD_WIDTH)
        out[k, TAG_WIDTH : TAG_WIDTH + WORD_WIDTH] = bag / max(1.0, float(np.linalg.norm(bag)))
        stops = text.count(".") + text.count(",") + text.count("!") + text.count("?")
        raw = max(1, sum(map(len, block.pieces)))
        out[k, -NUMBERS:] = (np.log1p(len(words)) / 4, block.linked / raw, min(1.0, stops / max(1, len(words))), k / len(blocks), (len(blocks) - 1 - k) / len(blocks), len(block.path) / 8)
    return out


# --- the network ----------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _forward(x: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, keep: bool = False):
    """LSTM over ``x`` of time x rows x width; returns all outputs, and what the way back needs."""
    steps, rows, _ = x.shape
    size = u.shape[0]
    put = (x.reshape(steps * rows, -1) @ w + b).reshape(steps, rows, 4 * size)
    h, c = np.zeros((rows, size), np.float32), np.zeros((rows, size), np.float32)
    out, saved = np.empty((steps, rows, size), np.float32), []
    for t in range(steps):
        z = put[t] + h @ u
        gates = _sigmoid(z[:, : 3 * size])
        i, f, o, g = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :], np.tanh(z[:, 3 * size :])
        before, was = c, h
        c = f * c + i * g
        squashed = np.tanh(c)
        h = o * squashed
        out[t] = h
        if keep:
            saved.append((i, f, o, g, before, squashed, was))
    return out, saved


def _backward(x, u, saved, grad):
    """Gradients of the weights, given those of the outputs."""
    steps, rows, _ = x.shape
    size = u.shape[0]
    dz_all = np.empty((steps, rows, 4 * size), np.float32)
    du, dh, dc = np.zeros_like(u), np.zeros((rows, size), np.float32), np.zeros((rows, size), np.float32)
    for t in range(steps - 1, -1, -1):
        i, f, o, g, before, squashed, was = saved[t]
        dh = dh + grad[t]
        dc = dc + dh * o * (1 - squashed**2)
        dz = np.hstack([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)])
        dz_all[t] = dz
        du += was.T @ dz
        dh, dc = dz @ u.T, dc * f
    flat = dz_all.reshape(steps * rows, -1)
    return x.reshape(steps * rows, -1).T @ flat, du, flat.sum(axis=0)


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Time x page x width, the mask of real blocks, and for each page its blocks in reverse order."""
    lengths = np.array([len(p) for p in pages])
    steps = lengths.max()
    x = np.zeros((steps, len(pages), WIDTH), np.float32)
    for k, p in enumerate(pages):
        x[: len(p), k] = p
    time = np.arange(steps)[:, None]
    mask = time < lengths[None, :]
    back = np.where(mask, lengths[None, :] - 1 - time, time)
    return x, mask, back


@dataclass
class Labeller:
    """Two LSTMs, one for each direction, and a linear layer over both."""

    weights: dict[str, np.ndarray]

    @staticmethod
    def fresh(size: int, rng: np.random.Generator) -> Labeller:
        w: dict[str, np.ndarray] = {}
        for d in ("f", "b"):
            w[f"w{d}"] = (rng.standard_normal((WIDTH, 4 * size)) / np.sqrt(WIDTH)).astype(np.float32)
            w[f"u{d}"] = (rng.standard_normal((size, 4 * size)) / np.sqrt(size)).astype(np.float32)
            w[f"b{d}"] = np.zeros(4 * size, np.float32)
            w[f"b{d}"][size : 2 * size] = 1
        w["v"] = (rng.standard_normal(2 * size) / np.sqrt(2 * size)).astype(np.float32)
        w["a"] = np.zeros(1, np.float32)
        return Labeller(w)

    def scores(self, pages: list[np.ndarray], most: int = 20_000) -> list[np.ndarray]:
        """Probability of main text for every block; pages of like length are run together, ``most`` blocks at a time."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        while order:
            rows = max(1, most // len(pages[order[-1]]))
            now, order = order[-rows:], order[:-rows]
            x, mask, back = _padded([pages[k] for k in now])
            logits = self._logits(x, back)[0]
            for j, k in enumerate(now):
                out[k] = _sigmoid(logits[: len(pages[k]), j])
        return out

    def _logits(self, x: np.ndarray, back: np.ndarray, keep: bool = False):
        w = self.weights
        column = np.arange(x.shape[1])[None, :]
        there, saved_there = _forward(x, w["wf"], w["uf"], w["bf"], keep)
        turned = x[back, column]
        reverse, saved_back = _forward(turned, w["wb"], w["ub"], w["bb"], keep)
        both = np.concatenate([there, reverse[back, column]], axis=2)
        return both @ w["v"] + w["a"], (both, turned, saved_there, saved_back)

    def gradients(self, x: np.ndarray, mask: np.ndarray, back: np.ndarray, wanted: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        logits, (both, turned, saved_there, saved_back) = self._logits(x, back, keep=True)
        error = ((_sigmoid(logits) - wanted) * mask / mask.sum()).astype(np.float32)
        size = len(w["v"]) // 2
        spread = error[:, :, None] * w["v"]
        column = np.arange(x.shape[1])[None, :]
        wf, uf, bf = _backward(x, w["uf"], saved_there, spread[:, :, :size])
        wb, ub, bb = _backward(turned, w["ub"], saved_back, spread[:, :, size:][back, column])
        return {"wf": wf, "uf": uf, "bf": bf, "wb": wb, "ub": ub, "bb": bb, "v": (both * error[:, :, None]).sum((0, 1)), "a": error.sum(keepdims=True).reshape(1)}


def fit(pages: list[tuple[np.ndarray, np.ndarray]], size: int = 12, rounds: int = 12, batch: int = 40, rate: float = 0.01, seed: int = 7) -> Labeller:
    """Adam on the cross entropy of every block."""
    rng = np.random.default_rng(seed)
    model = Labeller.fresh(size, rng)
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step = 0
    for _ in range(rounds):
        order = sorted(rng.permutation(len(pages)).tolist(), key=lambda k: len(pages[k][0]) // 8)
        starts = rng.permutation(range(0, len(order), batch))
        for s in starts:
            now = [pages[k] for k in order[s : s + batch]]
            x, mask, back = _padded([p for p, _ in now])
            wanted = np.zeros(mask.shape, np.float32)
            for k, (_, labels) in enumerate(now):
                wanted[: len(labels), k] = labels
            step += 1
            for name, g in model.gradients(x, mask, back, wanted).items():
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.01 * (g * g - second[name])
                model.weights[name] -= rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)
    return model


# --- generated layouts ------------------------------------------------------------------------------

# Names that web pages give the parts of a layout; each is a wrapper the generator may use.
ARTICLE = ["article", "main", 'div class="content"', 'div id="content"', 'div class="post"', 'div class="entry-content"', 'div class="article-body"', 'div class="story"', 'section class="main-content"', 'div role="main"', "article", "article"]
MENU = ["nav", 'div class="menu"', 'div id="nav"', 'ul class="navigation"', 'div class="breadcrumb"', "nav"]
HEADER = ["header", 'div id="header"', 'div class="site-header"', 'div class="masthead"']
FOOTER = ["footer", 'div id="footer"', 'div class="site-footer"', "footer"]
ASIDE = ["aside", 'div class="sidebar"', 'div id="sidebar"', 'div class="related"', 'section class="widget"', 'div class="share"']
ADVERT = ['div class="ad"', 'div class="ads"', 'div class="advert"', 'div class="sponsored"', 'div class="promo"', 'div class="banner"']
NOTICE = ['div class="cookie-notice"', 'div id="consent"', 'div class="alert"', 'div class="newsletter"', 'div class="popup"']
COMMENTS = ['div id="comments"', 'section class="comments"', 'ol class="comment-list"', 'div class="comment"', 'div class="discussion"']


class _Layout:
    """Writes one page; every block of the article carries a mark that the reader of the page can find again."""

    def __init__(self, rng: np.random.Generator):
        self.rng = rng
        self.words = ["".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(1, 12, 60)]

    def pick(self, names: list[str]) -> str:
        return names[int(self.rng.integers(len(names)))]

    def word(self) -> str:
        return self.words[int(self.rng.integers(len(self.words)))]

    def prose(self, low: int, high: int) -> str:
        words = [self.words[k] for k in self.rng.integers(0, len(self.words), int(self.rng.integers(low, high)))]
        for k in range(0, len(words), int(self.rng.integers(4, 14))):
            words[k] = words[k].capitalize() + (". " if self.rng.random() < 0.5 else "")
        style = self.rng.random()
        if style < 0.06:
            words = [w.upper() + "!!" for w in words]
        elif style < 0.12:
            words = [w + self.pick(["***", "$$$", "###", "&amp;&amp;"]) for w in words]
        return " ".join(words) + ("." if self.rng.random() < 0.7 else "")

    def within(self, wrapper: str, inner: str) -> str:
        return f"<{wrapper}>{inner}</{wrapper.split(' ')[0]}>"

    def links(self) -> str:
        items = [f'<a href="/{self.word()}">{self.prose(1, 3)}</a>' for _ in range(int(self.rng.integers(2, 9)))]
        return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>" if self.rng.random() < 0.7 else " | ".join(items)

    def short(self) -> str:
        made = self.prose(2, 25)
        return made if self.rng.random() < 0.4 else f"<p>{made}</p>"

    def paragraph(self) -> str:
        made = self.prose(1, 4) if self.rng.random() < 0.1 else self.prose(3, 70)
        style = self.rng.random()
        if style < 0.1:
            return f"<p><b>{made}<br>"
        if style < 0.2:
            return self.within(self.pick(["h2", "h3", "blockquote", "pre", "li"]), self.prose(1, 15))
        return f"<p>{made}</p>"

    def page(self) -> str:
        r = self.rng
        body = [f"<h1>{self.prose(2, 9)}</h1>"] if r.random() < 0.8 else []
        body += [self.paragraph() for _ in range(int(r.integers(1, 14)))]
        if r.random() < 0.15:
            body += [body[-1]] * int(r.integers(1, 20))
        if r.random() < 0.2:
            body.insert(int(r.integers(len(body) + 1)), self.within(self.pick(ADVERT + NOTICE), f"<i>\x02{self.short()}\x03</i>"))
        title = self.prose(2, 9)
        parts = [f"<title>{title}</title>"]

        def extra(share: float, names: list[str], inner) -> list[str]:
            return [self.within(self.pick(names), inner())] if r.random() < share else []

        parts += extra(0.3, NOTICE, self.short) + extra(0.4, HEADER, self.short) + extra(0.8, MENU, self.links) + extra(0.5, ADVERT, self.short) + extra(0.2, ASIDE, self.links)
        parts.append(self.within(self.pick(ARTICLE), "\x02" + "".join(body) + "\x03"))
        parts += extra(0.3, ASIDE, self.links) + extra(0.3, ADVERT, self.short)
        parts += extra(0.3, COMMENTS, lambda: "".join(f"<p>{self.prose(2, 30)}</p>" for _ in range(int(r.integers(1, 5)))))
        parts += extra(0.2, ["form", 'form class="search"'], lambda: f"<label>{self.prose(1, 4)}</label><p>{self.prose(1, 3)}</p>")
        parts += extra(0.8, FOOTER, lambda: f"&copy; {self.short()}")
        return f"<html><head>{parts[0]}</head><body>{''.join(parts[1:])}</body></html>"


def layouts(pages: int, seed: int = 11) -> list[tuple[np.ndarray, np.ndarray]]:
    """Vectors and labels of generated pages. \\x02 and \\x03 enclose the article and, once more, what is foreign inside it."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(pages):
        page = _Layout(rng).page()
        found, labels, depth, at = blocks_of(page.replace("\x02", " \x02 ").replace("\x03", " \x03 ")), [], 0, []
        for block in found:
            raw = block.text
            inside = depth
            for c in raw:
                depth += (c == "\x02") - (c == "\x03")
                inside = max(inside, depth)
            block.text = " ".join(raw.replace("\x02", " ").replace("\x03", " ").split())
            if block.text:
                labels.append(float(inside == 1))
                at.append(block)
        if at:
            out.append((vectors(at), np.array(labels, np.float32)))
    return out


@functools.cache
def trained(pages: int = 700, rounds: int = 14) -> Labeller:
    """The labeller fitted on ``pages`` generated layouts; the same in every run."""
    return fit(layouts(pages), rounds=rounds)


def main_text(docs: DataFrame, page: str = "html", model: Labeller | None = None, threshold: float = 0.5) -> DataFrame:
    """All columns of ``docs`` but the page, then ``text`` and ``n_chars``.

    Null and empty pages, and pages without main text, have an empty text. Blocks are joined in page order by one
    space; every block of the page is read and labelled. Columns named like the results are replaced.
    """
    labeller = model or trained()
    rows = docs.select(packed(docs, page, "text", "n_chars"), F.col(f"`{page}`").cast("string").alias("page"))
    schema = rows.select("own", F.col("page").alias("text")).schema

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                pages = [blocks_of(p or "") for p in part.column("page").to_pylist()]
                scores = labeller.scores([vectors(b) for b in pages])
                texts = [" ".join(b.text for b, s in zip(blocks, found) if s >= threshold) for blocks, found in zip(pages, scores)]
                yield pa.RecordBatch.from_arrays([part.column("own"), pa.array(texts, pa.string())], ["own", "text"])

    found = rows.mapInArrow(batches, schema)
    return found.select(*unpacked(docs, page, "text", "n_chars"), "text", F.char_length("text").cast("long").alias("n_chars"))
