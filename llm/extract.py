"""Main-text extraction by a recurrent block labeller.

A page is cut into leaf blocks: the text between block-level tags, each with its tag path (names, classes, ids and
roles of the open elements) and its words.  Path parts and words are hashed to vectors; a bidirectional LSTM in numpy
reads the blocks of the whole page in order, both ways, and labels each block as main text or not.  Scripts, styles,
templates and comments are no text; character references are decoded; white space in a block becomes one space.

The labeller is trained on at most ``FIT_PAGES`` pages of the corpus, chosen by a hash of the page.  Its teacher is
the markup: text of an article or main element is main text unless it lies in navigation, asides, forms, headers,
footers, notices, adverts or comments.  As a corpus may lack some of these, each training page also gets such blocks,
built from the words of other pages.  Every page is then extracted whole.  A null or empty page gives an empty text;
equal pages give equal texts; with no page at all nothing is trained.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import widened

FIT_PAGES = 300
PATH_SIZE, WORD_SIZE, HIDDEN = 256, 64, 16

# HTML's own vocabulary.
RAW = "script|style|noscript|template|iframe|textarea|title"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i img ins kbd label mark q s samp small span strong sub sup time tt u var wbr".split())
BOILERPLATE = frozenset("nav aside header footer form button menu dialog head svg select object".split())
CLOSED_BY = {"p": "p", "li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
ENDS_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
NOISE_WORDS = frozenset("ad ads advert advertisement banner sponsored promo comment comments reply replies discussion sidebar widget related menu nav navbar breadcrumb breadcrumbs footer header masthead cookie consent notice popup modal newsletter subscribe share social login signup search pagination pager copyright disclaimer".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|<[!?/][^>]*>",
    re.S | re.I,
)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class Block:
    path: tuple[str, ...]  # parts of the open elements, outermost first
    text: str


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks of a page in order.  Unclosed and stray tags are taken as browsers do, roughly."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    held: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        if text:
            out.append(Block(tuple(p for _, ps in stack for p in ps), text))
        held.clear()

    page, at = page or "", 0
    for m in _TOKEN.finditer(page):
        held.append(page[at : m.start()])
        at = m.end()
        close, name, attrs = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])  # the second form has a stray quote
        if name is None:
            continue
        name = name.lower()
        if name in INLINE:
            continue
        if name in VOID:
            if name == "br":
                held.append(" ")
            elif name == "hr":
                flush()
            continue
        flush()
        if close:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            continue
        shut = set(CLOSED_BY.get(name, "").split()) | ({"p"} if name in ENDS_P else set())
        if stack and stack[-1][0] in shut:
            stack.pop()
        parts = [name]
        for a in _ATTR.finditer(attrs or ""):
            value = (a[2] or a[3] or a[4] or "").lower()
            parts += [f".{p}" for p in _PART.findall(value)]
        stack.append((name, tuple(parts)))
    held.append(page[at:])
    flush()
    return out


def taught(path: tuple[str, ...]) -> bool:
    """The teacher's label of a block."""
    main = "article" in path or "main" in path
    noise = any(p in BOILERPLATE or p.removeprefix(".") in NOISE_WORDS and p.startswith(".") for p in path)
    return main and not noise


def _slot(s: str, size: int) -> int:
    return zlib.crc32(s.encode("utf-8", "surrogatepass")) % size


class Hasher:
    """Hashed vectors of blocks; the slots of paths and words seen before are kept."""

    def __init__(self):
        self.paths: dict[tuple[str, ...], np.ndarray] = {}
        self.words: dict[str, int] = {}

    def path(self, path: tuple[str, ...]) -> np.ndarray:
        got = self.paths.get(path)
        if got is None:
            got = np.zeros(PATH_SIZE, np.float32)
            for p in set(path):
                got[_slot(p, PATH_SIZE)] = 1
            for a, b in zip(path[-3:], path[-2:], strict=False):
                got[_slot(f"{a}>{b}", PATH_SIZE)] += 0.5
            if len(self.paths) < 100_000:
                self.paths[path] = got
        return got

    def vectors(self, bs: list[Block]) -> np.ndarray:
        out = np.zeros((len(bs), PATH_SIZE + WORD_SIZE + 3), np.float32)
        if len(self.words) > 500_000:
            self.words.clear()
        known = self.words
        for i, b in enumerate(bs):
            out[i, :PATH_SIZE] = self.path(b.path)
            words = b.text.split()
            slots = []
            for w in words:
                s = known.get(w)
                if s is None:
                    s = known[w] = _slot(w, WORD_SIZE)
                slots.append(s)
            out[i, PATH_SIZE : PATH_SIZE + WORD_SIZE] = np.bincount(slots, minlength=WORD_SIZE) / np.sqrt(len(words))
            out[i, -3:] = np.log1p(len(words)) / 5, np.log1p(len(b.text)) / 8, float(b.text[-1] in ".!?")
        return out


# ---------------------------------------------------------------- the network


def _sig(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """One LSTM each way over the blocks of a page, and a logistic output on both states."""

    def __init__(self, seed: int = 0, size: int = PATH_SIZE + WORD_SIZE + 3, hidden: int = HIDDEN):
        r = np.random.default_rng(seed)
        self.h = hidden
        self.p = {"o": r.normal(0, 0.1, 2 * hidden), "ob": np.zeros(1)}
        for d in "fb":
            self.p[f"{d}x"] = r.normal(0, 0.1, (size, 4 * hidden))
            self.p[f"{d}h"] = r.normal(0, 0.1, (hidden, 4 * hidden))
            self.p[f"{d}b"] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])

    @staticmethod
    def _places(lens: np.ndarray, backwards: bool) -> tuple[np.ndarray, np.ndarray]:
        """Row of the k-th block read of each page, step after step; pages come longest first, so step k reads the first ones."""
        starts = np.cumsum(lens) - lens
        active = (lens[None, :] > np.arange(lens[0])[:, None]).sum(1)
        step = np.repeat(np.arange(lens[0]), active)
        page = np.arange(len(step)) - np.repeat(np.cumsum(active) - active, active)
        return (starts[page] + (lens[page] - 1 - step if backwards else step)), active

    def _run(self, d: str, x: np.ndarray, lens: np.ndarray):
        """States of all blocks (rows as in ``x``), and what the backward pass needs."""
        rows, active = self._places(lens, d == "b")
        z_all = x @ self.p[f"{d}x"] + self.p[f"{d}b"]
        w, n = self.p[f"{d}h"], self.h
        h, c, states, kept, at = np.zeros((len(lens), n)), np.zeros((len(lens), n)), np.zeros((len(x), n)), [], 0
        for m in active.tolist():
            r = rows[at : at + m]
            at += m
            before_h, before_c = h[:m], c[:m]
            z = z_all[r] + before_h @ w
            gates, g = _sig(z[:, : 3 * n]), np.tanh(z[:, 3 * n :])
            i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
            c = f * before_c + i * g
            t = np.tanh(c)
            h = o * t
            states[r] = h
            kept.append((r, before_h, before_c, i, f, o, g, t))
        return states, kept

    def logits(self, x: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Of every block of some pages, given longest page first; ``x`` holds their vectors page after page."""
        f, b = self._run("f", x, lens)[0], self._run("b", x, lens)[0]
        return np.concatenate([f, b], 1) @ self.p["o"] + self.p["ob"]

    def gradients(self, x: np.ndarray, lens: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        n = self.h
        runs = {d: self._run(d, x, lens) for d in "fb"}
        both = np.concatenate([runs["f"][0], runs["b"][0]], 1)
        p = _sig(both @ self.p["o"] + self.p["ob"])
        e = (p - y) / len(y)
        grad = {"o": both.T @ e, "ob": np.array([e.sum()])}
        up = e[:, None] * self.p["o"]
        for d, part in (("f", up[:, :n]), ("b", up[:, n:])):
            w, dz_all = self.p[f"{d}h"], np.zeros((len(x), 4 * n))
            gh, dh, dc = np.zeros_like(w), np.zeros((len(lens), n)), np.zeros((len(lens), n))
            for r, before_h, before_c, i, f, o, g, t in reversed(runs[d][1]):
                m = len(r)
                whole = part[r] + dh[:m]
                cell = dc[:m] + whole * o * (1 - t * t)
                dz = np.concatenate([cell * g * i * (1 - i), cell * before_c * f * (1 - f), whole * t * o * (1 - o), cell * i * (1 - g * g)], 1)
                dz_all[r] = dz
                gh += before_h.T @ dz
                dh[:m], dc[:m] = dz @ w.T, cell * f
            grad |= {f"{d}x": x.T @ dz_all, f"{d}h": gh, f"{d}b": dz_all.sum(0)}
        loss = -np.mean(y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12))
        return float(loss), grad

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 12, batch: int = 24, rate: float = 0.01, seed: int = 0) -> float:
        """Adam over shuffled batches of (vectors, labels); the mean loss of the last epoch."""
        r, m, v, k, losses = np.random.default_rng(seed), {}, {}, 0, [0.0]
        for _ in range(epochs):
            order, losses = r.permutation(len(pages)), []
            for at in range(0, len(order), batch):
                part = sorted((pages[i] for i in order[at : at + batch]), key=lambda p: -len(p[1]))
                loss, grad = self.gradients(np.concatenate([x for x, _ in part]), np.array([len(y) for _, y in part]), np.concatenate([y for _, y in part]))
                losses.append(loss)
                k += 1
                for name, g in grad.items():
                    m[name] = 0.9 * m.get(name, 0) + 0.1 * g
                    v[name] = 0.999 * v.get(name, 0) + 0.001 * g * g
                    self.p[name] -= rate * (m[name] / (1 - 0.9**k)) / (np.sqrt(v[name] / (1 - 0.999**k)) + 1e-8)
        return float(np.mean(losses))


# ---------------------------------------------------------------- training pages and use

# Paths of blocks that a corpus may lack, below the body.
EXTRA_NOISE = tuple(tuple(x.split()) for x in (
    "nav ul li", "nav .navbar ul li", "header", "header div .masthead", "header p", "div .header", "div .menu ul li", "aside", "aside p", "aside .sidebar ul li",
    "div .sidebar p", "div .widget p", "section .related ul li", "form", "form p", "form label", "div .newsletter form p", "div .subscribe p",
    "div .cookie .notice p", "div .notice", "p .notice", "div .consent p", "div .banner", "div .popup p", "div .modal p", "div .ad", "div .ads p", "div .advert p",
    "div .sponsored p", "section .comments div .comment p", "div .comments p", "ol .comment .list li .comment p", "section .comments h2", "div .reply p",
    "div .discussion p", "footer", "footer p", "footer ul li", "div .footer p", "div .copyright", "div .share ul li", "div .social", "div .pagination", "div .breadcrumb",
    "dialog p", "button", "table .menu tr td", "ul .menu li", "div .login form p", "div .search form",
))
EXTRA_TEXT = tuple(tuple(x.split()) for x in (
    "article p", "article h2", "article h3", "article section p", "article ul li", "article ol li", "article blockquote p", "article pre", "article table tr td",
    "article div p", "main p", "main h1", "main article p", "main section p", "main div p", "article figure figcaption", "article dl dd", "article div", "article",
))


def lesson(page: str | None, words: list[str], r: np.random.Generator) -> list[Block]:
    """The blocks of a page with foreign ones between them; some stand inside the article, as adverts and notices do."""
    own = blocks(page)
    out: list[Block] = []

    def some(paths, prefix):
        n = int(r.integers(1, 40))
        at = int(r.integers(0, max(1, len(words) - n)))
        return Block(prefix + paths[int(r.integers(len(paths)))], " ".join(words[at : at + n]) or "x")

    for b in own:
        while r.random() < 0.15:
            inside = ("html", "body", "article") if r.random() < 0.4 else ("html", "body")
            out.append(some(EXTRA_NOISE, inside))
        if taught(b.path) and r.random() < 0.3:
            b = Block(("html", "body", *EXTRA_TEXT[int(r.integers(len(EXTRA_TEXT)))]), b.text)
        out.append(b)
    while r.random() < 0.8:
        out.append(some(EXTRA_NOISE, ("html", "body")))
    return out


def fit(pages: DataFrame, limit: int = FIT_PAGES, seed: int = 0) -> Labeller | None:
    """Train on the pages (url, html) whose hashes are lowest; None without a page."""
    rows = pages.select("html").where("html is not null")
    u = F.pmod(F.xxhash64(F.lit(seed), F.col("html")), F.lit(1 << 40))
    low = rows.where(u < min(1.0, 2 * limit / max(rows.count(), 1)) * float(1 << 40))  # so that no task sends all its pages
    got = [r[0] for r in low.orderBy(u, "html").limit(limit).collect()]
    if not got:
        return None
    r, hasher, lessons = np.random.default_rng(seed), Hasher(), []
    words = [b.text.split() for p in got for b in blocks(p)]
    words = [w for ws in words for w in ws[:50]]
    for i, page in enumerate(got):
        for bs in (blocks(page), lesson(page, words[(i * 97) % max(1, len(words)) :][:2000] or words, r)):
            if bs:
                lessons.append((hasher.vectors(bs).astype(float), np.array([taught(b.path) for b in bs], float)))
    if not lessons:
        return None
    model = Labeller(seed)
    model.train(lessons, seed=seed)
    return model


def main_texts(pages: list[str | None], model: Labeller, hasher: Hasher) -> list[str]:
    """The main text of each page: its blocks labelled as such, one to a line."""
    found = [blocks(p) for p in pages]
    order = sorted((i for i, bs in enumerate(found) if bs), key=lambda i: -len(found[i]))
    out = [""] * len(pages)
    if not order:
        return out
    lens = np.array([len(found[i]) for i in order])
    z = model.logits(hasher.vectors([b for i in order for b in found[i]]), lens)
    at = 0
    for i, n in zip(order, lens.tolist(), strict=True):
        out[i] = "\n".join(b.text for b, v in zip(found[i], z[at : at + n], strict=True) if v > 0)
        at += n
    return out


def extracted(pages: DataFrame, model: Labeller | None, step: int = 128) -> DataFrame:
    """The pages with ``text``; a column of that name is replaced."""
    pages = pages.drop("text")
    if model is None:
        return pages.withColumn("text", F.lit(""))
    sent = pages.sparkSession.sparkContext.broadcast(model)
    at = pages.columns.index("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for k in range(0, batch.num_rows, step):
                b = batch.slice(k, step)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(main_texts(b.column(at).to_pylist(), sent.value, hasher), pa.string())], [*b.schema.names, "text"])

    return pages.mapInArrow(run, widened(pages, "text string"))
