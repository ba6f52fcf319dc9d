"""Main text of web pages: a recurrent labeller over the blocks of a page."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finecast.llm.html_blocks import Block, blocks
from finecast.llm.shared import present
from finecast.llm.tokens import word_numbers

PATH, WORDS, MORE = 192, 48, 6
HIDDEN = 16
#: Pages that the labeller is fitted on: a bounded sample, the smallest by hash of the id.
SAMPLE = 192
#: Characters of a sampled page that the fit reads; extraction always reads whole pages.
FIT_CHARS = 1 << 20
#: Made-up pages in the fit, per page of the sample.
MADE = 3
EPOCHS = 12
SEED = 5
#: Pages that one pass of the network takes together.
TOGETHER = 128

# Names by which pages mark what is, and what is not, the article.
GOOD = "article main content post entry story text articlebody".split()
BAD = (
    "nav menu navbar breadcrumb header masthead footer copyright aside sidebar widget ad ads advert advertisement banner promo sponsor "
    "sponsored cookie cookies consent notice alert popup modal newsletter subscribe form login search comments comment reply discussion "
    "respond related share social pagination tags button select".split()
)
_GOOD, _BAD = frozenset(GOOD), frozenset(BAD)
_STOPS = re.compile(r"[.,;:?!]")


def silver(path: tuple[str, ...]) -> int | None:
    """Label that the names on a path state: 1 in an article, 0 in one of its surroundings, None where none speaks."""
    bad = any(n in _BAD for n in path if n != "header" or "article" not in path)
    if bad or path[:2] == ("html", "head") or path[-1:] == ("title",):
        return 0
    return 1 if any(n in _GOOD for n in path) else None


def vectors(page: list[Block]) -> np.ndarray:
    """One row per block: names on its path, its words hashed, and a few sizes."""
    x = np.zeros((len(page), PATH + WORDS + MORE), np.float32)
    counts = np.array([b.text.encode().split().__len__() for b in page])
    numbers = word_numbers("\n".join(b.text for b in page).encode())
    row = np.repeat(np.arange(len(page)), counts)
    words = np.bincount(row * WORDS + (numbers % np.uint64(WORDS)).astype(np.int64), minlength=len(page) * WORDS).reshape(len(page), WORDS)
    x[:, PATH : PATH + WORDS] = 0.5 * np.sqrt(words / np.maximum(counts, 1)[:, None])
    for i, b in enumerate(page):
        for name in b.path:
            x[i, zlib.crc32(name.encode()) % PATH] = 2.0
        x[i, PATH + WORDS :] = (np.log1p(counts[i]) / 4, b.linked, min(1.0, len(_STOPS.findall(b.text)) / max(1, counts[i])), i / len(page), 1.0 if i == 0 else 0.0, 1.0 if i == len(page) - 1 else 0.0)
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _flip(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each row's first ``size`` steps in reverse order; padding stays at the end."""
    step = np.arange(x.shape[1])
    order = np.where(step < sizes[:, None], sizes[:, None] - 1 - step, step)
    return np.take_along_axis(x, order[:, :, None], axis=1)


def _run(x: np.ndarray, p: dict[str, np.ndarray], side: str, keep: bool = False):
    """Hidden states of one direction, (pages, steps, HIDDEN); with ``keep`` also what the gradient needs."""
    pre = x @ p[f"wx{side}"] + p[f"b{side}"]
    n, steps, _ = pre.shape
    h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    out, trace = np.zeros((n, steps, HIDDEN), np.float32), []
    for t in range(steps):
        z = pre[:, t] + h @ p[f"wh{side}"]
        i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN :])
        before_h, before_c = h, c
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        out[:, t] = h
        if keep:
            trace.append((i, f, o, g, tc, before_h, before_c))
    return (out, trace) if keep else out


def _back(x: np.ndarray, dout: np.ndarray, trace: list, p: dict[str, np.ndarray], side: str, grads: dict[str, np.ndarray]) -> None:
    """Adds the gradient of one direction, back through all steps."""
    n, steps, _ = dout.shape
    dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    dz_all = np.zeros((n, steps, 4 * HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        i, f, o, g, tc, before_h, before_c = trace[t]
        dh = dh + dout[:, t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before_c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        dz_all[:, t] = dz
        grads[f"wh{side}"] += before_h.T @ dz
        dh, dc = dz @ p[f"wh{side}"].T, dc * f
    flat = dz_all.reshape(-1, 4 * HIDDEN)
    grads[f"wx{side}"] += x.reshape(-1, x.shape[2]).T @ flat
    grads[f"b{side}"] += flat.sum(axis=0)


@dataclass(frozen=True)
class Labeller:
    """Weights of a two-way LSTM; their number is fixed."""

    weights: dict[str, np.ndarray]

    def chances(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Chance of every block of every page to be main text, seen with the whole page."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        for at in range(0, len(order), TOGETHER):
            some = order[at : at + TOGETHER]
            x, sizes = _padded([pages[i] for i in some])
            both = np.concatenate([_run(x, self.weights, "f"), _flip(_run(_flip(x, sizes), self.weights, "b"), sizes)], axis=2)
            chance = _sigmoid(both @ self.weights["wo"] + self.weights["bo"])
            for row, i in enumerate(some):
                out[i] = chance[row, : sizes[row]]
        return out


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for p in pages])
    x = np.zeros((len(pages), int(sizes.max()), pages[0].shape[1]), np.float32)
    for i, p in enumerate(pages):
        x[i, : len(p)] = p
    return x, sizes


def train(pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = SEED) -> Labeller:
    """Fit on (vectors, labels) of pages; label -1 leaves a block out.  Back-propagation through time with Adam."""
    rng = np.random.default_rng(seed)
    d = PATH + WORDS + MORE
    p: dict[str, np.ndarray] = {}
    for side in "fb":
        p[f"wx{side}"] = (rng.normal(size=(d, 4 * HIDDEN)) * 0.15).astype(np.float32)
        p[f"wh{side}"] = (rng.normal(size=(HIDDEN, 4 * HIDDEN)) * 0.2).astype(np.float32)
        p[f"b{side}"] = np.zeros(4 * HIDDEN, np.float32)
        p[f"b{side}"][HIDDEN : 2 * HIDDEN] = 1.0
    p["wo"], p["bo"] = (rng.normal(size=2 * HIDDEN) * 0.2).astype(np.float32), np.zeros((), np.float32)
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    pages = [q for q in pages if len(q[1])]
    turn = 0
    for _ in range(epochs if pages else 0):
        # Pages of like length go together, in a new order each time.
        order = sorted(rng.permutation(len(pages)), key=lambda i: len(pages[i][1]))
        for at in rng.permutation(range(0, len(order), 48)):
            some = [pages[i] for i in order[at : at + 48]]
            x, sizes = _padded([s[0] for s in some])
            y = np.full(x.shape[:2], -1.0, np.float32)
            for i, s in enumerate(some):
                y[i, : sizes[i]] = s[1]
            xb = _flip(x, sizes)
            hf, tf = _run(x, p, "f", keep=True)
            hb, tb = _run(xb, p, "b", keep=True)
            both = np.concatenate([hf, _flip(hb, sizes)], axis=2)
            chance = _sigmoid(both @ p["wo"] + p["bo"])
            error = np.where(y >= 0, chance - y, 0).astype(np.float32) / max(1, int((y >= 0).sum()))
            grads = {k: np.zeros_like(v) for k, v in p.items()}
            grads["wo"] = np.einsum("nt,nth->h", error, both)
            grads["bo"] = error.sum()
            dboth = error[:, :, None] * p["wo"]
            _back(x, dboth[:, :, :HIDDEN], tf, p, "f", grads)
            _back(xb, _flip(dboth[:, :, HIDDEN:], sizes), tb, p, "b", grads)
            turn += 1
            for k in p:
                first[k] = 0.9 * first[k] + 0.1 * grads[k]
                second[k] = 0.999 * second[k] + 0.001 * grads[k] ** 2
                p[k] = (p[k] - 0.01 * (first[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.999**turn)) + 1e-8)).astype(np.float32)
    return Labeller(p)


def made_page(texts: list[str], rng: np.random.Generator) -> list[tuple[Block, int]]:
    """A page of known labels: an article under varying names, among menus, notices, adverts, forms and comments.

    The texts of both kinds are the same; names and order tell them apart.
    """
    pick = lambda names: names[rng.integers(len(names))]
    out: list[tuple[Block, int]] = []
    top = ("html", "body") if rng.random() < 0.8 else ()
    words = lambda n: " ".join(pick(texts).split()[:n]) or "x"

    def around() -> None:
        name = pick(BAD)
        inner = pick((("ul", "li", "a"), ("p",), ("div",), (), ("div", "p"), ("ul", "li"), ("form", "label")))
        shape = (name,) if rng.random() < 0.4 else (pick(("div", "section", "ul", "span", "p")), name)
        for _ in range(int(rng.integers(1, 7))):
            long = rng.random() < 0.35
            out.append((Block(words(int(rng.integers(8, 90)) if long else int(rng.integers(1, 8))), top + shape + inner, float("a" in inner)), 0))

    if rng.random() < 0.7:
        out.append((Block(words(8), ("html", "head", "title"), 0.0), 0))
    for _ in range(int(rng.integers(0, 4))):
        around()
    shape = (pick(GOOD),) if rng.random() < 0.5 else (pick(("div", "section", "main", "td")), pick(GOOD))
    if rng.random() < 0.15:
        shape = ()
    body = top + shape
    if rng.random() < 0.8:
        head = ("header", pick(("h1", "h2"))) if "article" in body and rng.random() < 0.3 else (pick(("h1", "h2")),)
        out.append((Block(words(int(rng.integers(2, 12))), body + head, 0.0), 1))
    for _ in range(int(rng.integers(1, 9))):
        inner = pick((("p",), ("p",), ("p", "b"), ("div",), ("ul", "li"), ("blockquote", "p"), ("h2",), ("pre",), ("table", "tr", "td"), ("figure", "figcaption"), ("section", "p")))
        out.append((Block(words(int(rng.integers(1, 200))), body + inner, 0.0), 1))
        if rng.random() < 0.12:
            out.append((Block(words(int(rng.integers(2, 40))), body + (pick(("div", "aside", "form", "section")), pick(BAD)), 0.0), 0))
    for _ in range(int(rng.integers(0, 4))):
        around()
    return out


def fit(pages: DataFrame, html: str = "html", page_id: str = "page_id", sample: int = SAMPLE) -> Labeller:
    """Fit on a bounded sample of ``pages`` by what their own markup says (``silver``), and on pages made up of its texts.

    A hash below a bound that follows from the number of pages selects about
    twice the sample, the smallest ``sample`` hashes of these are taken; so only a
    bounded number of pages leaves the tasks.  An empty table gives a labeller
    too, fitted on made-up pages alone.
    """
    body = present(F.col(html))
    h = F.xxhash64(F.coalesce(F.col(page_id).cast("string"), F.lit("")), F.substring(body, 1, 64))
    bound = min(1.0, 2 * sample / max(1, pages.count()))
    few = pages.where(F.pmod(h, F.lit(1 << 40)) < int(bound * (1 << 40)))
    got = few.select(F.pmod(h, F.lit(1 << 40)).alias("h"), F.substring(body, 1, FIT_CHARS).alias("t")).orderBy("h", "t").limit(sample).collect()
    real = [blocks(r["t"]) for r in got]
    texts = [b.text for page in real for b in page] or ["one two three four five six seven"]
    rng = np.random.default_rng(SEED)
    known = []
    for page in real:
        labels = [silver(b.path) for b in page]
        if 1 in labels:
            known.append((vectors(page), np.array([-1 if y is None else y for y in labels], np.float32)))
    for _ in range(MADE * max(len(real), 64)):
        made = made_page(texts, rng)
        known.append((vectors([b for b, _ in made]), np.array([y for _, y in made], np.float32)))
    return train(known)


def main_texts(pages: list[str], labeller: Labeller) -> list[str]:
    """Main text of each page: its blocks labelled as such, joined by line feeds."""
    found = [blocks(p) for p in pages]
    chances = labeller.chances([vectors(f) if f else np.zeros((0, 1), np.float32) for f in found])
    return ["\n".join(b.text for b, c in zip(f, cs, strict=True) if c >= 0.5) for f, cs in zip(found, chances, strict=True)]


def extract(pages: DataFrame, labeller: Labeller, html: str = "html") -> DataFrame:
    """Every row of ``pages`` with ``text`` (replacing a column of that name).

    Whole pages are read; every block is labelled with the context of its whole
    page.  Null html counts as empty and gives an empty text; repeated rows get
    equal texts; an empty table gives no rows.
    """

    @F.pandas_udf(T.StringType())
    def text(body: pd.Series) -> pd.Series:
        out: list[str] = []
        for at in range(0, len(body), 512):
            out += main_texts(list(body[at : at + 512]), labeller)
        return pd.Series(out, dtype=object)

    return pages.withColumn("text", text(present(F.col(html))))


def html_report(pages: DataFrame) -> DataFrame:
    return extract(pages, fit(pages)).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
