"""Main text of web pages: boosted trees over DOM-node features, decoded so that no choice contradicts one above it."""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from html import escape

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.llm.dom import HINTS, Node, blocks, features, read

#: Marks main text in training pages; a private-use character.
MARK = "\ue000"


@dataclass(frozen=True)
class Settings:
    """``sample_pages`` bounds the pages a fit reads, the first in hash order; every page is extracted."""

    sample_pages: int = 300
    variants: int = 4
    trees: int = 60
    depth: int = 4
    bins: int = 32
    rate: float = 0.2
    seed: int = 3


@dataclass(frozen=True)
class Boosted:
    """Complete trees of one depth: the feature and threshold of each inner node, and leaf values."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    start: float

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Log odds that a node is main text."""
        out = np.full(len(x), self.start)
        depth = int(math.log2(self.value.shape[1]))
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += v[at - (len(v) - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, settings: Settings) -> Boosted:
    """Gradient boosting of the logistic loss over binned features; ties go to the first feature and bin."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, settings.bins)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)], 1)
    share = np.clip((weight @ y) / weight.sum(), 0.01, 0.99)
    odds = np.full(len(y), math.log(share / (1 - share)))
    inner, leaves, bins = 2**settings.depth - 1, 2**settings.depth, settings.bins
    model = Boosted(np.zeros((settings.trees, inner), np.int64), np.full((settings.trees, inner), np.inf), np.zeros((settings.trees, leaves)), float(odds[0]))
    for t in range(settings.trees):
        p = 1 / (1 + np.exp(-odds))
        g, h = weight * (p - y), weight * p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(settings.depth):
            first, width = 2**level - 1, 2**level
            best = np.zeros(width)
            for f, cut in enumerate(cuts):
                if not len(cut):
                    continue
                place = (at - first) * bins + binned[:, f]
                gl = np.bincount(place, g, width * bins).reshape(width, bins).cumsum(1)
                hl = np.bincount(place, h, width * bins).reshape(width, bins).cumsum(1)
                gr, hr = gl[:, -1:] - gl, hl[:, -1:] - hl
                gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - gl[:, -1:] ** 2 / (hl[:, -1:] + 1)
                gain[:, len(cut) :] = 0
                gain[(hl < 1) | (hr < 1)] = 0
                k = gain.argmax(1)
                top = gain[np.arange(width), k]
                better = top > best + 1e-9
                best[better] = top[better]
                model.feature[t, first : first + width][better] = f
                model.threshold[t, first : first + width][better] = cut[k[better]]
            at = 2 * at + 1 + (x[np.arange(len(y)), model.feature[t, at]] > model.threshold[t, at])
        leaf = at - inner
        value = -settings.rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + 1)
        model.value[t] = value
        odds += value[leaf]
    return model


#: Weights of the steps to a child: main text goes on, main text is interrupted, a mixed node holds anything.
KEPT, BROKEN, OPEN = 0.0, math.log(1 / 9), math.log(2 / 3)

_AVOID = sum(1 << k for k, name in enumerate(HINTS) if name != "main")


def _own_labels(nodes: list[Node]) -> list[str]:
    """Pieces of main text by the page's own markup: inside article or main, outside what is named otherwise."""
    inside, found = [False] * len(nodes), []
    for i, x in enumerate(nodes):
        named = x.tag in ("nav", "header", "footer", "aside", "form") or x.hints & _AVOID
        inside[i] = (x.tag in ("article", "main") or (i > 0 and inside[x.parent])) and not named
        if inside[i]:
            found += [p for p in x.text if isinstance(p, str) and p.strip()]
    return found


def _variant(texts: list[str], rng: np.random.Generator) -> str:
    """The same main text in another layout, with menus, notices and the like made of the page's words."""
    words = " ".join(texts).split() or ["text"]
    pick = lambda *options: options[int(rng.integers(len(options)))]
    some = lambda low, high: escape(" ".join(pick(*words[:500]) for _ in range(int(rng.integers(low, high)))))
    name = lambda *options: pick("", "", ' class="x%d"' % rng.integers(99), *(f' {pick("class", "id")}="{o}"' for o in options * 2))
    link = lambda: f'<a href="/{rng.integers(999)}">{some(1, 4)}</a>'

    def listed(tag: str, attributes: str) -> str:
        return f"<{tag}{attributes}><ul>" + "".join(f"<li>{link()}</li>" for _ in range(int(rng.integers(2, 9)))) + f"</ul></{tag}>"

    def prose(tag: str, attributes: str, low: int, high: int) -> str:
        return f"<{tag}{attributes}>" + "".join(f"<p>{some(low, high)}.</p>" for _ in range(int(rng.integers(1, 4)))) + f"</{tag}>"

    def comments() -> str:
        kind = pick("comments", "comment-list", "replies", "discussion", "reader-comments")
        each = "".join(prose(pick("div", "li", "article"), f' class="{pick("comment", "reply", "comment-body")}"', 5, 60) for _ in range(int(rng.integers(1, 6))))
        return f'<{pick("div", "section")} {pick("class", "id")}="{kind}"><h3>{some(1, 3)}</h3>{each}</{pick("div", "section")}>'.replace("</section>", "</div>") if rng.random() < 0.5 else f'<div id="{kind}">{each}</div>'

    ads = lambda: prose("div", f' class="{pick("ad", "ads", "advert", "banner ad", "sponsored", "promo-box")}"', 3, 30)
    notice = lambda: prose(pick("div", "section", "aside"), f' class="{pick("cookie-notice", "notice", "consent-banner", "newsletter", "alert", "gdpr")}"', 5, 40)
    form = lambda: f"<form{name('search', 'login')}><label>{some(1, 4)}</label><input><button>{some(1, 3)}</button></form>"
    menu = lambda: listed(pick("nav", "nav", "div"), name("menu", "navbar", "nav", "breadcrumb"))
    side = lambda: pick(listed, lambda t, a: prose(t, a, 3, 40))(pick("aside", "aside", "div"), f' class="{pick("sidebar", "side", "related", "widget", "recommended")}"')
    foot = lambda: f"<{(t := pick('footer', 'footer', 'div'))}{' class=footer' if t == 'div' else name('footer')}>&copy; {some(2, 12)} {link()}</{t}>"
    head = lambda: f"<header{name('header', 'masthead')}>{pick(link(), '<h2>' + some(1, 4) + '</h2>', '<p>' + some(3, 9) + '</p>')}</header>"

    body = []
    for k, text in enumerate(texts):
        tag = "h1" if k == 0 and len(text) < 120 else pick("p", "p", "p", "p", "p", "div", "h2" if len(text) < 80 else "p", "blockquote" if rng.random() < 0.2 else "p")
        body.append(f"<{tag}>{MARK}{escape(text)}</{tag}>")
        if rng.random() < 0.06:
            body.append(pick(ads, side, form, notice)())
    tag, attributes = pick(("article", name("post", "entry")), ("article", ""), ("main", name("main")), ("div", ' class="content"'), ("div", ' id="main-content"'), ("div", ' class="post-body entry"'), ("section", ' class="story"'), ("div", ' class="article-text"'), ("div", name("page")))
    main = f"<{tag}{attributes}>{''.join(body)}{comments() if rng.random() < 0.15 else ''}</{tag}>"
    before = [f() for f in (head, menu, ads, notice, side, form) if rng.random() < 0.45]
    after = [f() for f in (comments, side, ads, form, notice, foot, menu) if rng.random() < 0.45]
    parts = [before[k] for k in rng.permutation(len(before))] + [main] + [after[k] for k in rng.permutation(len(after))]
    inner = "".join(parts)
    return f"<html><head><title>{some(2, 9)}</title></head><body>{pick(inner, f'<div class={pick('wrapper', 'container')}>{inner}</div>')}</body></html>"


def _other_texts(texts: list[str], rng: np.random.Generator) -> list[str]:
    """Paragraphs of other numbers and lengths from the page's words, so that no page length stands for main text."""
    words = " ".join(texts).split()
    longest = int(rng.integers(12, 120))
    out = []
    for _ in range(int(rng.integers(1, 12))):
        n, at = int(rng.integers(5, longest)), int(rng.integers(len(words)))
        own = [w if rng.random() < 0.9 else w + rng.choice([",", "."]) for w in (words[at:] + words)[:n]]
        out.append(" ".join(own))
    return out


def _rows(page: str, nodes: list[Node], marked) -> tuple[list[list[float]], list[int], list[float]]:
    main = [sum(len(p) for p in x.text if isinstance(p, str) and marked(i, p)) for i, x in enumerate(nodes)]
    all_ = [sum(len(p) for p in x.text if isinstance(p, str)) for x in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        main[nodes[i].parent] += main[i]
        all_[nodes[i].parent] += all_[i]
    return features(nodes, len(page)), [int(2 * m >= a and m > 0) for m, a in zip(main, all_)], [math.log1p(a) for a in all_]


def train(pages: list[str], settings: Settings) -> Boosted:
    """Fit on pages that mark their own main text, as they are and in ``variants`` other layouts each, half of them
    with paragraphs of other lengths.

    Without such a page, made-up words stand in, so that a model of layouts is always there.
    """
    rng = np.random.default_rng(settings.seed)
    x, y, w = [], [], []
    sources = []
    for page in pages:
        nodes = read(page)
        texts = _own_labels(nodes)
        if not texts:
            continue
        own = set(map(id, texts))
        rows, marks, weights = _rows(page, nodes, lambda i, p, own=own: id(p) in own)
        # a page as it is counts as much as all its variants
        x += rows
        y += marks
        w += [settings.variants * v for v in weights]
        sources.append([" ".join(t.split()) for t in texts])
    sources = sources or [[" ".join(f"word{rng.integers(999)}" for _ in range(int(rng.integers(5, 60)))) + "." for _ in range(int(rng.integers(2, 12)))] for _ in range(40)]
    for texts in sources:
        for k in range(settings.variants):
            page = _variant(texts if k % 2 else _other_texts(texts, rng), rng)
            nodes = read(page)
            for part, out in zip(_rows(page, nodes, lambda i, p: MARK in p), (x, y, w)):
                out += part
    return boost(np.array(x), np.array(y, float), np.array(w) + 0.1, settings)


def fit(pages: DataFrame, settings: Settings = Settings()) -> Boosted:
    ids = pages.where("html is not null").select(F.xxhash64("html").alias("h"), F.length("html").alias("n")).orderBy("h").limit(settings.sample_pages).select("h").distinct()
    sample = pages.select("html").withColumn("h", F.xxhash64("html")).join(F.broadcast(ids), "h").dropDuplicates(["h"])  # at most sample_pages

    def once(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"model": [pickle.dumps(train(group.sort_values("h")["html"].tolist(), settings))]})

    got = sample.groupBy(F.lit(0).alias("all")).applyInPandas(once, "model binary").collect()
    return pickle.loads(got[0]["model"]) if got else train([], settings)


def decode(nodes: list[Node], odds: np.ndarray) -> list[bool]:
    """Which nodes are main text: the best consistent choice of main, rest or mixed for every node.

    Below a node of the rest everything is rest; below a main node a child is main or rest; only a mixed node, whose
    own text is left out, may hold main nodes besides. The sum of the nodes' log probabilities and of the
    weights of the steps from parent to child decides.
    """
    yes = -np.logaddexp(0, -odds)
    no = -np.logaddexp(0, odds)
    mixed = math.log(0.5)
    n = len(nodes)
    as_main, as_rest, as_mixed = list(map(float, yes)), list(map(float, no)), [mixed] * n
    for i in range(n - 1, 0, -1):
        p = nodes[i].parent
        as_main[p] += max(as_main[i] + KEPT, as_rest[i] + BROKEN)
        as_rest[p] += as_rest[i]
        as_mixed[p] += max(as_main[i], as_rest[i], as_mixed[i]) + OPEN
    state = ["mixed"] * n
    for i, x in enumerate(nodes):
        above = state[x.parent] if i else "mixed"
        if above == "rest":
            state[i] = "rest"
        elif above == "main":
            state[i] = "main" if as_main[i] + KEPT >= as_rest[i] + BROKEN else "rest"
        else:
            top = max(as_main[i], as_rest[i], as_mixed[i])
            state[i] = "main" if top == as_main[i] else "mixed" if top == as_mixed[i] else "rest"
    return [s == "main" for s in state]


def extract(pages: list[str], model: Boosted) -> list[str]:
    trees = [read(p) for p in pages]
    rows = [features(t, len(p)) for t, p in zip(trees, pages)]
    odds = model.odds(np.array([r for page in rows for r in page]))
    out, at = [], 0
    for t in trees:
        out.append(blocks(t, decode(t, odds[at : at + len(t)])))
        at += len(t)
    return out


def main_text(pages: DataFrame, model: Boosted) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every page from its whole html; null or empty html gives an empty text."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = extract([h or "" for h in part.column(2).to_pylist()], shared.value)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op3_html_extraction(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return main_text(pages, fit(pages))
