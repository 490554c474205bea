"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into blocks: the text runs between block-level tags, each with the path of its
open elements. Every block is labelled article or boilerplate; the chain's potentials come from
ancestor tags (with the words of their class, id and role) and text features. The model is
trained on labelled pages: ``labelled_pages`` makes them from seeded layouts that vary the usual
ways in which sites mark up articles, menus, sidebars, notices, adverts, forms and comments.
Training maximises the chain's likelihood (forward-backward, Adam); decoding is Viterbi.

Defined cases: NULL or empty html, and pages without article blocks, give empty text; unclosed
and stray tags, truncated pages, comments and raw-text elements follow the usual recovery;
white space in a block becomes one blank, blocks are joined by one blank; nothing is cut off.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML element groups.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp "
                   "small span strike strong sub sup time tt u var wbr img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title template iframe object svg math noscript".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form "
                     "h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SIBLINGS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
            "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
            "option": ("option", ("select",)), "p": ("p", ())}

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"
    r"|<[!?/][^>]*+>"
    r"|<[a-zA-Z/!?][^>]*+\Z", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Block:
    path: tuple[str, ...]  # open elements as "tag" or "tag word word"
    text: str
    linked: int            # characters inside links


def _element(tag: str, attributes: str) -> str:
    if not attributes or attributes.isspace():
        return tag
    words: set[str] = set()
    for name, value in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("hidden", "aria-hidden"):
            if value.strip("\"'").lower() != "false":
                words.add("hidden")
        else:
            words.update(_WORD.findall(_CAMEL.sub(" ", value).lower()))
    return " ".join([tag, *sorted(words)])


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page, in order."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    run: list[str] = []
    linked = 0
    in_link = False
    pos, n = 0, len(page)

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                out.append(Block(tuple(e for _, e in stack), text, linked))
            run.clear()
        linked = 0

    def close(tags: tuple[str, ...] | list[str], fences: tuple[str, ...] = ()) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in tags:
                del stack[k:]
                return
            if stack[k][0] in fences:
                return

    while pos < n:
        m = _TOKEN.search(page, pos)
        text = page[pos:m.start() if m else n]
        if text:
            if "&" in text:
                text = entities.unescape(text)
            run.append(text)
            if in_link:
                linked += len(text)
        if not m:
            break
        pos = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag, end = name.lower(), bool(m[1] or m[4])
        if tag in INLINE:
            if tag == "a":
                in_link = not end
            continue
        if tag == "br":
            run.append(" ")
            continue
        flush()
        in_link = False
        if end:
            close([tag])
        elif tag in RAW:
            if not (m[3] or m[6] or "").endswith("/") or tag in ("script", "style", "title"):
                stop = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>", re.I).search(page, pos)
                pos = stop.end() if stop else n
        elif tag not in VOID:
            if tag in CLOSES_P and any(t == "p" for t, _ in stack[-8:]):
                close(["p"], ("table", "button", "td", "th"))
            if tag in SIBLINGS and tag != "p":
                siblings, fences = SIBLINGS[tag]
                close(siblings.split(), fences)
            if tag not in ("html", "body", "head"):
                stack.append((tag, _element(tag, m[3] or m[6])))
        elif tag in CLOSES_P:
            close(["p"], ("table",))
    flush()
    return out


def path_features(path: tuple[str, ...]) -> list[str]:
    """Features of a block's ancestors: each tag and marking word, the nearest elements."""
    parts = [e.split(" ") for e in path]
    tags = [p[0] for p in parts]
    out = {f"in:{t}" for t in tags} | {f"word:{w}" for p in parts for w in p[1:]}
    out.add(f"tag:{tags[-1] if tags else '-'}")
    out.add(f"tags:{'>'.join(tags[-2:])}")
    out.add(f"depth:{min(len(tags), 6)}")
    out.update(f"last:{w}" for p in parts[-2:] for w in p[1:])
    return sorted(out)


def text_features(block: Block) -> list[str]:
    text = block.text
    size = len(text)
    words = text.count(" ") + 1
    share = block.linked / size
    out = [f"words:{min(words.bit_length(), 8)}", f"links:{min(4, int(share * 5))}",
           f"end:{text[-1] if text[-1] in '.!?:,;|' else 'x'}", f"stops:{min(3, sum(map(text.count, '.!?')))}"]
    if "©" in text:
        out.append("copyright")
    if text[0].isdigit():
        out.append("digit")
    if sum(map(text.count, "|·»›")) > 1 and words < 30:
        out.append("bars")
    return out


@dataclass(frozen=True)
class Model:
    """Label 1 is the article. ``weights``: a feature's log-potential for label 1 against 0."""

    weights: dict[str, float]
    change: tuple[tuple[float, float], tuple[float, float]]
    begin: tuple[float, float]
    end: tuple[float, float]

    def extract(self, page: str | None, memo: dict[tuple[str, ...], float]) -> str:
        found = blocks(page) if page else []
        if not found:
            return ""
        w = self.weights
        scores = []
        for b in found:
            s = memo.get(b.path)
            if s is None:
                if len(memo) > 50_000:
                    memo.clear()
                s = memo[b.path] = sum(w.get(f, 0.0) for f in path_features(b.path))
            for f in text_features(b):
                s += w.get(f, 0.0)
            scores.append(s)
        return " ".join(b.text for b, keep in zip(found, self.viterbi(scores)) if keep)

    def viterbi(self, scores: list[float]) -> list[int]:
        (c00, c01), (c10, c11) = self.change
        a, b = self.begin[0], self.begin[1] + scores[0]
        back = []
        for s in scores[1:]:
            from_a, from_b = a + c00 < b + c10, a + c01 < b + c11
            a, b = (b + c10 if from_a else a + c00), (b + c11 if from_b else a + c01) + s
            back.append((from_a, from_b))
        label = int(a + self.end[0] < b + self.end[1])
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return out[::-1]


def train(pages: list[tuple[list[Block], list[int]]], rounds: int = 120, rate: float = 0.15,
          decay: float = 2e-4) -> Model:
    """Maximise the mean log-likelihood of the label chains, with an L2 penalty."""
    pages = [p for p in pages if p[0]]
    lens = np.array([len(b) for b, _ in pages])
    n, top = len(pages), int(lens.max())
    index: dict[str, int] = {}
    rows, cols = [], []
    for k, (found, _) in enumerate(pages):
        for t, b in enumerate(found):
            for f in path_features(b.path) + text_features(b):
                rows.append(k * top + t)
                cols.append(index.setdefault(f, len(index)))
    rows, cols = np.array(rows), np.array(cols)
    gold = np.zeros((n, top), int)
    for k, (_, labels) in enumerate(pages):
        gold[k, :len(labels)] = labels
    inside = np.arange(top) < lens[:, None]
    last = lens - 1
    every = np.arange(n)
    n_f = len(index)
    theta = np.zeros(n_f + 8)  # weights, change (4), begin (2), end (2)
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    both = inside[:, 1:]
    pair = 2 * gold[:, :-1] + gold[:, 1:]
    seen_pairs = np.array([((pair == x) & both).sum() for x in range(4)], float)
    seen_begin = np.bincount(gold[:, 0], minlength=2).astype(float)
    seen_end = np.bincount(gold[every, last], minlength=2).astype(float)
    for step in range(1, rounds + 1):
        emit = np.zeros((n, top, 2))
        emit[:, :, 1] = np.bincount(rows, theta[:n_f][cols], minlength=n * top).reshape(n, top)
        change = theta[n_f:n_f + 4].reshape(2, 2)
        alpha, beta = np.zeros((n, top, 2)), np.zeros((n, top, 2))
        alpha[:, 0] = theta[n_f + 4:n_f + 6] + emit[:, 0]
        for t in range(1, top):
            alpha[:, t] = np.logaddexp.reduce(alpha[:, t - 1, :, None] + change, axis=1) + emit[:, t]
        for t in range(top - 1, -1, -1):
            ends = last == t
            if t < top - 1:
                beta[:, t] = np.logaddexp.reduce(change + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[ends, t] = theta[n_f + 6:]
        log_z = np.logaddexp.reduce(alpha[every, last] + theta[n_f + 6:], axis=1)
        single = np.exp(alpha + beta - log_z[:, None, None])
        joint = np.exp(alpha[:, :-1, :, None] + change + (emit + beta)[:, 1:, None, :] - log_z[:, None, None, None])
        grad = np.zeros_like(theta)
        wrong = np.where(inside, gold - single[:, :, 1], 0.0).ravel()
        grad[:n_f] = np.bincount(cols, wrong[rows], minlength=n_f)
        grad[n_f:n_f + 4] = seen_pairs - (joint * both[:, :, None, None]).sum((0, 1)).ravel()
        grad[n_f + 4:n_f + 6] = seen_begin - single[:, 0].sum(0)
        grad[n_f + 6:] = seen_end - single[every, last].sum(0)
        grad = grad / n - decay * theta
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad**2
        theta += rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
    c = theta[n_f:].tolist()
    return Model({f: float(theta[k]) for f, k in index.items()}, ((c[0], c[1]), (c[2], c[3])),
                 (c[4], c[5]), (c[6], c[7]))


_GOLD = "\ue000"  # marks a block of the article in a generated page


class _Layout:
    """Draws one labelled page."""

    def __init__(self, rng: random.Random):
        self.r = rng
        self.stems = ["".join(rng.choice("bcdfghklmnprstvz") + rng.choice("aeiouéäñ") for _ in range(rng.randint(1, 4)))
                      for _ in range(120)]

    def words(self, lo: int, hi: int) -> str:
        return " ".join(self.r.choice(self.stems) for _ in range(self.r.randint(lo, hi)))

    def sentences(self, lo: int, hi: int) -> str:
        mark = self.r.choice(["."] * 8 + ["!", "?"])
        return " ".join(self.words(1, 14).capitalize() + mark for _ in range(self.r.randint(lo, hi)))

    def maybe(self, p: float, make) -> str:
        return make() if self.r.random() < p else ""

    def named(self, tags: str, words: str, inner: str, plain: float = 0.0) -> str:
        """An element with one of the tags, marked by one of the words (or not at all)."""
        tag, word = self.r.choice(tags.split()), self.r.choice(words.split())
        if self.r.random() < plain:
            return f"<{tag}>{inner}</{tag}>"
        extra = self.r.choice(["", "", "-box", "-wrap", " widget", "-1", " block"])
        return f'<{tag} {self.r.choice(["class", "class", "id"])}="{word}{extra}">{inner}</{tag}>'

    def links(self, n: int) -> str:
        items = [f'<a href="/{k}">{self.words(1, 4)}</a>' for k in range(n)]
        if self.r.random() < 0.75:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return self.r.choice([" | ", " ", " &middot; "]).join(items)

    def menu(self) -> str:
        inner = self.links(self.r.randint(3, 9))
        return f"<nav>{inner}</nav>" if self.r.random() < 0.6 else self.named(
            "div ul div", "menu nav navbar navigation breadcrumb breadcrumbs tabs topnav", inner)

    def advert(self) -> str:
        return self.named("div div aside section", "ad ads advert advertisement sponsored promo banner sponsor",
                          self.r.choice([self.sentences(1, 2), f"<p>{self.sentences(1, 3)}</p>", self.links(2), self.words(2, 8)]))

    def notice(self) -> str:
        inner = f"<p>{self.sentences(1, 3)}</p>" + self.maybe(0.6, lambda: f"<button>{self.words(1, 2)}</button>")
        return self.named("div div section aside", "cookie cookies notice consent alert gdpr banner popup modal overlay newsletter subscribe", inner)

    def form(self) -> str:
        inner = f"<label>{self.words(1, 3)}</label><input type=text><button>{self.words(1, 2)}</button>"
        inner = self.maybe(0.5, lambda: f"<p>{self.sentences(1, 2)}</p>") + inner
        return f"<form>{inner}</form>" if self.r.random() < 0.8 else self.named("div", "form signup login search newsletter", inner)

    def sidebar(self) -> str:
        parts = [self.r.choice([lambda: f"<h3>{self.words(1, 3)}</h3>" + self.links(4), self.advert,
                                lambda: f"<p>{self.sentences(1, 3)}</p>", self.form])() for _ in range(self.r.randint(1, 3))]
        inner = "".join(parts)
        return f"<aside>{inner}</aside>" if self.r.random() < 0.5 else self.named(
            "div div section", "sidebar side aside related recommended widget rail secondary more popular trending", inner)

    def comments(self) -> str:
        one = lambda: (f'<span class="author">{self.words(1, 2)}</span>' if self.r.random() < 0.5 else "") + f"<p>{self.sentences(1, 4)}</p>"
        items = [self.named("div li article div", "comment reply comment response", one()) for _ in range(self.r.randint(1, 5))]
        title = self.maybe(0.6, lambda: f"<h3>{self.words(1, 3)}</h3>")
        inner = title + "".join(items) + self.maybe(0.3, self.form)
        return self.named("section div div ol", "comments commentlist discussion responses replies disqus", inner)

    def share(self) -> str:
        return self.named("div ul", "share social sharing tags meta byline buttons", self.links(3))

    def footer(self) -> str:
        inner = self.r.choice([f"&copy; {self.words(1, 3)} &middot; {self.sentences(1, 2)}", f"<p>&copy; {self.words(2, 6)}</p>",
                               self.links(5) + f"<p>{self.sentences(1, 2)}</p>", f"<p>{self.sentences(1, 2)}</p>"])
        return f"<footer>{inner}</footer>" if self.r.random() < 0.65 else self.named(
            "div section", "footer bottom colophon copyright legal", inner)

    def header(self) -> str:
        inner = f"<a href=/>{self.words(1, 3)}</a>" + self.maybe(0.5, lambda: f"<p>{self.words(2, 8)}</p>") + self.maybe(
            0.2, lambda: f"<h1>{self.words(1, 3)}</h1>") + self.maybe(0.4, self.menu)
        return f"<header>{inner}</header>" if self.r.random() < 0.6 else self.named(
            "div", "header masthead top topbar logo site-header branding", inner)

    def body(self) -> str:
        """The article's blocks, some with unclosed tags, and what stands in between."""
        parts = [self.maybe(0.85, lambda: f"<h1>{_GOLD}{self.words(2, 12)}</h1>")]
        for _ in range(self.r.randint(1, 12)):
            kind = self.r.random()
            if kind < 0.62:
                text = self.sentences(1, 9) if self.r.random() < 0.8 else self.words(1, 3).capitalize() + "."
                if self.r.random() < 0.1:
                    text = " | ".join(self.words(1, 2) for _ in range(self.r.randint(2, 20)))
                if self.r.random() < 0.2:
                    text = text.replace(" ", f' <a href="/x">{self.words(1, 2)}</a> ', 1)
                parts.append(self.r.choice([f"<p>{_GOLD}{text}</p>"] * 4 + [f"<p><b>{_GOLD}{text}<br>", f"<p>{_GOLD}{text}",
                                                                      f"<div>{_GOLD}{text}</div>"]))
            elif kind < 0.70:
                parts.append(f"<h2>{_GOLD}{self.words(1, 6)}</h2>")
            elif kind < 0.78:
                parts.append("<ul>" + "".join(f"<li>{_GOLD}{self.words(1, 12)}</li>" for _ in range(self.r.randint(2, 5))) + "</ul>")
            elif kind < 0.83:
                parts.append(f"<blockquote><p>{_GOLD}{self.sentences(1, 2)}</p></blockquote>")
            elif kind < 0.86:
                parts.append(f"<pre>{_GOLD}{self.words(3, 20)}</pre>")
            elif kind < 0.89:
                cells = "".join(f"<td>{_GOLD}{self.words(1, 3)}</td>" for _ in range(3))
                parts.append(f"<table><tr>{cells}</tr><tr>{cells}</tr></table>")
            else:
                parts.append(self.r.choice([self.advert, self.advert, self.share, self.notice, self.sidebar, self.form])())
        return "".join(parts)

    def article(self) -> str:
        inner = self.body()
        kind = self.r.random()
        if kind < 0.5:
            inner = f"<article>{inner}{self.maybe(0.12, self.comments)}</article>"
            return f"<main>{inner}</main>" if self.r.random() < 0.3 else inner
        if kind < 0.65:
            return f"<main>{inner}</main>"
        inner = self.named("div div section", "content article post entry story body text main post-content entry-content", inner, 0.15)
        return self.named("div", "container wrapper page layout site", inner) if self.r.random() < 0.4 else inner

    def page(self) -> str:
        r = self.r
        before = [self.maybe(0.5, self.header), self.maybe(0.75, self.menu), self.maybe(0.25, self.notice), self.maybe(0.4, self.advert)]
        after = [self.maybe(0.3, self.share), self.maybe(0.35, self.comments), self.maybe(0.4, self.sidebar), self.maybe(0.25, self.advert),
                 self.maybe(0.2, self.form), self.maybe(0.15, self.notice), self.maybe(0.85, self.footer)]
        if r.random() < 0.3:
            before.append(self.sidebar())
        inner = "".join(before) + self.article() + "".join(after)
        page = f"<!DOCTYPE html><html><head><title>{self.words(2, 8)}</title></head><body>{inner}</body></html>"
        return page[:-len("</body></html>")] if r.random() < 0.1 else page


def labelled_pages(n: int, seed: int) -> list[tuple[list[Block], list[int]]]:
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        found = blocks(_Layout(rng).page())
        labels = [int(_GOLD in b.text) for b in found]
        for b in found:
            b.text = " ".join(b.text.replace(_GOLD, " ").split())
        keep = [k for k, b in enumerate(found) if b.text]
        out.append(([found[k] for k in keep], [labels[k] for k in keep]))
    return out


def extract(pages: DataFrame, train_pages: int = 400, seed: int = 4, html_col: str = "html",
            model: Model | None = None) -> DataFrame:
    """All columns but the html, plus ``text`` and ``n_chars`` (code points), which replace
    columns of these names. ``train_pages`` bounds the labelled pages. No shuffle."""
    model = model or train(labelled_pages(train_pages, seed))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo: dict[tuple[str, ...], float] = {}
        for batch in batches:
            yield pd.Series([model.extract(page, memo) for page in batch], dtype=object)

    udf = F.pandas_udf(run, "string")
    out = pages.withColumn("_text", udf(F.col(html_col))).drop("text", "n_chars", html_col)
    return (out.withColumnRenamed("_text", "text")
            .withColumn("n_chars", F.length("text").cast("long")))
