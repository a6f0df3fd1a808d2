"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM."""

from __future__ import annotations

import bisect
import functools
import html
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelight.llm.common import table

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
UNQUOTED = re.compile(r"[^>\"']*")
NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
#: Elements whose content is no text of the page, read up to their end tag; elements that never have content; blocks.
RAW = frozenset(("script", "style", "template", "noscript", "title", "textarea", "iframe", "svg", "select", "noframes", "xmp"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
BLOCK = frozenset(("address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "label", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"))
#: A start tag ends open elements of these names, up to a border.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"), "body": ("head",)}
BORDER = frozenset(("ul", "ol", "dl", "table", "menu"))
#: Open elements at most: deeper ones leave no trace but the end of a block, as in browsers, so a page takes linear time.
DEPTH = 512


@dataclass
class Block:
    """A leaf block: its text with white space folded; the kinds of open elements outside in and the innermost again;
    their class, id and role words."""

    text: str
    path: tuple[str, ...]
    names: tuple[str, ...]
    link_share: float


def tags_of(source: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """(start, end, closing, name, attributes) of every tag in one forward pass; comments and the like have no name.

    A quote counts after an equals sign. Where a quoted value has no end, tags from there on end at their first >.
    """
    at, quotes = 0, True
    while (start := source.find("<", at)) >= 0:
        sign = source[start + 1 : start + 2]
        if source.startswith("<!--", start) or source.startswith("<![CDATA[", start):
            ending = "-->" if source.startswith("<!--", start) else "]]>"
            end = source.find(ending, start + 2)
            at = len(source) if end < 0 else end + 3
            yield start, at, False, "", ""
            continue
        name = None if sign in ("!", "?") else NAME.match(source, start + 1 + (sign == "/"))
        if name is None and sign not in ("!", "?"):
            at = start + 1
            continue
        end = begin = name.end() if name else start
        while quotes and name:
            end = UNQUOTED.match(source, end).end()
            if end == len(source):
                quotes = False
            elif source[end] == ">":
                break
            else:
                before = end - 1
                while source[before].isspace():
                    before -= 1
                close = source.find(source[end], end + 1) if source[before] == "=" else end
                quotes = close >= 0
                end = close + 1
        if not quotes or not name:
            end = source.find(">", begin)
            if end < 0:  # no tag can follow, but a comment may
                start = source.find("<!--", start)
                if start >= 0:
                    yield start, len(source), False, "", ""
                return
        at = end + 1
        yield start, at, sign == "/", name[0].lower() if name else "", source[begin:end]


@functools.cache
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.IGNORECASE)


def blocks_of(source: str | None) -> list[Block]:
    """The blocks that hold text, in page order. Comments and raw elements hold none."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    places: dict[str, list[int]] = defaultdict(list)  # of the open elements of a name
    blocks: list[int] = []
    borders: list[int] = []
    parts: list[str] = []
    linked, place = 0, None

    def flush() -> None:
        nonlocal linked, place
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                if place is None:
                    path = [n for n, _ in stack if n in BLOCK or n == "a"]
                    place = (*dict.fromkeys(path), *path[-1:]), tuple(dict.fromkeys(w for _, ws in stack for w in ws))
                out.append(Block(text, *place, min(1.0, linked / max(1, len(text)))))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if places["a"]:
                linked += len(text.strip())

    def pop(to: int) -> None:
        nonlocal place
        place = None
        while len(stack) > to:
            name, _ = stack.pop()
            places[name].pop()
            for some in (blocks, borders):
                if some and some[-1] == len(stack):
                    some.pop()

    source, at = source or "", 0
    for start, end, closing, name, attributes in tags_of(source):
        if start < at:  # within a raw element
            continue
        add(source[at:start])
        at = end
        if not name:
            if source.startswith("<![CDATA[", start):
                add(html.escape(source[start + 9 : end].removesuffix("]]>")))
            continue
        if closing:
            if name in BLOCK:
                flush()
            if places[name] and (name in BLOCK or not blocks or blocks[-1] < places[name][-1]):
                pop(places[name][-1])
            continue
        if name in RAW:
            if not attributes.endswith("/") or name != "svg":
                found = _raw_end(name).search(source, at)
                at = found.end() if found else len(source)
            if name not in ("script", "style", "template"):
                add(" ")
            continue
        if name in BLOCK:
            flush()
            if blocks and stack[blocks[-1]][0] == "p":
                pop(blocks[-1])
            border = borders[-1] if borders else -1
            ended = [k for c in CLOSES.get(name, ()) for k in places[c][bisect.bisect(places[c], border) :][:1]]
            if ended:
                pop(min(ended))
        if name in VOID:
            add(" " if name in ("br", "img", "input") else "")
            continue
        if attributes.endswith("/") and name not in BLOCK or len(stack) >= DEPTH:
            continue
        words = tuple(w for x in NAMES.findall(attributes) for w in re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", "".join(x)).lower())) if attributes else ()
        places[name].append(len(stack))
        if name in BLOCK:
            blocks.append(len(stack))
        if name in BORDER:
            borders.append(len(stack))
        stack.append((name, words))
        place = None
    add(source[at:])
    flush()
    return out


def _bucket(x: float) -> int:
    return int(math.log2(x + 1))


def structure_features(path: tuple[str, ...], names: tuple[str, ...]) -> list[str]:
    return ["bias", *(f"in:{t}" for t in dict.fromkeys(path)), f"leaf:{path[-1] if path else ''}", *(f"name:{w}" for w in names)]


def text_features(block: Block, k: int, n: int) -> list[str]:
    """Of length, links, sentence marks and place; none of the words, so any language is treated alike."""
    text = block.text
    marks = text.count(".") + text.count("!") + text.count("?") + text.count(",")
    return [f"length:{min(9, _bucket(len(text)))}", f"links:{int(block.link_share * 4)}", f"marks:{min(4, _bucket(marks))}", f"words:{min(7, _bucket(text.count(' ')))}", f"end:{text[-1] in '.!?:'}", f"sign:{text[0] in '©|·»>'}", f"place:{min(3, k)}:{min(3, n - 1 - k)}"]


@dataclass
class Crf:
    """Weights of (feature, label) and of (label, next label); labels are 0 for surroundings, 1 for main text."""

    weights: dict[str, list[float]] = field(default_factory=lambda: defaultdict(lambda: [0.0, 0.0]))
    moves: list[list[float]] = field(default_factory=lambda: [[0.0, 0.0], [0.0, 0.0]])
    cache: dict = field(default_factory=dict, repr=False)

    def scores(self, blocks: list[Block]) -> list[tuple[float, float]]:
        out = []
        for k, b in enumerate(blocks):
            key = (b.path, b.names)
            base = self.cache.get(key)
            if base is None:
                found = [self.weights[f] for f in structure_features(*key) if f in self.weights]
                base = (sum(w[0] for w in found), sum(w[1] for w in found))
                if len(self.cache) > 20_000:
                    self.cache.clear()
                self.cache[key] = base
            zero, one = base
            for f in text_features(b, k, len(blocks)):
                w = self.weights.get(f)
                if w is not None:
                    zero += w[0]
                    one += w[1]
            out.append((zero, one))
        return out

    def decode(self, blocks: list[Block]) -> list[int]:
        """The likeliest labels by Viterbi; equal scores go to label 0."""
        best, back = (0.0, 0.0), []
        for k, (zero, one) in enumerate(self.scores(blocks)):
            if k:
                m = self.moves
                from0 = (best[0] + m[0][0], best[1] + m[1][0])
                from1 = (best[0] + m[0][1], best[1] + m[1][1])
                back.append((int(from0[1] > from0[0]), int(from1[1] > from1[0])))
                best = (max(from0) + zero, max(from1) + one)
            else:
                best = (zero, one)
        labels = [int(best[1] > best[0])] if blocks else []
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def train(pages: list[list[tuple[Block, int]]], rounds: int = 12, rate: float = 0.3, penalty: float = 1e-4) -> Crf:
    """Maximum likelihood by AdaGrad: forward-backward over each page, L2 penalty, pages in an order fixed by a seed."""
    crf, order = Crf(), random.Random(7)
    squares: dict[str, list[float]] = defaultdict(lambda: [1e-6, 1e-6])
    move_squares = [[1e-6, 1e-6], [1e-6, 1e-6]]
    data = [([structure_features(b.path, b.names) + text_features(b, k, len(page)) for k, (b, _) in enumerate(page)], [y for _, y in page]) for page in pages if page]
    for _ in range(rounds):
        order.shuffle(data)
        for features, labels in data:
            n, m = len(labels), crf.moves
            score = [[sum(crf.weights[f][y] for f in fs) for y in (0, 1)] for fs in features]
            log = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b)))
            ahead = [score[0]]
            for k in range(1, n):
                ahead.append([log(ahead[-1][0] + m[0][y], ahead[-1][1] + m[1][y]) + score[k][y] for y in (0, 1)])
            behind = [[0.0, 0.0]]
            for k in range(n - 1, 0, -1):
                behind.append([log(m[y][0] + score[k][0] + behind[-1][0], m[y][1] + score[k][1] + behind[-1][1]) for y in (0, 1)])
            behind.reverse()
            total = log(*ahead[-1])
            for k, fs in enumerate(features):
                for y in (0, 1):
                    slope = math.exp(ahead[k][y] + behind[k][y] - total) - (labels[k] == y)
                    for f in fs:
                        w, s = crf.weights[f], squares[f]
                        g = slope + penalty * w[y]
                        s[y] += g * g
                        w[y] -= rate * g / math.sqrt(s[y])
            slopes = [[0.0, 0.0], [0.0, 0.0]]
            for k in range(1, n):
                for a in (0, 1):
                    for b in (0, 1):
                        slopes[a][b] += math.exp(ahead[k - 1][a] + m[a][b] + score[k][b] + behind[k][b] - total) - (labels[k - 1] == a and labels[k] == b)
            for a in (0, 1):
                for b in (0, 1):
                    move_squares[a][b] += slopes[a][b] ** 2
                    m[a][b] -= rate * slopes[a][b] / math.sqrt(move_squares[a][b])
    crf.weights = dict(crf.weights)
    return crf


def labelled_pages(n: int = 260, seed: int = 11) -> list[list[tuple[Block, int]]]:
    """Labelled pages to learn from: laid out at random from the parts that web pages have, in made-up words.

    A mark before each block of main text is its label; it is taken off after the blocks are cut.
    """
    r, mark = random.Random(seed), "\x01"
    word = lambda: "".join(r.choice(("an", "el", "ti", "ro", "us", "me", "sha", "ve", "in", "ko")) for _ in range(r.randint(1, 4)))
    phrase = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))
    sentence = lambda a, b: phrase(a, b).capitalize() + r.choice((".", ".", ".", "!", "?"))
    text = lambda a, b: " ".join(sentence(3, 14) for _ in range(r.randint(a, b)))
    link = lambda: f'<a href="/{word()}">{phrase(1, 3)}</a>'
    box = lambda names, inner: f'<div {r.choice(("class", "id"))}="{r.choice(names)}">{inner}</div>'
    items = lambda a, b: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(r.randint(a, b))) + "</ul>"
    menu = lambda: r.choice((f"<nav>{items(2, 8)}</nav>", box(("menu", "navbar", "nav", "topbar", "navigation"), items(2, 8)), box(("breadcrumb", "breadcrumbs"), " &gt; ".join(link() for _ in range(3)))))
    header = lambda: r.choice((f"<header><h1>{phrase(1, 4)}</h1><p>{sentence(2, 8)}</p></header>", box(("header", "masthead", "site-header", "banner"), f"<p>{phrase(1, 5)}</p>")))
    advert = lambda: r.choice((box(("ad", "ads", "advert", "sponsored", "promo", "ad-box", "advertisement"), r.choice((text(1, 4), f"<p>{text(1, 3)}</p>"))), f'<aside class="ad"><p>{text(1, 3)}</p></aside>'))
    notice = lambda: box(("cookie", "notice", "cookie-banner", "consent", "alert", "gdpr", "popup", "modal", "newsletter", "subscribe"), f"<p>{text(1, 3)}</p><button>{phrase(1, 2)}</button>")
    form = lambda: f'<form><label>{phrase(1, 3)}</label><input name="q"><p>{sentence(3, 9)}</p><button>{word()}</button></form>'
    side = lambda: r.choice((f"<aside><h3>{phrase(1, 3)}</h3>{r.choice((items(2, 6), f'<p>{text(1, 3)}</p>'))}</aside>", box(("sidebar", "related", "widget", "side", "recommended", "trending", "share", "social", "tags"), f"<h3>{phrase(1, 3)}</h3>" + r.choice((items(2, 6), f"<p>{text(1, 2)}</p>")))))
    comments = lambda: r.choice((box(("comments", "comment-list", "discussion", "responses", "disqus"), f"<h3>{phrase(1, 3)}</h3>" + "".join(f'<div class="comment"><p>{text(1, 4)}</p></div>' for _ in range(r.randint(1, 5)))), f'<section id="comments"><h2>{phrase(1, 2)}</h2>' + "".join(f'<article class="comment"><p>{text(1, 4)}</p></article>' for _ in range(r.randint(1, 4))) + "</section>"))
    footer = lambda: r.choice((f"<footer>&copy; {word()}.example &middot; {text(1, 2)}</footer>", box(("footer", "site-footer", "copyright", "bottom", "legal"), f"<p>&copy; {phrase(1, 4)} {sentence(2, 8)}</p>{r.choice(('', items(1, 4)))}"), f"<footer><p>{text(1, 3)}</p>{items(1, 4)}</footer>"))

    def main() -> str:
        body = [f"<{h}>{mark}{phrase(2, 9)}{r.choice(('', '.'))}</{h}>" for h in [r.choice(("h1", "h1", "h2"))] if r.random() < 0.9]
        for _ in range(r.choice((1, 2, 3, 5, 8, 12))):
            body.append(r.choices((f"<p>{mark}{text(1, 8)}</p>", f"<p>{mark}<b>{text(1, 4)}<br>", f"<p>{mark}{sentence(1, 6)} {link()} {text(1, 3)}</p>", f"<h2>{mark}{phrase(1, 5)}</h2>", f"<ul><li>{mark}{sentence(2, 9)}</li><li>{mark}{phrase(2, 9)}</li></ul>", f"<blockquote>{mark}{text(1, 3)}</blockquote>", f"<pre>{mark}{phrase(3, 9)}</pre>", f"<table><tr><td>{mark}{phrase(1, 3)}</td><td>{mark}{phrase(1, 3)}</td></tr></table>", f"<div>{mark}{text(1, 5)}</div>", f"<p>{mark}{phrase(1, 3)}</p>", advert(), side()), (12, 4, 3, 2, 1, 1, 1, 1, 2, 1, 0.6, 0.4))[0])
        inner = "".join(body)
        return r.choices((f"<article>{inner}</article>", f"<main>{inner}</main>", f"<main><article>{inner}</article></main>", box(("content", "post", "entry", "article-body", "story", "main", "post-content"), inner), f"<section>{inner}</section>", f"<div>{inner}</div>"), (6, 2, 2, 4, 1, 1))[0]

    out = []
    for _ in range(n):
        head = [f() for f in (header, menu, menu, notice, advert, form) if r.random() < 0.45]
        tail = [f() for f in (side, comments, form, advert, notice, footer, footer) if r.random() < 0.45]
        r.shuffle(head)
        page = f"<!DOCTYPE html><html><head><title>{phrase(2, 6)}</title></head><body>{''.join(head)}{main()}{''.join(tail)}</body></html>"
        cut = blocks_of(page)
        out.append([(Block(b.text.replace(mark, ""), b.path, b.names, b.link_share), int(mark in b.text)) for b in cut])
    return out


@functools.cache
def default_model() -> Crf:
    return train(labelled_pages())


def main_text(source: str | None, model: Crf) -> str:
    """The blocks that the model takes for main text, joined by an empty line; none for null or empty pages."""
    blocks = blocks_of(source)
    return "\n\n".join(b.text for b, y in zip(blocks, model.decode(blocks), strict=True) if y)


def extract(pages: DataFrame, model: Crf) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages (page_id, url, html), from the whole html, row by row.

    text is empty for null, empty or textless pages; null and repeated keys and rows are kept as they are, other
    columns are not read, and an empty table gives no rows. A page's time grows in proportion to its length.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [main_text(x.as_py(), shared.value) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array([len(x) for x in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by the field trained on labelled_pages(); null pages have the empty text."""
    return extract(table(spark, sf_dir, "pages"), default_model())
