"""HTML extraction: flat text blocks, classified by a decision tree.

A page is cut into flat blocks at every block-level tag. A block has its word
count and link density and those of its two neighbours, and where it stands:
in an article or main part, in a part that pages use for navigation and the
like (by tag, or by a class, id or role that says nothing else), or in neither;
its nearest ancestor of either kind decides. A
decision tree, grown on a small labelled table of pages, says which blocks are
main text. Scripts, styles, forms and other text that a page does not show as
prose are never blocks.

Each page is parsed in its own task; nothing is shuffled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textbytes

#: Tags that begin and end a block.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section
summary table tbody td tfoot th thead tr ul""".split())
#: Tags whose content is no text of the page.
HIDDEN_TAGS = frozenset("""annotation annotation-xml applet audio button canvas datalist embed form frameset head iframe input label map
noembed noframes noscript object optgroup option output progress script select style svg template textarea title
video""".split())
#: Tags without content.
VOID_TAGS = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
#: Tags of parts that are not the article.
SIDE_TAGS = frozenset("aside dialog footer header menu nav search".split())
#: Hidden tags inside a line of text, which end no block.
INLINE_TAGS = frozenset("annotation annotation-xml button input label map output".split())
#: Words of a class, id or role that name such parts.
SIDE_WORDS = frozenset("""ad ads advert adverts advertisement advertising adbox adslot alert banner billboard breadcrumb
breadcrumbs comment comments commentlist consent cookie cookies copyright discussion disqus footer gdpr header legal
login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall
popup promo promoted promotion reaction reactions recommended related reply replies respond search share sharing
sidebar signup skip social sponsor sponsored subscribe subscription toast toolbar topbar widget widgets complementary
contentinfo dialog""".split())

#: Of these, the words for parts that may stand around an article.
AROUND = frozenset("""banner header masthead menu modal overlay popup sidebar toolbar topbar widget widgets""".split())
#: Words that such a name may hold besides, as in ``comment-list`` or ``site-header``.
PLAIN_WORDS = frozenset("""area article articles bar block blog body bottom box col column container content entry
feed form global group inner item items left line link links list main outer page panel post posts primary right
secondary section site slot stories thread title top unit wrap wrapper""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())

FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "article", "side"]
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Words of a block are counted up to this many.
MANY = 60


@dataclass
class Block:
    text: str
    words: int
    links: float
    article: int
    side: int
    inner: bool = False  # in an article that a side part stands around


def _names(token: str) -> set[str]:
    """The side words of a class, id or role, if it has no words but those and plain ones."""
    parts = {p.lower() for p in _PART.findall(token)}
    return parts & SIDE_WORDS if parts <= SIDE_WORDS | PLAIN_WORDS else set()


def _mark(tag: str, attrs: list[tuple[str, str | None]]) -> str:
    """What a tag begins: ``side``, ``header`` or ``around`` (sides that may hold
    an article or its headline), ``article``, ``main``, or nothing."""
    found: set[str] = set()
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return "side"
        if name == "style" and value and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return "side"
        if name in ("class", "id", "role") and value and not (name == "class" and tag in ("html", "body", "main")):
            for token in value.split():
                found |= _names(token)
    if tag == "header" and not found - AROUND or found == {"header"}:
        return "header"
    if tag in SIDE_TAGS or found - AROUND:
        return "side"
    if found and tag not in ("html", "body", "main"):
        return "around"
    return tag if tag in ("article", "main") else ""


@dataclass(frozen=True)
class Place:
    """Where text below the open marks stands: in an article; in a side part;
    in an article that a side part stands around (``inner``); in a side part
    whose articles are not the page's own (``closed``)."""
    mark: str = ""
    article: bool = False
    side: bool = False
    inner: bool = False
    closed: bool = False

    def below(self, mark: str) -> Place:
        if mark == "side":
            return Place(mark, self.article, True, False, True)
        if mark in ("around", "header"):
            return Place(mark, self.article, True, False, self.closed or self.article)
        if self.closed:
            return Place(mark, True, True, False, True)
        inner = mark == "article" and (self.side or self.inner)
        return Place(mark, True, inner, inner, False)


class _Parser(HTMLParser):
    """Collects the blocks of a page. Open tags are kept on a stack; an end tag
    closes the nearest open tag of its name, and what is open above it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, str]] = []  # tag, hidden, mark
        self.places = [Place()]  # of the open tags that have a mark
        self.depth = {"hidden": 0, "a": 0}
        self.open: dict[str, int] = {}
        self.blocks: list[Block] = []
        self.pieces: list[tuple[str, bool]] = []

    def flush(self) -> None:
        text = " ".join("".join(t for t, _ in self.pieces).split())
        if text:
            linked = sum(len(t.split()) for t, link in self.pieces if link)
            words, here = len(text.split()), self.places[-1]
            self.blocks.append(Block(text, words, min(1.0, linked / words), int(here.article), int(here.side), here.inner))
        self.pieces = []

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.pieces.append(("\n", False))
            return
        if tag in BLOCK_TAGS or tag in HIDDEN_TAGS - INLINE_TAGS:
            self.flush()
            if tag in BLOCK_TAGS and self.open.get("p") and tag not in ("html", "body"):
                self._close("p")  # a block begins: an open paragraph ends
            if tag == "li" and self.stack and self.stack[-1][0] == "li":
                self._close("li")
        if tag in VOID_TAGS:
            return
        if tag == "a" and self.open.get("a"):
            self._close("a")
        mark = _mark(tag, attrs)
        if tag in HEADINGS and not mark and self.places[-1].mark == "header" and self.places[-2].article:
            mark = "headline"
        entry = (tag, tag in HIDDEN_TAGS, mark)
        self.stack.append(entry)
        self.open[tag] = self.open.get(tag, 0) + 1
        self._count(entry, 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "math", "annotation", "annotation-xml"):
            self.handle_endtag(tag)

    def _count(self, entry, by):
        tag, hidden, mark = entry
        self.depth["hidden"] += by * hidden
        self.depth["a"] += by * (tag == "a")
        if mark and by < 0:
            self.places.pop()
        elif mark == "headline":  # stands where its header does
            self.places.append(self.places[-2])
        elif mark:
            self.places.append(self.places[-1].below(mark))

    def _close(self, tag):
        while self.stack:
            entry = self.stack.pop()
            self.open[entry[0]] -= 1
            self._count(entry, -1)
            if entry[0] == tag:
                return

    def handle_endtag(self, tag):
        if tag in BLOCK_TAGS or tag in HIDDEN_TAGS - INLINE_TAGS:
            self.flush()
        if tag == "br":
            self.pieces.append(("\n", False))
        elif self.open.get(tag):
            self._close(tag)

    def handle_data(self, data):
        if not self.depth["hidden"]:
            self.pieces.append((data, self.depth["a"] > 0))


def blocks(html: str | None) -> list[Block]:
    """The flat text blocks of a page, in page order. An article that stands in
    a side part such as a sidebar counts as one if the page has no other article
    and no more text in unmarked parts."""
    p = _Parser()
    p.feed(html or "")
    p.close()
    p.flush()
    if not any(b.article and not b.side for b in p.blocks):
        if sum(b.words for b in p.blocks if b.inner) > sum(b.words for b in p.blocks if not b.article and not b.side):
            for b in p.blocks:
                b.side = b.side and int(not b.inner)
    return p.blocks


def block_features(page: list[Block]) -> np.ndarray:
    """A row of FEATURES for every block; beyond the page's ends are no words."""
    own = np.array([[min(b.words, MANY), b.links] for b in page], float).reshape(-1, 2)
    none = np.zeros((1, 2))
    before, after = np.vstack([none, own[:-1]])[:len(page)], np.vstack([own[1:], none])[:len(page)]
    place = np.array([[b.article, b.side] for b in page], float).reshape(-1, 2)
    return np.hstack([own, before, after, place])


# ---- the decision tree ----------------------------------------------------

@dataclass
class Tree:
    """Inner nodes send rows with feature <= cut to ``low``; leaves have a label."""
    label: int
    feature: int = -1
    cut: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.low is None:
            return np.full(len(x), self.label)
        low = x[:, self.feature] <= self.cut
        out = np.empty(len(x), int)
        out[low], out[~low] = self.low.predict(x[low]), self.high.predict(x[~low])
        return out


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 2) -> Tree:
    """A tree by the greatest fall of Gini impurity; ties go to the first
    feature, then the smallest cut."""
    label = int(2 * y.sum() >= len(y))
    if depth == 0 or len(y) < 2 * least or len(set(y.tolist())) == 1:
        return Tree(label)
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            n = low.sum()
            if n < least or len(y) - n < least:
                continue
            p, q = y[low].mean(), y[~low].mean()
            impurity = (n * p * (1 - p) + (len(y) - n) * q * (1 - q)) / len(y)
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, float(cut), low)
    share = y.mean()
    if best is None or best[0] >= share * (1 - share) - 1e-12:
        return Tree(label)
    _, f, cut, low = best
    return Tree(label, f, cut, grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least))


def _words(n: int) -> str:
    return " ".join(["word"] * n)


def _links(n: int, words: int = 2) -> str:
    return "<ul>" + f"<li><a href=x>{_words(words)}</a></li>" * n + "</ul>"


def labelled_pages() -> list[tuple[str, list[int]]]:
    """The labelled table: small pages, and for each of their blocks 1 if it is
    main text. ``w`` stands for prose of a length, ``l`` for a list of links."""
    w, l, out = _words, _links, []  # noqa: E741
    for n in (1, 2, 4, 7, 12):  # link texts, headings and lone blocks of many lengths
        side = [(f"<nav>{l(4, n)}</nav>", 4), (f"<header><h1>{w(n)}</h1><p>{w(8)}</p></header>", 2),
                (f"<footer>{w(3 * n)}</footer>", 1), (f"<aside><p>{w(5 * n)}</p><p>{w(n)}</p></aside>", 2),
                (f"<div class=ad>{w(n)}</div>", 1), (f"<div id=cookie-notice><p>{w(25)}</p>{l(1, n)}</div>", 2),
                (f"<section class=comments><p>{w(60)}</p><p>{w(n)}</p><p>{w(30)}</p></section>", 3),
                (f"<div class='sidebar'>{l(3, n)}<p>{w(20)}</p>{l(2, n)}</div>", 6)]
        teasers = "".join(f"<div><a href=x>{w(n + 1)}</a></div><div>{w(k)}</div>" for k in (4, 9, 14, 18))
        for k in range(8):  # articles among such parts
            (a, i), (b, j), (c, m) = side[k], side[(k + 3) % 8], side[(k + 5) % 8]
            body = (f"<h1>{w(n)}</h1><p>{w(1)}</p><p>{w(30 + k)}</p><p>{w(n)} <a href=x>{w(2)}</a></p>"
                    f"<p><a href=x>{w(n)}</a></p><p><a href=x>{w(n)}</a></p><p>{w(1)}</p>")
            out.append((f"{a}<article>{body}</article>{b}", [0] * i + [1] * 7 + [0] * j))
            headline = [1] + [0] * (m - 1) if c.startswith("<header>") else [0] * m
            out.append((f"<main><p>{w(20)}</p>{c}<p>{w(n)}</p></main>", [1, *headline, 1]))
        for prose in (12, 25, 45, 60):  # pages that name no part: prose among links
            out.append((f"{l(4, n)}<h1>{w(6)}</h1><p>{w(prose)}</p><p>{w(prose + 9)}</p><p>{w(3)}</p><p>{w(prose)}</p>"
                        f"{l(3, n)}<div>{w(4)}</div>{l(2, n)}", [0] * 4 + [1] * 5 + [0] * 6))
            out.append((f"{l(2, n)}<div>{w(3)}</div>{l(2, n)}<p>{w(prose)}</p><p>{w(prose)}</p>{l(2, n)}<div>{w(5)}</div>"
                        f"{l(1, n)}", [0] * 5 + [1, 1] + [0] * 4))
        for prose in (20, 40, 60):  # neighbours decide: headlines before prose, short lines in it, teasers among links
            out.append((f"{l(3, n)}<h1>{w(3)}</h1><p>{w(prose)}</p><p>{w(prose + 5)}</p>{l(2, n)}{teasers}{l(1, n)}",
                        [0] * 3 + [1, 1, 1] + [0] * 11))
            out.append((f"{teasers}{l(1, n)}<div class='content has-sidebar'><h2>{w(2)}</h2><p>{w(prose)}</p><p>{w(4)}</p>"
                        f"<p>{w(prose)}</p></div>{l(2, n)}", [0] * 9 + [1] * 4 + [0] * 2))
        out.append((f"<h1>{w(n)}</h1><p>{w(20)}</p><p>{w(2)}</p><p>{w(50)}</p>", [1] * 4))
        out.append((f"<p>{w(3 * n)}</p>", [1]))
        lengths = [1, 2, 3, 5, 8, 13, 16, 18, 21, 34, 55]
        for k in lengths:  # side parts of any length, beside links, headlines and prose
            out.append((f"{l(2, n)}<div class=ad>{w(k)}</div><article><h1>{w(n)}</h1><p>{w(k)}</p></article>"
                        f"<div class=sidebar><p>{w(k)}</p></div>{l(1, n)}", [0] * 3 + [1, 1] + [0] * 2))
            out.append((f"<h1>{w(n)}</h1><p>{w(30)}</p><div class=ad>{w(k)}</div><p>{w(40)}</p><div class=share>{w(n)}</div>",
                        [1, 1, 0, 1, 0]))
        for turn in range(0, 11, 2):  # in an article, blocks of any length stand beside blocks of any length
            order = [lengths[(n + turn + k * (turn + 1)) % 11] for k in range(11)]
            mixed = "".join(f"<p>{w(k)}</p>" if i % 3 else f"<p><a href=x>{w(k)}</a></p>" for i, k in enumerate(order))
            out.append((f"{l(2, n)}<article>{mixed}{l(2, n)}</article>{teasers}", [0] * 2 + [1] * 13 + [0] * 8))
    return out


def fit() -> Tree:
    """The tree of the labelled table."""
    pages = labelled_pages()
    x = np.vstack([block_features(blocks(h)) for h, _ in pages])
    return grow(x, np.array([v for _, labels in pages for v in labels]))


def main_text(html: str | None, tree: Tree) -> str:
    """The main blocks of a page, one on a line; empty if it has none."""
    page = blocks(html)
    if not page:
        return ""
    keep = tree.predict(block_features(page))
    return "\n".join(b.text for b, k in zip(page, keep) if k)


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text
    (the main blocks, joined by line breaks), n_chars (its code points).

    A null, empty or textless page has an empty text; broken markup is read as
    far as it goes; long pages are parsed whole; repeated rows are repeated;
    further columns are not read; an empty table gives no rows."""
    tree = pages.sparkSession.sparkContext.broadcast(fit())

    def run(batches):
        for batch in batches:
            for part in textbytes.slices(batch, "html"):
                texts = [main_text(h, tree.value) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
