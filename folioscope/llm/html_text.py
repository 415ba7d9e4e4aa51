"""Main text of web pages from flat text blocks.

A page is cut at block-level tags into flat blocks.  Of each block are measured:
its words, link density and sentences, words and link density of its two
neighbours and whether they share its container, whether it is a heading, its
container's share of the page's text, and how strongly its ancestors declare a role such as navigation or article, by
element (2) or by class, id or ARIA role (1).  A decision tree by Gini impurity,
grown on the blocks of the labelled pages that `html_pages` makes, says which
blocks are main text; they are joined in page order.

What names declare is one measure among the others.  Of the parts of a name that
say something, those for other things than the article count first, so
"footer-content" is a footer.  A container that holds more than half of the
page's text doesn't count as something else for a name that can be the page's
frame or state, such as "header-wrap" or "menu-open", nor if a first heading or
a declared article lies in it, nor if it is a form.  How much of the page's text
is declared main is a measure too, so a teaser named "post" beside a long
undeclared text doesn't hide that.  Words of scripts that don't part them by
spaces are counted by letters, and cells of tables that hold blocks are
containers like any other.

Markup that the tree never sees: comments, scripts, styles and the other
elements whose content isn't text.  Tags that a page's end cuts off are dropped.
Character references are decoded after the tags are cut, so they never become
markup.

Defined results: a null or empty page, or one without main text, has the empty
text.  Repeated rows each get a row, and pages of any length are read whole.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import html_pages
from .common import limit_batches, map_texts

#: Elements whose content is no text, elements that start a new block, and those whose names are kept on the stack of ancestors.
RAW = ("script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp")
BLOCKS = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul template noscript svg math object video audio canvas map".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: What an element declares by itself: main text above zero, not main below.
ELEMENTS = {"article": 2, "main": 2, "form": -1} | dict.fromkeys("nav header footer aside menu dialog button select label noscript template svg math object video audio canvas map head".split(), -2)
ROLES = {"main": 2, "article": 2} | dict.fromkeys("navigation banner contentinfo complementary search menu menubar toolbar dialog alertdialog alert form".split(), -2)
#: Parts of a class or id that declare main text, and those that declare something else and count before them.
MAIN_PARTS = frozenset("article content entry main post story".split())
OTHER_PARTS = frozenset(
    "ad ads advert advertisement advertising adverts aside banner banners breadcrumb breadcrumbs byline colophon comment commentlist comments consent cookie cookies copyright disclaimer discussion feedback foot footer form forms gdpr header latest links login masthead menu menubar meta modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup popular privacy promo promotion recent recommended related replies reply respond responses search share sharing sidebar sidenav signup sitemap skip social sponsor sponsored sponsors subscribe tags teaser teasers toolbar topbar tracking trending widget widgets".split()
)
#: A header of these is the article's own.
OWN_PARTS = frozenset("article entry post story".split())
#: What follows these in a name says what a page has, not what the element is.
LAYOUT = frozenset("has with without no not is show hide and".split())
#: Names with these can be about the page, or its state, as well: they are void around most of its text.
FRAME = frozenset("active app body closed collapsed container expanded fixed frame holder inner layout loaded on open opened outer page root shell site sticky view visible wrap wrapper".split())
#: Elements that hold blocks together; text-level and table elements don't.
CONTAINERS = frozenset("div section article main aside nav footer header form body center details fieldset dialog".split())
#: A form with most of the page's text and more words than that is the page's frame.
FORM_WORDS = 60
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    rf"|<({'|'.join(RAW)})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1(?=[\s/>])[^>]*(?:>|\Z)|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Letters of scripts that don't part words by spaces; two of them count as a word.
_UNSPACED = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def n_words(text: str) -> int:
    """Words of a text without white space at its ends, at least one."""
    return text.count(" ") + 1 + (0 if text.isascii() else len(_UNSPACED.findall(text)) // 2)


def named(name: str) -> tuple[int, bool]:
    """What one class or id says: 1 main text, -1 something else, 0 nothing; and whether it can be the page's frame."""
    parts = [x.lower() for x in _PART.findall(name)]
    for i, part in enumerate(parts):
        if part in LAYOUT:
            parts = parts[:i]
            break
    other = OTHER_PARTS.intersection(parts)
    if other and not (other <= {"header"} and OWN_PARTS.intersection(parts)):
        return -1, not FRAME.isdisjoint(parts)
    return int(not other and not MAIN_PARTS.isdisjoint(parts)), False


def declared(name: str, attributes: str) -> tuple[int, bool]:
    """What an element says about its content: 2 or 1 main text, -1 or -2 not, 0 nothing; and whether it can be the page's frame."""
    own = ELEMENTS.get(name, 0)
    if not attributes.strip() or name in ("html", "body"):
        return own, False
    found, frames = {own}, []
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return -2, False
        if key == "role":
            found.add(ROLES.get(value.strip().lower(), 0))
        elif key in ("class", "id"):
            for one in value.split():
                says, frame = named(one)
                found.add(says)
                if says < 0:
                    frames.append(frame)
    low, high = min(found), max(found)
    if low < 0 < high and own >= 0:
        # Names of both kinds: an element's own word stands, else nothing is said.
        return (low if own == 2 and low == -2 else own), False
    return (low if low < 0 else high), low == -1 and bool(frames) and all(frames)


@dataclass(frozen=True)
class Block:
    text: str
    words: int
    link_words: int
    sentences: int
    heading: int
    role: int
    parent: int

    @property
    def density(self) -> float:
        return self.link_words / self.words


class Container:
    """An element that holds blocks, or declares something: its words, counted up to the root, and what it says."""

    __slots__ = ("name", "says", "frame", "above", "plain", "marks", "id", "holds")

    def __init__(self, name: str, says: int, frame: bool, above: "Container | None", number: int):
        self.name, self.says, self.frame, self.above, self.plain, self.marks, self.id = name, says, frame, above, 0, False, number
        self.holds = name in CONTAINERS or above is None

    @property
    def parent(self) -> int:
        """The element that holds a block together with others; elements within the text don't."""
        own = self
        while not own.holds:
            own = own.above
        return own.id


_SENTENCE = re.compile(r"[.!?\u2026]+[\"')\u00bb\u201d\u2019]*(?=\s|\Z)|[\u3002\uff01\uff1f]+")


def blocks(page: str) -> list[Block]:
    """The page's flat text blocks, those without words left out."""
    raw: list[tuple[str, int, int, Container]] = []
    root = Container("", 0, False, None, 0)
    stack = [root]
    names: dict[str, int] = {}
    number = 0
    parts: list[str] = []
    linked: list[str] = []
    link = heading = False
    at = 0

    def flush() -> None:
        if parts:
            words = html.unescape("".join(parts)).split()
            if words:
                own, links = " ".join(words), " ".join(html.unescape(" ".join(linked)).split())
                raw.append((own, min(n_words(own), n_words(links)) if links else 0, int(heading), stack[-1]))
            parts.clear()
            linked.clear()

    def text(piece: str) -> None:
        if piece:
            parts.append(piece)
            if link:
                linked.append(piece)

    for m in _TOKEN.finditer(page):
        text(page[at : m.start()])
        at = m.end()
        if m[1]:
            if m[1].lower() in ("textarea", "iframe"):
                flush()
            continue
        closing, name, attributes = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
        if not name:
            continue
        name = name.lower()
        if name == "br":
            text(" ")
            continue
        if name == "a":
            link = not closing
            continue
        if name not in BLOCKS:
            continue
        flush()
        heading = name in HEADINGS and not closing
        if heading and name == "h1":
            stack[-1].marks = True
        if name in VOID:
            continue
        if closing:
            if names.get(name):
                to = next(i for i in range(len(stack) - 1, -1, -1) if stack[i].name == name)
                for one in stack[to:]:
                    names[one.name] -= 1
                del stack[to:]
            continue
        # An open paragraph ends here, and so does an open item or cell before the next.
        if stack[-1].name == "p" or stack[-1].name == name in ("li", "td"):
            names[stack.pop().name] -= 1
        if stack[-1].name == "td" and name not in ("table", "td", "th", "tr"):
            # A cell of a layout table holds blocks; one of a data table is a block.
            stack[-1].holds = True
        says, frame = declared(name, attributes)
        if not says and name not in CONTAINERS:
            # Elements that say nothing and hold nothing together need no place, unless an end tag must find them.
            if name in ("p", "li") or name in HEADINGS:
                continue
        number += 1
        stack.append(Container(name, says, frame, stack[-1], number))
        names[name] = names.get(name, 0) + 1
    text(page[at:])
    flush()
    return _measured(raw)


def _measured(raw: list[tuple[str, int, int, Container]]) -> list[Block]:
    """Blocks with what their ancestors credibly declare."""
    # Words go up from each container once: children are made after their parents.
    held: dict[int, Container] = {}
    total = 0
    for text, linked, _, own in raw:
        n = n_words(text) - linked
        own.plain += n
        total += n
        while own is not None and own.id not in held:
            held[own.id] = own
            own = own.above
    for number in sorted(held, reverse=True):
        own = held[number]
        if own.above is not None:
            own.above.plain += own.plain
            own.above.marks |= own.marks or own.says > 0
    claims: dict[int, tuple[int, int]] = {}
    for number in sorted(held):
        own = held[number]
        yes, no = claims[own.above.id] if own.above is not None else (0, 0)
        says = own.says
        if says == -1 and 2 * own.plain > total and (own.marks or own.frame or own.name == "form" and own.plain > FORM_WORDS):
            says = 0
        # An article within a header, a notice or the like belongs to that; a form around it doesn't.
        claims[number] = max(yes, says), max(no, -says)
    out = []
    for text, linked, heading, own in raw:
        yes, no = claims[own.id]
        if no == 2 and heading and yes == 2 and _headline(own):
            no = 0
        out.append(Block(text, n_words(text), linked, len(_SENTENCE.findall(text)), heading, -no or yes, own.parent))
    return out


def _headline(own: Container) -> bool:
    """Whether a heading lies in an article, and nothing around it says not main but the article's own header."""
    inside = True
    while own is not None:
        if own.says < 0 and not (inside and own.name == "header"):
            return False
        inside &= own.says < 2
        own = own.above
    return True


#: Names of the measures, in their order.
FEATURES = ("role", "role_gap", "declared_share", "words", "density", "sentences", "heading", "container_share", "before_words", "before_density", "before_same", "after_words", "after_density", "after_same")


def features(found: list[Block]) -> np.ndarray:
    """One row of measures for each block."""
    if not found:
        return np.zeros((0, len(FEATURES)))
    roles = np.array([b.role for b in found])
    plain = np.array([b.words - b.link_words if b.role >= 0 else 0 for b in found], float)
    by: dict[int, float] = {}
    for b, n in zip(found, plain, strict=True):
        by[b.parent] = by.get(b.parent, 0) + n
    largest = max(by.values()) or 1.0
    gap = max(0, roles.max()) - roles
    declared_share = np.full(len(found), plain[roles > 0].sum() / max(plain.sum(), 1.0))
    own = np.array([[b.words, 100 * b.density] for b in found], float)
    parents = np.array([b.parent for b in found])
    same = (parents[1:] == parents[:-1]).astype(float)[:, None]
    edge = np.zeros((1, 3))
    before, after = np.concatenate([edge, np.hstack([own[:-1], same])]), np.concatenate([np.hstack([own[1:], same]), edge])
    rest = np.array([[b.sentences, b.heading, by[b.parent] / largest] for b in found], float)
    return np.column_stack([roles, gap, declared_share, own, rest, before, after])


#: Splits by role: not main, undeclared, main by a name, main by an element.
ROLE_CUTS = (-0.5, 0.5, 1.5)
#: Pages of each kind and style that the tree is grown on, and the fewest blocks of a leaf.
PAGES_EACH, LEAF_ROWS, DEPTH = 45, 8, 24


SEED = 1


def measured(page: str, main: set[str]) -> tuple[np.ndarray, list[int]]:
    """Measures and labels of a labelled page's blocks."""
    found = blocks(page)
    return features(found), [int(b.text in main) for b in found]


def labelled(spark: SparkSession | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Measures and labels of the blocks of the labelled pages, a few ten thousand rows; with a session the pages are made and measured on its executors."""
    if spark is None:
        xs, ys = zip(*(measured(page, main) for _, _, page, main in html_pages.pages(SEED, PAGES_EACH)), strict=True)
        return np.concatenate(xs), np.concatenate(ys)
    kinds, styles = html_pages.KINDS, html_pages.STYLES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in batch.column(0).to_pylist():
                rest, i = divmod(n, PAGES_EACH)
                x, y = measured(*html_pages.made(SEED, kinds[rest // len(styles)], styles[rest % len(styles)], i))
                yield pa.RecordBatch.from_arrays([pa.array([n] * len(y), pa.int64()), pa.array(list(x), pa.list_(pa.float64())), pa.array(y, pa.int32())], names=["page", "x", "y"])

    limit_batches(spark)
    n = len(kinds) * len(styles) * PAGES_EACH
    rows = spark.range(0, n, 1, max(1, min(n // 60, spark.sparkContext.defaultParallelism))).mapInArrow(run, "page bigint, x array<double>, y int").toArrow()
    x = rows.column("x").combine_chunks()
    return np.asarray(x.flatten()).reshape(len(x), -1), rows.column("y").to_numpy()


_grown: list = []


def tree(spark: SparkSession | None = None) -> tuple | int:
    """The tree over the labelled pages, grown once in a process; its splits don't depend on the order of rows."""
    if not _grown:
        _grown.append(grow(*labelled(spark), first=ROLE_CUTS))
    return _grown[0]


def grow(x: np.ndarray, y: np.ndarray, depth: int = DEPTH, least: int = LEAF_ROWS, first: tuple[float, ...] = ()) -> tuple | int:
    """A tree by Gini impurity: (feature, threshold, tree at or below, tree above), or a class.

    first are thresholds of the first feature that are split at before impurity
    rules, so that each role has a subtree of its own, and the few short articles
    that are declared aren't outvoted by short blocks that aren't.
    """
    n, best = len(y), None
    if first:
        best = 0.0, 0, first[0]
    elif depth and y.min() != y.max():
        for f in range(x.shape[1]):
            order = np.argsort(x[:, f], kind="stable")
            v, ones = x[order, f], np.cumsum(y[order])
            at = np.flatnonzero(v[1:] != v[:-1]) + 1
            at = at[(at >= least) & (at <= n - least)]
            if len(at):
                a, b = ones[at - 1] / at, (ones[-1] - ones[at - 1]) / (n - at)
                cost = at * a * (1 - a) + (n - at) * b * (1 - b)
                i = int(cost.argmin())
                if best is None or cost[i] < best[0] - 1e-9:
                    best = cost[i], f, float(v[at[i] - 1] + v[at[i]]) / 2
    if best is None:
        return int(2 * y.sum() >= n)
    _, f, cut = best
    low = x[:, f] <= cut
    if first and (low.all() or not low.any()):
        return grow(x, y, depth, least, first[1:])
    a, b = (grow(x[part], y[part], depth - 1, least, first[1:]) for part in (low, ~low))
    return a if a == b and isinstance(a, int) else (f, cut, a, b)


def decide(tree: tuple | int, x: tuple) -> int:
    while not isinstance(tree, int):
        f, cut, low, high = tree
        tree = low if x[f] <= cut else high
    return tree


def main_text(page: str, by: tuple | int) -> str:
    """The joined main text of one page."""
    found = blocks(page)
    return " ".join(b.text for b, x in zip(found, features(found).tolist(), strict=True) if decide(by, x))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of every page."""
    by = tree(pages.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def run(pages: list[bytes]) -> list:
        texts = [main_text(p.decode(), by) for p in pages]
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    return map_texts(pages, [key, url], page, run, f"{key} {kinds[key]}, {url} {kinds[url]}, text string, n_chars bigint")
