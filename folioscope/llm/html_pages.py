"""Labelled pages for the main-text tree, made by rule.

A page has an article and what stands around it: menus, site headers, bylines,
adverts, notices, forms, sidebars, teasers, reader comments and footers.  Its
kind sets the article's shape and its style how far the markup tells the parts:
by elements, by class names, not at all (random names), wrongly, or for the
article only or all the rest only.  Some pages have no article.  Text is
pseudo-words, so a page's blocks are known by their text, and every block that
the parser cuts from a page can be labelled and measured.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

KINDS = ("news", "blog", "docs", "table", "notes", "wrapped", "sections", "short", "single", "bare", "none")
STYLES = ("elements", "names", "random", "wrong", "article only", "rest only")

#: How the parts of a page are named where its style tells them.
ELEMENT = {"menu": "nav", "head": "header", "foot": "footer", "side": "aside", "form": "form", "article": "article"}
NAMES = {
    "menu": ("main-nav", "menu", "navbar", "topbar", "breadcrumbs"),
    "head": ("header", "site-header", "masthead"),
    "foot": ("footer", "site-footer", "pageFooter", "footer-content", "colophon"),
    "side": ("sidebar", "widget", "related", "side-widget", "related-post", "latest-content"),
    "form": ("newsletter", "search", "signup"),
    "notice": ("cookie-notice", "notice", "gdpr-banner", "popup", "modal-content"),
    "advert": ("ad", "advert", "sponsored", "promo"),
    "comments": ("comments", "comment-list", "replies", "comment-content"),
    "byline": ("byline", "post-meta", "share"),
    "article": ("article", "post-content", "entry", "story", "article-body"),
}
_SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe ri so tu va we xi yo zu bran cled drif frol glus plem strin".split()


class Writer:
    """Random text and markup."""

    def __init__(self, rng: random.Random, style: str):
        self.rng, self.style, self.main, self.seen = rng, style, set(), set()

    def once(self, make) -> str:
        """A text that the page doesn't have yet, so that labels go by texts."""
        text = make()
        while text in self.seen:
            text += " " + self.words(1, 1)[0]
        self.seen.add(text)
        return text

    @property
    def told(self) -> bool:
        """Whether elements say where the article is."""
        return self.style in ("elements", "article only")

    def words(self, low: int, high: int) -> list[str]:
        r = self.rng
        return ["".join(r.choices(_SYLLABLES, k=r.choice((1, 1, 2, 2, 3)))) for _ in range(r.randint(low, high))]

    def prose(self, low: int, high: int) -> str:
        return self.once(lambda: self._sentences(low, high))

    def _sentences(self, low: int, high: int) -> str:
        out, at = self.words(low, high), 0
        while at < len(out):
            end = min(len(out), at + self.rng.randint(4, 18))
            out[at] = out[at].capitalize()
            if end - at > 7 and self.rng.random() < 0.6:
                out[at + 3] += ","
            out[end - 1] += self.rng.choice((".", ".", ".", "?", "!"))
            at = end
        return " ".join(out)

    def phrase(self, low: int, high: int) -> str:
        return self.once(lambda: " ".join(self.words(low, high)).capitalize())

    def kept(self, tag: str, text: str, inner: str | None = None) -> str:
        """A block of the article."""
        self.main.add(text)
        return f"<{tag}>{inner or text}</{tag}>"

    def linked(self, text: str) -> str:
        """The text with one to three of its words as a link."""
        parts = text.split(" ")
        if len(parts) < 8 or self.rng.random() < 0.6:
            return text
        a = self.rng.randrange(len(parts) - 3)
        b = a + self.rng.randint(1, 3)
        return " ".join([*parts[:a], f"<a href='/{a}'>{' '.join(parts[a:b])}</a>", *parts[b:]])

    def part(self, role: str, inner: str, inside: bool = False) -> str:
        """A part of the page, or of its article, in the markup of the style; a told article tells its own parts."""
        r, style = self.rng, self.style
        if style == "article only":
            style = "elements" if role == "article" else "names" if role == "byline" or inside else "random"
        elif style == "rest only":
            style = "random" if role == "article" else r.choice(("elements", "names"))
        if style == "elements" and role in ELEMENT and (role != "article" or r.random() < 0.8):
            return f"<{ELEMENT[role]}>{inner}</{ELEMENT[role]}>"
        if role == "article" and style == "elements":
            return f"<main>{inner}</main>"
        if style in ("elements", "names"):
            return f'<div {r.choice(("class", "class", "id"))}="{r.choice(NAMES[role])}">{inner}</div>'
        if style == "wrong" and role in ("foot", "notice", "advert", "comments", "form", "menu") and r.random() < 0.5:
            tag = ELEMENT.get(role)
            return f"<{tag}>{inner}</{tag}>" if tag else f'<div class="{r.choice(NAMES[role])}">{inner}</div>'
        return f'<div class="{r.choice("cxqkjz")}{r.randrange(10, 9999)}">{inner}</div>'

    def links(self, n: int, low: int, high: int) -> str:
        items = "".join(f"<li><a href='/{i}'>{self.phrase(low, high)}</a></li>" for i in range(n))
        return f"<ul>{items}</ul>"

    def article(self, kind: str) -> str:
        r, out = self.rng, []
        title = self.kept("h1", self.phrase(*r.choice(((1, 3), (3, 12))))) if r.random() < 0.75 else ""
        para = lambda low, high: self.kept("p", t := self.prose(low, high), self.linked(t))
        if kind == "news":
            out = [para(20, 60), *(para(*r.choice(((25, 90), (12, 40), (2, 14)))) for _ in range(r.randint(4, 14)))]
        elif kind == "blog":
            out = [para(15, 120) for _ in range(r.randint(2, 6))]
            out.insert(1, self.kept("blockquote", self.prose(8, 40)))
            out.insert(2, self.kept("h2", self.phrase(2, 6)))
        elif kind == "docs":
            for _ in range(r.randint(2, 5)):
                out += [self.kept("h2", self.phrase(1, 5)), para(15, 60), "<ul>" + "".join(self.kept("li", self.prose(3, 18)) for _ in range(r.randint(2, 5))) + "</ul>", self.kept("pre", self.phrase(3, 12)), para(8, 40)]
        elif kind == "table":
            rows = "".join("<tr>" + "".join(self.kept("td", self.phrase(1, 4)) for _ in range(3)) + "</tr>" for _ in range(r.randint(3, 8)))
            out = [para(25, 70), para(15, 50), f"<table>{rows}</table>", para(20, 60), para(20, 50)]
        elif kind == "notes":
            out = [para(40, 90), para(1, 5), para(30, 80), para(1, 8), para(15, 60)]
        elif kind == "sections":
            lead = self.part("byline", f"<p>{self.phrase(2, 6)}</p>") if r.random() < 0.5 else ""
            out = [para(6, 30)] if r.random() < 0.6 else []
            for _ in range(r.randint(2, 5)):
                items = "<ul>" + "".join(self.kept("li", t := self.phrase(2, 7), f"<a href='/l'>{t}</a>") for _ in range(r.randint(2, 4))) + "</ul>" if r.random() < 0.3 and self.told else ""
                caption = "<figure><img src='/i'>" + self.kept("figcaption", self.phrase(3, 9)) + "</figure>" if r.random() < 0.4 else ""
                out.append(f"<{(tag := r.choice(('section', 'div')))}>{self.kept('h2', self.phrase(1, 5))}{para(*r.choice(((20, 80), (5, 30))))}{caption}{para(10, 60)}{items}</{tag}>")
            if self.told and r.random() < 0.3:
                return f"<header>{title}{lead}</header>" + "".join(out)
        elif kind == "bare":
            return "".join(para(20, 60) for _ in range(r.randint(2, 4)))
        elif kind in ("short", "single"):
            sure = self.told or self.style == "names"
            size = (1, r.choice((3, 20, 40))) if sure else (25, 60)
            if kind == "single":
                self.main.clear()
                return para(*size) if r.random() < 0.7 else self.kept("div", self.prose(*size))
            return title + "".join(para(*size) for _ in range(r.randint(1, 3)))
        else:
            out = [f"<div>{para(25, 90)}</div>" for _ in range(r.randint(3, 8))]
        if r.random() < 0.5:
            byline = self.part("byline", f"<p>{self.phrase(2, 6)}</p>")
            out.insert(0, byline)
        if r.random() < 0.4:
            out.insert(r.randrange(1, len(out)), self.part("advert", f"<p>{self.prose(4, 30)}</p>", inside=True))
        return title + "".join(out)

    def teaser(self) -> str:
        text = f"<h3><a href='/t'>{self.phrase(3, 8)}</a></h3>" + (f"<p>{self.prose(8, 22)}</p>" if self.rng.random() < 0.5 else "")
        if self.style == "wrong":
            return f'<div class="{self.rng.choice(NAMES["article"])}">{text}</div>'
        return f"<div>{text}</div>" if self.style != "rest only" else f"<article>{text}</article>"

    def comment(self) -> str:
        body = f"<p>{self.phrase(1, 3)}</p><p>{self.prose(4, 45)}</p><p><a href='/r'>{self.phrase(1, 1)}</a></p>"
        return f"<div>{body}</div>"

    def page(self, kind: str) -> str:
        r = self.rng
        maybe = lambda share, make: make() if r.random() < share else ""
        head = maybe(0.6, lambda: self.part("head", f"<div>{self.phrase(1, 4)}</div><p>{self.phrase(3, 9)}</p>"))
        head += maybe(0.7, lambda: self.part("menu", self.links(r.randint(3, 9), 1, 3)))
        notice = maybe(0.5, lambda: self.part("notice", f"<p>{self.prose(12, 40)}</p><a href='/ok'>{self.phrase(1, 2)}</a>"))
        advert = maybe(0.5, lambda: self.part("advert", self.prose(3, 30)))
        side = maybe(0.7, lambda: self.part("side", f"<h3>{self.phrase(1, 3)}</h3>" + "".join(self.teaser() for _ in range(r.randint(1, 4))) + self.links(r.randint(0, 5), 3, 9)))
        form = maybe(0.4, lambda: self.part("form", f"<p>{self.prose(4, 20)}</p><label>{self.phrase(1, 3)}</label><input><button>{self.phrase(1, 2)}</button>"))
        comments = maybe(0.5, lambda: self.part("comments", f"<h3>{self.phrase(1, 3)}</h3>" + "".join(self.comment() for _ in range(r.randint(1, 5)))))
        line, few = f"<p>{self.phrase(3, 14)} &middot; {self.prose(3, 25)}</p>", self.links(r.randint(2, 5), 1, 3)
        inline = " ".join(f"<a href='/{i}'>{self.phrase(1, 2)}</a>" for i in range(r.randint(2, 5)))
        foot = maybe(0.7, lambda: self.part("foot", r.choice((line, line + few, few + line, few, inline, inline + line))))
        alone = maybe(0.5, lambda: self.part("side", self.teaser()) if self.style != "wrong" else self.teaser())
        article = self.article(kind) if kind != "none" else ""
        # A bare article stands among the other parts half of the time.
        if article and (kind != "bare" or r.random() < 0.5):
            article = self.part("article", article)
        middle = [article, alone, form, comments] if r.random() < 0.5 else [alone, article, form, comments]
        middle.insert(r.choice((0, len(middle))), side)
        if kind == "bare" and r.random() < 0.7:
            # Right after links.
            before = r.choice((few, self.links(r.randint(1, 2), 1, 2), inline, f"<div>{inline}</div>", self.teaser(), f"<h3><a href='/t'>{self.phrase(2, 8)}</a></h3>", f"<p><a href='/t'>{self.phrase(1, 8)}</a></p>"))
            middle[middle.index(article)] = f"<table><tr><td>{before}</td>{r.choice(('', '</tr><tr>'))}<td>{article}</td></tr></table>" if r.random() < 0.4 else before + article
        if r.random() < 0.3 and kind != "bare":
            # Few of the other parts, in any place.
            middle = r.sample([article, r.choice((notice, advert, side, form, comments, foot, head, alone, alone))], 2)
            notice = head = advert = foot = ""
        if r.random() < 0.1:
            # The article alone.
            middle, notice, head, advert, foot = [article], "", "", "", ""
        body = "".join(middle)
        if r.random() < 0.3:
            body = f'<div class="{r.choice(("has-sidebar", "with-header", "wrap", "page", "header-wrap", "menu-open", "page-with-banner"))}">{body}</div>'
        parts = [notice, head, advert, body, foot] if r.random() < 0.7 else [head, body, advert, foot, notice]
        return f"<!DOCTYPE html><html><head><title>{self.phrase(2, 5)}</title></head><body>{''.join(parts)}</body></html>"


def made(seed: int, kind: str, style: str, i: int) -> tuple[str, set[str]]:
    """One page of a kind and style: (html, texts of the article's blocks)."""
    writer = Writer(random.Random(f"{seed} {kind} {style} {i}"), style)
    return writer.page(kind), writer.main


def pages(seed: int, each: int, kinds: tuple[str, ...] = KINDS, styles: tuple[str, ...] = STYLES) -> Iterator[tuple[str, str, str, set[str]]]:
    """(kind, style, html, texts of the article's blocks)."""
    for kind in kinds:
        for style in styles:
            for i in range(each):
                yield kind, style, *made(seed, kind, style, i)
