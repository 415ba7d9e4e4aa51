"""Blocks, the tree and whole pages, against another parser on the given pages."""

from html.parser import HTMLParser

import numpy as np
import pytest

from folioscope.llm import html_pages as P
from folioscope.llm import html_text as H
from folioscope.llm.common import table

TREE = H.tree()
LONG = "This is a paragraph of plain running text that goes on for a good while, with commas and all the words that a story needs to be told."


def text(page):
    return H.main_text(page, TREE)


class Article(HTMLParser):
    """Text of the article element."""

    def __init__(self):
        super().__init__()
        self.inside, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag in ("p", "h1", "br"):
            self.out.append(" ")

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        if tag in ("p", "h1"):
            self.out.append(" ")

    def handle_data(self, data):
        if self.inside:
            self.out.append(data)


def test_given_pages(spark, sf):
    pages = table(spark, sf, "pages")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in H.extract(pages).collect()}
    for row in pages.collect():
        parser = Article()
        parser.feed(row.html)
        want = " ".join("".join(parser.out).split())
        assert got[row.page_id] == (row.url, want, len(want))


def test_tree_fits_its_table():
    x, y = H.labelled()
    assert np.mean([H.decide(TREE, r) == k for r, k in zip(x.tolist(), y.tolist(), strict=True)]) > 0.98


def test_the_tree_is_the_same_from_executors(spark):
    x, y = H.labelled()
    u, v = H.labelled(spark)
    assert x.shape == u.shape and sorted(map(tuple, np.column_stack([x, y]).tolist())) == sorted(map(tuple, np.column_stack([u, v]).tolist()))
    assert H.grow(u, v, first=H.ROLE_CUTS) == TREE


def test_pages_held_out():
    """Precision and recall in words, by kind and by style, on pages that the tree wasn't grown on."""
    right, kept, main = {}, {}, {}
    for kind, style, page, texts in P.pages(20_002, 12):
        found = H.blocks(page)
        for b, x in zip(found, H.features(found).tolist(), strict=True):
            k, m = H.decide(TREE, x), b.text in texts
            for name in (kind, style):
                right[name] = right.get(name, 0) + b.words * (k and m)
                kept[name] = kept.get(name, 0) + b.words * k
                main[name] = main.get(name, 0) + b.words * m
    for name in {*P.KINDS, *P.STYLES} - {"none"}:
        assert right[name] / kept[name] > 0.95 and right[name] / main[name] > 0.95, name
    # Pages without an article give next to nothing.
    assert kept["none"] < 0.01 * sum(kept.values())


AROUND = "Some thirty words of plain prose stand here, and they say nothing that a reader of the story would want to know about it at all, so they go away."
STORY = f"<div class='k81'><p>{LONG}</p><p>{LONG}</p></div>"


@pytest.mark.parametrize("frame", ["<body>{story}{part}</body>", "<body>{part}{story}</body>", "<div id=page>{part}<div class=x2>{story}</div></div>", "<div class='has-sidebar'><h1></h1>{story}{part}</div>"])
@pytest.mark.parametrize(
    "part",
    [
        f"<footer>{AROUND}</footer>",
        f"<aside>{AROUND}</aside>",
        f"<nav>{AROUND}</nav>",
        f"<header><p>{AROUND}</p></header>",
        f"<form><p>{AROUND}</p><input></form>",
        f"<div class='comments'><p>{AROUND}</p></div>",
        f"<section id='comments'><div class='comment'><p>{AROUND}</p></div></section>",
        f"<div class='cookie-notice'>{AROUND}</div>",
        f"<div class='ad'>{AROUND}</div>",
        f"<div class='sponsored-content-ad'><p>{AROUND}</p></div>",
        f"<div role='complementary'>{AROUND}</div>",
        f"<div class='newsletter'><p>{AROUND}</p></div>",
        "<div class='post'>Older post title here</div>",
    ],
)
def test_undeclared_article_beside_other_parts(part, frame):
    assert text(frame.format(part=part, story=STORY)) == f"{LONG} {LONG}"


@pytest.mark.parametrize("frame", ["<body>{story}{part}</body>", "<body>{part}{story}</body>"])
def test_linked_teaser(frame):
    assert text(frame.format(part="<div class='entry'><h3><a href='/x'>Another story</a></h3></div>", story=STORY)) == f"{LONG} {LONG}"


# Pages written by hand, apart from the rule that makes the labelled ones.
RIVER = "The river rose in the night, and by the morning the lower road was gone, so the people of the village walked over the hill to the mill and waited there."
BRIDGE = "Nobody had seen water like this since the old bridge fell, and the miller, who was eighty, said that it would take a week before the fields were dry again."
OTHER = "Thirty words of something else stand here, such as a note about cookies or the terms of use, and they don't belong to the story that the reader came for today."
KAWA = "川の水は夜のうちに増え、朝には下の道が消えていた。村の人々は丘を越えて水車小屋まで歩き、そこで水が引くのを待っていた。古い橋が落ちてから、このような洪水を見た者は一人もいなかった。八十歳になる粉屋は、畑が乾くまでに一週間はかかるだろうと言った。"
TWO = f"<p>{RIVER}</p><p>{BRIDGE}</p>"


@pytest.mark.parametrize("frame", ['<div class="header-wrap">{}</div>', '<div class="page-with-banner"><h2>A title</h2>{}</div>', '<div class="menu-open">{}</div>', '<div id="main-menu-page"><h2>A title</h2>{}</div>', '<body class="menu">{}</body>', '<div class="site-header-fixed"><div>{}</div></div>'])
def test_a_frame_around_most_text_keeps_it(frame):
    assert text(frame.format(TWO)) == ("A title " if "h2" in frame else "") + f"{RIVER} {BRIDGE}"


@pytest.mark.parametrize("page", ["<table><tr><td><a href=/>Home</a><br><a href=/x>News</a></td><td>{}</td></tr></table>", "<table><tr><td><a href=/>Home</a></td></tr><tr><td>{}</td></tr></table>", "<table><tr><td><a href=/>Home</a> <a href=/x>News</a><td>{}</table>"])
def test_layout_tables(page):
    assert text(page.format(TWO)) == f"{RIVER} {BRIDGE}"


def test_scripts_without_spaces():
    assert text(f"<body><p>{KAWA}</p></body>") == KAWA
    assert text(f"<body><ul><li><a href=/>家</a></li></ul><p>{KAWA}</p><p>{KAWA}二</p></body>") == f"{KAWA} {KAWA}二"
    assert H.n_words("one two") == 2 and H.n_words(KAWA) > 40


@pytest.mark.parametrize("name", ["footer-content", "comment-content", "modal-content", "related-post", "sponsored-content-ad", "latest-posts", "widget-content", "comments-area", "entry-footer", "post-meta"])
@pytest.mark.parametrize("page", ["<article>{two}</article><div class='{name}'>{other}</div>", "<article>{two}</article><div class='{name}'><p>{other}</p></div>", "<main>{two}<div class='{name}'>{other}</div></main>", "<div class=x>{two}</div><div id='{name}'><p>{other}</p></div>"])
def test_names_of_two_kinds(name, page):
    assert text(page.format(two=TWO, name=name, other=OTHER)) == f"{RIVER} {BRIDGE}"


def test_an_articles_own_header_stays():
    assert text(f"<article><div class='entry-header'><h1>Title of it</h1></div>{TWO}</article>") == f"Title of it {RIVER} {BRIDGE}"
    assert text(f"<div class='header'><p>{OTHER}</p></div><article>{TWO}</article>") == f"{RIVER} {BRIDGE}"


@pytest.mark.parametrize("part", ["<footer>{}</footer>", "<div class=footer>{}</div>", "<aside>{}</aside>", "<nav>{}</nav>", "<div class='comments'>{}</div>", "<form>{}</form>"])
def test_pages_of_one_other_part(part):
    assert text(part.format(AROUND)) == ""


def test_headings_of_an_article_stay():
    assert text(f"<article><header><h1>The title</h1><p>By Someone</p></header><p>{LONG}</p></article>") == f"The title {LONG}"
    assert text(f"<header><h1>The site</h1></header><article><p>{LONG}</p></article>") == LONG
    assert text(f"<aside><article><header><h1>Teaser</h1></header></article></aside><article><p>{LONG}</p></article>") == LONG


@pytest.mark.parametrize(
    "page, want",
    [
        ("", ""),
        ("   <p></p>", ""),
        ("<article>a&amp;lt;b &#233;&nbsp;c &lt;p&gt;</article>", "a&lt;b é c <p>"),
        ("<article>in<b>li</b>ne<p>x\n\t y</article>", "inline x y"),
        ("<article>a<!-- <p>no --> b<script>if (a</p>) x</script> c<style>p{}</style></article>", "a b c"),
        ("<article>cut off<p cla", "cut off"),
        ("<article>1 < 2 and 3>2</article>", "1 < 2 and 3>2"),
        ("<main><div class='comments'><p>nice</p></div><p>story</p></main>", "story"),
        ("<article><p>one<p class=ad>buy<p>two</article>", "one two"),
        ("<article>x<aside>side</aside>y<form>name <input></form>z</article><div>out</div>", "x y z"),
        ("<form><article>all in a form</article></form>", "all in a form"),
        ("<div id='entry-content'>text</div><div id='main-nav'>nav</div>", "text"),
        ("<div hidden>secret</div><article>seen</article>", "seen"),
        ("<article title='a>b'>quoted</article>", "quoted"),
        ("</div></article><article>a</div>b</article>", "a b"),
    ],
)
def test_cases(page, want):
    assert text(page) == want


def test_pages_without_declared_parts():
    menu = "<ul>" + "".join(f"<li><a href='/{i}'>Topic {i}</a></li>" for i in range(8)) + "</ul>"
    page = f"<body><div>{menu}</div><div><h1>A title of the story</h1><p>{LONG}</p><p>Short one.</p><p>{LONG}</p></div><div><a href=/>Home</a> <a href=/x>Contact</a></div></body>"
    assert text(page) == f"A title of the story {LONG} Short one. {LONG}"


def test_deep_and_long_pages():
    assert text("<div>" * 20_000 + "<article>deep</article>" + "</b></div>" * 20_000) == "deep"
    assert len(text("<article>" + "word " * 300_000 + "</article>")) == 5 * 300_000 - 1
    assert text("<article>" + "<a href='" * 2000) == ""


def test_odd_rows(spark):
    rows = spark.createDataFrame([(1, None, None, "x"), (1, "u", "", "y"), (None, "u", "<article>a</article>", "z")], "page_id bigint, url string, html string, text string")
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in H.extract(rows).collect()) == [(0, "a", 1), (1, "", 0), (1, "", 0)]
    assert H.extract(rows.limit(0)).count() == 0
    assert isinstance(H.grow(np.zeros((3, 2)), np.array([0, 1, 1])), int)
    copies = rows.unionByName(rows)
    assert H.extract(copies).count() == 6
