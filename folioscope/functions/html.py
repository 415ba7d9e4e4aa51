"""HTML pages to lines of light Markdown; an Arrow UDF over the standard library's parser.

A page is first recorded as a tape of events, which is then played by a table
that says what opening and closing an element writes.
"""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements that break lines, that hide their content, and that have none; and marks of inline elements.
LINES = frozenset("p div li tr td th table ul ol h1 h2 h3 h4 h5 h6 hr section article header footer nav blockquote pre form fieldset figcaption".split())
HIDDEN = frozenset("script style head noscript iframe svg".split())
EMPTY = frozenset("br img hr meta link base input col wbr embed source track area param".split())
MARKS = {"b": "**", "strong": "**", "i": "*", "em": "*"}

#: What an element writes where it opens and where it closes.
WRITES = {t: ("\n", "\n") for t in LINES} | {t: (m, m) for t, m in MARKS.items()} | {"br": ("\n", "")}
WRITES["hr"] = ("", "\n")

Event = tuple[str, str, dict]


def tape(html: str) -> list[Event]:
    """The page's events: (open, element, attributes), (close, element, {}) and (text, content, {})."""
    events: list[Event] = []
    parser = HTMLParser(convert_charrefs=True)
    parser.handle_starttag = lambda tag, attrs: events.append(("open", tag, dict(attrs)))
    parser.handle_endtag = lambda tag: events.append(("close", tag, {}))
    parser.handle_startendtag = lambda tag, attrs: events.extend([("open", tag, dict(attrs)), ("close", tag, {})][: 1 if tag in EMPTY else 2])
    parser.handle_data = lambda data: events.append(("text", data, {}))
    parser.feed(html)
    parser.close()
    return events


def play(events: list[Event]) -> str:
    """What the events write; a link's words are held back until it closes."""
    out: list[str] = []
    words: list[str] = []
    target = None
    depth = 0
    for kind, what, attributes in events:
        if kind != "text" and what in HIDDEN:
            depth = max(0, depth + (1 if kind == "open" else -1))
        elif kind == "open" and what == "img":
            if attributes.get("src"):
                out.append(f"![{attributes.get('alt') or ''}]({attributes['src']})")
        elif depth and not (kind == "open" and what in EMPTY):
            continue
        elif kind == "text":
            (out if target is None else words).append(what)
        else:
            if what == "a":
                if kind == "close":
                    out.append(_linked(target, words))
                # A link that opens in another drops what that has held.
                target, words = (attributes.get("href") or "", []) if kind == "open" else (None, [])
            out.append(WRITES.get(what, ("", ""))[kind == "close"])
    return "".join([*out, _linked(target, words)])


def _linked(target: str | None, words: list[str]) -> str:
    inner = "".join(words).strip()
    return f"[{inner}]({target})" if target and inner else inner


def page_text(html: str, unescape_twice: bool = False) -> str:
    """Lines with single spaces, no runs of empty lines, none at the ends."""
    text = play(tape(html))
    rows = [re.sub(r"[ \t ]+", " ", row).strip() for row in (unescape(text) if unescape_twice else text).split("\n")]
    kept = [row for i, row in enumerate(rows) if row or i and rows[i - 1]]
    return "\n".join(kept).strip("\n")


@F.pandas_udf(T.StringType())
def html_text(pages: pd.Series) -> pd.Series:
    return pages.map(lambda p: None if p is None else page_text(p))


def page_of_bytes(content: Column | str) -> Column:
    """A captured page's bytes as ISO-8859-1, which any bytes are; null stays null."""
    return F.decode(F.col(content) if isinstance(content, str) else content, "ISO-8859-1")
