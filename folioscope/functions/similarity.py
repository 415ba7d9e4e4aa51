"""Similarity of two texts by matching blocks, and their first difference; Arrow UDFs.

Texts of any length are compared whole, in time that grows with their length.
The ratio goes by positional blocks of BLOCK characters, each by the standard
library's matcher.  The first difference is what that matcher's alignment of the
whole texts begins with, found without making the rest of the alignment: the
longest match of a range, then that of the range before it, and so on, all from
one suffix automaton of the right text.
"""

from __future__ import annotations

from collections import Counter
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Block length, and the characters shown around a difference.
BLOCK, CONTEXT = 8_000, 60
# Fixed values of the matcher: texts of so many characters have popular characters, of more than this share, which begin no match.
POPULAR_FROM, POPULAR_SHARE = 200, 100


def ratio(a: str, b: str) -> float:
    """1 for equal texts; else the mean ratio of positional blocks, weighted by their length."""
    if a == b:
        return 1.0
    size = max(len(a), len(b))
    pieces = [(a[i : i + BLOCK], b[i : i + BLOCK]) for i in range(0, size, BLOCK)]
    weights = [max(len(x), len(y)) for x, y in pieces]
    scores = [1.0 if x == y else SequenceMatcher(None, x, y).ratio() for x, y in pieces]
    return sum(s * w for s, w in zip(scores, weights, strict=True)) / sum(weights)


class _Matches:
    """Longest matches of characters that aren't popular between a text and ranges of b that begin at `start`.

    A suffix automaton; of each state the earliest end of its strings is kept,
    which tells whether one lies before a range's end.
    """

    def __init__(self, b: str, start: int, stop: int, popular: frozenset):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length, self.first, self.popular = [-1], [0], [start], popular
        last = 0
        for at in range(start, stop):
            c = b[at]
            last = 0 if c in popular else self._add(last, c, at + 1)

    def _new(self, edges: dict, link: int, length: int, first: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.link) - 1

    def _add(self, last: int, c: str, end: int) -> int:
        known = self.next[last].get(c)
        if known is not None:
            # After a popular character strings begin anew, and may be there.
            return known if self.length[known] == self.length[last] + 1 else self._copy(last, c, known)
        own = self._new({}, 0, self.length[last] + 1, end)
        while last >= 0 and c not in self.next[last]:
            self.next[last][c] = own
            last = self.link[last]
        if last >= 0:
            known = self.next[last][c]
            self.link[own] = known if self.length[known] == self.length[last] + 1 else self._copy(last, c, known)
        return own

    def _copy(self, last: int, c: str, known: int) -> int:
        short = self._new(dict(self.next[known]), self.link[known], self.length[last] + 1, self.first[known])
        self.link[known] = short
        while last >= 0 and self.next[last].get(c) == known:
            self.next[last][c] = short
            last = self.link[last]
        return short

    def longest(self, a: str, low: int, high: int, stop: int) -> tuple[int, int, int]:
        """(start in a, start in b, length) of the longest match of a[low:high] before `stop` in b, the earliest in a and then in b; length 0 if there is none."""
        state = size = 0
        best, best_i, best_j = 0, low, 0
        first, link, length, edges, popular = self.first, self.link, self.length, self.next, self.popular
        for i in range(low, high):
            c = a[i]
            if c in popular:
                state = size = 0
                continue
            while state and not ((to := edges[state].get(c)) is not None and first[to] <= stop):
                state = link[state]
                size = min(size, length[state])
            to = edges[state].get(c)
            if to is None or first[to] > stop:
                state = size = 0
                continue
            state, size = to, size + 1
            if size > best:
                best, best_i, best_j = size, i + 1 - size, first[state] - size
        return best_i, best_j, best


def first_gap(a: str, b: str) -> tuple[int, int, int, int] | None:
    """(i, j, k, m): a[i:j] and b[k:m] are the first stretches that the alignment of both texts doesn't match; null for equal texts."""
    if a == b:
        return None
    counts = Counter(b) if len(b) >= POPULAR_FROM else Counter()
    popular = frozenset(c for c, n in counts.items() if n > len(b) // POPULAR_SHARE + 1)

    def leftmost(i0: int, i1: int, j0: int, j1: int) -> list[tuple[int, int, int]]:
        """The longest match of a range, the longest before it, and so on to the first."""
        found = []
        matches = _Matches(b, j0, j1, popular) if i0 < i1 and j0 < j1 else None
        while i0 < i1 and j0 < j1:
            i, j, n = matches.longest(a, i0, i1, j1)
            # Popular characters go on with a match; without one, with what the ranges both begin with.
            if not n:
                i, j = i0, j0
            end_i, end_j = i + n, j + n
            while i > i0 and j > j0 and a[i - 1] == b[j - 1]:
                i, j = i - 1, j - 1
            while end_i < i1 and end_j < j1 and a[end_i] == b[end_j]:
                end_i, end_j = end_i + 1, end_j + 1
            if end_i == i:
                break
            found.append((i, j, end_i - i))
            i1, j1 = i, j
        return found

    chain = leftmost(0, len(a), 0, len(b))
    i = j = 0
    if chain and chain[-1][:2] == (0, 0):
        i = j = chain.pop()[2]
        while chain and chain[-1][:2] == (i, j):
            n = chain.pop()[2]
            i, j = i + n, j + n
        end_i, end_j = chain[-1][:2] if chain else (len(a), len(b))
        inner = leftmost(i, end_i, j, end_j)
        end_i, end_j = inner[-1][:2] if inner else (end_i, end_j)
    else:
        end_i, end_j = chain[-1][:2] if chain else (len(a), len(b))
    return i, end_i, j, end_j


def difference(a: str, b: str) -> dict[str, str | None]:
    """The first differing stretch of both texts with its surroundings; null for equal texts."""
    gap = first_gap(a, b)
    if gap is None:
        return {"left": None, "right": None}
    i, j, k, m = gap
    return {"left": a[max(0, i - CONTEXT) : j + CONTEXT], "right": b[max(0, k - CONTEXT) : m + CONTEXT]}


def text_ratio(a: str | Column, b: str | Column) -> Column:
    @F.pandas_udf(T.DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return run(a, b)


def first_difference(a: str | Column, b: str | Column) -> Column:
    @F.pandas_udf(T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())]))
    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([difference(x or "", y or "") for x, y in zip(a, b, strict=True)], columns=["left", "right"])

    return run(a, b)


def letters(text: str | Column, n: int = 32) -> Column:
    """How many of a text's characters fall into each of n classes."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def run(text: pd.Series) -> pd.Series:
        return pd.Series([np.bincount(np.frombuffer((x or "").encode("utf-32-le"), "<u4") % n, minlength=n).astype(np.int32) for x in text])

    return run(text)
