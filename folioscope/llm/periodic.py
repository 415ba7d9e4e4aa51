"""Runs of a text whose words repeat with a period, and the text without the repeats.

A run is a longest stretch of words in which words p apart are equal, p being
the smallest such period, of max(LEAST, FOLD * p) words at least.  Words become
numbers, equal exactly where the words are.

For each period p only the words of the grid 0, p, 2p, ... are compared with
their next neighbours on it, which is a harmonic sum of n log n tests.  A run of
period p has at least max(LEAST, FOLD * p) - p matches in a row, so so many
neighbouring grid points match, and all words between them.  Points that pass
are extended both ways by comparing chunks of doubling length until a mismatch.
Grid points inside a run found before, whose period divides p, are skipped, as
their stretch is that run; this keeps the work near n log n on texts that are
one long repeat.  Periods up to the root of n are tested one after the other,
each over its whole grid; longer ones in blocks of a factor of two, each step j
for all periods of the block at once.

Defined results: a null or empty text has no words and no runs.  Repeated rows
each get a row.  A text is one task's; memory is some numbers a word.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_texts

#: The least words of a run, and the least times its period that it is long.
LEAST, FOLD = 24, 3
_CHUNK = 64


def numbers(words: list[bytes]) -> np.ndarray:
    """Numbers that are equal exactly where the words are."""
    table = dict.fromkeys(words)
    for i, w in enumerate(table):
        table[w] = i
    return np.fromiter(map(table.__getitem__, words), np.int32, len(words))


def _forward(x: np.ndarray, at: int, p: int) -> int:
    """The first position from `at` on that doesn't match its neighbour p later, or the last possible one's end."""
    end, step = len(x) - p, _CHUNK
    while at < end:
        stop = min(end, at + step)
        differ = x[at:stop] != x[at + p : stop + p]
        first = int(differ.argmax())
        if differ[first]:
            return at + first
        at, step = stop, 2 * step
    return end


def _backward(x: np.ndarray, at: int, p: int) -> int:
    """The first position of the matches that end before `at`."""
    step = _CHUNK
    while at > 0:
        start = max(0, at - step)
        differ = x[start:at] != x[start + p : at + p]
        last = int(differ[::-1].argmax())
        if differ[len(differ) - 1 - last]:
            return at - last
        at, step = start, 2 * step
    return 0


class _Search:
    def __init__(self, x: np.ndarray, least: int, fold: int):
        self.x, self.least, self.fold = x, least, fold
        self.found: dict[tuple[int, int], int] = {}
        #: By period, (-length, start) of its runs, longest first.
        self.by: dict[int, list[tuple[int, int]]] = {}

    def matches(self, p: int) -> int:
        """Matches in a row that a run of period p has at least."""
        return max(self.least, self.fold * p) - p

    def inside(self, p: int) -> Iterator[tuple[int, int]]:
        """[start, end) of the positions that match at p within runs of a period that divides p."""
        need = self.matches(p) + p
        for q, runs in self.by.items():
            if p % q == 0 and p != q:
                for n, start in runs:
                    if -n < need:
                        break
                    yield start, start - n - p

    def settle(self, p: int, points: np.ndarray) -> None:
        """Extend ascending grid points of period p that head enough matching points."""
        x, need = self.x, self.matches(p)
        for start, end in self.inside(p):
            points = points[(points < start) | (points >= end)]
        # All words up to the last of the matching points match; a few places tell most others off.
        span = (need // p - 1) * p
        for share in (2, 4, 3, 8, 5, 7):
            if len(points) < 4:
                break
            at = points + span // share
            points = points[x[at] == x[at + p]]
        reach = -1
        for g in points.tolist():
            if g < reach:
                continue
            reach = _forward(x, g, p)
            if reach - g < p and reach - g < need:
                continue  # Not to the next grid point.
            start = _backward(x, g, p)
            if reach - start >= need and (start, reach + p) not in self.found:
                self.found[start, reach + p] = p
                insort(self.by.setdefault(p, []), (start - reach - p, start))

    def run(self) -> None:
        x, n = self.x, len(self.x)
        longest = n // self.fold if n >= self.least else 0
        root = min(longest, max(self.least, int(n**0.5)))
        for p in range(1, root + 1):
            grid = x[::p]
            same = grid[:-1] == grid[1:]
            k = self.matches(p) // p
            if len(same) < k:
                continue
            if k == 2:
                heads = np.flatnonzero(same[:-1] & same[1:])
            else:
                sums = np.cumsum(np.r_[0, same])
                heads = np.flatnonzero(sums[k:] - sums[:-k] == k)
            if len(heads):
                self.settle(p, heads * p)
        low = root + 1
        while low <= longest:
            self._block(low, min(longest + 1, 2 * low))
            low *= 2

    def _block(self, low: int, high: int) -> None:
        """All periods in [low, high), step by step of their grids."""
        x, n, k = self.x, len(self.x), self.fold - 1
        periods, points = [], []
        streak = np.zeros(high - low, np.int8)
        j = 0
        while (j + 1) * low < n:
            # Periods whose next grid point still lies in the text.
            top = min(high, (n - 1) // (j + 1) + 1)
            same = x[j * low : j * (top - 1) + 1 : j or 1] == x[(j + 1) * low : (j + 1) * (top - 1) + 1 : j + 1] if j else x[0] == x[low:top]
            streak = np.where(same, np.minimum(streak[: top - low] + 1, k), 0).astype(np.int8)
            full = np.flatnonzero(streak == k)
            if len(full):
                periods.append(full + low)
                points.append((full + low) * (j + 1 - k))
            j += 1
        if not periods:
            return
        p, g = np.concatenate(periods), np.concatenate(points)
        # Halfway between the first two matching points is a match as well.
        at = g + p // 2
        kept = x[at] == x[at + p]
        p, g = p[kept], g[kept]
        order = np.lexsort((g, p))
        p, g = p[order], g[order]
        cuts = [0, *(np.flatnonzero(p[1:] != p[:-1]) + 1).tolist(), len(p)]
        for a, b in pairwise(cuts):
            if a < b:
                self.settle(int(p[a]), g[a:b])


def runs(words: list[bytes], least: int = LEAST, fold: int = FOLD) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and then period; fold is 3 or more."""
    if fold < 3:
        raise ValueError("a run needs three periods or more")
    if len(words) < least:
        return []
    search = _Search(numbers(words), least, fold)
    search.run()
    return sorted((a, b - a, p) for (a, b), p in search.found.items())


def kept(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each of n words stays when every run is cut to its first period."""
    out = np.ones(n, bool)
    for start, length, period in found:
        out[start + period : start + length] = False
    return out


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length for its period, compared exactly; of equal ones the first, and then the shortest period."""
    best = None
    for start, length, period in found:
        if best is None or length * best[2] > best[1] * period:
            best = start, length, period
    return best


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, fold: int = FOLD, reword: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per document: (key, n_words, runs, strongest, collapsed).

    collapsed has the words that stay, joined by one space.  reword, if given,
    makes another list of words of a key and its text's words first.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(texts: list[bytes], keys: list) -> list:
        n, every, best, left = [], [], [], []
        for own, t in zip(keys, texts, strict=True):
            words = t.split()
            if reword:
                words = reword(own, words)
            found = runs(words, least, fold)
            n.append(len(words))
            every.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found])
            top = strongest(found)
            best.append(top and dict(zip(("start", "length", "period"), top, strict=True)))
            if found:
                words = [words[i] for i in np.flatnonzero(kept(len(words), found)).tolist()]
            left.append(b" ".join(words))
        return [pa.array(n, pa.int64()), pa.array(every, pa.list_(_RUN)), pa.array(best, _RUN), pa.array(left, pa.binary()).cast(pa.string())]

    one = "struct<start:bigint,length:bigint,period:bigint>"
    return map_texts(docs, [key], text, run, f"{key} {kind}, n_words bigint, runs array<{one}>, strongest {one}, collapsed string", with_keys=True)
