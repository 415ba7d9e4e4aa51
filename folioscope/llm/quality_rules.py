"""Quality rules as a short-circuit cascade.

Each rule looks at statistics of one text, which are computed when first asked
for.  On a bounded sample every rule is timed alone and its verdicts are noted;
rules are then ordered greedily by the share of the remaining sample they reject
per second.  A document goes through the rules in that order until one rejects
it, so later statistics aren't computed for it.  The order changes the cost
only, never the verdict, which is that no rule rejects.

Defined results: a null text counts as empty and has no words; texts of fewer
than ten words are rejected.  Repeated rows each get a row, ties in the order
go to the rule listed first, and an empty table gives no rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import filter_texts, map_texts

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
REPEAT_WIDTH = 5
#: Rows of the sample on which rules are measured.
SAMPLE_ROWS = 2000

_NOT_COUNTED = SPACES + bytes(range(0x80, 0xC0))
_UPPER, _LETTERS = bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123)])


class Stats:
    """Statistics of one text in UTF-8, each computed when first read."""

    def __init__(self, raw: bytes):
        self.raw = raw

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.raw.translate(None, _NOT_COUNTED))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, SYMBOLS))

    @cached_property
    def n_upper(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, _UPPER))

    @cached_property
    def n_letters(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, _LETTERS))

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines with a word."""
        return [x for x in self.raw.split(b"\n") if x.strip(SPACES)]

    @cached_property
    def n_lines(self) -> int:
        return len(self.lines)

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        return repeated_words(self.words)


def repeated_words(words: list[bytes], width: int = REPEAT_WIDTH) -> int:
    """Words that lie in a window of `width` words found twice or more; compared exactly, by ranks."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ranks: dict[bytes, int] = {}
    own = np.fromiter([ranks.setdefault(w, len(ranks)) for w in words], np.int64, len(words))
    base = bound = len(ranks)
    keys = own[:n]
    for j in range(1, width):
        if bound * base >= 1 << 62:
            known, keys = np.unique(keys, return_inverse=True)
            bound = len(known)
        keys = keys * base + own[j : j + n]
        bound *= base
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(keys, twice))
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + width, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Stats], bool]


#: The two base rules, then the rules that this method adds.
BASE = (
    Rule("few_words", lambda s: s.n_words < 10),
    Rule("repeated_words", lambda s: 100 * s.n_repeat_words > 20 * s.n_words),
)
RULES = (
    *BASE,
    Rule("symbols", lambda s: 10 * s.n_symbols > s.word_chars),
    Rule("repeated_lines", lambda s: 100 * s.n_dup_lines > 50 * s.n_lines),
    Rule("long_words", lambda s: s.word_chars > 20 * s.n_words),
    Rule("capitals", lambda s: 100 * s.n_upper > 70 * s.n_letters and s.n_letters >= 10),
)


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> tuple[list[float], np.ndarray]:
    """Mean seconds of each rule, and a verdict matrix (row, rule), over a sample of about `rows` rows.

    Rows are picked by a hash of key and text; where equal rows are so many that
    more than twice as many are picked, the sample is cut there, which like the
    sample as a whole bears on the order only.
    """
    total = docs.count()
    share = min(1.0, rows / max(total, 1))
    hashed = F.pmod(F.xxhash64(key, text, F.lit("rules")), F.lit(1 << 30))
    picked = docs.where(hashed < int(share * (1 << 30)) + 1).select(F.lit(0).alias("k"), text).limit(2 * rows)

    def run(texts: list[bytes]) -> list:
        seconds, verdicts = [], []
        for t in texts:
            own, found = [], []
            for rule in rules:
                began = time.perf_counter()
                found.append(rule.rejects(Stats(t)))
                own.append(time.perf_counter() - began)
            seconds.append(own)
            verdicts.append(found)
        return [pa.array(seconds, pa.list_(pa.float64())), pa.array(verdicts, pa.list_(pa.bool_()))]

    got = map_texts(picked, ["k"], text, run, "k int, seconds array<double>, verdicts array<boolean>").select("seconds", "verdicts").collect()
    if not got:
        return [0.0] * len(rules), np.zeros((0, len(rules)), bool)
    return np.mean([r.seconds for r in got], axis=0).tolist(), np.array([r.verdicts for r in got], bool)


def cascade_order(seconds: list[float], verdicts: np.ndarray) -> list[int]:
    """Rules by rejection per second among the rows that the rules before let pass."""
    left, order, alive = list(range(len(seconds))), [], np.ones(len(verdicts), bool)
    while left:
        rows = max(1, int(alive.sum()))
        best = max(left, key=lambda i: (verdicts[alive, i].sum() / rows / max(seconds[i], 1e-9), -i))
        order.append(best)
        left.remove(best)
        alive &= ~verdicts[:, best]
    return order


def first_rejection(stats: Stats, rules: list[Rule]) -> str | None:
    """The rule that ends the cascade, if any."""
    return next((r.name for r in rules if r.rejects(stats)), None)


def ordered(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> list[Rule]:
    return [rules[i] for i in cascade_order(*measure(docs, rules, key, text))]


def cascade(docs: DataFrame, keys: list[str | Column], text: str = "text", key: str = "doc_id", rules: tuple[Rule, ...] = RULES, schema: str = "doc_id bigint") -> DataFrame:
    """(keys, rejected_by string, kept boolean); schema gives the keys' names and types."""
    chain = ordered(docs, rules, key, text)

    def run(texts: list[bytes]) -> list:
        by = [first_rejection(Stats(t), chain) for t in texts]
        return [pa.array(by, pa.string()), pa.array([x is None for x in by], pa.bool_())]

    return map_texts(docs, keys, text, run, f"{schema}, rejected_by string, kept boolean")


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The cascade's verdict beside the base statistics of every row.

    (key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept)
    """
    chain = ordered(docs, rules, key, text)
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(texts: list[bytes]) -> list:
        own, failed, kept = [], [], []
        for t in texts:
            stats = Stats(t)
            kept.append(first_rejection(stats, chain) is None)
            failed.append(any(r.rejects(stats) for r in BASE))
            own.append([getattr(stats, c) for c in columns])
            if failed[-1]:
                kept[-1] = False
        return [*[pa.array(c, pa.int64()) for c in zip(*own, strict=True)], pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_())]

    return map_texts(docs, [key], text, run, f"{key} {docs.schema[key].dataType.simpleString()}, {', '.join(c + ' bigint' for c in columns)}, base_failed boolean, kept boolean")


def keep(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows, with all their columns, that no rule rejects; each text stops at its first rejection."""
    chain = ordered(docs, rules, key, text)
    return filter_texts(docs, text, lambda texts: [first_rejection(Stats(t), chain) is None for t in texts])
