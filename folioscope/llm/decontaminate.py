"""Benchmark decontamination by winnowing.

A window is ten consecutive words of a benchmark item; an item of fewer words is
one window.  Winnowing keeps the smallest hash of the 5-word grams in each run of
six neighbouring grams, which is one fingerprint for every ten-word window, so
any shared span of ten words has a fingerprint in common.  Documents are
winnowed the same way, their fingerprints are joined with those of the
benchmark, and each hit is extended to the whole window, compared word by word.
A shorter item of L words is winnowed with grams of min(5, L) words, so that it
too is one fingerprint.

A benchmark of up to BLOCK_ROWS windows, which are counted first, is sent to the
executors whole, so documents are read once and not shuffled.  A larger one
stays a table: a bitmap of its fingerprints, of bounded size, is sent, documents
give the windows whose fingerprint it may hold, one row each, and these are
joined with the benchmark's; windows of very many documents are joined apart, so
that they don't meet in one task.  The driver holds the bitmap only.

Defined results: a null or empty text, or one without words, has no hits and the
digest of the empty string.  Items without words give no windows.  An item with
a null id still marks words, but is not listed.  Repeated rows each get a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import checkpointed, drop_rows, filter_texts, fresh, limit_batches, located, map_texts, raw_texts, skew_join

SPAN, GRAM = 10, 5
#: Windows of a benchmark that is sent whole, some 40 MB in a Python worker; bits of a larger one's bitmap at most; and suspect windows that a worker puts out at once.
BLOCK_ROWS, FILTER_BITS, SUSPECTS = 200_000, 1 << 27, 10_000

#: Keeps a-z, 0-9 and bytes of other scripts, lower-cases A-Z, and turns the rest to spaces.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

_MIX, _END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(WORD_BYTES).split()


def windows_of(raw: bytes, span: int = SPAN) -> list[list[bytes]]:
    """An item's windows."""
    words = words_of(raw)
    return [words[i : i + span] for i in range(max(1, len(words) - span + 1))] if words else []


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _grams(h: np.ndarray, k: int) -> np.ndarray:
    """Well mixed hashes of k consecutive word hashes."""
    n = len(h) - k + 1
    out = h[:n].copy()
    for j in range(1, k):
        out *= _MIX
        out += h[j : j + n]
    out ^= out >> np.uint64(32)
    out *= _END
    return out ^ out >> np.uint64(29)


def _winnow(h: np.ndarray, size: int, gram: int) -> np.ndarray:
    """The kept hash of every run of `size` words."""
    k = min(gram, size)
    g = _grams(h, k)
    n = len(h) - size + 1
    out = g[:n].copy()
    for j in range(1, size - k + 1):
        np.minimum(out, g[j : j + n], out=out)
    return out


def _matches(texts: list[bytes], sizes: list[int], gram: int, known: Callable[[int, np.ndarray], np.ndarray]) -> tuple[list[int], list[list[tuple[int, int, bytes]]]]:
    """For each text its number of words, and (first word, end, window) of every window whose kept hash is known."""
    per = [words_of(t) for t in texts]
    counts = np.array([len(w) for w in per], np.int64)
    out: list[list[tuple[int, int, bytes]]] = [[] for _ in texts]
    flat = list(chain.from_iterable(per))
    if flat:
        h, ends = _hashes(flat), np.cumsum(counts)
        for size in sizes:
            if len(flat) < size:
                continue
            own = _winnow(h, size, gram)
            # Neighbouring windows mostly keep the same hash; look each up once.
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            found = known(size, own[first])
            until = np.r_[first[1:], len(own)]
            for a, b in zip(first[found].tolist(), until[found].tolist(), strict=True):
                for s in range(a, b):
                    d = int(np.searchsorted(ends, s, side="right"))
                    if s + size <= ends[d]:
                        base = int(ends[d] - counts[d])
                        out[d].append((s - base, s - base + size, b" ".join(flat[s : s + size])))
    return counts.tolist(), out


class Block:
    """A bounded benchmark's windows: {size: (sorted fingerprints, {window: item ids})}."""

    def __init__(self, rows: list[tuple[bytes, str | None]], gram: int = GRAM):
        self.gram = gram
        by_size: dict[int, dict[bytes, set[str]]] = {}
        for window, item in rows:
            items = by_size.setdefault(window.count(b" ") + 1, {}).setdefault(window, set())
            if item is not None:
                items.add(item)
        self.sizes = {size: (np.unique(np.array([_fingerprint(w, gram) for w in known], np.uint64)), known) for size, known in by_size.items()}

    def _known(self, size: int, own: np.ndarray) -> np.ndarray:
        kept = self.sizes[size][0]
        return kept[np.minimum(np.searchsorted(kept, own), len(kept) - 1)] == own

    def scan(self, texts: list[bytes]) -> tuple[list[int], list[list[tuple[int, int]]], list[set[str]]]:
        """For each text its number of words, its hits as (first word, end), and the items hit."""
        counts, found = _matches(texts, list(self.sizes), self.gram, self._known)
        hits: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[set[str]] = [set() for _ in texts]
        for d, own in enumerate(found):
            for a, b, window in own:
                if (listed := self.sizes[b - a][1].get(window)) is not None:
                    hits[d].append((a, b))
                    items[d] |= listed
        return counts, hits, items


def _fingerprint(window: bytes, gram: int) -> int:
    words = window.split(b" ")
    return int(_winnow(_hashes(words), len(words), gram)[0])


def _covered(hits: list[tuple[int, int]]) -> int:
    """Words in the union of intervals."""
    total = reach = 0
    for a, b in sorted(hits):
        if b > reach:
            total += b - max(a, reach)
            reach = b
    return total


def _columns(counts: list[int], hits: list[list[tuple[int, int]]], items: list) -> list:
    covered = [_covered(x) for x in hits]
    digests = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]
    return [pa.array(counts, pa.int64()), pa.array(covered, pa.int64()), pa.array([len(x) for x in items], pa.int64()), digests, pa.array([c > 0 for c in covered], pa.bool_())]


_RESULT = "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", span: int = SPAN) -> DataFrame:
    """(window, item) rows, each once."""

    def run(texts: list[bytes]) -> list:
        return [pa.array([[b" ".join(w) for w in windows_of(t, span)] for t in texts], pa.list_(pa.binary()))]

    found = map_texts(benchmark, [F.col(item).cast("string").alias("item")], text, run, "item string, windows array<binary>")
    return found.select(F.explode("windows").alias("window"), "item").distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", span: int = SPAN, gram: int = GRAM, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per document: (key, n_words, n_hit, n_items, items_sha256, contaminated)."""
    windows = benchmark_windows(benchmark, item, item_text, span)
    kind = docs.schema[key].dataType.simpleString()
    if (sent := _sent(windows, gram, block_rows)) is not None:
        return map_texts(docs, [key], text, lambda texts: _columns(*sent.value.scan(texts)), f"{key} {kind}, {_RESULT}")
    # Repeated rows have equal hits, which count once.
    scanned, hits = _joined(docs.select(F.col(key).alias("k"), F.col(text).alias("t")), [F.col("k").alias("k"), F.xxhash64("t").alias("digest")], f"k {kind}, digest bigint", windows, gram)
    reach = F.max("b").over(W.partitionBy("k", "digest").orderBy("a", "b").rowsBetween(W.unboundedPreceding, -1))
    new = F.greatest(F.col("b") - F.greatest("a", F.coalesce(reach, F.lit(0))), F.lit(0))
    covered = hits.select("k", "digest", new.alias("new")).groupBy("k", "digest").agg(F.sum("new").alias("n_hit"))
    named = hits.select("k", "digest", F.explode("items").alias("item")).distinct().groupBy("k", "digest").agg(F.array_sort(F.collect_list("item")).alias("items"))
    out = scanned
    for i, more in enumerate((covered, named)):
        own = more.withColumnsRenamed({"k": f"k{i}", "digest": f"digest{i}"})
        out = out.join(own, F.col("k").eqNullSafe(F.col(f"k{i}")) & (F.col("digest") == F.col(f"digest{i}")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(F.col("k").alias(key), "n_words", n_hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def keep(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", span: int = SPAN, gram: int = GRAM, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The rows, with all their columns, that share no window with the benchmark."""
    windows = benchmark_windows(benchmark, item, item_text, span)
    if (sent := _sent(windows, gram, block_rows)) is not None:
        return filter_texts(docs, text, lambda texts: [not h for h in sent.value.scan(texts)[1]])
    file, row = fresh("__file", docs.columns), fresh("__row", docs.columns)
    placed = located(docs, file, row)
    _, hits = _joined(placed.select(F.col(file).alias("f"), F.col(row).alias("r"), F.col(text).alias("t")), ["f", "r"], "f bigint, r bigint", windows, gram)
    return drop_rows(placed, checkpointed(hits.select("f", "r").distinct()), docs.columns)


def _sent(windows: DataFrame, gram: int, block_rows: int):
    """The broadcast block of a benchmark whose windows, counted first, are few enough."""
    if windows.count() > block_rows:
        return None
    return windows.sparkSession.sparkContext.broadcast(Block([(bytes(r.window), r.item) for r in windows.collect()], gram))


def _joined(rows: DataFrame, keys: list, schema: str, windows: DataFrame, gram: int) -> tuple[DataFrame, DataFrame]:
    """(keys, n_words) of all rows of a text column t, and (keys, a, b, items) of their hits, by a join with the table of windows."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_pylist()
            fps = np.array([_fingerprint(w, gram) for w in own], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([w.count(b" ") + 1 for w in own], pa.int32()), pa.array(fps, pa.int64())], names=["window", "items", "size", "fp"])

    # A window's items that have an id; all windows mark words.
    listed = windows.groupBy("window").agg(F.collect_list("item").alias("items"))
    table = checkpointed(listed.mapInArrow(index, "window binary, items array<string>, size int, fp bigint"))
    n = table.count()
    bits = min(FILTER_BITS, 1 << max(6, (16 * n - 1).bit_length()))
    sizes = sorted(r.size for r in table.select("size").distinct().collect())
    # 64 bits a row, so the bitmap that comes to the driver is bounded by FILTER_BITS.
    slot = F.col("fp").bitwiseAND(F.lit(bits - 1))
    parts = table.select(F.shiftright(slot, 6).alias("at"), F.expr(f"shiftleft(1L, cast((fp & {min(bits, 64) - 1}) AS int))").alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    bitmap = np.zeros(max(1, bits >> 6), np.uint64)
    bitmap[parts.column("at").to_numpy()] = parts.column("bit").to_numpy().view(np.uint64)
    sent = rows.sparkSession.sparkContext.broadcast(bitmap)

    def known(_: int, own: np.ndarray) -> np.ndarray:
        at = own & np.uint64(bits - 1)
        return (sent.value[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)

    names = [c.split()[0] for c in schema.split(", ")]
    limit_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row of each text with its number of words as b, and a row of each suspect window."""
        for batch in batches:
            for at in range(batch.num_rows):
                counts, found = _matches(raw_texts(batch.column(len(names)).slice(at, 1)), sizes, gram, known)
                every = [(-1, counts[0], None), *found[0]]
                for start in range(0, len(every), SUSPECTS):
                    part = every[start : start + SUSPECTS]
                    own = [c.take(pa.array([at] * len(part))) for c in batch.columns[: len(names)]]
                    a, b, window = zip(*part, strict=True)
                    yield pa.RecordBatch.from_arrays([*own, pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(window, pa.binary())], names=[*names, "a", "b", "window"])

    emitted = checkpointed(rows.select(*keys, "t").mapInArrow(run, f"{schema}, a bigint, b bigint, window binary"))
    suspects = emitted.where("a >= 0")
    met = suspects.groupBy("window").agg(F.count("*").alias("n")).join(table.select("window", "items"), "window")
    hits = skew_join(suspects, met, "window", "n", suspects.count())
    return emitted.where("a < 0").select(*names, F.col("b").alias("n_words")), hits.select(*names, "a", "b", "items")
