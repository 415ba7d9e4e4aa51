"""Packing of token sequences by minimum bin slack.

A document's tokens are cut into full windows of `capacity` tokens, each a
sequence of its own, and a tail.  How many tails there are of each length, at
most `capacity` numbers, is all that the plan needs: window by window, the
longest tail left is put in, and a bitset of reachable sums over the multiset of
the other lengths, the counts as powers of two, picks what fills the window
closest to its capacity; the counts are traced back through the bitsets.  A
window's multiset is used as often as the counts allow, so that the plan is some
thousand patterns however many tails there are.

Where no sum fits exactly, one more tail is cut at the slack, and the rest of it
goes back to the lengths.  When less than a window is left, the capacity falls
to powers of two, which need no padding either.  So no sequence is padded.

Tails get their places without meeting in a task: rows of a few numbers are
sorted by tail length over ranges, a row's rank says which use of which pattern
it has, and the plan's slots, which are broadcast, say where.  Documents are
tokenised once; only tails that the plan cuts are tokenised again, for the
checksums of their parts.

Token ids come from a byte-level BPE file of the tokenizers library, whose
merges are numbered in their order, so that its vocabulary serves as ranks for
the faster tiktoken; special tokens' strings are ordinary text.

Defined results: a null or empty text has the end id only.  Repeated rows each
get their pieces, of one document each.  An empty table gives no rows.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, fresh, limit_batches, located
from .sharding import numbered

CAPACITY, END = 2048, 1
#: Documents with cut tails that are broadcast.
CUT_ROWS = 1_000_000

_loaded: dict[tuple[str, str], Callable[[str], list[int]]] = {}


def encoder(path: str, pattern: str) -> Callable[[str], list[int]]:
    """The ids of a text, by one encoder for each vocabulary and worker process."""
    if (path, pattern) not in _loaded:
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        own = {b: chr(b) for b in (*range(33, 127), *range(161, 173), *range(174, 256))}
        # A byte without a character of its own has the next one from 256 on.
        own |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in own)}
        byte = {c: b for b, c in own.items()}
        order = [vocabulary[a + b] for a, b in merges]
        if order != sorted(order) or len(order) + 256 != len(vocabulary):
            raise ValueError(f"{path}: the merges aren't numbered in their order")
        ranks = {bytes(byte[c] for c in token): rank for token, rank in vocabulary.items()}
        _loaded[path, pattern] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return _loaded[path, pattern]


def as_bytes(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def fill(lengths: list[tuple[int, int]], target: int) -> tuple[int, dict[int, int]]:
    """The greatest sum up to target of a multiset of (length, count), longest first, and how many of each length it takes."""
    reach, mask = 1, (1 << (target + 1)) - 1
    before: list[tuple[int, int]] = []
    for length, count in lengths:
        if length > target:
            continue
        before.append((length, reach))
        left, step = min(count, target // length), 1
        while left:
            step = min(step, left)
            reach |= reach << (step * length) & mask
            left -= step
            step *= 2
        if reach >> target & 1:
            break
    best = at = reach.bit_length() - 1
    need = {}
    for length, own in reversed(before):
        k = 0
        while not own >> at & 1:
            at -= length
            k += 1
        if k:
            need[length] = k
    return best, need


class Plan:
    """Where the tails go.

    counts[l] is the number of tails of length l; ranks run over all tails by
    length.  A level's slots are arrays by ascending first rank: ranks
    [low, low + n) have, from `at` on, `length` tokens in sequence
    base + t // each at offset + t % each * length, t being first + rank - low.
    Level 0 has a slot for every rank, each further level for those cut before.
    """

    FIELDS = ("low", "n", "at", "length", "first", "each", "base", "offset")

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity, self.sequences, self.cut_rows = capacity, 0, 0
        self.lengths: list[int] = []
        self._slots: list[list[tuple[int, ...]]] = []
        #: By length, (low, n, at, level) of the tails or rests that have it.
        pool: dict[int, deque] = {}
        left: dict[int, int] = {}
        low = 0
        for length in sorted(counts):
            if counts[length]:
                pool[length], left[length] = deque([(low, counts[length], 0, 0)]), counts[length]
                low += counts[length]
        total = sum(k * n for k, n in left.items())
        while total:
            window = capacity if total >= capacity else 1 << (total.bit_length() - 1)
            total -= window * self._fill(pool, left, window, total // window if window == capacity else 1)
        self.levels = [{f: np.array(c, np.int64) for f, c in zip(self.FIELDS, zip(*sorted(level), strict=True), strict=True)} for level in self._slots]

    def _fill(self, pool: dict[int, deque], left: dict[int, int], window: int, most: int) -> int:
        """Use one multiset as often as it goes; how often that is."""
        order = sorted(left, reverse=True)
        seed = next((k for k in order if k <= window), None)
        need: dict[int, int] = {}
        got = 0
        if seed:
            rest = [(k, left[k] - (k == seed)) for k in order if k <= window - seed and left[k] > (k == seed)]
            got, need = fill(rest, window - seed)
            got += seed
            need[seed] = need.get(seed, 0) + 1
        slack, cut = window - got, 0
        uses = dict(need)
        if slack:
            # All that is left over is longer than the slack.
            cut = next(k for k in order if left[k] > need.get(k, 0))
            uses[cut] = uses.get(cut, 0) + 1
        times = min(most, *(left[k] // n for k, n in uses.items()))
        offset = 0
        for length in sorted(need, reverse=True):
            self._take(pool, left, length, length, need[length], times, offset)
            offset += need[length] * length
        if cut:
            self._take(pool, left, cut, slack, 1, times, offset)
        self.sequences += times
        return times

    def _take(self, pool: dict[int, deque], left: dict[int, int], length: int, used: int, each: int, times: int, offset: int) -> None:
        first, todo, queue = 0, each * times, pool[length]
        left[length] -= todo
        rests = []
        while todo:
            low, n, at, level = queue.popleft()
            part = min(n, todo)
            if part < n:
                queue.appendleft((low + part, n - part, at, level))
            while len(self._slots) <= level:
                self._slots.append([])
            self._slots[level].append((low, part, at, used, first, each, self.sequences, offset))
            if used < length:
                rests.append((low, part, at + used, level + 1))
                self.cut_rows += part * (level == 0)
            first, todo = first + part, todo - part
        if not queue:
            del pool[length], left[length]
        if rests:
            pool.setdefault(length - used, deque()).extend(rests)
            left[length - used] = left.get(length - used, 0) + sum(r[1] for r in rests)

    def places(self, ranks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each level (which of the ranks, start, length, sequence, offset)."""
        for level in self.levels:
            i = np.searchsorted(level["low"], ranks, side="right") - 1
            own = np.flatnonzero((i >= 0) & (ranks < level["low"][i] + level["n"][i]))
            if not len(own):
                continue
            i = i[own]
            t = level["first"][i] + ranks[own] - level["low"][i]
            yield own, level["at"][i], level["length"][i], level["base"][i] + t // level["each"][i], level["offset"][i] + t % level["each"][i] * level["length"][i]


_PIECES = "array<struct<start:bigint,length:bigint,crc:bigint,sequence:bigint,offset:bigint>>"


def pack(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END, cut_rows: int = CUT_ROWS) -> DataFrame:
    """One row per piece: (key, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    A document's tokens are its text's ids and the end id.  path is a byte-level
    vocabulary file of the tokenizers library, and pattern cuts its pre-tokens.
    """
    limit_batches(docs.sparkSession)
    file, row = fresh("__file", [key, text]), fresh("__row", [key, text])
    placed = located(docs.select(key, text), file, row).select(F.col(file).alias("f"), F.col(row).alias("r"), F.col(key).alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    kind = docs.schema[key].dataType.simpleString()
    width = 4 * capacity

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = encoder(path, pattern)
        for batch in batches:
            n, full, tail = [], [], []
            for t in batch.column(3).to_pylist():
                ids = as_bytes([*by(t), end])
                whole = len(ids) // width * width
                n.append(len(ids) // 4)
                full.append([zlib.crc32(ids[i : i + width]) for i in range(0, whole, width)])
                tail.append(zlib.crc32(ids[whole:]))
            n = np.array(n, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n), pa.array(n // capacity), pa.array(n % capacity), pa.array(full, pa.list_(pa.int64())), pa.array(tail, pa.int64())], names=["f", "r", "k", "n", "n_full", "tail", "full_crcs", "tail_crc"])

    rows = checkpointed(placed.mapInArrow(tokenised, f"f bigint, r bigint, k {kind}, n bigint, n_full bigint, tail bigint, full_crcs array<bigint>, tail_crc bigint"))
    counts, alone, n_full = {}, 0, 0
    for length, of, whole in rows.groupBy("tail").agg(F.count("*"), F.sum("n_full")).collect():
        n_full += whole
        if length:
            counts[length] = of
        else:
            alone = of
    plan = Plan(counts, capacity)
    sent = docs.sparkSession.sparkContext.broadcast(plan)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["f", "r", "k", "n", "n_full", "full_crcs", "tail_crc", "places"]
        for batch in batches:
            column = dict(zip(batch.schema.names, batch.columns, strict=True))
            ranks = column["rank"].to_numpy() - alone
            places: list[list] = [[] for _ in range(len(ranks))]
            for which, *values in sent.value.places(ranks):
                for i, *place in zip(which.tolist(), *(v.tolist() for v in values), strict=True):
                    places[i].append(dict(zip(("at", "length", "sequence", "offset"), place, strict=True)))
            kinds = pa.list_(pa.struct([(x, pa.int64()) for x in ("at", "length", "sequence", "offset")]))
            yield pa.RecordBatch.from_arrays([*(column[x] for x in names[:-1]), pa.array(places, kinds), column["before"]], names=[*names, "before"])

    ranked = numbered(rows, ["tail", "f", "r"], "n_full")
    known = ranked.mapInArrow(assigned, f"f bigint, r bigint, k {kind}, n bigint, n_full bigint, full_crcs array<bigint>, tail_crc bigint, places array<struct<at:bigint,length:bigint,sequence:bigint,offset:bigint>>, before bigint")
    if plan.cut_rows:
        known = checkpointed(known)
    base = F.col("n_full") * capacity
    full = F.transform("full_crcs", lambda c, i: F.struct((i * capacity).cast("bigint").alias("start"), F.lit(capacity).cast("bigint").alias("length"), c.alias("crc"), (F.col("before") + i).alias("sequence"), F.lit(0).cast("bigint").alias("offset")))
    whole = F.transform("places", lambda p: F.struct((base + p["at"]).alias("start"), p["length"].alias("length"), F.col("tail_crc").alias("crc"), (p["sequence"] + n_full).alias("sequence"), p["offset"].alias("offset")))
    is_cut = F.size("places") > 1
    pieces = known.select("k", "n", F.concat(full, F.when(~is_cut, whole).otherwise(F.array().cast(_PIECES))).alias("pieces"))
    if plan.cut_rows:
        cuts = known.where(is_cut).select(F.col("f").alias("cf"), F.col("r").alias("cr"), F.col("n_full").alias("first"), "places")
        if plan.cut_rows <= cut_rows:
            cuts = F.broadcast(cuts)

        def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            by = encoder(path, pattern)
            for batch in batches:
                n, out = [], []
                for t, first, own in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                    ids = as_bytes([*by(t), end])
                    n.append(len(ids) // 4)
                    starts = [first * capacity + p["at"] for p in own]
                    out.append([{"start": s, "length": p["length"], "crc": zlib.crc32(ids[4 * s : 4 * (s + p["length"])]), "sequence": p["sequence"] + n_full, "offset": p["offset"]} for s, p in zip(starts, own, strict=True)])
                one = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "crc", "sequence", "offset")]))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(out, one)], names=["k", "n", "pieces"])

        joined = placed.join(cuts, (F.col("f") == F.col("cf")) & (F.col("r") == F.col("cr")))
        pieces = pieces.unionByName(joined.select("k", "t", "first", "places").mapInArrow(again, f"k {kind}, n bigint, pieces {_PIECES}"))
    one = pieces.select("k", "n", F.explode("pieces").alias("p"))
    return one.select(F.col("k").alias(key), F.col("p.start").alias("start"), F.col("p.length").alias("length"), F.col("p.crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"), F.col("p.sequence").alias("sequence_id"), F.col("p.offset").alias("offset"))
