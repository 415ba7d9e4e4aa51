"""SimHash near-duplicates: pigeonhole blocks, a join on blocks, then Hamming checks.

A fingerprint has 64 bits; two that differ in at most three agree on at least
one of four blocks.  Every distinct fingerprint goes to its four block buckets,
and a bucket's fingerprints are compared there.  A bucket of more than
BUCKET fingerprints isn't compared: its members are dealt again by four blocks
of the bits that the bucket leaves open, of which a close pair again shares one.
After six levels at most twelve bits are open, so no bucket holds more than
4,096 and the split is exact at any size.  Buckets return a spanning star of
each group of links, never all pairs; `graph.components` joins the stars.

Exact copies have one fingerprint and are gathered before the blocks by an
aggregate with partial results.  Where rows are joined with their component
again, fingerprints and components that hold very many of them are joined apart
(`common.skew_join`).

Defined results: null and empty texts have no words and the fingerprint zero,
which links like any other.  Repeated rows each get a row.  A null id never
names a component: a component of null ids only has a null component_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import DROPPED, LOWER_AZ, checkpointed, drop_rows, fresh, limit_batches, located, map_texts, skew_join
from .graph import components

BITS, DISTANCE = 64, 3
#: Most fingerprints that one bucket compares: two to the power of the bits open at the last level.
BUCKET = 4096
#: Shingles whose bits are unpacked at once.
_SLICE = 1 << 15


def fingerprint(raw: bytes, width: int = 3, seed: int = 42) -> int:
    """The signed 64-bit SimHash over shingles of the lower-cased words."""
    words = raw.translate(LOWER_AZ).split()
    if not words:
        return 0
    if len(words) <= width:
        shingles: Iterator[bytes] = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    n = max(1, len(words) - width + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, _SLICE):
        bits = np.unpackbits(hashes[at : at + _SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(key, fp bigint) of every row."""
    return map_texts(docs, [key], text, lambda texts: [pa.array([fingerprint(t, width) for t in texts], pa.int64())], f"{key} {docs.schema[key].dataType.simpleString()}, fp bigint")


def _blocks(mask: int) -> list[int]:
    """The masks that follow a mask: with one of four blocks of its open bits each."""
    open_bits = [i for i in range(BITS) if not mask >> i & 1]
    return [mask | sum(1 << i for i in part) for part in (x.tolist() for x in np.array_split(open_bits, DISTANCE + 1))]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _deal(rows: DataFrame) -> DataFrame:
    """Deal (mask, fp) rows to the next level's (mask, fp), four for each."""
    limit_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for m in np.unique(mask).tolist():
                own = fp[mask == m]
                children = [_signed(c) for c in _blocks(m % (1 << BITS))]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(children, np.int64), len(own))), pa.array(np.tile(own, len(children)))], names=["mask", "fp"])

    return rows.select("mask", "fp").mapInArrow(run, "mask bigint, fp bigint")


def links(distinct_fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(u, v) edges that join exactly the fingerprints that links within the distance join."""
    found, open_bits = None, BITS
    rows = distinct_fps.select(F.lit(0).cast("bigint").alias("mask"), "fp")
    while True:
        keyed = _deal(rows).withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        open_bits -= open_bits // (DISTANCE + 1)
        hot = None
        if open_bits > max(DISTANCE, bucket.bit_length() - 1):
            hot = checkpointed(keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where(F.col("n") > bucket).select("mask", "key"))
            if hot.isEmpty():
                hot = None
        cold = keyed.join(hot, ["mask", "key"], "left_anti") if hot is not None else keyed
        found = _compare(cold) if found is None else found.unionByName(_compare(cold))
        if hot is None:
            return found
        rows = checkpointed(keyed.join(hot, ["mask", "key"], "left_semi").select("mask", "fp").distinct())


def _compare(keyed: DataFrame) -> DataFrame:
    """Stars over the linked fingerprints of each (mask, key) bucket; streams sorted buckets."""
    limit_batches(keyed.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3
        for batch in chain(batches, [None]):
            if batch is None:
                ready = held
            else:
                now = [np.concatenate([a, b.to_numpy()]) for a, b in zip(held, batch.columns, strict=True)]
                if not len(now[0]):
                    continue
                # The last bucket may go on in the next batch.
                same = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
                cut = len(same) - int(same.sum())
                ready, held = [x[:cut] for x in now], [x[cut:] for x in now]
            u, v = _stars(*ready)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    dealt = keyed.select("mask", "key", "fp").repartition("mask", "key").sortWithinPartitions("mask", "key")
    return dealt.mapInArrow(run, "u bigint, v bigint")


def _stars(mask: np.ndarray, key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(fp)
    if n < 2:
        return fp[:0], fp[:0]
    new = np.r_[True, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.r_[starts, n])
    us, vs = [], []
    # Small buckets are first compared all at once; few have a link.
    small = np.repeat(sizes <= 32, sizes)
    group = np.cumsum(new) - 1
    linked = sizes > 32
    for d in range(1, min(32, int(sizes.max()))):
        at = np.flatnonzero(small[:-d] & (group[d:] == group[:-d]))
        if len(at):
            near = np.bitwise_count((fp[at] ^ fp[at + d]).view(np.uint64)) <= DISTANCE
            linked[group[at[near]]] = True
    for g in np.flatnonzero(linked):
        own = fp[starts[g] : starts[g] + sizes[g]]
        for members in _groups(own):
            root = members.min()
            rest = members[members != root]
            us.append(rest)
            vs.append(np.full(len(rest), root))
    return (np.concatenate(us), np.concatenate(vs)) if us else (fp[:0], fp[:0])


def _groups(fps: np.ndarray) -> Iterator[np.ndarray]:
    """Linked groups of two or more; what is reached leaves the pool, so dense groups cost little."""
    pool = fps
    while len(pool) > 1:
        reached, pool = [pool[0]], pool[1:]
        for at in reached:
            if not len(pool):
                break
            near = np.bitwise_count((pool ^ at).view(np.uint64)) <= DISTANCE
            if near.any():
                reached.extend(pool[near])
                pool = pool[~near]
        if len(reached) > 1:
            yield np.array(reached, np.int64)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """One row per document: (key, fp, label, component_id).

    label is the smallest fingerprint of the component, component_id its
    smallest key.
    """
    own = checkpointed(fingerprints(docs, key, text, width))
    return _labelled(own, key).select(key, "fp", "label", "component_id")


def _labelled(own: DataFrame, key: str) -> DataFrame:
    """Rows with a fingerprint, and their (label, component_id)."""
    distinct = checkpointed(own.groupBy("fp").agg(F.min(key).alias("__least"), F.count("*").alias("__rows")))
    n, n_rows = distinct.agg(F.count("*"), F.sum("__rows")).first()
    labels = components(links(distinct.select("fp")))
    labelled = distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "__least", "__rows", F.coalesce("root", "fp").alias("label"))
    least = labelled.groupBy("label").agg(F.min("__least").alias("component_id"), F.count("*").alias("__fps"))
    by_fp = skew_join(labelled.select("fp", "label", "__rows"), least, "label", "__fps", n)
    return skew_join(own, by_fp, "fp", "__rows", n_rows or 0)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, most: int = DROPPED) -> DataFrame:
    """The row with the smallest key of each component, with all its columns.

    Of repeated rows with that key one stays, and of a component of null keys
    only one row.  Each text is fingerprinted once; all decisions are made on
    narrow rows of key, position in the files and fingerprint.  The files are
    then read again without the rows to drop (`common.drop_rows`).
    """
    file, row = fresh("__file", docs.columns), fresh("__row", docs.columns)
    placed = located(docs, file, row)
    own = checkpointed(map_texts(placed, [F.col(key).alias("k"), F.col(file).alias("f"), F.col(row).alias("r")], text, lambda texts: [pa.array([fingerprint(t, width) for t in texts], pa.int64())], f"k {docs.schema[key].dataType.simpleString()}, f bigint, r bigint, fp bigint"))
    labelled = checkpointed(_labelled(own, "k").select("label", "k", "f", "r"))
    # Nulls come last.
    first = labelled.groupBy("label").agg(F.min(F.struct(F.col("k").isNull(), "k", "f", "r")).alias("least")).select("least.f", "least.r")
    dropped = checkpointed(labelled.select("f", "r").join(first, ["f", "r"], "left_anti"))
    return drop_rows(placed, dropped, docs.columns, most)


def hex_fingerprint(column: str = "fp"):
    """16 lower-case hex digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
