"""Shards cut from a Hilbert curve over quantised metadata.

Each dimension becomes an ordinal of some bits: strings by the rank of their
distinct values, sizes by quarter octaves and then by rank, ranks stretched over
the whole range.  Rows are ordered by the index of a Hilbert curve through the
cells, then by text hash and key, so that rows of one cell, and equal texts in
it, lie together; runs of the order become shards whose files have narrow ranges
in every dimension at once.

The law is `bytes`: a row goes to the shard in which the middle of its bytes
falls, so a shard's size differs from its equal share by at most one row's
bytes.  Positions come from a range-partitioned sort with one running sum per
partition and an offset each; only a row count and a byte sum per partition
come to the driver.

Defined results: a null text has no bytes, counts as size 8 with the crc32 of
nothing; null metadata counts as an empty string.  Repeated rows each get a
slot.  A row larger than a share may leave a neighbouring shard empty, and an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, checkpointed, limit_batches, skew_join

#: Bits of a dimension; bytes that a row takes besides its text.
BITS, ROW_BYTES = 6, 8


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Curve indices of integer cells (rows, dimensions), by Skilling's transform to and from Gray code."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            index = index << 1 | (x[i] >> b & 1)
    return index


def octave(size: str) -> Column:
    """A quarter-octave class of a positive size: its number of bits, and the two bits after the first."""
    return F.expr(f"cast(length(bin({size})) * 4 + if({size} >= 8, pmod(shiftright({size}, cast(length(bin({size})) - 3 AS int)), 4), 0) AS bigint)")


def numbered(rows: DataFrame, order: list[str], weight: str | None = None) -> DataFrame:
    """Add rank (from 0) and before (the weights' sum before a row) in a total order, without one task for all."""
    limit_batches(rows.sparkSession)
    laid = rows.withColumn("__weight", F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint"))
    laid = checkpointed(laid.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()))
    sums = sorted(tuple(r) for r in laid.groupBy("__part").agg(F.count("*"), F.sum("__weight")).collect())
    at = {p: (n, w) for p, n, w in zip([p for p, *_ in sums], accumulate((n for _, n, _ in sums), initial=0), accumulate((w for *_, w in sums), initial=0), strict=False)}
    kept = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = rank = before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(len(kept) + 1)[0].as_py()
            if own != part:
                part, (rank, before) = own, at[own]
            weights = batch.column(len(kept)).to_numpy()
            sums = np.cumsum(weights)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(rank + np.arange(len(weights))), pa.array(before + sums - weights)], names=[*kept, "rank", "before"])
            rank, before = rank + len(weights), before + int(sums[-1])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return laid.select(*kept, "__weight", "__part").mapInArrow(run, f"{schema}, rank bigint, before bigint")


def _with_ordinal(placed: DataFrame, rows: DataFrame, dimension: str, bits: int, total: int) -> DataFrame:
    """Add the rank of a dimension's value among its distinct ones, stretched over the range of `bits` bits.

    The distinct values are counted first: few are broadcast, many are joined so
    that a value of very many rows doesn't meet in one task.
    """
    known = checkpointed(rows.groupBy(dimension).agg(F.count("*").alias("__n")))
    n = known.count()
    ordinals = numbered(known, [dimension]).select(dimension, "__n", F.expr(f"cast(rank * {1 << bits} div {max(1, n)} AS bigint)").alias(f"{dimension}_cell"))
    if n <= BROADCAST_ROWS:
        return placed.join(F.broadcast(ordinals.drop("__n")), dimension)
    return skew_join(placed, checkpointed(ordinals), dimension, "__n", total)


def shards(docs: DataFrame, n_shards: int, dimensions: tuple[str, ...] = ("lang", "source"), key: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """One row per document: (key, size, text_crc32, law, shard, slot, grown_shard, hilbert).

    The curve runs over the given string columns and the size.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    raw = content.cast("binary")
    rows = docs.select(F.col(key).alias("k"), *[F.coalesce(F.col(d).cast("string"), F.lit("")).alias(f"d{i}") for i, d in enumerate(dimensions)], (F.octet_length(content) + ROW_BYTES).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32"), F.xxhash64(content).alias("text_hash"))
    # Text is read once; everything below is narrow.
    rows = checkpointed(rows.withColumn("octave", octave("size")))
    names = [*(f"d{i}" for i in range(len(dimensions))), "octave"]
    total, n_rows = rows.agg(F.sum("size"), F.count("*")).first()
    total = max(1, total or 0)
    placed = rows
    for name in names:
        placed = _with_ordinal(placed, rows, name, bits, n_rows)
    cells = [f"{n}_cell" for n in names]
    limit_batches(docs.sparkSession)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.stack([c.to_numpy() for c in batch.columns[4:]], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(hilbert_index(own, bits))], names=["k", "size", "text_crc32", "text_hash", "hilbert"])

    kind = docs.schema[key].dataType.simpleString()
    curve = placed.select("k", "size", "text_crc32", "text_hash", *cells).mapInArrow(index, f"k {kind}, size bigint, text_crc32 bigint, text_hash bigint, hilbert bigint")
    # Twice the middle of a row's bytes, over twice the total, in shards.
    cut = numbered(curve, ["hilbert", "text_hash", "k"], "size").withColumn("shard", F.expr(f"cast((2 * before + size) * {n_shards}L div {2 * total}L AS int)"))
    starts = cut.groupBy("shard").agg(F.min("rank").alias("start"))
    return cut.join(F.broadcast(starts), "shard").select(F.col("k").alias(key), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("rank") - F.col("start")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "hilbert")
