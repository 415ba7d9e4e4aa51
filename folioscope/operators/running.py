"""Running values over the lines of documents, however long one document is.

A window over a document is one task.  Here a document's lines are dealt to
blocks by their numbers, each block has a window of its own, and what a block is
told by the blocks before it comes from a row a block: the state after several
blocks is the composition of what each does.  Only documents of more than one
block are looked at for that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Lines of a block.
BLOCK = 1 << 16


def _blocks(rows: DataFrame, key: str, event: Column, block: int) -> tuple[DataFrame, DataFrame]:
    """All rows with their block and event, and those of documents with several blocks."""
    own = rows.withColumn("__block", F.floor(F.col("line_no") / block)).withColumn("__event", event)
    long = rows.where(F.col("line_no") >= block).select(key).distinct()
    return own, own.select(key, "line_no", "__block", "__event").join(long, key, "left_semi")


def _joined(own: DataFrame, before: DataFrame, key: str, value: Column, out: str) -> DataFrame:
    return own.join(before, [key, "__block"], "left").withColumn(out, value).drop("__block", "__event", "__own", "__before")


def last_event(rows: DataFrame, key: str, event: Column, out: str, block: int = BLOCK) -> DataFrame:
    """Rows (key, line_no, ...) with the last event that isn't null up to each line."""
    own, long = _blocks(rows, key, event, block)
    inside = W.partitionBy(key, "__block").orderBy("line_no").rowsBetween(W.unboundedPreceding, W.currentRow)
    own = own.withColumn("__own", F.last("__event", ignorenulls=True).over(inside))
    ends = long.groupBy(key, "__block").agg(F.max_by("__event", F.when(F.col("__event").isNotNull(), F.col("line_no"))).alias("__end"))
    before = F.last("__end", ignorenulls=True).over(W.partitionBy(key).orderBy("__block").rowsBetween(W.unboundedPreceding, -1))
    return _joined(own, ends.select(key, "__block", before.alias("__before")), key, F.coalesce("__own", "__before"), out)


def count_events(rows: DataFrame, key: str, event: Column, out: str, block: int = BLOCK) -> DataFrame:
    """Rows (key, line_no, ...) with the number of events that aren't null up to each line."""
    own, long = _blocks(rows, key, event, block)
    inside = W.partitionBy(key, "__block").orderBy("line_no").rowsBetween(W.unboundedPreceding, W.currentRow)
    own = own.withColumn("__own", F.count("__event").over(inside))
    sums = long.groupBy(key, "__block").agg(F.count("__event").alias("__n"))
    before = F.sum("__n").over(W.partitionBy(key).orderBy("__block").rowsBetween(W.unboundedPreceding, -1))
    return _joined(own, sums.select(key, "__block", before.alias("__before")), key, F.col("__own") + F.coalesce("__before", F.lit(0)), out)
