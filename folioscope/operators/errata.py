"""Mechanical repairs: glued words, unique replacements, what they touch, and what they would change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import occurrences, strip, unglue

SHOWN = 160


def glued_words(rows: DataFrame, key: str) -> DataFrame:
    """(key, line_no, before, after, n_splits) of the lines that a repair changes; a log row each."""
    after = rows.select(key, "line_no", "line", unglue("line").alias("fixed")).where("line <> fixed")
    return after.select(key, "line_no", F.left(strip("line"), F.lit(SHOWN)).alias("before"), F.left(strip("fixed"), F.lit(SHOWN)).alias("after"), (F.length("fixed") - F.length("line")).cast("bigint").alias("n_splits"))


def repair_summary(log: DataFrame, key: str) -> DataFrame:
    """(key, n) of a log of repaired lines, most first, and by name among equals."""
    return log.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key)


def write_version(docs: DataFrame, path: str, version: str, key: str, text: str = "text") -> str:
    """The documents as a new version of a corpus beside the earlier ones; one that is there is never written over."""
    folder = f"{path}/version={version}"
    docs.select(key, text).write.mode("error").parquet(folder)
    return folder


def apply_unglue(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents repaired, as a new version; nothing is rewritten in place."""
    return docs.withColumn(text, unglue(text))


def unique_replace(docs: DataFrame, errata: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, n_found, state, text): replace where the wanted text stands exactly once.

    errata: (key, buscar, reemplazar), one for each document; the rest stay as they are.
    """
    joined = docs.select(key, text).join(errata.select(key, "buscar", "reemplazar"), key)
    n = occurrences(text, "buscar")
    state = F.when(n == 1, "aplicada").when(n == 0, "no_encontrada").otherwise("ambigua")
    return joined.select(key, n.alias("n_found"), state.alias("state"), F.when(n == 1, F.replace(F.col(text), F.col("buscar"), F.col("reemplazar"))).otherwise(F.col(text)).alias("text"))


#: Lines of a block of the first level, blocks of a block of the next, and levels; together 16^8 lines.
RADIX, DEPTH = 16, 8


def _cover(l1: Column, l2: Column) -> Column:
    """Blocks (level, block) that together are the lines from l1 to l2, at most two runs of less than RADIX on each level."""
    none = F.array().cast("array<struct<level:int,block:bigint>>")
    run = lambda level, a, b: F.when(a < b, F.transform(F.sequence(a, b - 1), lambda x: F.struct(level.alias("level"), x.alias("block")))).otherwise(none)

    def step(state, level):
        low, high = F.ceil(state["low"] / RADIX), F.floor(state["high"] / RADIX)
        apart = low < high
        ends = F.concat(run(level, state["low"], low * RADIX), run(level, high * RADIX, state["high"]))
        taken = F.when(apart, ends).otherwise(run(level, state["low"], state["high"]))
        return F.struct(F.concat(state["out"], taken).alias("out"), F.when(apart, low).otherwise(0).cast("bigint").alias("low"), F.when(apart, high).otherwise(0).cast("bigint").alias("high"))

    start = F.struct(none.alias("out"), l1.cast("bigint").alias("low"), (l2 + 1).cast("bigint").alias("high"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(DEPTH - 1)), start, step, lambda s: s["out"])


def overlap(changed: DataFrame, spans: DataFrame, key: str) -> DataFrame:
    """(key, span_id, n_lines): how many changed lines (key, line_no) lie inside spans (key, span_id, l1, l2), none left out.

    Changes are counted for blocks of 1, 16, 256 and so on lines, and a span is
    the sum of the few blocks that make it up; so no line meets a span.
    """
    lines = changed.select(key, F.col("line_no").cast("bigint").alias("line_no")).distinct()
    level = F.explode(F.sequence(F.lit(0), F.lit(DEPTH - 1))).alias("level")
    counted = lines.select(key, "line_no", level).groupBy(key, "level", F.floor(F.col("line_no") / F.pow(F.lit(RADIX), F.col("level"))).alias("block")).agg(F.count("*").alias("n"))
    wanted = spans.where("l1 <= l2").select(key, "span_id", "l1", "l2").withColumn("__blocks", _cover(F.col("l1"), F.col("l2")))
    met = wanted.select(key, "span_id", F.inline("__blocks")).join(counted, [key, "level", "block"])
    return met.groupBy(key, "span_id").agg(F.sum("n").alias("n_lines"))


def dry_run(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(key, status, n_changed) of a write that isn't made: lines are compared by position, and a missing line differs."""
    a, b = (s.select(key, "line_no", F.col("line").alias(n)) for s, n in ((old, "old"), (new, "new")))
    joined = a.join(b, [key, "line_no"], "full_outer").groupBy(key).agg(F.count("old").alias("n_old"), F.count("new").alias("n_new"), F.count_if(~F.col("old").eqNullSafe(F.col("new"))).alias("n_changed"))
    status = F.when(F.col("n_old") == 0, "NUEVO").when(F.col("n_new") == 0, "SIN_DESTINO").when(F.col("n_changed") > 0, "MODIFICADO").otherwise("SIN_CAMBIOS")
    return joined.select(key, status.alias("status"), "n_changed")
