"""Arriving files and logs as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import sha256


def arriving_files(spark: SparkSession, folder: str, pattern: str = "*.md") -> DataFrame:
    """(filename, bytes, content) of files as they arrive."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern).load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("filename"), F.col("length").alias("bytes"), "content")


def arriving_violations(arriving: DataFrame, sealed: DataFrame) -> DataFrame:
    """(filename, status) of arriving files that the sealed manifest doesn't have or has otherwise; a stream joined with a table."""
    own = arriving.select("filename", F.sha2("content", 256).alias("current_sha"))
    joined = own.join(sealed.select("filename", F.col("sha256").alias("sealed_sha")), "filename", "left")
    status = F.when(F.col("sealed_sha").isNull(), "added").when(F.col("sealed_sha") != F.col("current_sha"), "modified")
    return joined.select("filename", status.alias("status")).where("status IS NOT NULL")


def tumbling_log(log: DataFrame, ts: str, kind: str, width: str = "1 hour", late: str | None = None) -> DataFrame:
    """(window_start, kind, n): log entries by window; a watermark bounds the state of a stream."""
    rows = log.withWatermark(ts, late) if late else log
    counted = rows.groupBy(F.window(ts, width).alias("w"), F.col(kind).alias("kind")).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), "kind", "n")


def text_seals(arriving: DataFrame, text: str = "text") -> DataFrame:
    """Arriving rows with the digest of their text."""
    return arriving.withColumn("sha256", sha256(text))
