"""Corpus files, their decoding, manifests and sinks."""

from __future__ import annotations

import json
import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip

MANIFEST = "format_version int, algorithm string, scope string, created_at string, file_count int, total_bytes bigint, set_hash string, files map<string, struct<sha256:string, bytes:bigint>>"


def corpus_files(spark: SparkSession, folder: str, pattern: str = "*.md") -> DataFrame:
    """(filename, path, bytes, content) of the files of one folder level."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(F.col("_metadata.file_name").alias("filename"), "path", F.col("length").alias("bytes"), "content")


def decode(content: Column | str) -> tuple[Column, Column]:
    """Text and encoding of bytes: UTF-8 if valid, else Latin-1, so that nothing is lost."""
    raw = F.col(content) if isinstance(content, str) else content
    valid = F.is_valid_utf8(raw)
    return F.when(valid, raw.cast("string")).otherwise(F.decode(raw, "ISO-8859-1")), F.when(valid, "utf-8").otherwise("latin-1")


def encode(text: Column | str, encoding: Column | str) -> Column:
    """The bytes that `decode` has read."""
    t, e = (F.col(x) if isinstance(x, str) else x for x in (text, encoding))
    return F.when(e == "utf-8", t.cast("binary")).otherwise(F.encode(t, "ISO-8859-1"))


def decode_lossy(content: Column | str) -> Column:
    """UTF-8 text with U+FFFD for what isn't valid."""
    return F.make_valid_utf8(F.col(content).cast("string") if isinstance(content, str) else content.cast("string"))


def lines(docs: DataFrame, key: str | list[str], text: str = "text") -> DataFrame:
    """(key..., line_no from 1, line); split at line feeds only, empty lines kept."""
    keys = [key] if isinstance(key, str) else key
    return docs.select(*keys, F.posexplode(F.split(F.col(text), "\n")).alias("at", "line")).select(*keys, (F.col("at") + 1).cast("bigint").alias("line_no"), "line")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(filename, sha256, bytes) of a manifest document."""
    files = spark.read.schema(MANIFEST).json(path, multiLine=True).select(F.explode("files").alias("filename", "entry"))
    return files.select("filename", "entry.sha256", "entry.bytes")


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Documents of a schema with a `problem` column: null, 'missing' or 'invalid'."""
    found = spark.read.option("columnNameOfCorruptRecord", "_corrupt").schema(f"{schema}, _corrupt string")
    try:
        docs = found.json(path, multiLine=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        columns = spark.createDataFrame([], schema).schema.fields
        return spark.range(1).select(*[F.lit(None).cast(c.dataType).alias(c.name) for c in columns], F.lit("missing").alias("problem"))
    return docs.withColumn("problem", F.when(F.col("_corrupt").isNotNull(), "invalid")).drop("_corrupt")


def write_manifest(manifest: DataFrame, path: str, created_at: str, scope: str) -> None:
    """One exploded Parquet table of files and one JSON line of totals; manifest is (filename, sha256, bytes)."""
    from ..operators.manifest import set_hash

    manifest.write.mode("overwrite").parquet(f"{path}/files")
    set_hash(manifest).select(F.lit(1).alias("format_version"), F.lit("sha256").alias("algorithm"), F.lit(scope).alias("scope"), F.lit(created_at).alias("created_at"), "file_count", "total_bytes", "set_hash").write.mode("overwrite").json(f"{path}/totals")


def write_manifest_document(manifest: DataFrame, path: str, created_at: str, scope: str) -> None:
    """The manifest as one JSON document, as `read_manifest` reads it; its files stream to the driver in the order of names."""
    from ..operators.manifest import set_hash

    total = set_hash(manifest).first()
    head = {"format_version": 1, "algorithm": "sha256", "scope": scope, "created_at": created_at, "file_count": total.file_count, "total_bytes": total.total_bytes, "set_hash": total.set_hash}
    with open(f"{path}.new", "w", encoding="utf-8") as out:
        out.write(json.dumps(head, ensure_ascii=False)[:-1] + ', "files": {')
        for i, r in enumerate(manifest.orderBy("filename").toLocalIterator()):
            out.write((", " if i else "") + json.dumps(r.filename, ensure_ascii=False) + ": " + json.dumps({"sha256": r.sha256, "bytes": r.bytes}))
        out.write("}}\n")
    os.replace(f"{path}.new", path)


def append_log(rows: DataFrame, path: str) -> None:
    """Append JSON lines."""
    rows.write.mode("append").json(path)


def write_reports(rows: DataFrame, path: str, key: str, text: str = "informe") -> None:
    """One text a key, each in a folder named by its key; written by the executors, whole before anything is shown."""
    rows.select(F.col(key).cast("string").alias("documento"), F.col(text).alias("value")).write.mode("overwrite").partitionBy("documento").text(path)


def write_artifact(rows: DataFrame, path: str, text: str = "text", order: str = "line_no") -> None:
    """A bounded, ordered report as one text file, written beside its place and moved there."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(f"{path}.new", "w", encoding="utf-8") as out:
        for r in rows.orderBy(order).select(text).toLocalIterator():
            out.write(r[0] + "\n")
    os.replace(f"{path}.new", path)


def write_state(state: dict, path: str) -> None:
    """A small state document, replaced in one step."""
    with open(f"{path}.new", "w", encoding="utf-8") as out:
        json.dump(state, out, ensure_ascii=False, indent=2)
    os.replace(f"{path}.new", path)


def write_index(docs: DataFrame, chunks: DataFrame, postings: DataFrame, meta: DataFrame, path: str) -> None:
    """Drop and rebuild an index as Parquet tables; postings lie by token, so that a term reads few files."""
    docs.write.mode("overwrite").parquet(f"{path}/docs")
    chunks.write.mode("overwrite").parquet(f"{path}/chunks")
    postings.repartitionByRange("token").sortWithinPartitions("token").write.mode("overwrite").parquet(f"{path}/postings")
    meta.write.mode("overwrite").parquet(f"{path}/meta")


def is_pattern(pattern: Column) -> Column:
    """Whether Java's engine, which will run a user's pattern, can compile it; blank ones and null can't be meant."""
    return F.coalesce(strip(pattern) != "", F.lit(False)) & F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), pattern).isNotNull()
