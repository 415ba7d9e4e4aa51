"""Building the searchable index of a sealed corpus, and checking what was built."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.corpus import write_index
from . import chunks as C
from . import gate
from . import manifest as M


def build(docs: DataFrame, sealed: DataFrame, path: str, built_at: str, name: str = "filename", text: str = "text") -> None:
    """Write docs, chunks, postings and meta of documents that match their seal.

    The seal is checked before anything is written; what was written is read
    again and must give every document back.
    """
    spark = docs.sparkSession
    own = M.manifest(docs, name, text)
    gate.require_empty(M.integrity_diff(own, sealed), "integrity")
    parts = C.chunks(docs.select(F.col(name).alias("filename"), F.col(text).alias("text")), "filename")
    posted = C.postings(parts, ["filename", "chunk_no"], {"text": "text", "heading": "heading"})
    meta = M.set_hash(own).select(F.lit(built_at).alias("built_at"), "set_hash", "file_count", "total_bytes")
    write_index(own, parts, posted, meta, path)
    written = spark.read.parquet(f"{path}/chunks")
    checked = C.lossless(docs.select(F.col(name).alias("filename"), F.col(text).alias("text")), written, "filename")
    gate.require_empty(checked.where("NOT lossless"), "reconstruction")
    gate.require_empty(M.coverage(spark.read.parquet(f"{path}/docs"), own, sealed), "coverage")
