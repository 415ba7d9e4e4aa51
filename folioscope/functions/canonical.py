"""Fingerprints of JSON documents in a canonical form."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical(document: str) -> str:
    """The document with sorted keys and plain separators."""
    return json.dumps(json.loads(document), sort_keys=True, ensure_ascii=False)


def fingerprint(document: str, digits: int = 64) -> str:
    """SHA-256 over the canonical document; its first digits."""
    return hashlib.sha256(canonical(document).encode()).hexdigest()[:digits]


def _try_fingerprint(document: str | None) -> str | None:
    try:
        return None if document is None else fingerprint(document)
    except ValueError:
        return None


@F.pandas_udf(T.StringType())
def json_fingerprint(documents: pd.Series) -> pd.Series:
    """Fingerprints; null for null and for what isn't JSON, which `json_problem` tells apart."""
    return pd.Series([_try_fingerprint(d) for d in documents], dtype=object)


@F.pandas_udf(T.StringType())
def json_canonical(documents: pd.Series) -> pd.Series:
    """Canonical forms of documents that are JSON."""
    return documents.map(canonical, na_action="ignore").astype(object)


def list_fingerprints(pieces: DataFrame, key: str, order: list[str], piece: str) -> DataFrame:
    """(key, print): for each key the fingerprint of the JSON list of its canonical pieces in their order.

    The pieces are sorted with spilling; a key's digest is sequential by
    definition and streams through one task that holds one batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, digest = None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([own], pa.string()), pa.array([digest.hexdigest()], pa.string())], names=[key, "print"])
        for batch in batches:
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if digest is None or k != own:
                    if digest:
                        digest.update(b"]")
                        yield row()
                    own, digest = k, hashlib.sha256(b"[")
                else:
                    digest.update(b", ")
                digest.update(x.encode())
        if digest:
            digest.update(b"]")
            yield row()

    ordered = pieces.repartition(key).sortWithinPartitions(key, *order).select(F.col(key).cast("string"), piece)
    return ordered.mapInArrow(run, f"{key} string, print string")


def json_problem(document: Column, prints: Column) -> Column:
    """'invalid' where a document gave no fingerprint, 'missing' where there is none, else null."""
    return F.when(document.isNull(), "missing").when(prints.isNull(), "invalid")
