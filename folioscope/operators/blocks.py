"""Tokens of some documents at once as arrays: what one document's tokens have to do with each other needs no shuffle.

Texts come as tokens joined by single spaces; a token has none itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that are looked at together.
BLOCK_BYTES = 16 << 20


class Block:
    """Documents' tokens as codes of a vocabulary, with the document and the place of each."""

    def __init__(self, texts: pa.Array):
        texts = texts.fill_null("")
        cut = pc.split_pattern(texts, " ")
        # An empty text is cut into one empty piece, which is no token.
        self.lengths = np.where(pc.equal(texts, "").to_numpy(zero_copy_only=False), 0, cut.value_lengths().to_numpy()).astype(np.int64)
        flat = cut.flatten()
        coded = flat.filter(pc.not_equal(flat, "")).dictionary_encode()
        self.vocabulary, self.codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        self.doc = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.at = np.arange(len(self.codes)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, code, occurrences) of each distinct token of each document."""
        width = max(1, len(self.vocabulary))
        which, n = np.unique(self.doc * width + self.codes, return_counts=True)
        return which // width, which % width, n

    def term_of_code(self, terms: pa.Array) -> np.ndarray:
        """For each code its place among the terms, -1 for the others."""
        return pc.index_in(self.vocabulary, value_set=terms).fill_null(-1).to_numpy().astype(np.int64)


def by_term(term: np.ndarray, n_terms: int, *columns: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """The columns' values of each term in their order; those of no term (-1) are left out."""
    order = np.argsort(term, kind="stable")
    ends = np.searchsorted(term[order], np.arange(n_terms + 1))
    laid = [c[order] for c in columns]
    return [tuple(c[a:b] for c in laid) for a, b in zip(ends[:-1], ends[1:])]


def pieces(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Batches in pieces of about BLOCK_BYTES of a text column."""
    for batch in batches:
        if not batch.num_rows:
            continue
        part = np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy().astype(np.int64)) // BLOCK_BYTES
        ends = [*np.flatnonzero(np.diff(part)) + 1, batch.num_rows]
        start = 0
        for end in ends:
            yield batch.slice(start, end - start)
            start = end


def _counted(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    text = len(names) - 2
    for batch in pieces(batches, text):
        block = Block(batch.column(text))
        doc, code, n = block.counts()
        rows = pa.array(doc)
        yield pa.RecordBatch.from_arrays([block.vocabulary.take(pa.array(code)), *[batch.column(i).take(rows) for i in range(text)], pa.array(n, pa.int64())], names=names)


def count_tokens(rows: DataFrame, tokens: str) -> DataFrame:
    """(token, ..., tf) of each distinct token of each row; rows have their other columns first, then an array of tokens."""
    others = [f for f in rows.schema.fields if f.name != tokens]
    joined = rows.select(*[f.name for f in others], F.array_join(tokens, " ").alias(tokens))
    kinds = ["token string", *[f"`{f.name}` {f.dataType.simpleString()}" for f in others], "tf bigint"]
    return joined.mapInArrow(partial(_counted, names=["token", *[f.name for f in others], "tf"]), ", ".join(kinds))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 0):
        block = Block(batch.column(0))
        _, code, _ = block.counts()
        df, tf = (np.bincount(c, minlength=len(block.vocabulary)) for c in (code, block.codes))
        yield pa.RecordBatch.from_arrays([block.vocabulary, pa.array(df, pa.int64()), pa.array(tf, pa.int64())], names=["token", "df", "tf"])


def block_frequencies(rows: DataFrame, tokens: str) -> DataFrame:
    """(token, df, tf) of each block of rows: how many hold a token, and its occurrences."""
    return rows.select(F.array_join(tokens, " ").alias("own")).mapInArrow(_frequencies, "token string, df bigint, tf bigint")
