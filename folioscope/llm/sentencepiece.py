"""SentencePiece encoding and decoding through tables of distinct chunks.

In a vocabulary whose pieces carry the white space marker only as a leading
run, no merge can cross from a word into the marker that follows it.  The texts
of a block of BLOCK_BYTES are then cut before each run of markers, the block's chunks
are put into a table of distinct ones, each of those is segmented once, and
their ids are joined back by position: a take over the positions lays all ids of
the block out in order, and a text's ids are a slice of that.  A worker keeps
the segments of TABLE_ENTRIES chunks from block to block.

The table is one block's and not the corpus's: every distinct chunk of a corpus
in one table would have to be joined with every position of it, which moves more
than the texts themselves (README, figures).

The result is what the library gives for the whole text; `crosses_markers` tells
whether a model qualifies, and a model that doesn't is run over whole texts
instead.

Defined results: a null text counts as empty, and an empty text has the begin
and end ids only.  Repeated rows are encoded each by itself, and all columns but
the key and the text are ignored.  A very long text is cut like any other; it is
a batch of its own.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import map_texts

MARKER = "▁"
#: Bytes of text whose chunks share one table, or one longer text.
BLOCK_BYTES = 2 << 20
#: Chunks that a worker keeps from batch to batch, and the longest of them; the table starts anew when full.
TABLE_ENTRIES, TABLE_WORD = 250_000, 48

_RUN = re.compile(f"{MARKER}+[^{MARKER}]*")
_loaded: dict[str, "ChunkCodec"] = {}


def crosses_markers(processor) -> bool:
    """Whether some piece has a marker after another character, or a piece could match inside raw text on its own."""
    return any(MARKER in processor.id_to_piece(i).lstrip(MARKER) for i in range(processor.get_piece_size()))


class ChunkCodec:
    """Encodes and decodes texts with one model."""

    def __init__(self, model: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.ends = array("I", [self.sp.bos_id()]).tobytes(), array("I", [self.sp.eos_id()]).tobytes()
        # The marker's place is probed: chunk tables need the identity
        # normaliser with one leading marker and nothing removed.
        plain = self.sp.encode(" a  b ", out_type=str)
        self.separable = not crosses_markers(self.sp) and "".join(plain) == f"{MARKER * 2}a{MARKER * 2}b{MARKER}"
        self.table: dict[str, tuple[bytes, bytes]] = {}

    def segments(self, words: list[str]) -> list[tuple[bytes, bytes]]:
        """Packed ids, and the decoded form with a space after it, of distinct chunks, given without their first marker."""
        table = self.table
        found = [table.get(w) for w in words]
        new = [w for w, f in zip(words, found, strict=True) if f is None]
        if new:
            # The library puts the first marker back by itself, but not before
            # an empty text, where the lone marker is a piece of its own.
            ids = self.sp.encode(new, num_threads=1)
            if "" in new:
                ids[new.index("")] = [self.sp.piece_to_id(MARKER)]
            made = [(array("I", i).tobytes(), (d + " ").encode()) for i, d in zip(ids, self.sp.decode(ids, num_threads=1), strict=True)]
            if len(table) + len(new) > TABLE_ENTRIES:
                table.clear()
            table.update((w, m) for w, m in list(zip(new, made, strict=True))[:TABLE_ENTRIES] if len(w) <= TABLE_WORD)
            rest = iter(made)
            found = [f or next(rest) for f in found]
        return found

    def _joined(self, words: pa.Array, ends: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
        """Ids and decoded text of texts that end after so many of the chunks."""
        coded = words.dictionary_encode()
        found = self.segments(coded.dictionary.to_pylist())
        laid = [_laid(pa.array(column, pa.large_binary()).take(coded.indices)) for column in (zip(*found, strict=True) if found else ((), ()))]
        (ids, at), (decoded, to) = laid
        start = 0
        for end in ends.tolist():
            # The last chunk's space isn't the text's.
            yield ids[at[start] : at[end]], decoded[to[start] : max(to[start], to[end] - 1)]
            start = end

    def encode(self, texts: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """For each text in UTF-8 its ids with begin and end as little-endian 32-bit integers, and the text that they decode to."""
        begin, end = self.ends
        if not self.separable:
            for t in texts:
                ids = self.sp.encode(t.decode())
                yield begin + array("I", ids).tobytes() + end, self.sp.decode(ids).encode()
            return
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size + len(texts[to]) <= BLOCK_BYTES):
                size += len(texts[to])
                to += 1
            for ids, decoded in self._block(texts[at:to]):
                yield begin + ids + end, decoded
            at = to

    def _block(self, texts: list[bytes]) -> list[tuple[bytes, bytes]]:
        """Ids without begin and end, and decoded texts, by one table of distinct chunks."""
        column = pa.array(texts, pa.large_binary()).cast(pa.large_string())
        # Runs of markers, and markers at an end, are cut one text at a time.
        plain = pc.and_not(pc.not_equal(column, ""), pc.match_substring_regex(column, rf"  |{MARKER}|\A | \z"))
        out: list = [(b"", b"")] * len(texts)
        usual = np.flatnonzero(plain.to_numpy(zero_copy_only=False))
        if len(usual):
            split = pc.split_pattern(column.filter(plain), " ")
            ends = split.offsets.to_numpy()[1:] - split.offsets[0].as_py()
            for i, found in zip(usual.tolist(), self._joined(split.flatten(), ends), strict=True):
                out[i] = found
        odd = [i for i in set(range(len(texts))) - set(usual.tolist()) if texts[i]]
        if odd:
            lists = [[chunk[1:] for chunk in _RUN.findall(MARKER + texts[i].decode().replace(" ", MARKER))] for i in odd]
            flat = pa.array([w for words in lists for w in words], pa.large_string())
            for i, found in zip(odd, self._joined(flat, np.cumsum([len(words) for words in lists])), strict=True):
                out[i] = found
        return out


def _laid(values: pa.Array) -> tuple[memoryview, list[int]]:
    """The bytes of an array one after another, and where each value starts, with the end."""
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int64)
    return memoryview(data or b""), at


def codec(model: str) -> ChunkCodec:
    """One codec for each model and worker process."""
    if model not in _loaded:
        _loaded[model] = ChunkCodec(model)
    return _loaded[model]


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids and decoded text of every row: (key, ids array<int>, decoded string)."""

    def run(texts: list[bytes]) -> list:
        pairs = [(ids, bytes(decoded)) for ids, decoded in codec(model).encode(texts)]
        return [pa.array([array("i", ids) for ids, _ in pairs], pa.list_(pa.int32())), pa.array([d for _, d in pairs], pa.binary()).cast(pa.string())]

    return map_texts(docs, [key], text, run, f"{key} {docs.schema[key].dataType.simpleString()}, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and digests in place of ids and texts: (key, n_tokens, ids_sha256, decoded_sha256)."""

    def run(texts: list[bytes]) -> list:
        found = [(len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(d).hexdigest()) for ids, d in codec(model).encode(texts)]
        return [pa.array([n for n, *_ in found], pa.int64()), [x for _, x, _ in found], [x for *_, x in found]]

    return map_texts(docs, [key], text, run, f"{key} {docs.schema[key].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
