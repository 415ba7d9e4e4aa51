"""Token counts that follow edits.

A byte-level BPE merges within pre-tokens only, and the pattern that cuts a text
into pre-tokens reads forward, at most CONTEXT characters past a pre-token's
end.  A document's pre-tokens are the leaves of a height-balanced tree whose
nodes keep the sums of characters, tokens and pre-tokens below them.  An edit
goes down by character sums to the pre-tokens it touches, steps back by CONTEXT
characters, cuts anew from there until a boundary meets an old one, encodes only
what it has cut, and puts the new leaves in by splitting and joining the tree at
leaf boundaries, which updates the sums of the nodes on the way.

Leaves hold runs of LEAF pre-tokens or fewer; a run that shrinks below half of
that takes its neighbour in.  So the tree's height is logarithmic however many
edits there are.

Trees are kept: `build_trees` returns one row a document with its sums and its
leaves, `apply_edits` takes such a stored table and edits, opens only the leaves
that an edit touches, and returns the next table; `totals` reads the sums only.
`count_tokens` builds and edits at once.

Defined results: a null text counts as empty and has no tokens; an edit's
position and length are clipped to the text as it is when the edit's turn comes,
and a null edit list, or a document without a row of edits, means no edits.
Repeated rows each get a row, and edits of a key apply to each of its rows.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from itertools import accumulate, pairwise

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import limit_batches

#: Pre-tokens in a leaf; how far past its end a pre-token can depend on the text; entries and longest pre-token of a worker's table of counts.
LEAF, CONTEXT = 128, 3
TABLE_ENTRIES, TABLE_LENGTH = 250_000, 48
#: Longest piece of text that is read at once when an edit is cut anew.
_READ = 256

_loaded: dict[tuple[str, str], "Counter"] = {}


class Counter:
    """Counts tokens of pre-tokens by a rank file and a pattern."""

    def __init__(self, ranks: str, pattern: str):
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.find = regex.compile(pattern).finditer
        self.split = regex.compile(pattern).findall
        self.table: dict[str, int] = {}

    def count(self, pretoken: str) -> int:
        n = self.table.get(pretoken)
        if n is None:
            n = len(self.encoding.encode_ordinary(pretoken))
            if len(pretoken) <= TABLE_LENGTH:
                if len(self.table) >= TABLE_ENTRIES:
                    self.table.clear()
                self.table[pretoken] = n
        return n


def counter(ranks: str, pattern: str) -> Counter:
    """One counter for each vocabulary and worker process."""
    if (ranks, pattern) not in _loaded:
        _loaded[ranks, pattern] = Counter(ranks, pattern)
    return _loaded[ranks, pattern]


class Leaf:
    """A run of pre-tokens with their counts; packed until something asks for them."""

    __slots__ = ("chars", "tokens", "n", "height", "_pieces", "_counts", "_packed")

    def __init__(self, pieces: list[str], counts: list[int]):
        self._pieces, self._counts, self._packed = pieces, counts, None
        self.chars, self.tokens, self.n, self.height = sum(map(len, pieces)), sum(counts), len(pieces), 0

    @classmethod
    def stored(cls, row) -> "Leaf":
        """A leaf from its row, a mapping or an Arrow struct, whose text isn't read yet."""
        leaf = cls.__new__(cls)
        leaf._pieces = leaf._counts = None
        leaf._packed, leaf.height = row, 0
        leaf.chars, leaf.tokens, leaf.n = (_plain(row[k]) for k in ("chars", "tokens", "n"))
        return leaf

    @property
    def opened(self) -> bool:
        return self._pieces is not None

    def open(self) -> tuple[list[str], list[int]]:
        if self._pieces is None:
            text, lengths, counts = (_plain(self._packed[k]) for k in ("text", "lengths", "counts"))
            ends = [0, *accumulate(array("I", lengths))]
            self._pieces, self._counts = [text[a:b] for a, b in pairwise(ends)], array("I", counts).tolist()
        return self._pieces, self._counts

    def row(self) -> dict:
        if self._pieces is None:
            return {k: _plain(self._packed[k]) for k in ("text", "lengths", "counts", "chars", "tokens", "n")}
        return {"text": "".join(self._pieces), "lengths": array("I", map(len, self._pieces)).tobytes(), "counts": array("I", self._counts).tobytes(), "chars": self.chars, "tokens": self.tokens, "n": self.n}


def _plain(value):
    return value.as_py() if isinstance(value, pa.Scalar) else value


class Node:
    """Two subtrees of nearly the same height, and the sums of both."""

    __slots__ = ("left", "right", "chars", "tokens", "n", "height")

    def __init__(self, left: "Tree", right: "Tree"):
        self.left, self.right = left, right
        self.chars, self.tokens, self.n = left.chars + right.chars, left.tokens + right.tokens, left.n + right.n
        self.height = 1 + max(left.height, right.height)


Tree = Leaf | Node


def _balanced(left: Tree, right: Tree) -> Node:
    """A node of two subtrees whose heights differ by two at most."""
    if left.height > right.height + 1:
        if left.left.height >= left.right.height:
            return Node(left.left, Node(left.right, right))
        return Node(Node(left.left, left.right.left), Node(left.right.right, right))
    if right.height > left.height + 1:
        if right.right.height >= right.left.height:
            return Node(Node(left, right.left), right.right)
        return Node(Node(left, right.left.left), Node(right.left.right, right.right))
    return Node(left, right)


def join(a: Tree | None, b: Tree | None) -> Tree | None:
    """One balanced tree of two, in steps of the difference of their heights."""
    if a is None or b is None:
        return a or b
    if a.height > b.height + 1:
        return _balanced(a.left, join(a.right, b))
    if b.height > a.height + 1:
        return _balanced(join(a, b.left), b.right)
    return Node(a, b)


def split(tree: Tree | None, at: int) -> tuple[Tree | None, Tree | None]:
    """The trees before and after a character position that is a leaf's boundary."""
    if tree is None or at <= 0:
        return None, tree
    if at >= tree.chars:
        return tree, None
    cut = tree.left.chars
    if at <= cut:
        a, b = split(tree.left, at)
        return a, join(b, tree.right)
    a, b = split(tree.right, at - cut)
    return join(tree.left, a), b


def built(leaves: list[Leaf]) -> Tree | None:
    """A balanced tree over leaves, level by level."""
    level: list[Tree] = leaves
    while len(level) > 1:
        above = [Node(*level[i : i + 2]) for i in range(0, len(level) - 1, 2)]
        if len(level) % 2:
            # A lone last subtree joins its neighbour, so that heights stay close.
            above[-1] = join(above[-1], level[-1])
        level = above
    return level[0] if level else None


def runs(pieces: list[str], counts: list[int]) -> list[Leaf]:
    """Leaves of about equal length."""
    n = len(pieces)
    k = -(-n // LEAF)
    return [Leaf(pieces[n * i // k : n * (i + 1) // k], counts[n * i // k : n * (i + 1) // k]) for i in range(k)]


def leaves(tree: Tree | None, at: int = 0) -> Iterator[tuple[int, Leaf]]:
    """(start, leaf) from the leaf that holds a character position on; none past the end."""
    if tree is None or at >= tree.chars:
        return
    stack, base = [], 0
    while isinstance(tree, Node):
        if at - base < tree.left.chars:
            stack.append(tree.right)
            tree = tree.left
        else:
            base += tree.left.chars
            tree = tree.right
    while True:
        yield base, tree
        base += tree.chars
        if not stack:
            return
        tree = stack.pop()
        while isinstance(tree, Node):
            stack.append(tree.right)
            tree = tree.left


class Document:
    """A text's pre-token tree under edits."""

    def __init__(self, text: str, by: Counter):
        self.by = by
        pieces = by.split(text)
        count, known = by.count, by.table
        counts = [known.get(p) or count(p) for p in pieces]
        self.encoded = 0
        self.root = built(runs(pieces, counts))

    @classmethod
    def stored(cls, rows, by: Counter) -> "Document":
        """The document of a stored tree's leaves."""
        doc = cls.__new__(cls)
        doc.by, doc.encoded, doc.root = by, 0, built([Leaf.stored(r) for r in rows])
        return doc

    @property
    def chars(self) -> int:
        return self.root.chars if self.root else 0

    @property
    def tokens(self) -> int:
        return self.root.tokens if self.root else 0

    @property
    def n_pieces(self) -> int:
        return self.root.n if self.root else 0

    def pieces(self, start: int = 0) -> Iterator[str]:
        """Pre-tokens from the one that holds character `start` on."""
        for at, leaf in leaves(self.root, start):
            for piece in leaf.open()[0]:
                at += len(piece)
                if at > start:
                    yield piece

    def text(self) -> str:
        return "".join(self.pieces())

    def _start_of(self, at: int) -> int:
        """The first character of the pre-token that holds `at`, or the text's end."""
        for base, leaf in leaves(self.root, at):
            for piece in leaf.open()[0]:
                if base + len(piece) > at:
                    return base
                base += len(piece)
        return self.chars

    def _replace(self, start: int, stop: int, pieces: list[str], counts: list[int]) -> None:
        """Put pre-tokens in place of those of [start, stop), both boundaries."""
        low = high = start
        before: tuple[list[str], list[int]] = ([], [])
        after: tuple[list[str], list[int]] = ([], [])
        found = next(leaves(self.root, start), None)
        if found:
            low, leaf = found
            high = low + leaf.chars
            before = _part(leaf, 0, start - low)
            if stop > high:
                high, leaf = next(leaves(self.root, stop - 1))
                high, low_of = high + leaf.chars, high
                after = _part(leaf, stop - low_of, leaf.chars)
            else:
                after = _part(leaf, stop - low, leaf.chars)
        head, rest = split(self.root, low)
        _, tail = split(rest, high - low)
        pieces, counts = [*before[0], *pieces, *after[0]], [*before[1], *counts, *after[1]]
        if len(pieces) < LEAF // 2 and (head or tail):
            if tail:
                _, leaf = next(leaves(tail))
                _, tail = split(tail, leaf.chars)
                pieces, counts = pieces + leaf.open()[0], counts + leaf.open()[1]
            else:
                at, leaf = next(leaves(head, head.chars - 1))
                head, _ = split(head, at)
                pieces, counts = leaf.open()[0] + pieces, leaf.open()[1] + counts
        self.root = join(join(head, built(runs(pieces, counts))), tail)

    def edit(self, at: int, removed: int, inserted: str) -> None:
        """Replace `removed` characters from `at` on by a string."""
        at = max(0, min(at, self.chars))
        end = max(at, min(at + max(0, removed), self.chars))
        if at == end and not inserted:
            return
        start = self._start_of(max(0, at - CONTEXT))
        # Old pre-tokens from the start on; their ends after the edit are where the new ones may meet them.
        old = self.pieces(start)
        reach, window = start, ""
        ends: set[int] = set()
        exhausted = False

        def read(upto: int) -> None:
            nonlocal reach, window, exhausted
            grown = [window]
            while reach < upto and not exhausted:
                piece = next(old, None)
                if piece is None:
                    exhausted = True
                else:
                    grown.append(piece)
                    reach += len(piece)
                    if reach >= end:
                        ends.add(reach)
            window = "".join(grown)

        span = _READ
        while True:
            read(end + span)
            fresh = window[: at - start] + inserted + window[end - start :]
            shift = len(inserted) - (end - at)
            found, stop = [], None
            # A pre-token too near the end of what has been read may go on.
            safe = len(fresh) if exhausted else len(fresh) - CONTEXT
            for m in self.by.find(fresh):
                if m.end() > safe:
                    break
                found.append(m[0])
                if m.end() - shift + start in ends and m.end() >= at - start + len(inserted):
                    stop = m.end() - shift + start
                    break
            if stop is None and exhausted:
                stop = reach
            if stop is not None:
                break
            span *= 4
        self.encoded += len(found)
        self._replace(start, stop, found, [self.by.count(p) for p in found])

    def apply(self, changes) -> None:
        for c in changes or ():
            if c is not None:
                self.edit(c["at"] or 0, c["removed"] or 0, c["inserted"] or "")


def _part(leaf: Leaf, start: int, stop: int) -> tuple[list[str], list[int]]:
    """The pre-tokens of a leaf between two of its boundaries."""
    pieces, counts = leaf.open()
    at, i = 0, 0
    while i < len(pieces) and at < start:
        at += len(pieces[i])
        i += 1
    j = i
    while j < len(pieces) and at < stop:
        at += len(pieces[j])
        j += 1
    return pieces[i:j], counts[i:j]


EDIT = "struct<at:int,removed:int,inserted:string>"
LEAVES = "array<struct<text:string,lengths:binary,counts:binary,chars:bigint,tokens:bigint,n:bigint>>"
_ARROW_LEAVES = pa.list_(pa.struct([("text", pa.string()), ("lengths", pa.binary()), ("counts", pa.binary()), ("chars", pa.int64()), ("tokens", pa.int64()), ("n", pa.int64())]))
_SUMS = ["n_chars", "n_tokens", "n_pretokens"]


#: Documents and characters of trees that a worker puts out at once, a longer document alone; and edited keys that are broadcast.
STORED_ROWS, STORED_CHARS, EDIT_ROWS = 256, 1 << 20, 100_000


def _stored(keys: pa.Array, key: str, docs: Iterator[Document]) -> Iterator[pa.RecordBatch]:
    """Rows of a stored table, in batches of bounded size."""

    def batch(rows: list[tuple], first: int) -> pa.RecordBatch:
        *sums, found = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([keys.slice(first, len(rows)), *(pa.array(x, pa.int64()) for x in sums), pa.array(found, _ARROW_LEAVES)], names=[key, *_SUMS, "reencoded", "leaves"])

    rows, first, chars = [], 0, 0
    for doc in docs:
        rows.append((doc.chars, doc.tokens, doc.n_pieces, doc.encoded, [leaf.row() for _, leaf in leaves(doc.root)]))
        chars += doc.chars
        if len(rows) >= STORED_ROWS or chars >= STORED_CHARS:
            yield batch(rows, first)
            rows, first, chars = [], first + len(rows), 0
    if rows:
        yield batch(rows, first)


def build_trees(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The trees of all rows, to be written as a table: (key, n_chars, n_tokens, n_pretokens, reencoded, leaves).

    reencoded is the number of pre-tokens that the last call had encoded because
    of edits, here 0.
    """
    limit_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = counter(ranks, pattern)
        for batch in batches:
            yield from _stored(batch.column(0), key, (Document(t, by) for t in batch.column(1).to_pylist()))

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("__text")).mapInArrow(run, f"{key} {kind}, {', '.join(f'{n} bigint' for n in _SUMS)}, reencoded bigint, leaves {LEAVES}")


def apply_edits(trees: DataFrame, edits: DataFrame, ranks: str, pattern: str, key: str = "doc_id", changes: str = "edits") -> DataFrame:
    """The table of trees after edits, one row of edits a key: (key, changes array of (at, removed, inserted)).

    Leaves that no edit touches are passed on packed.  Trees without edits don't
    go through Python at all, and with edits of few keys, which are counted, they
    aren't shuffled either.
    """
    edits = edits.select(key, changes)
    if edits.limit(EDIT_ROWS + 1).count() <= EDIT_ROWS:
        edits = F.broadcast(edits)
    limit_batches(trees.sparkSession)
    kind = trees.schema[key].dataType.simpleString()
    columns = [key, *_SUMS, "reencoded", "leaves"]
    joined = trees.select(*columns).join(edits.select(F.col(key).alias("__key"), F.col(changes).cast(f"array<{EDIT}>").alias("__edits")), F.col(key).eqNullSafe(F.col("__key")), "left")
    touched = F.coalesce(F.size("__edits") > 0, F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = counter(ranks, pattern)
        for batch in batches:

            def edited(batch=batch) -> Iterator[Document]:
                for rows, changes in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                    doc = Document.stored(rows.values or [], by)
                    doc.apply(changes)
                    yield doc

            yield from _stored(batch.column(0), key, edited())

    changed = joined.where(touched).select(key, "leaves", "__edits").mapInArrow(run, f"{key} {kind}, {', '.join(f'{n} bigint' for n in _SUMS)}, reencoded bigint, leaves {LEAVES}")
    return changed.unionByName(joined.where(~touched).select(key, *_SUMS, F.lit(0).cast("bigint").alias("reencoded"), "leaves"))


def edit_files(spark: SparkSession, files: list[str], edits: DataFrame, to: str, ranks: str, pattern: str, key: str = "doc_id", changes: str = "edits") -> list[str]:
    """The files of a table of trees after edits: those without an edited key as they are, the others written anew in `to`.

    files are those of a table that `build_trees` gave, sorted by key if few of
    them are to be touched; only their keys are read to tell which are.
    """
    trees = spark.read.parquet(*files)
    name = F.col("_metadata.file_path")
    keys = edits.select(F.col(key).alias("__key")).distinct()
    if keys.limit(EDIT_ROWS + 1).count() <= EDIT_ROWS:
        keys = F.broadcast(keys)
    touched = {r[0] for r in trees.select(key, name.alias("__file")).join(keys, F.col(key).eqNullSafe(F.col("__key")), "left_semi").select("__file").distinct().collect()}
    if not touched:
        return files
    apply_edits(spark.read.parquet(*sorted(touched)), edits, ranks, pattern, key, changes).write.parquet(to)
    every = [r[0] for r in trees.select(name).distinct().collect()]
    return sorted(set(every) - touched) + sorted(r[0] for r in spark.read.parquet(to).select(name).distinct().collect())


def totals(trees: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_chars, n_tokens, n_pretokens) of stored trees; no leaf is read."""
    return trees.select(key, *_SUMS)


def count_tokens(docs: DataFrame, edits: Column, ranks: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts before and after each row's edits: (key, n_tokens, n_pretokens, edited_tokens, edited_chars, reencoded).

    edits is an array of (at, removed, inserted), applied in its order;
    reencoded is the number of pre-tokens that the edits had encoded anew.
    """
    limit_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    names = ["n_tokens", "n_pretokens", "edited_tokens", "edited_chars", "reencoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = counter(ranks, pattern)
        for batch in batches:
            rows = []
            for content, changes in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                doc = Document(content, by)
                first = doc.tokens, doc.n_pieces
                doc.apply(changes)
                rows.append((*first, doc.tokens, doc.chars, doc.encoded))
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in columns]], names=[key, *names])

    return docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("__text"), edits.cast(f"array<{EDIT}>").alias("__edits")).mapInArrow(run, f"{key} {kind}, {', '.join(f'{n} bigint' for n in names)}")


def sample_edits(text: str) -> Column:
    """Four edits whose places follow from the text's length: a replacement, a removal, an insertion and an addition."""
    n = F.length(F.coalesce(F.col(text), F.lit("")))
    at = lambda share: F.floor(n * share).cast("int")
    one = lambda where, removed, inserted: F.struct(where.alias("at"), F.lit(removed).alias("removed"), F.lit(inserted).alias("inserted"))
    return F.array(one(at(0.25), 7, " and 12 more, isn't it"), one(at(0.5), 40, ""), one(at(0.75), 0, "\n\n  new"), one(n.cast("int"), 0, " the end."))
