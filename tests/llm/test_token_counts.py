"""Trees under edits against encoding the whole text again."""

import random
import time

import pytest

from folioscope.llm import token_counts as C
from folioscope.llm.common import table, tokenizer_path

import public_tokenizers

RANKS, PATTERN = tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
BY = C.counter(RANKS, PATTERN)


def whole(text):
    return len(BY.encoding.encode_ordinary(text))


def check(node):
    """Sums, balance and sizes of a whole tree; returns its number of leaves."""
    if isinstance(node, C.Leaf):
        pieces, counts = node.open()
        assert 0 < len(pieces) <= C.LEAF
        assert (node.chars, node.tokens, node.n, node.height) == (sum(map(len, pieces)), sum(counts), len(pieces), 0)
        return 1
    assert abs(node.left.height - node.right.height) <= 1 and node.height == 1 + max(node.left.height, node.right.height)
    assert (node.chars, node.tokens, node.n) == tuple(getattr(node.left, k) + getattr(node.right, k) for k in ("chars", "tokens", "n"))
    return check(node.left) + check(node.right)


@pytest.mark.parametrize("leaf, read", [(128, 256), (3, 4)])
def test_random_edits(monkeypatch, leaf, read):
    monkeypatch.setattr(C, "LEAF", leaf)
    monkeypatch.setattr(C, "_READ", read)
    rng, parts = random.Random(8), ["'", "l", "ll", "ve", " ", "  ", "\n", "a", "Word", "12", "é", "!?", "'s", "日", "\t", " x"]
    some = lambda n: "".join(rng.choice(parts) for _ in range(rng.randrange(n)))
    for _ in range(150):
        text = some(120)
        doc = C.Document(text, BY)
        for _ in range(8):
            at, removed, inserted = rng.randrange(len(text) + 3), rng.choice([0, 0, 1, 2, 5, 60]), some(rng.choice([1, 2, 12]))
            doc.edit(at, removed, inserted)
            text = text[:at] + inserted + text[at + removed :]
            assert doc.text() == text and doc.chars == len(text)
            assert doc.tokens == whole(text)
            assert list(doc.pieces()) == BY.split(text) and doc.n_pieces == len(BY.split(text))
            assert not doc.root or check(doc.root)
        again = C.Document.stored([leaf.row() for _, leaf in C.leaves(doc.root)], BY)
        assert (again.text(), again.tokens) == (text, doc.tokens)


def test_an_edit_touches_little():
    text = "some words go here and there. " * 20_000
    doc = C.Document(text, BY)
    doc.edit(300_000, 3, "new")
    assert doc.encoded < 12 and doc.tokens == whole(text[:300_000] + "new" + text[300_003:])


def test_many_appends_stay_balanced():
    doc, began = C.Document("", BY), time.perf_counter()
    for i in range(100_000):
        doc.edit(doc.chars, 0, f" word{i % 97} and")
    assert time.perf_counter() - began < 60
    leaves = check(doc.root)
    assert doc.root.height < 2 * leaves.bit_length() and leaves < 4 * doc.n_pieces / C.LEAF
    assert doc.tokens == whole(doc.text())


def test_many_removals_leave_no_empty_leaves():
    doc = C.Document("some words go here. " * 5_000, BY)
    while doc.chars > 50:
        doc.edit(doc.chars // 3, 900, "")
    assert check(doc.root) == 1 and doc.tokens == whole(doc.text())
    doc.edit(0, 10**9, "")
    assert doc.root is None and (doc.tokens, doc.chars, doc.n_pieces) == (0, 0, 0)
    doc.edit(0, 0, "anew")
    assert doc.text() == "anew"


def test_stored_trees(spark, tmp_path):
    """A second run over a stored table opens and encodes only what edits touch."""
    text = "some words go here and there. " * 20_000
    rows = spark.createDataFrame([(1, text, "x"), (2, None, "y"), (3, "left alone", "z"), (1, "a second row", "q")], "doc_id bigint, text string, leaves string")
    C.build_trees(rows, RANKS, PATTERN).write.parquet(str(tmp_path / "trees"))
    trees = spark.read.parquet(str(tmp_path / "trees"))
    edits = spark.createDataFrame([(1, [(3, 2, "new"), (300_000, 0, " more")]), (2, [(0, 0, "from nothing")]), (3, None)], f"doc_id bigint, edits array<{C.EDIT}>")
    C.apply_edits(trees, edits, RANKS, PATTERN).write.parquet(str(tmp_path / "next"))
    after = spark.read.parquet(str(tmp_path / "next"))
    one = text[:3] + "new" + text[5:]
    one = one[:300_000] + " more" + one[300_000:]
    # The second edit is clipped to the end of the short row.
    want = sorted([(1, whole(one)), (1, whole("a snewcond row more")), (2, whole("from nothing")), (3, whole("left alone"))])
    assert sorted((r.doc_id, r.n_tokens) for r in C.totals(after).collect()) == want
    assert after.agg({"reencoded": "max"}).first()[0] < 20
    assert "leaves" not in C.totals(after)._jdf.queryExecution().executedPlan().toString()
    # In one process: leaves that no edit touches stay packed.
    doc = C.Document.stored([leaf.row() for _, leaf in C.leaves(C.Document(text, BY).root)], BY)
    doc.edit(300_000, 3, "new")
    assert sum(leaf.opened for _, leaf in C.leaves(doc.root)) <= 3


def test_only_files_with_edited_keys_are_written(spark, tmp_path):
    rows = spark.range(4000).selectExpr("id AS doc_id", "concat('some words of row ', id) AS text").repartitionByRange(8, "doc_id").sortWithinPartitions("doc_id")
    C.build_trees(rows, RANKS, PATTERN).write.parquet(str(tmp_path / "trees"))
    files = sorted(map(str, (tmp_path / "trees").glob("*.parquet")))
    edits = spark.createDataFrame([(7, [(0, 4, "no")]), (9, [(0, 0, "x ")]), (99_999, [(0, 0, "lost")])], f"doc_id bigint, edits array<{C.EDIT}>")
    after = C.edit_files(spark, files, edits, str(tmp_path / "next"), RANKS, PATTERN)
    assert len(files) == 8 and sum("/trees/" in f for f in after) == 7
    got = {r.doc_id: r.n_tokens for r in C.totals(spark.read.parquet(*after)).collect()}
    assert len(got) == 4000 and got[7] == whole("no words of row 7") and got[9] == whole("x some words of row 9") and got[8] == whole("some words of row 8")
    assert C.edit_files(spark, after, edits.limit(0), str(tmp_path / "none"), RANKS, PATTERN) == after


def test_query(spark, sf):
    docs = table(spark, sf, "documents")
    got = {r.doc_id: r for r in C.count_tokens(docs, C.sample_edits("text"), RANKS, PATTERN).collect()}
    for row in docs.collect():
        n, text = len(row.text), row.text
        edited = text
        for at, removed, inserted in ((n // 4, 7, " and 12 more, isn't it"), (n // 2, 40, ""), (int(n * 0.75), 0, "\n\n  new"), (n, 0, " the end.")):
            edited = edited[:at] + inserted + edited[at + removed :]
        r = got[row.doc_id]
        assert (r.n_tokens, r.n_pretokens, r.edited_tokens, r.edited_chars) == (whole(text), len(BY.split(text)), whole(edited), len(edited))


def test_odd_rows(spark):
    rows = spark.createDataFrame([(1, None, 0), (1, None, 0), (None, "a" * 200_000, 0)], "doc_id bigint, text string, n_tokens int")
    from pyspark.sql import functions as F

    got = sorted((r.doc_id or 0, r.n_tokens, r.edited_tokens) for r in C.count_tokens(rows, F.lit(None), RANKS, PATTERN).collect())
    assert got == [(0, whole("a" * 200_000), whole("a" * 200_000)), (1, 0, 0), (1, 0, 0)]
    no_edits = spark.createDataFrame([], f"doc_id bigint, edits array<{C.EDIT}>")
    assert C.apply_edits(C.build_trees(rows, RANKS, PATTERN), no_edits, RANKS, PATTERN).count() == 3
    assert C.build_trees(rows.limit(0), RANKS, PATTERN).count() == 0
    assert C.count_tokens(rows.limit(0), C.sample_edits("text"), RANKS, PATTERN).count() == 0
