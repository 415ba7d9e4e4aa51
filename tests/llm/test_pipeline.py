"""Each stage against a brute-force version of its decision."""

import pytest

from folioscope.llm import common, decontaminate, quality_classifier, quality_rules, simhash
from folioscope.llm.common import table

from .test_decontaminate import brute as brute_hits
from .test_simhash import brute_components, brute_fingerprint

pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark, sf, tmp_path):
    docs, before = table(spark, sf, "documents"), None
    for i, (name, stage) in enumerate(pipeline.STAGES):
        rows = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, sf)
        out.write.parquet(f"{tmp_path}/{i}")
        out = spark.read.parquet(f"{tmp_path}/{i}")
        got = [r.doc_id for r in out.collect()]
        assert len(got) == len(set(got))
        if i == 0:
            model = quality_classifier.train(docs, table(spark, sf, "labels"))
            want = {r.doc_id for r in quality_classifier.score(docs, model).collect() if r.predicted == 1}
        elif i == 1:
            want = {r.doc_id for r in quality_rules.statistics(docs).collect() if r.kept}
        elif i == 2:
            parts = brute_components({d: brute_fingerprint(r.text) for d, r in rows.items()})
            want = set(parts.values())
        elif i == 3:
            items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
            want = {d for d, x in brute_hits([(d, r.text) for d, r in rows.items()], items).items() if not x[4]}
        else:
            want = set(rows)
        assert set(got) == want, name
        if i < len(pipeline.STAGES) - 1:
            assert out.columns == docs.columns == pipeline.COLUMNS
            assert len(want) < len(rows), name
            assert {r.doc_id: r for r in out.collect()} == {d: rows[d] for d in want}
        docs = out
    assert sorted(map(tuple, pipeline.run(spark, sf).collect())) == sorted(map(tuple, docs.collect()))


def test_keep_one_of_odd_rows(spark):
    rows = [(2, "a b c d", "x"), (2, "a b c d", "y"), (1, "other words are here", "z"), (1, None, "z"), (None, "A b c d", "n"), (None, "lonely text without a key", "n"), (None, "lonely text without a key", "m"), (5, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp string")
    got = sorted((r.doc_id or 0, r.text or "") for r in simhash.keep_one(docs).collect())
    assert got == [(0, "lonely text without a key"), (1, ""), (1, "other words are here"), (2, "a b c d")]
    assert simhash.keep_one(docs.limit(0)).columns == docs.columns
    # Beyond the bound of what is broadcast, positions are joined.
    assert sorted((r.doc_id or 0, r.text or "") for r in simhash.keep_one(docs, most=0).collect()) == got


@pytest.mark.parametrize("name", ["__fp", "__file", "__row", "__FILE", "k", "label", "__key"])
def test_keep_one_beside_any_column(spark, name):
    docs = spark.createDataFrame([(1, "a b c d", 5), (2, "a b c d", 6), (3, "x y z w", 7)], f"doc_id bigint, text string, `{name}` int")
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == [(1, "a b c d", 5), (3, "x y z w", 7)]


def test_keep_one_reads_files_in_place(spark, sf):
    plan = simhash.keep_one(table(spark, sf, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "documents.parquet" in plan and "Exchange" not in plan


def test_rows_of_a_join_have_places_of_their_own(spark, tmp_path):
    """Rows that share a position in a file must not fall together."""
    spark.createDataFrame([(1, "a b c d"), (2, "x y z w")], "k bigint, text string").write.parquet(str(tmp_path / "t"))
    twice = spark.read.parquet(str(tmp_path / "t")).join(spark.range(2), how="cross").selectExpr("k * 10 + id AS doc_id", "if(id = 0, text, concat(text, ' of its own kind')) AS text")
    assert sorted(r.doc_id for r in simhash.keep_one(twice).collect()) == [10, 11, 20, 21]
    some = spark.read.parquet(str(tmp_path / "t")).where("k = 2").selectExpr("text", "k AS doc_id")
    assert [tuple(r) for r in simhash.keep_one(some).collect()] == [("x y z w", 2)]


def test_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, name, other):
            return other

    class Session:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "spark://somewhere"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(ValueError, match="checkpoint"):
        common.shared_folder(Session())


@pytest.mark.parametrize("keep", ["rules", "classifier", "benchmark", "blocks", "copies"])
def test_filters_of_odd_rows(spark, sf, keep):
    """Null keys, null and empty texts, repeated rows, clashing columns and empty tables."""
    benchmark = table(spark, sf, "benchmark")
    passage = " ".join(next(r.text.split() for r in benchmark.collect() if r.text and len(r.text.split()) >= 12)[:12])
    rows = [(None, None, "a", 1), (1, "", "b", 2), (1, passage, "c", 3), (1, passage, "c", 3), (None, "w " * 50_000, "d", 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, item_id string, kept int")
    model = quality_classifier.train(table(spark, sf, "documents"), table(spark, sf, "labels"))
    run = {
        "rules": quality_rules.keep,
        "classifier": lambda d: quality_classifier.keep(d, model),
        "benchmark": lambda d: decontaminate.keep(d, benchmark),
        "blocks": lambda d: decontaminate.keep(d, benchmark, block_rows=7),
        "copies": simhash.keep_one,
    }[keep]
    got = run(docs)
    assert got.columns == docs.columns and set(map(tuple, got.collect())) <= set(rows)
    if keep in ("benchmark", "blocks"):
        assert sorted(r.kept for r in got.collect()) == [1, 2, 4]
    assert run(docs.limit(0)).count() == 0 and run(docs.unionByName(docs)).count() <= 10
    assert common.filter_texts(docs, "text", lambda t: [not x for x in t]).count() == 2
