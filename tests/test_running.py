"""Running values over blocks of lines against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from folioscope.operators import running as R


@pytest.mark.parametrize("block", [1, 4, 1 << 16])
def test_against_loops(spark, block):
    rng = random.Random(block)
    lines = [(d, i + 1, rng.choice((None, None, None, 0, 1))) for d in ("a", "b", "c", "d") for i in range({"a": 40, "b": 3, "c": 17, "d": 1}[d])]
    rows = spark.createDataFrame(rng.sample(lines, len(lines)), "doc string, line_no bigint, e int")
    last, count = {}, {}
    for d, i, e in lines:
        before = (d, i - 1)
        last[d, i] = last.get(before) if e is None else e
        count[d, i] = count.get(before, 0) + (e is not None)
    assert {(r.doc, r.line_no): r.out for r in R.last_event(rows, "doc", F.col("e"), "out", block).collect()} == last
    got = R.count_events(rows, "doc", F.col("e"), "out", block)
    assert {(r.doc, r.line_no): r.out for r in got.collect()} == count and got.columns == ["doc", "line_no", "e", "out"]


def test_no_window_holds_a_document(spark):
    rows = spark.range(10).selectExpr("'a' AS doc", "id AS line_no", "1 AS e")
    plan = R.last_event(rows, "doc", F.col("e"), "out")._jdf.queryExecution().toString()
    assert "windowspecdefinition(doc" in plan and plan.count("__block") > 3
