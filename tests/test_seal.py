"""Trees of digests: differences, updates and what they read."""

import random

import pytest

from folioscope.operators import manifest as M

SCHEMA = "filename string, sha256 string, bytes bigint"


def frame(spark, files):
    return spark.createDataFrame([(n, s, 1) for n, s in files.items()], SCHEMA)


def rows(found):
    return sorted(tuple(r) for r in found.select("filename", "status", "sealed_sha", "current_sha").collect())


def test_updates_and_differences(spark, tmp_path):
    rng = random.Random(1)
    files = {f"f{i}.md": f"{i:x}" for i in range(120)}
    seal = M.Seal.write(frame(spark, files), str(tmp_path / "0"), 2)
    now, states = seal, [(seal, dict(files))]
    for step in range(2):
        changes = {f"f{rng.randrange(130)}.md": rng.choice((None, f"s{step}")) for _ in range(rng.choice((1, 12)))}
        now = now.update(spark.createDataFrame([(n, s, 1) for n, s in changes.items()], SCHEMA), str(tmp_path / str(step + 1)))
        files = {n: s for n, s in (files | changes).items() if s is not None}
        states.append((now, dict(files)))
        assert {r.filename: r.sha256 for r in now.files().collect()} == files
        # An update leads to the same tree as a new seal, and writes only what it touches.
        assert now.root() == M.Seal.write(frame(spark, files), str(tmp_path / f"new{step}"), 2).root()
        assert spark.read.parquet(str(tmp_path / str(step + 1) / "nodes" / "2")).count() <= len(changes)
    for (a, of_a), (b, of_b) in zip(states, states[1:] + states[:1], strict=True):
        assert rows(a.diff(b)) == rows(M.integrity_diff(frame(spark, of_b), frame(spark, of_a)))
    # Only leaves that differ are looked at.
    one = seal.update(spark.createDataFrame([("f7.md", "x", 1)], SCHEMA), str(tmp_path / "one"))
    assert seal.unequal(one).count() == 1
    again = M.Seal.open(spark, one.paths)
    assert again.root() == one.root() and again.depth == 2


def test_empty_seals(spark, tmp_path):
    none = M.Seal.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "0"))
    assert none.root() is None and none.files().count() == 0 and none.depth == 1
    some = none.update(spark.createDataFrame([("a", "1", 1), ("gone", None, 0)], SCHEMA), str(tmp_path / "1"))
    assert rows(none.diff(some)) == [("a", "added", None, "1")]
    back = some.update(spark.createDataFrame([("a", None, 0)], SCHEMA), str(tmp_path / "2"))
    assert back.root() is None and rows(some.diff(back)) == [("a", "removed", "1", None)]
    with pytest.raises(ValueError):
        none.diff(M.Seal.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "3"), 2))
