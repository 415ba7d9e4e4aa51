"""Every registered query of the verification engine against its SQL, on the smallest tables."""

import duckdb
import pytest

from folioscope.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    show = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(show(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, sf, duck, name):
    frame = catalogue.QUERIES[name](spark, sf)
    got = frame.collect()
    if name in catalogue.SQL:
        found = duck.execute(catalogue.SQL[name])
        columns = [d[0] for d in found.description]
        assert sorted(columns) == sorted(frame.columns)
        assert rows(frame.columns, got) == rows(columns, found.fetchall())
    else:
        assert got


def test_entry_needs_no_session_to_import():
    import subprocess
    import sys

    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries()); print(len(e.queries()))"
    assert int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout) > 80


def test_entry_without_a_library_of_the_subpackage():
    import subprocess
    import sys

    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries()); assert not [n for n in e.queries() if n.startswith('op')]; print(len(e.queries()))"
    assert int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout) > 95


def test_stored_results_follow_every_table(spark, sf, tmp_path):
    import shutil

    copy = tmp_path / "sf"
    copy.mkdir()
    for t in ("documents", "part"):
        src = f"{sf}/{t}.parquet"
        shutil.copytree(src, copy / f"{t}.parquet") if __import__("os").path.isdir(src) else shutil.copy(src, copy / f"{t}.parquet")
    run = lambda: {r.objectives for r in catalogue.QUERIES["run_delivery"](spark, str(copy)).collect()}
    before = run()
    some = spark.read.parquet(f"{sf}/part.parquet").where("p_partkey <> 0").limit(40)
    some.write.parquet(str(tmp_path / "part"))
    path = copy / "part.parquet"
    shutil.rmtree(path) if path.is_dir() else path.unlink()
    shutil.copytree(tmp_path / "part", path)
    fewer = run()
    assert before != fewer
