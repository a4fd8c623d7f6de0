"""Every query runs on the smallest data, and those with an SQL twin agree with it."""

import glob
import math
import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry

DATA = os.environ.get("DOCLOOM_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    return repr(round(value, 6)) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, name):
    df = entry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if (sql := entry.oracle_sql().get(name)) is None:
        return
    import duckdb

    with duckdb.connect() as db:
        for path in glob.glob(f"{DATA}/*.parquet"):
            db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
        found = db.execute(sql)
        names = [d[0] for d in found.description]
        want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall())
        assert sorted(names) == columns
    assert rows == want


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("hindrance", ["empty folder", "missing dependency"])
def test_core_queries_without_the_training_data(tmp_path, hindrance):
    """What the training-data subpackage lacks never takes the other queries with it."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(f"{root}/docloom", tmp_path / "docloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    (tmp_path / "docloom" / "llm").mkdir()
    if hindrance == "missing dependency":
        (tmp_path / "docloom" / "llm" / "__init__.py").write_text("")
        (tmp_path / "docloom" / "llm" / "registry.py").write_text("import a_module_that_is_missing\n")
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n[0] == 'p' for n in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True, env={**os.environ, "PYTHONPATH": ""})
    n, with_sql, training = out.stdout.split()
    assert int(n) >= 40 and int(with_sql) >= 30 and training == "False"
