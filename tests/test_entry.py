"""Driver contract + every registered query against its DuckDB twin at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as se
from conftest import SF_SMALL
from gridmix.plans import catalog
from scripts.check_oracle import TABLES, rows_of

catalog.load_all()
QUERIES, ORACLE = catalog.QUERIES, catalog.ORACLE


def test_contract(spark):
    df = se.entry(spark)
    assert df.count() > 0 and "renewable_pct" in df.columns
    assert set(se.oracle_sql()) <= set(se.queries())
    assert set(QUERIES) <= set(se.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    o_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(o_cols)
    assert rows_of(df.columns, s_rows) == rows_of(o_cols, res.fetchall())


def test_entry_without_the_text_operators(tmp_path):
    """In a copy that lacks their folders, with and without the pipeline's file, the entry names the other queries."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    copy = tmp_path / "copy"
    copy.mkdir()
    shutil.copytree(f"{root}/gridmix", copy / "gridmix", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    ask = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
    for files in (["__spark_entry__.py"], ["__spark_entry__.py", "corpus_pipeline.py"]):
        for f in files:
            shutil.copy(f"{root}/{f}", copy)
        out = subprocess.run([sys.executable, "-c", ask], cwd=copy, env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True)
        assert out.returncode == 0, out.stderr
        assert out.stdout.split() == [str(len(QUERIES)), str(len(ORACLE)), "False"]
