"""Each registered query with SQL against DuckDB on the smallest tables; entry() and the optional part's guard."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from tomewright.plans import catalog_queries, source_queries  # noqa: F401  (add to the queries)
from tomewright.plans.queries import QUERIES, SQL

ROOT = Path(__file__).resolve().parent.parent
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(frame):
    def cell(v):
        if v is None or v != v:
            return "null"
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(cell(v) for v in row) for row in frame.where(frame.notna(), None).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, duck, name):
    got, expected = QUERIES[name](spark, sf_dir).toPandas(), duck.execute(SQL[name]).fetchdf()
    assert sorted(got.columns) == sorted(expected.columns)
    assert norm(got) == norm(expected)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_entry_without_the_optional_part(tmp_path):
    """With the corpus operators and the pipeline gone, the entry module still imports and has all other queries."""
    import shutil

    shutil.copytree(ROOT / "tomewright", tmp_path / "tomewright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert out.stdout.split() == [str(len(QUERIES)), str(len(SQL))]
