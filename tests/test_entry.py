"""Driver contract: entry() smoke and every registered query against its
DuckDB oracle on the smallest driver tables."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from conftest import ROOT, SF_SMALL
from tools.check_oracle import TABLES, digest

# what SQL cannot say is named by the optional subpackage and tested there
NO_ORACLE: set[str] = set(E.llm.NO_ORACLE) if E.llm else set()
NO_ORACLE |= {"pipeline"} if E.corpus_pipeline and not E.corpus_pipeline.ORACLE_SQL else set()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["region", "month", "total_sales", "order_count"]


def test_every_query_has_an_oracle():
    assert set(E.queries()) - set(E.oracle_sql()) == NO_ORACLE


@pytest.mark.parametrize("kept", [(), ("corpus_pipeline.py",)])
def test_entry_imports_without_the_optional_part(tmp_path, kept):
    gone = shutil.ignore_patterns("llm", ".git", "__pycache__", ".hypothesis", ".pytest_cache", *({"corpus_pipeline.py"} - set(kept)))
    copy = shutil.copytree(ROOT, tmp_path / "repo", ignore=gone)
    code = "import __spark_entry__ as E, sys; print(len(E.queries()), len(E.oracle_sql()), any('llm' in m for m in sys.modules))"
    env = {**os.environ, "PYTHONPATH": str(copy), "PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    retail = len(E.catalog.QUERIES)
    assert done.stdout.split() == [str(retail), str(retail), "False"]
    assert not {"pipeline", "op1_warc_derivatives"} & set(E.catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
