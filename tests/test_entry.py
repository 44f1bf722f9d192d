"""Driver contract: entry smoke test and every query against its DuckDB oracle (sf0.001)."""
import hashlib
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from ordwise.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return "NULL" if v is None else str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 6000
    assert df.columns == ["rk", "key_hex", "l_orderkey", "l_linenumber", "l_shipdate"]
    assert sorted(r["rk"] for r in rows) == list(range(1, len(rows) + 1))


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(E.queries())
    assert set(catalog.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_every_query_is_mapped_to_operators():
    from ordwise.plans.catalog import QUERY_OPERATORS
    assert set(QUERY_OPERATORS) == set(catalog.QUERIES)


@pytest.mark.parametrize("without", [["llm"], ["llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_entry_without_optional_parts(tmp_path, without):
    """A copy that lacks the training-data parts still offers every other query."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", *without))
    code = "import __spark_entry__ as E; print(*sorted(E.queries())); print(*sorted(E.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True,
                         env={**os.environ, "PYTHONPATH": str(copy)})
    assert out.returncode == 0, out.stderr
    names, sql = (set(line.split()) for line in out.stdout.splitlines())
    assert set(catalog.QUERIES) <= names and set(catalog.QUERIES) <= sql
    assert "pipeline" not in names
    assert ("op2_pii" in names) == ("llm" not in without)
