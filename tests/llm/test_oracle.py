"""Every training-data query that SQL can express equals its DuckDB SQL."""
import duckdb
import pytest

from ordwise.llm.queries import ORACLE_SQL, QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name, sf):
    folder = f"/root/testdata/{sf}"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    found = con.execute(ORACLE_SQL[name])
    columns, want = [d[0] for d in found.description], found.fetchall()
    df = QUERIES[name](spark, folder)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(want)


def test_pii_and_secret_sql_on_odd_texts(spark, tmp_path):
    """The fixture texts of the span tests, through both engines."""
    from test_spans import TEXTS
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    for name in ("op2_pii", "op4_secrets"):
        found = con.execute(ORACLE_SQL[name])
        columns, want = [d[0] for d in found.description], found.fetchall()
        got = {r.doc_id: r for r in QUERIES[name](spark, str(tmp_path)).collect()}
        for row in want:
            assert tuple(got[row[0]][c] for c in columns) == row, TEXTS[row[0]]
