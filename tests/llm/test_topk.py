"""Exact search against a full matrix product, and against SQL."""
import duckdb
import numpy as np
from pyspark.sql import functions as F

from ordwise.llm import topk
from ordwise.llm.queries import ORACLE_SQL, op10_topk


def plain(ids, m, queries, k):
    out = set()
    for i in queries:
        s = m @ m[i]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out |= {(int(ids[i]), r + 1, int(ids[j]), int(s[j])) for r, j in enumerate(order)}
    return out


def test_query_equals_brute_force_and_sql(spark, small):
    t = spark.read.parquet(f"{small}/embeddings.parquet").toPandas()
    m = np.floor(1024 * np.stack(t.embedding.values).astype(float)).astype(np.int64)
    ids = t.vec_id.values
    rows = {tuple(r) for r in op10_topk(spark, small).collect()}
    assert rows == plain(ids, m, np.flatnonzero(ids % 100 == 0), 10)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{small}/embeddings.parquet'")
    assert rows == set(con.execute(ORACLE_SQL["op10_topk"]).fetchall())


def test_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "SLAB_ROWS", 40)
    monkeypatch.setattr(topk, "QUERY_ROWS", 5)
    rng = np.random.default_rng(1)
    m = rng.integers(-2, 3, (300, 21))
    m[50:150] = m[50]
    df = spark.createDataFrame([(int(i), [float(x) / 1024 for x in v]) for i, v in enumerate(m)],
                               "vec_id long, embedding array<double>")
    v = topk.quantised(df)
    got = topk.top_k(v, v.filter("vec_id % 20 = 0"), 7).collect()
    assert {tuple(r) for r in got} == plain(np.arange(300), m, range(0, 300, 20), 7)


def test_queries_are_dealt_by_their_values(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_ROWS", 50)
    df = spark.createDataFrame([(i, [i, -i]) for i in range(400)], "vec_id long, v array<bigint>")
    dealt = [{r.vec_id: r.b for r in d.select("vec_id", topk.query_block(8).alias("b")).collect()}
             for d in (df, df.orderBy(F.desc("vec_id")).repartition(5))]
    assert dealt[0] == dealt[1] and set(dealt[0].values()) == set(range(8))
    m = np.array([[i, -i] for i in range(400)])
    got = topk.top_k(df, df, 3)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("monotonically_increasing_id") == 1 and {tuple(r) for r in got.collect()} == plain(
        np.arange(400), m, range(400), 3)


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 2.0]), (1, [1.0, None]), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, None), (5, [0.5]), (6, []),
            (7, [-1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, [1.0, 1.0]), (8, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit("x"))
    v = topk.quantised(df)
    got = [tuple(r) for r in topk.top_k(v, v.filter("vec_id = 0")).orderBy("rank").collect()]
    s = 1024 * 1024
    assert got == [(0, 1, 7, 3 * s), (0, 2, 8, 3 * s), (0, 3, 8, 3 * s), (0, 4, 5, s // 2), (0, 5, 6, 0)]
    none = v.filter("vec_id = 99")
    assert topk.top_k(v, none).count() == 0 and topk.top_k(none, none).count() == 0
    assert topk.top_k(none, v).count() == 0


def test_search_prunes_to_the_same_result_with_any_block():
    rng = np.random.default_rng(7)
    m = (rng.normal(size=(500, 64)) * 100 * np.linspace(3, 0.1, 64)).astype(np.int64)
    ids = rng.permutation(500)
    want = plain(ids, m, range(9), 10)
    for block in (1, 5, 8, 64, 100):
        i, j, s = topk.search_block(ids[:9], m[:9], ids, m, 10, block)
        rank = np.zeros(len(i), int)
        for x in range(9):
            rank[i == x] = np.arange(1, (i == x).sum() + 1)
        assert {(int(ids[a]), int(r), int(ids[b]), int(c)) for a, r, b, c in zip(i, rank, j, s)} == want


def test_repeated_queries_meet_each_other(spark, tmp_path):
    """Every row whose id is a query is one; its candidates are all rows but itself."""
    rows = [(100, [1.0, 2.0])] * 3 + [(100, [0.5, 0.5]), (200, [1.0, 2.0]), (7, [3.0, -1.0])]
    path = str(tmp_path / "embeddings.parquet")
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(path)
    got = {}
    for r in op10_topk(spark, str(tmp_path)).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    m = [[int(1024 * x) for x in v] for _, v in rows]
    want = {}
    for i, (q, _) in enumerate(rows):
        if q % 100 == 0:
            best = sorted((-sum(a * b for a, b in zip(m[i], m[j])), rows[j][0]) for j in range(len(rows)) if j != i)
            want.setdefault(q, []).extend((r + 1, v, -s) for r, (s, v) in enumerate(best[:10]))
    assert {q: sorted(x) for q, x in got.items()} == {q: sorted(x) for q, x in want.items()}
    assert len(got[100]) == 4 * 5


def test_one_huge_component_does_not_fail_the_others(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(120)]
    rows[13] = (13, [1e18, -1.0, 0.0, 2.0, 0.0, 0.0])
    rows[20] = (20, [-1e30, 0.0, 0.0, 0.0, 0.0, 1.0])
    v = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    ints = {r.vec_id: list(r.v) for r in v.collect()}
    top = (1 << 63) - 1
    want = set()
    for q in range(0, 120, 20):
        best = sorted((-min(max(sum(a * b for a, b in zip(ints[q], c)), -top - 1), top), i) for i, c in ints.items() if i != q)
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best[:10])}
    got = {tuple(r) for r in topk.top_k(v, v.filter("vec_id % 20 = 0")).collect()}
    assert got == want and any(abs(r[3]) == top for r in got)
