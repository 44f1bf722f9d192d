"""Total order, global rank, skew handling."""
import collections

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ordwise.functions.keys import md5_key
from ordwise.operators.partition import TIEBREAK, partition_even, partition_sampled
from ordwise.operators.sort import sort_records, with_global_rank
from ordwise.operators.validate import validate
from ordwise.sources.generator import generate_records


def _parts(df, col="key"):
    return df.rdd.mapPartitions(lambda it: [[r[col] for r in it]]).collect()


@pytest.mark.parametrize("strategy", ["even", "sampled"])
def test_concatenated_partitions_are_sorted(spark, strategy):
    g = generate_records(spark, 20000, num_partitions=4).select("key", "value")
    s = sort_records(g, ["key"], strategy, 6)
    flat = [k for p in _parts(s) for k in p]
    assert flat == sorted(r["key"] for r in g.select("key").collect())
    assert validate(s).first()["ok"]


def test_even_partitioner_places_top_prefix_in_last_partition(spark):
    df = spark.createDataFrame([(bytes([0xFF] * 10),), (bytes(10),)], "key binary")
    parts = _parts(partition_even(df, 3))
    assert parts[2] == [bytes([0xFF] * 10)] and parts[0] == [bytes(10)]


@pytest.mark.parametrize("strategy", ["even", "sampled"])
def test_global_rank_equals_row_number(spark, strategy):
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select(
        "o_orderkey", md5_key("o_orderkey").alias("key"))
    ranked = with_global_rank(o, ["key"], strategy, 7)
    exp = o.select("o_orderkey", F.row_number().over(Window.orderBy("key")).alias("rn"))
    assert ranked.join(exp, "o_orderkey").filter("rk != rn").count() == 0
    assert ranked.count() == 15000


def test_ascii_keys_skew_even_but_not_sampled(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    keyed = li.select(F.lpad(F.col("l_orderkey").cast("string"), 10, "0").cast("binary").alias("key"))
    even_sizes = [len(p) for p in _parts(partition_even(keyed, 8))]
    assert max(even_sizes) == sum(even_sizes)          # digits share one prefix range
    sampled = [len(p) for p in _parts(sort_records(keyed, ["key"], "sampled", 8))]
    assert max(sampled) < 0.25 * sum(sampled)


def test_hot_key_is_split_across_partitions(spark):
    # a third of all rows share one key
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    s = sort_records(df, ["k"], "sampled", 8)
    sizes = [len(p) for p in _parts(s, "k")]
    assert sum(sizes) == 30000 and max(sizes) < 0.2 * 30000
    flat = [k for p in _parts(s, "k") for k in p]
    assert flat == sorted(flat)
    assert TIEBREAK not in s.columns


def test_plans_have_one_shuffle(spark):
    g = generate_records(spark, 1000, num_partitions=2).select("key", "value")
    for strategy in ("even", "sampled"):
        plan = sort_records(g, ["key"], strategy, 4)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1, plan
    even = sort_records(g, ["key"], "even", 4)._jdf.queryExecution().executedPlan().toString()
    assert "Sort [key" in even
    sampled = partition_sampled(g, 4, "key")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in sampled


def test_even_ranges_need_binary_keys(spark):
    df = spark.range(0, 30).select(F.md5(F.col("id").cast("string")).alias("k"), "id")
    for key in ("k", "id"):
        with pytest.raises(TypeError):
            sort_records(df, [key], "even", 4)
        with pytest.raises(TypeError):
            with_global_rank(df, [key], "even", 4)
    with pytest.raises(ValueError):
        sort_records(df, ["k"], "global", 4)


def test_null_keys_come_first(spark):
    df = spark.createDataFrame([(None if i % 5 == 0 else bytes([255 - i % 256] * 10), i) for i in range(500)],
                               "key binary, id int")
    for strategy in ("even", "sampled"):
        flat = [k for p in _parts(sort_records(df, ["key"], strategy, 6)) for k in p]
        assert flat[:100] == [None] * 100 and flat[100:] == sorted(flat[100:])
        r = [x["key"] for x in with_global_rank(df, ["key"], strategy, 6).orderBy("rk").collect()]
        assert r[:100] == [None] * 100 and r[100:] == sorted(r[100:])


def test_sampled_rank_is_one_lazy_query(spark):
    """No checkpoint, no job while it is built, and a hot key spread over partitions."""
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    sc = spark.sparkContext
    sc.setJobGroup("rank", "rank")
    ranked = with_global_rank(df, ["k"], "sampled", 8)
    assert not sc.statusTracker().getJobIdsForGroup("rank")
    sc.setJobGroup("after", "after")
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "Checkpoint" not in plan
    rows = ranked.withColumn("pid", F.spark_partition_id()).orderBy("rk").collect()
    assert [r["rk"] for r in rows] == list(range(1, 30001))
    assert [r["k"] for r in rows] == sorted(r["k"] for r in rows)
    sizes = {}
    for r in rows:
        sizes[r["pid"]] = sizes.get(r["pid"], 0) + 1
    assert len(sizes) == 8 and max(sizes.values()) < 0.25 * 30000


def test_sampled_rank_of_odd_keys(spark):
    nan = float("nan")
    vals = [None, nan, 1.5, -2.0, None, nan, 7.0, 1.5] * 40
    df = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "x double, i int")
    got = [r["x"] for r in with_global_rank(df, ["x"], "sampled", 5).orderBy("rk").collect()]
    want = [r["x"] for r in df.orderBy("x").collect()]
    assert list(map(str, got)) == list(map(str, want))
    assert with_global_rank(df.limit(0), ["x"], "sampled", 5).count() == 0
    same = spark.range(100).select(F.lit(1).alias("x"))
    assert sorted(r["rk"] for r in with_global_rank(same, ["x"], "sampled", 3).collect()) == list(range(1, 101))


def test_choosing_the_partition_count_runs_no_job(spark):
    from ordwise.operators.sort import default_partitions
    df = spark.range(9000).groupBy((F.col("id") % 3000).alias("k")).count()
    sc = spark.sparkContext
    sc.setJobGroup("count", "count")
    assert default_partitions(df) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert not sc.statusTracker().getJobIdsForGroup("count")
    sc.setJobGroup("after", "after")
    assert sort_records(df, ["k"]).rdd.getNumPartitions() == default_partitions(df)


def test_single_column_key_argument(spark):
    from ordwise.operators.sort import record_key
    g = generate_records(spark, 2000, num_partitions=2, whole=True).select("record")
    s = sort_records(g, record_key(), "sampled", 3)
    flat = [r for p in _parts(s, "record") for r in p]
    assert flat == sorted(flat)
    r = with_global_rank(g, record_key(), "even", 3)
    assert sorted(x["rk"] for x in r.select("rk").collect()) == list(range(1, 2001))


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("strategy", ["even", "sampled"])
def test_rank_reads_one_shuffle(spark, strategy, adaptive):
    """Counts and rows come from one exchange over one scan."""
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select(
        "o_orderkey", "o_totalprice", md5_key("o_orderkey").alias("key"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        plan = _final_plan(with_global_rank(o, ["key"], strategy, 7))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert "ReusedExchange" in plan
    assert plan.count("FileScan") == 1, plan


def test_rank_refuses_counts_of_another_shuffle(spark):
    """Counts that are not those of the rows are an error, never a wrong rank."""
    from ordwise.operators.sort import _attach_rank
    df = spark.range(0, 1000, 1, 4).sortWithinPartitions("id")
    right = [(0, 250, 0), (1, 250, 250), (2, 250, 500), (3, 250, 750)]
    schema = "pid int, n long, offset long"
    ok = _attach_rank(df, spark.createDataFrame(right, schema), "rk").collect()
    assert sorted(r.rk for r in ok) == list(range(1, 1001))
    for wrong in ([(0, 251, 0), (1, 249, 251)] + right[2:], right[:3]):
        with pytest.raises(Exception, match="does not match"):
            _attach_rank(df, spark.createDataFrame(wrong, schema), "rk").collect()


def test_rank_splits_equal_rows(spark):
    df = spark.range(0, 20000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"))
    rows = with_global_rank(df, ["k"], "sampled", 8).withColumn("pid", F.spark_partition_id()).collect()
    assert sorted(r.rk for r in rows) == list(range(1, 20001))
    assert len({r.pid for r in rows if r.k == 0}) > 1
    by_rank = [r.k for r in sorted(rows, key=lambda r: r.rk)]
    assert by_rank == sorted(by_rank)


def test_ranges_grow_with_the_table(spark, tmp_path, monkeypatch):
    """A query's ranges hold a fixed share of the files, so no task's share grows with the table."""
    from ordwise.plans import catalog
    cols = [f"(id * 7919 % {m}) AS {c}" for m, c in zip([50, 9, 7, 5, 3, 2, 90, 10, 8, 2, 2], catalog.LINEITEM_SORT)]
    li = spark.range(0, 4000).selectExpr(*cols)
    li.repartition(4).write.parquet(f"{tmp_path}/lineitem.parquet")
    size = sum(f.stat().st_size for f in (tmp_path / "lineitem.parquet").glob("*"))
    monkeypatch.setattr(catalog, "RANGE_BYTES", size // 20, raising=False)
    got = catalog.q_sort_table_sampled(spark, str(tmp_path)).withColumn("pid", F.spark_partition_id()).collect()
    sizes = collections.Counter(r.pid for r in got)
    assert len(sizes) >= 20 and max(sizes.values()) < 4 * 4000 / 20
    got.sort(key=lambda r: r.rk)
    assert [r.rk for r in got] == list(range(1, 4001))
    assert [tuple(r)[1:-1] for r in got] == sorted(map(tuple, li.collect()))
    monkeypatch.setattr(catalog, "RANGE_BYTES", 16 << 20, raising=False)
    assert catalog.q_sort_table_sampled(spark, str(tmp_path)).rdd.getNumPartitions() == catalog.N_PARTS


def test_rank_of_rows_with_maps_and_odd_names(spark):
    df = spark.range(50).select(F.create_map(F.lit("a"), F.col("id")).alias("m"), (-F.col("id")).alias("a.b"))
    got = with_global_rank(df, [F.col("`a.b`")], "sampled", 3).orderBy("rk").collect()
    assert [r["a.b"] for r in got] == list(range(-49, 1)) and [r["m"]["a"] for r in got] == list(range(49, -1, -1))


# --- histogram ranges ---------------------------------------------------------------------

def _skewed(spark):
    """Text keys with a long common prefix, one value in a third of the rows, some NULL."""
    i = F.col("id")
    return spark.range(0, 30000).select(
        F.when(i % 3 == 0, F.lit("prefix/hot")).when(i % 11 == 0, F.lit(None))
        .when(i % 3 == 1, F.concat(F.lit("prefix/a"), F.lpad((i * i).cast("string"), 12, "0")))
        .otherwise(F.concat(F.lit("prefix/a00000"), i.cast("string"))).cast("binary").alias("key"), "id")


def test_histogram_ranges_balance_skewed_keys(spark):
    df = _skewed(spark)
    for n in (1, 5, 8, 37):
        parts = _parts(sort_records(df, ["key"], "histogram", n))
        flat = [k for p in parts for k in p]
        assert flat == sorted(flat, key=lambda k: (k is not None, k or b"")) and len(flat) == 30000
        sizes = sorted(map(len, parts))
        assert len(parts) == n and sizes[-1] < 2 * sizes[n // 2], sizes
    ranked = with_global_rank(df, ["key"], "histogram", 8).orderBy("rk").collect()
    assert [r.rk for r in ranked] == list(range(1, 30001))
    assert sorted(r.id for r in ranked) == list(range(30000))


@pytest.mark.parametrize("keys", [
    [], [None] * 9, [b""] * 5 + [None], [b"", b"\0", b"\0\0", b"\0\0\0"] * 40, [b"x" * 40 + bytes([i % 256]) for i in range(600)],
    [bytes([i % 251, i % 7]) for i in range(2000)], [b"a", b"a\0", b"a\0\0\0b"] * 100 + [b"a\0\0\0c"] * 300])
def test_histogram_ranges_of_odd_keys(spark, keys):
    df = spark.createDataFrame([(None if k is None else bytearray(k),) for k in keys], "key binary")
    flat = [k for p in _parts(sort_records(df, ["key"], "histogram", 4)) for k in p]
    assert [None if k is None else bytes(k) for k in flat] == sorted(keys, key=lambda k: (k is not None, k or b""))


def test_histogram_ranges_serve_other_data(spark):
    """Ranges of one table keep another one, with keys outside of them, in order."""
    from ordwise.operators.histogram import key_ranges, partition_histogram
    ranges = key_ranges(_skewed(spark), 6)
    other = [b"", b"prefix", b"prefix/", b"a", b"z", b"prefix/zzz", b"prefix/hot", b"prefix/hot!", None, b"prefix/a5"] * 20
    df = spark.createDataFrame([(None if k is None else bytearray(k),) for k in other], "key binary")
    dealt = partition_histogram(df, 6, ranges=ranges).sortWithinPartitions("key")
    flat = [None if k is None else bytes(k) for p in _parts(dealt) for k in p]
    assert flat == sorted(other, key=lambda k: (k is not None, k or b""))
    with pytest.raises(TypeError):
        key_ranges(spark.range(3), 2, "id")
