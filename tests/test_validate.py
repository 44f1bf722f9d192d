"""Validation, including the negative fixtures."""
import pytest
from pyspark.sql import functions as F

from ordwise.operators.validate import (assert_sorted, checksum, compare_datasets,
                                        order_violations, partition_summary, validate)
from ordwise.sources.generator import generate_records


def _frame(spark, parts):
    """DataFrame whose partition i holds exactly parts[i], in order."""
    rows = [(k,) for p in parts for k in p]
    sizes = [len(p) for p in parts]
    rdd = spark.sparkContext.parallelize(rows, len(parts))
    # re-cut so the partitions are exactly the given lists
    bounds = []
    acc = 0
    for s in sizes:
        bounds.append((acc, acc + s))
        acc += s
    rdd = spark.sparkContext.parallelize(range(len(parts)), len(parts)).flatMap(
        lambda i: [(k,) for k in parts[i]])
    return spark.createDataFrame(rdd, "key binary")


def k(i):
    return i.to_bytes(10, "big")


def test_sorted_input_is_valid(spark):
    df = _frame(spark, [[k(1), k(2)], [k(3), k(4)], [k(5)]])
    v = validate(df).first()
    assert v["ok"] and v["n"] == 5 and v["violations"] == 0 and v["bad_boundaries"] == 0


def test_one_swap_inside_partition(spark):
    df = _frame(spark, [[k(1), k(3), k(2), k(4)], [k(5), k(6)]])
    v = validate(df).first()
    assert v["violations"] == 1 and not v["ok"]
    with pytest.raises(AssertionError):
        assert_sorted(df)


def test_swapped_partitions_fail_boundary(spark):
    df = _frame(spark, [[k(5), k(6)], [k(1), k(2)]])
    v = validate(df).first()
    assert v["bad_boundaries"] == 1 and v["violations"] == 1 and not v["ok"]


def test_empty_middle_partition_is_valid(spark):
    df = _frame(spark, [[k(1), k(2)], [], [k(3)]])
    v = validate(df).first()
    assert v["ok"] and v["n"] == 3


def test_first_last_are_positional(spark):
    df = _frame(spark, [[k(3), k(1), k(2)]])
    s = partition_summary(df).first()
    assert s["first"] == k(3) and s["last"] == k(2) and s["min_key"] == k(1) and s["max_key"] == k(3)
    assert s["violations"] == 1


def test_flipped_key_and_value_bytes(spark):
    g = generate_records(spark, 2000, num_partitions=2).cache()
    bad_key = g.withColumn("key", F.when(F.col("rec_no") == 7, F.unhex(F.lit("00" * 10))).otherwise(F.col("key")))
    bad_val = g.withColumn("value", F.when(F.col("rec_no") == 7, F.unhex(F.lit("11" * 90))).otherwise(F.col("value")))
    assert checksum(bad_key).first()["checksum"] != checksum(g).first()["checksum"]
    assert checksum(bad_key).first()["n"] == 2000
    assert checksum(bad_val).first()["checksum"] == checksum(g).first()["checksum"]
    assert (checksum(bad_val, ["key", "value"]).first()["checksum"]
            != checksum(g, ["key", "value"]).first()["checksum"])
    cmp = compare_datasets(g, bad_key).first()
    assert cmp["same_n"] and not cmp["same_checksum"]
    g.unpersist()


def test_order_violations_brute_force_with_hot_group(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for pos in range(6000):
        grp = 0 if pos % 3 == 0 else rnd.randrange(50)     # group 0 holds a third
        rows.append((grp, pos, rnd.randrange(1000)))
    df = spark.createDataFrame(rows, "g int, pos bigint, v int").repartition(5)
    got = {r["g"]: r["n_bad"] for r in order_violations(df, "v", "g", "pos", num_partitions=6).collect()}
    exp = {}
    last = {}
    for grp, pos, v in sorted(rows, key=lambda r: r[1]):
        exp.setdefault(grp, 0)
        if grp in last and v < last[grp]:
            exp[grp] += 1
        last[grp] = v
    assert got == exp


def test_summary_checksum_equals_aggregate_checksum(spark):
    g = generate_records(spark, 30000, num_partitions=3)
    v = validate(g.select("key", "value"))
    assert v.first()["checksum"] == checksum(g).first()["checksum"]
    full = validate(g, crc_cols=["key", "value"]).first()["checksum"]
    assert full == checksum(g, ["key", "value"]).first()["checksum"]


def test_order_violations_single_sequence(spark):
    import random
    rnd = random.Random(11)
    rows = [(pos, rnd.randrange(100)) for pos in range(3000)]
    df = spark.createDataFrame(rows, "pos bigint, v int").repartition(4)
    got = order_violations(df, "v", position="pos", num_partitions=5).collect()
    exp = sum(1 for a, b in zip(rows, rows[1:]) if b[1] < a[1])
    assert len(got) == 1 and got[0]["n_bad"] == exp


def test_order_violations_many_small_batches(spark):
    import random
    rnd = random.Random(5)
    rows = [(rnd.randrange(300), pos, rnd.randrange(50)) for pos in range(20000)]
    df = spark.createDataFrame(rows, "g int, pos bigint, v int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = {r["g"]: r["n_bad"] for r in order_violations(df, "v", "g", "pos", num_partitions=3).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    exp, last = {}, {}
    for grp, _, v in rows:
        exp.setdefault(grp, 0)
        if grp in last and v < last[grp]:
            exp[grp] += 1
        last[grp] = v
    assert got == exp


def test_validate_orders_nan_like_spark(spark):
    nan = float("nan")
    vals = [1.0, nan, 2.0, nan, nan, 0.5, -1.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double").coalesce(1)
    v = validate(df, key="x").first()
    # Spark orders NaN above every number: descents are NaN->2.0, NaN->0.5, 0.5->-1.0
    assert v["violations"] == 3 and not v["ok"]
    s = spark.createDataFrame([(v,) for v in [-1.0, 0.5, 2.0, nan, nan]], "x double").coalesce(1)
    assert validate(s, key="x").first()["ok"]
    summ = partition_summary(s, key="x").first()
    assert summ["min_key"] == -1.0 and summ["max_key"] != summ["max_key"]   # NaN


def test_validate_other_key_types_and_grouped_nan(spark):
    import datetime as dt
    ts = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=h) for h in range(200)]
    df = spark.createDataFrame([(t, f"k{i:04d}") for i, t in enumerate(ts)], "t timestamp, s string")
    srt = df.repartitionByRange(4, "t").sortWithinPartitions("t")
    assert validate(srt, key="t").first()["ok"]
    assert validate(srt, key="s").first()["ok"]
    rev = df.repartitionByRange(4, F.col("t").desc()).sortWithinPartitions(F.col("t").desc())
    assert validate(rev, key="t").first()["violations"] == 199
    nan = float("nan")
    rows = [(0, 1, 1.0), (0, 2, nan), (0, 3, 5.0), (1, 1, nan), (1, 2, nan), (1, 3, 2.0)]
    g = spark.createDataFrame(rows, "g int, p int, v double")
    got = {r["g"]: r["n_bad"] for r in order_violations(g, "v", "g", "p", num_partitions=2).collect()}
    assert got == {0: 1, 1: 1}


def test_checksum_of_non_binary_columns(spark):
    import zlib
    df = spark.createDataFrame([(i, f"s{i}") for i in range(100)], "i bigint, s string")
    assert checksum(df, ["i"]).first()["checksum"] == sum(zlib.crc32(str(i).encode()) for i in range(100))
    assert (checksum(df, ["s"]).first()["checksum"]
            == sum(zlib.crc32(f"s{i}".encode()) for i in range(100)))
    v = validate(df.coalesce(1), key="i").first()
    assert v["ok"] and v["checksum"] == checksum(df, ["i"]).first()["checksum"]


def test_validate_with_column_key_and_crc(spark):
    from ordwise.operators.sort import record_key, sort_records
    g = generate_records(spark, 5000, num_partitions=2, whole=True).select("record")
    s = sort_records(g, [record_key()], "even", 3)
    v = validate(s, key=record_key()).first()
    assert v["ok"] and v["n"] == 5000
    full = validate(s, key=record_key(), crc_cols=[F.col("record")]).first()["checksum"]
    split = generate_records(spark, 5000, num_partitions=2)
    assert full == checksum(split, ["key", "value"]).first()["checksum"]
    assert v["checksum"] == checksum(split).first()["checksum"]


@pytest.mark.parametrize("cuts", [1, 2, 4])
def test_null_keys_are_the_smallest(spark, cuts):
    cases = {(b"a", b"c", None, b"b", b"d"): 1, (b"a", None): 1, (None, None, b"a", b"b"): 0,
             (None, b"a", None, b"a"): 1, (b"b", b"a", None, None): 2}
    for keys, want in cases.items():
        step = -(-len(keys) // cuts)
        df = _frame(spark, [list(keys[i:i + step]) for i in range(0, len(keys), step)])
        v = validate(df).first()
        assert (v["violations"], v["ok"]) == (want, want == 0), keys


@pytest.mark.parametrize("n", [1, 4, 16])
def test_null_groups_and_keys_do_not_depend_on_the_partitions(spark, n):
    down = spark.createDataFrame([(None, i, 40 - i) for i in range(40)], "g int, p int, v int")
    assert [tuple(r) for r in order_violations(down, "v", "g", "p", num_partitions=n).collect()] == [(None, 39)]
    rows = [(None if i % 3 else 1, i, None if i % 4 == 0 else i % 7) for i in range(200)]
    df = spark.createDataFrame(rows, "g int, p int, v int")
    want, last = {}, {}
    low = lambda a, b: b is not None and (a is None or a < b)
    for g, _, v in rows:
        want.setdefault(g, 0)
        want[g] += g in last and low(v, last[g])
        last[g] = v
    assert {r["g"]: r["n_bad"] for r in order_violations(df, "v", "g", "p", num_partitions=n).collect()} == want
    nan = float("nan")
    nans = spark.createDataFrame([(nan, i, -i) for i in range(30)], "g double, p int, v int")
    got = order_violations(nans, "v", "g", "p", num_partitions=n).collect()
    assert [r["n_bad"] for r in got] == [29]


def test_group_needs_a_position(spark):
    df = spark.createDataFrame([(1, 2)], "g int, v int")
    with pytest.raises(ValueError):
        order_violations(df, "v", group="g")


def test_pipeline_refuses_a_sort_that_loses_a_record(spark, tmp_out, monkeypatch):
    from ordwise.plans import pipeline
    log, verdict = pipeline.run_pipeline(spark, 3000, f"{tmp_out}/good", num_partitions=3)
    assert verdict["ok"] and verdict["same_records"]
    with pytest.raises(FileExistsError):
        pipeline.run_pipeline(spark, 3000, f"{tmp_out}/good", num_partitions=3)
    plain = pipeline.sort_records

    def lossy(df, *a, **k):      # one record lost, another doubled; order and count stay right
        low = df.orderBy("record").limit(2).collect()
        kept = df.filter(F.col("record") != F.lit(low[1]["record"]))
        return plain(kept.unionByName(df.filter(F.col("record") == F.lit(low[0]["record"]))), *a, **k)

    monkeypatch.setattr(pipeline, "sort_records", lossy)
    log, verdict = pipeline.run_pipeline(spark, 3000, f"{tmp_out}/bad", num_partitions=3)
    assert verdict["n"] == 3000 and verdict["violations"] == 0
    assert not verdict["ok"] and not verdict["same_records"]
    assert not log.filter("phase = 'validate'").first()["ok"]
    from ordwise.plans.metric import hsph
    assert hsph(log).first()["metric"] is None


def test_order_violations_are_lazy(spark):
    """No job, no checkpoint while the query is built, and one sort shuffle in its plan."""
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), F.col("id"), (F.col("id") * 7 % 11).alias("k"))
    sc = spark.sparkContext
    sc.setJobGroup("violations", "violations")
    v = order_violations(df, "k", "g", "id", num_partitions=5)
    assert not sc.statusTracker().getJobIdsForGroup("violations")
    sc.setJobGroup("after", "after")
    plan = v._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ExistingRDD" not in plan and plan.count("rangepartitioning") == 1
    assert plan.count("MapInArrow") == 1


def test_order_violations_in_tiny_batches(spark):
    """Groups that go on over batches and partitions, against a plain loop."""
    import random
    rng = random.Random(3)
    rows = [(rng.choice([None, "a", "b", "c"]), i, rng.choice([None, 1, 2, 3])) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, p int, k int")
    want = {}
    for g in {r[0] for r in rows}:
        ks = [(-1 if k is None else k) for gg, _, k in rows if gg == g]
        want[g] = sum(b < a for a, b in zip(ks, ks[1:]))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size, n in (("1", 3), ("7", 8), ("10000", 200)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got = {r.g: r.n_bad for r in order_violations(df, "k", "g", "p", num_partitions=n).collect()}
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        assert got == want


def test_range_digests_and_differences(spark):
    from ordwise.operators.digest import differing_ranges, range_digests
    from ordwise.sources.generator import generate_records
    g = generate_records(spark, 3000, num_partitions=3).select("key", "value")
    nodes = {(r.level, r.prefix): (r.n, r.checksum) for r in range_digests(g).collect()}
    assert nodes[0, ""] == tuple(checksum(g).select("n", "checksum").first())
    for level in (0, 1):
        for (lv, p), (n, c) in nodes.items():
            if lv == level:
                kids = [v for (l2, q), v in nodes.items() if l2 == level + 1 and q.startswith(p)]
                assert (sum(k[0] for k in kids), sum(k[1] for k in kids)) == (n, c)
    assert differing_ranges(g, g.repartition(5), cols=["key", "value"]).count() == 0
    one = g.orderBy("key").first().key
    hurt = g.withColumn("value", F.when(F.col("key") == F.lit(bytes(one)), F.lit(b"changed")).otherwise(F.col("value")))
    found = {(r.level, r.prefix): r.leaves for r in differing_ranges(g, hurt, cols=["key", "value"]).collect()}
    name = bytes(one).hex().upper()
    assert found == {(0, ""): 1, (1, name[:2]): 1, (2, name[:4]): 1}
    deeper = differing_ranges(g, hurt, cols=["key", "value"], within=bytes(one)[:2]).collect()
    assert {(r.level, r.prefix) for r in deeper} == {(0, name[:4]), (1, name[:6]), (2, name[:8])}
    lost = g.filter(F.col("key") != F.lit(bytes(one)))
    assert {(r.level, r.n_a - r.n_b) for r in differing_ranges(g, lost).collect()} == {(0, 1), (1, 1), (2, 1)}


def test_range_digests_of_odd_keys(spark):
    from ordwise.operators.digest import differing_ranges, range_digests
    df = spark.createDataFrame([(None, 1), (b"", 2), (b"a", 3), (b"abc", 4), (b"abd", 5)], "key binary, v int")
    got = {(r.level, r.prefix): r.n for r in range_digests(df, cols=["v"]).collect()}
    assert got == {(None, None): 1, (0, ""): 4, (1, "61"): 3, (2, "6162"): 2}
    assert range_digests(df.limit(0)).collect() == []
    other = df.withColumn("v", F.when(F.col("key").isNull(), 9).otherwise(F.col("v")))
    assert [(r.level, r.prefix) for r in differing_ranges(df, other, cols=["v"]).collect()] == [(None, None)]
    with pytest.raises(TypeError):
        range_digests(df, "v")
