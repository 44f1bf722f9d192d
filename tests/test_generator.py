"""Golden vectors and properties of the record generator."""
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordwise.functions import lcg
from ordwise.operators.validate import checksum
from ordwise.sources.generator import generate_records, records_at

GOLDEN_KEYS = {
    0: "4a696d47726179524950",
    1: "95e0e48262b3edfe0447",
    2: "45979353dbed5329365c",
    999: "4d15a82070c03ee39bf5",
    10 ** 6: "32c9af20bff42df02caa",
    10 ** 10: "57b8fc52d1595865fa47",
}
RECORD0 = ("4a696d47726179524950001130303030303030303030303030303030303030303030303030303030303030308899aabb"
           "323232323030303032323232303030303232323230303030323232323030303032323232303030303030303031313131"
           "ccddeeff")
# n -> (sum crc32(key), sum crc32(key||value), min key, max key)
GOLDEN_SUMS = {
    1: ("81f7743a", "97503e23", "4a696d47726179524950", "4a696d47726179524950"),
    10: ("562dc112f", "5b2d1434d", "10431af6a0d847b8c55f", "95e0e48262b3edfe0447"),
    1000: ("1eea4a93bef", "1f9ffe645ec", "00675bef0e528c74d1e4", "ffb4d5e8475ed345334b"),
    10000: ("137954548db1", "139abefd74b2", "000766ef777e4e5c67d0", "fff96593b2c4e5f19295"),
    100000: ("c2f9b3b96fb1", "c327a1c42c28", "000066fc34d9bc9d51e1", "ffff52690a350ed9bc1c"),
}


def test_power_table_matches_repeated_steps():
    a, c = 1, 0
    for _ in range(8):
        a, c = lcg.compose((a, c), lcg.power_of_two_steps(1)[0])
    assert lcg.power_of_two_steps(4)[3] == (a, c)


def test_kernel_golden_keys():
    recs = np.array(sorted(GOLDEN_KEYS), dtype=np.int64)
    k, v = lcg.encode_records(recs, lcg.states_for_records(recs))
    for i, r in enumerate(recs):
        assert k[i].tobytes().hex() == GOLDEN_KEYS[int(r)]
    assert (k[0].tobytes() + v[0].tobytes()).hex() == RECORD0


def test_contiguous_equals_jump_ahead():
    a = lcg.states_for_contiguous(12345, 9000, table_size=1000)
    b = lcg.states_for_records(np.arange(12345, 12345 + 9000, dtype=np.int64))
    assert (a == b).all()


def test_spark_golden_sums(spark):
    g = generate_records(spark, 100000, num_partitions=7).cache()
    for n, (ck, ck_full, kmin, kmax) in GOLDEN_SUMS.items():
        sub = g.filter(F.col("rec_no") < n)
        row = checksum(sub).first()
        assert row["n"] == n and row["checksum_hex"] == ck
        assert checksum(sub, ["key", "value"]).first()["checksum_hex"] == ck_full
        mm = sub.agg(F.lower(F.hex(F.min("key"))), F.lower(F.hex(F.max("key")))).first()
        assert (mm[0], mm[1]) == (kmin, kmax)
    assert g.select("key").distinct().count() == 100000
    g.unpersist()


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_same_records_for_any_partitioning(spark, parts):
    base = {r["rec_no"]: (r["key"], r["value"]) for r in generate_records(spark, 5000, num_partitions=2).collect()}
    other = {r["rec_no"]: (r["key"], r["value"]) for r in
             generate_records(spark, 5000, num_partitions=parts).collect()}
    assert base == other


def test_start_offset_is_tail(spark):
    full = {r["rec_no"]: r["key"] for r in generate_records(spark, 3000, num_partitions=3).collect()}
    tail = {r["rec_no"]: r["key"] for r in generate_records(spark, 1000, start=2000, num_partitions=2).collect()}
    assert tail == {k: v for k, v in full.items() if k >= 2000}


def test_floor_to_partitions(spark):
    assert generate_records(spark, 1003, num_partitions=4, floor_to_partitions=True).count() == 1000
    assert generate_records(spark, 1003, num_partitions=4).count() == 1003


def test_records_at_matches_generator_and_nulls(spark):
    df = spark.createDataFrame([(999,), (10 ** 10,), (None,)], "r bigint")
    rows = {r["r"]: r["key"] for r in records_at(df, "r").collect()}
    assert rows[999].hex() == GOLDEN_KEYS[999]
    assert rows[10 ** 10].hex() == GOLDEN_KEYS[10 ** 10]
    assert rows[None] is None


def test_records_at_large_numbers_beside_nulls(spark):
    nums = [2 ** 60 + 1, 2 ** 53 + 1, 2 ** 53, 7]
    alone = {n: records_at(spark.createDataFrame([(n,)], "r bigint"), "r").first()["key"] for n in nums}
    mixed = spark.createDataFrame([(n,) for n in nums] + [(None,)], "r bigint").coalesce(1)
    assert {r["r"]: r["key"] for r in records_at(mixed, "r").collect()} == {**alone, None: None}


def test_value_layout(spark):
    row = generate_records(spark, 1, start=255).first()
    v = row["value"]
    assert v[:2] == bytes.fromhex("0011") and v[34:38] == bytes.fromhex("8899AABB")
    assert v[2:34] == b"0" * 30 + b"FF" and v[86:] == bytes.fromhex("CCDDEEFF")
    state_hex = row["key"].hex().upper()  # key = top 10 bytes; filler comes from the low 6
    assert len(v) == 90 and len(state_hex) == 20
    assert zlib.crc32(row["key"]) >= 0
