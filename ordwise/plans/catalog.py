"""Named queries over the driver tables, one per operator family.

Each takes ``(spark, sf_dir)`` and returns a DataFrame whose columns are all
aliased; ``ordwise.plans.oracle`` holds the equivalent DuckDB SQL. Sorted
results are compared through their rank column ``rk`` (the comparison is
order-insensitive), so every sort key list is unique per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordwise.functions.keys import hex_digit, key_crc32, key_prefix56, key_unsigned_bytes, md5_key
from ordwise.functions.sizes import bytes_to_size, size_to_bytes
from ordwise.functions.u128 import (U128, add128, format_hex128, from_hex_u128, halves128, multiply128,
                                    parse_hex128, shift_left128, to_hex_u128)
from ordwise.operators.digest import differing_ranges
from ordwise.operators.histogram import partition_histogram
from ordwise.operators.partition import partition_even
from ordwise.operators.sort import sort_records, with_global_rank
from ordwise.operators.validate import (boundary_check, checksum, compare_datasets,
                                        order_violations, partition_summary, validate, validate_files)
from ordwise.plans.metric import hsph
from ordwise.plans.pipeline import observed_write, sort_two_level
from ordwise.session import scratch_path, ship_package
from ordwise.sources.fixed_record import read_records, write_records
from ordwise.sources.generator import records_at

# Fixed query parameters (shared with the oracle SQL).
N_PARTS = 8            # partitions of the even-range / sampled sorts
RANGE_BYTES = 8 << 20    # of a table's files for a range of a sort, where the number of ranges leaves the result alone
SKIP_MUL = 1_000_003   # gen_skip_ahead: record number = o_orderkey * SKIP_MUL + o_custkey
VALUE_PAD = 90         # fixed_record_roundtrip: value = o_orderkey text padded to 90 bytes
SIZE_SUFFIXES = ["", "k", "M", "g", "T"]   # size_functions: suffix by doc_id % 5
LINEITEM_SORT = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                 "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                 "l_linestatus"]
LINEITEM_KEY_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def range_count(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Ranges of a sort of the table's rows: N_PARTS, and more as its files grow, so that a task's share does not."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    size = path.getFileSystem(sc._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return max(N_PARTS, -(-size // RANGE_BYTES))


def keyed_orders(spark, sf_dir) -> DataFrame:
    """orders with a uniform 10-byte key: MD5 of the order key's text."""
    return table(spark, sf_dir, "orders").select("o_orderkey", md5_key("o_orderkey").alias("key"))


def sorted_orders(spark, sf_dir) -> DataFrame:
    return sort_records(keyed_orders(spark, sf_dir), ["key"], "even", N_PARTS)


def records_of_orders(spark, sf_dir) -> DataFrame:
    """The benchmark record of every order: record number o_orderkey."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("rec_no"))
    return records_at(o, "rec_no")


def padded_orders(spark, sf_dir) -> DataFrame:
    return keyed_orders(spark, sf_dir).select(
        "key", F.rpad(F.col("o_orderkey").cast("string"), VALUE_PAD, " ").cast("binary").alias("value"))


def cross_keyed_orders(spark, sf_dir) -> DataFrame:
    """orders in the order of one key, carrying another: checks on ``other`` find descents."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", md5_key("o_orderkey").alias("key"), md5_key("o_custkey", "o_orderkey").alias("other"))
    return sort_records(o, ["key"], "even", N_PARTS)


# --- queries -------------------------------------------------------------------------

def q_gen_records(spark, sf_dir):
    g = records_of_orders(spark, sf_dir)
    return g.select("rec_no", F.hex("key").alias("key_hex"), F.hex("value").alias("value_hex"))


def q_gen_skip_ahead(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_orderkey") * SKIP_MUL + F.col("o_custkey")).alias("rec_no"))
    r = records_at(o, "rec_no")
    return r.select("o_orderkey", "rec_no", F.hex("key").alias("key_hex"))


def q_key_prefix(spark, sf_dir):
    k = keyed_orders(spark, sf_dir)
    return k.select("o_orderkey", key_prefix56("key").alias("prefix"),
                    F.array_join(key_unsigned_bytes("key"), ",").alias("key_bytes"))


def q_even_range_partition(spark, sf_dir):
    p = partition_even(keyed_orders(spark, sf_dir), N_PARTS)
    return p.select("o_orderkey", F.spark_partition_id().alias("pid"))


def q_sort_total_order(spark, sf_dir):
    r = with_global_rank(keyed_orders(spark, sf_dir), ["key"], "even", range_count(spark, sf_dir, "orders"))
    return r.select("rk", F.hex("key").alias("key_hex"), "o_orderkey")


def q_sort_table_sampled(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(*LINEITEM_SORT)
    return with_global_rank(li, LINEITEM_SORT, "sampled", range_count(spark, sf_dir, "lineitem")).select("rk", *LINEITEM_SORT)


def q_gen_sort_rank(spark, sf_dir):
    r = with_global_rank(records_of_orders(spark, sf_dir), ["key"], "even", range_count(spark, sf_dir, "orders"))
    return r.select("rk", F.hex("key").alias("key_hex"), F.hex("value").alias("value_hex"), "rec_no")


def q_partition_summary(spark, sf_dir):
    s = partition_summary(sorted_orders(spark, sf_dir))
    return s.select("pid", "n", F.hex("first").alias("first_hex"), F.hex("last").alias("last_hex"),
                    to_hex_u128("checksum").alias("checksum_hex"))


def q_boundary_check(spark, sf_dir):
    """Boundaries of a key the rows are not sorted by: some partitions fail, some do not."""
    b = boundary_check(partition_summary(cross_keyed_orders(spark, sf_dir), key="other"))
    return b.select("pid", F.hex("prev_last").alias("prev_last_hex"), F.hex("first").alias("first_hex"),
                    F.hex("last").alias("last_hex"), "descent", "ok")


def q_order_violations(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return order_violations(o, key="o_orderdate", group="o_custkey", position="o_orderkey",
                            num_partitions=range_count(spark, sf_dir, "orders"))


def q_hot_group_violations(spark, sf_dir):
    """Five event types each hold ~20 % of the rows: every group is spread over
    several partitions, so the result depends on the boundary fix-ups."""
    e = table(spark, sf_dir, "events")
    return order_violations(e, key="value", group="event_type", position="event_id",
                            num_partitions=range_count(spark, sf_dir, "events"))


def q_null_order_violations(spark, sf_dir):
    """NULL groups and NULL keys: NULL is a group of its own and the smallest key."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif(F.col("o_custkey") % 7, F.lit(3)).alias("grp"),
        F.nullif(F.col("o_orderkey") * 7 % 11, F.lit(5)).alias("k"))
    return order_violations(o, key="k", group="grp", position="o_orderkey", num_partitions=range_count(spark, sf_dir, "orders"))


def q_null_sort_rank(spark, sf_dir):
    """Sampled rank over nullable keys: NULLs first, ties by the unique order key."""
    o = table(spark, sf_dir, "orders").select(
        F.nullif(F.col("o_custkey") % 13, F.lit(4)).alias("k"), "o_orderkey")
    return with_global_rank(o, ["k", "o_orderkey"], "sampled", range_count(spark, sf_dir, "orders"))


def q_validate_verdict(spark, sf_dir):
    # sorted by one key, validated on another: descents and bad boundaries are expected
    return validate(cross_keyed_orders(spark, sf_dir), key="other").select(
        "n", "checksum_hex", "violations", "bad_boundaries", "ok")


def q_gen_sort_validate(spark, sf_dir):
    """Records sorted by key, then by the reversed key: the second order fails."""
    g = records_of_orders(spark, sf_dir)
    good = validate(sort_records(g, ["key"], "even", range_count(spark, sf_dir, "orders")), crc_cols=["key", "value"])
    turned = sort_records(g.withColumn("back", F.unhex(F.reverse(F.hex("key")))), ["back"], "even", range_count(spark, sf_dir, "orders"))
    bad = validate(turned, crc_cols=["key", "value"])
    cols = ["n", "checksum_hex", "violations", "ok"]
    return good.select(F.lit("key").alias("sorted_by"), *cols).unionByName(
        bad.select(F.lit("back").alias("sorted_by"), *cols))


def q_checksum_total(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(md5_key(*LINEITEM_KEY_COLS).alias("key"))
    return checksum(li).select("n", "checksum_hex")


def q_compare_datasets(spark, sf_dir):
    """Orders against themselves sorted, written and read back; and against a copy in
    which the key of every 1,000th order was replaced."""
    o = padded_orders(spark, sf_dir)
    path = scratch_path(spark, "compare")
    write_records(sort_records(o, ["key"], "even", range_count(spark, sf_dir, "orders")), path)
    same = compare_datasets(o, read_records(spark, path, columns="key"))
    k = keyed_orders(spark, sf_dir)
    hurt = k.select(F.when(F.col("o_orderkey") % 1000 == 0, F.lit(bytes(10))).otherwise(F.col("key")).alias("key"))
    cols = ["n_a", "n_b", "checksum_a_hex", "checksum_b_hex", "same_n", "same_checksum"]
    return same.select(F.lit("written").alias("pair"), *cols).unionByName(
        compare_datasets(k, hurt).select(F.lit("changed").alias("pair"), *cols))


def q_fixed_record_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "roundtrip")
    write_records(padded_orders(spark, sf_dir), path)
    back = read_records(spark, path, columns="key,value")
    return back.select(F.hex("key").alias("key_hex"), F.hex("value").alias("value_hex"))


def q_sorted_files_rank(spark, sf_dir):
    """Sampled sort written as record files; the rank is read back from the file
    sizes (``global_index``), so no count job or checkpoint is needed."""
    path = scratch_path(spark, "sorted-rank")
    write_records(sort_records(padded_orders(spark, sf_dir), ["key"], "sampled", range_count(spark, sf_dir, "orders")), path)
    back = read_records(spark, path, columns="key,value,global_index")
    return back.select((F.col("global_index") + 1).alias("rk"), F.hex("key").alias("key_hex"),
                       F.hex("value").alias("value_hex"))


def q_size_functions(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    suffix = F.element_at(F.array(*[F.lit(s) for s in SIZE_SUFFIXES]),
                          (F.pmod(F.col("doc_id"), F.lit(len(SIZE_SUFFIXES))) + 1).cast("int"))
    s = d.select("doc_id", F.concat(F.col("n_chars").cast("string"), suffix).alias("size_in"))
    b = s.withColumn("bytes", size_to_bytes("size_in"))
    return b.select("doc_id", "size_in", "bytes", bytes_to_size("bytes").alias("text"))


def q_u128_hex(spark, sf_dir):
    k = table(spark, sf_dir, "orders").select("o_custkey", md5_key("o_orderkey").alias("key"))
    per = k.groupBy("o_custkey").agg(F.sum(key_crc32("key").cast(U128)).alias("s"))
    # s * 2^64 + s: both 64-bit halves in use
    big = (F.col("s") * F.expr("CAST(18446744073709551616 AS DECIMAL(38,0))") + F.col("s")).cast(U128)
    h = per.select("o_custkey", big.alias("big")).select(
        "o_custkey", to_hex_u128("big").alias("hex"), "big")
    return h.select("o_custkey", "hex", (from_hex_u128("hex") == F.col("big")).alias("roundtrip_ok"))


def q_u128_full(spark, sf_dir):
    """Values over the whole 128-bit range: parse, format, halves and digits."""
    text = F.regexp_replace(F.md5(F.col("o_orderkey").cast("string")), "^0+", "")
    o = table(spark, sf_dir, "orders").select("o_orderkey", parse_hex128(text).alias("v"))
    high, low = halves128("v")
    return o.select("o_orderkey", format_hex128("v").alias("hex"), high.alias("high"), low.alias("low"),
                    F.concat(*[hex_digit("v", i) for i in (0, 15, 16, 31, 32)]).alias("digits"))


def q_hsph_metric(spark, sf_dir):
    """Run log from events: one run per user, one phase per event type; a phase whose
    number of events is a multiple of five failed."""
    e = table(spark, sf_dir, "events")
    log = e.groupBy(F.col("user_id").alias("run"), F.col("event_type").alias("phase")).agg(
        F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"),
        F.count(F.lit(1)).alias("records"),
        (F.count(F.lit(1)) * 100).alias("bytes"),
        (F.count(F.lit(1)) % 5 != 0).alias("ok"))
    return hsph(log).select("run", "seconds", "bytes", "sf", "hours", "metric")


def q_u128_arithmetic(spark, sf_dir):
    """Sum, product and shift modulo 2^128 of two hashes of every order."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_orderkey") % 140).alias("bits"),
        F.unhex(F.md5(F.col("o_orderkey").cast("string"))).alias("a"),
        F.unhex(F.md5(F.col("o_custkey").cast("string"))).alias("b"))
    return o.select("o_orderkey", format_hex128(add128("a", "b")).alias("sum"),
                    format_hex128(multiply128("a", "b")).alias("product"),
                    format_hex128(shift_left128("a", "bits")).alias("shifted"))


def skewed_lineitem(spark, sf_dir) -> DataFrame:
    """lineitem with text keys that share a long prefix, a third of them one value."""
    li = table(spark, sf_dir, "lineitem")
    text = F.when(F.col("l_orderkey") % 3 == 0, F.lit("order:0000")).otherwise(
        F.concat(F.lit("order:"), F.lpad(F.col("l_orderkey").cast("string"), 10, "0")))
    return li.select(text.cast("binary").alias("key"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def q_histogram_sort_rank(spark, sf_dir):
    """Rank of unique text keys with a common prefix, over ranges from a prefix histogram."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(
        F.lit("c"), F.lpad((F.col("o_custkey") * F.col("o_custkey")).cast("string"), 14, "0"), F.lit("/"),
        F.col("o_orderkey").cast("string")).cast("binary").alias("key"))
    return with_global_rank(o, ["key"], "histogram", range_count(spark, sf_dir, "orders")).select("rk", F.hex("key").alias("key_hex"), "o_orderkey")


def q_histogram_balance(spark, sf_dir):
    """Rows, order and balance of the partitions of skewed keys: none holds twice the median."""
    dealt = partition_histogram(skewed_lineitem(spark, sf_dir), N_PARTS).sortWithinPartitions("key")
    s = boundary_check(partition_summary(dealt))
    return s.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"),
                 (F.max("n") < 2 * F.percentile("n", 0.5)).alias("balanced"),
                 (F.sum("violations") + F.sum(F.when(F.col("ok"), 0).otherwise(1))).alias("violations"))


def q_changed_ranges(spark, sf_dir):
    """Key ranges in which orders differ from a copy where every 1,000th customer was changed."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", md5_key("o_orderkey").alias("key"),
        F.rpad(F.col("o_custkey").cast("string"), 10, " ").cast("binary").alias("value"))
    hurt = o.withColumn("value", F.when(F.col("o_orderkey") % 1000 == 0, F.lit(b"changed...")).otherwise(F.col("value")))
    return differing_ranges(o, hurt, cols=["key", "value"])


def q_manifest_verdict(spark, sf_dir):
    """Verdicts over sorted and over unsorted record files of all orders: from the summaries in
    the manifest, and from a scan of the files."""
    o = padded_orders(spark, sf_dir)
    out = None
    for name, rows in (("sorted", sort_records(o, ["key"], "even", range_count(spark, sf_dir, "orders"))), ("unsorted", o)):
        path = scratch_path(spark, f"verdict-{name}")
        write_records(rows, path)
        for scan in (False, True):
            v = validate_files(spark, path, scan=scan).select(
                F.lit(name).alias("files"), F.lit(scan).alias("scan"), "n", "checksum_hex", "violations", "ok")
            out = v if out is None else out.unionByName(v)
    return out


def q_key_range_read(spark, sf_dir):
    """Orders of a key range, read from sorted record files: other files are not opened."""
    path = scratch_path(spark, "key-range")
    write_records(sort_records(padded_orders(spark, sf_dir), ["key"], "even", range_count(spark, sf_dir, "orders")), path)
    got = read_records(spark, path, columns="key,value", key_range=(bytes.fromhex("30"), bytes.fromhex("3a80")))
    return got.select(F.hex("key").alias("key_hex"), F.rtrim(F.col("value").cast("string")).alias("o_orderkey"))


def q_observed_phases(spark, sf_dir):
    """Records and checksum of two writes, as observed while the rows went to the files."""
    r = records_of_orders(spark, sf_dir).select(F.concat("key", "value").alias("record"))
    path = scratch_path(spark, "observed")
    rows = [("generate", *observed_write(r, f"{path}/gen"))]
    back = read_records(spark, f"{path}/gen", columns="record")
    rows.append(("sort", *observed_write(sort_records(back, [F.substring("record", 1, 10)], "even", range_count(spark, sf_dir, "orders")),
                                         f"{path}/sorted")))
    log = spark.createDataFrame([(p, n, str(c)) for p, n, c in rows], "phase string, n long, c string")
    return log.select("phase", "n", to_hex_u128(F.col("c").cast(U128)).alias("checksum_hex"))


def q_two_level_sort(spark, sf_dir):
    """Records of all orders sorted through coarse ranges; the rank follows from the files."""
    path = scratch_path(spark, "two-level")
    write_records(records_of_orders(spark, sf_dir).select("key", "value"), f"{path}/gen")
    sort_two_level(spark, f"{path}/gen", f"{path}/sorted", num_partitions=range_count(spark, sf_dir, "orders"), groups=3)
    back = read_records(spark, f"{path}/sorted", columns="key,value,global_index")
    return back.select((F.col("global_index") + 1).alias("rk"), F.hex("key").alias("key_hex"),
                       F.hex("value").alias("value_hex"))


# Which SURVEY §2 operators each query exercises.
QUERY_OPERATORS = {
    "gen_records": "O-S3, O-P1..P6",
    "gen_skip_ahead": "O-P3 (jump-ahead per row)",
    "key_prefix": "O-P10, O-P12",
    "even_range_partition": "O-X1",
    "sort_total_order": "O-X2..X4 (even)",
    "sort_table_sampled": "O-X3 (sampled), O-X4",
    "gen_sort_rank": "O-S3, O-X1..X4",
    "partition_summary": "O-A1..A4, O-P8",
    "boundary_check": "O-W2, O-W3",
    "order_violations": "O-W1 (grouped, by position)",
    "hot_group_violations": "O-W1 (hot groups split over partitions)",
    "null_order_violations": "O-W1 (NULL keys and groups)",
    "null_sort_rank": "O-X3, O-X4 (sampled, NULL keys)",
    "validate_verdict": "O-W4",
    "gen_sort_validate": "O-S3, O-X3, O-W4",
    "checksum_total": "O-A2, O-P11, O-P8",
    "compare_datasets": "O-W5",
    "fixed_record_roundtrip": "O-S1, O-S2",
    "sorted_files_rank": "O-X3 (sampled), O-S2, O-S1, O-X4",
    "size_functions": "O-P9",
    "u128_hex": "O-P8, O-P8c",
    "u128_full": "O-P7, O-P8, O-P8c (whole range)",
    "hsph_metric": "O-B3",
    "u128_arithmetic": "O-P4, O-P5, O-P6 (columns)",
    "histogram_sort_rank": "O-X1 (histogram ranges), O-X2..X4",
    "histogram_balance": "O-X1, O-X3 (skewed binary keys)",
    "changed_ranges": "O-W5 (range digests)",
    "manifest_verdict": "O-A1..A4, O-W1..W4 (write-time summaries), O-S2d",
    "key_range_read": "O-S1 (key-range pruning)",
    "observed_phases": "O-B1, O-B2 (observed counts)",
    "two_level_sort": "O-X2 (two-level shuffle), O-X3, O-X4",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "gen_records": q_gen_records,
    "gen_skip_ahead": q_gen_skip_ahead,
    "key_prefix": q_key_prefix,
    "even_range_partition": q_even_range_partition,
    "sort_total_order": q_sort_total_order,
    "sort_table_sampled": q_sort_table_sampled,
    "gen_sort_rank": q_gen_sort_rank,
    "partition_summary": q_partition_summary,
    "boundary_check": q_boundary_check,
    "order_violations": q_order_violations,
    "hot_group_violations": q_hot_group_violations,
    "null_order_violations": q_null_order_violations,
    "null_sort_rank": q_null_sort_rank,
    "validate_verdict": q_validate_verdict,
    "gen_sort_validate": q_gen_sort_validate,
    "checksum_total": q_checksum_total,
    "compare_datasets": q_compare_datasets,
    "fixed_record_roundtrip": q_fixed_record_roundtrip,
    "sorted_files_rank": q_sorted_files_rank,
    "size_functions": q_size_functions,
    "u128_hex": q_u128_hex,
    "u128_full": q_u128_full,
    "hsph_metric": q_hsph_metric,
    "u128_arithmetic": q_u128_arithmetic,
    "histogram_sort_rank": q_histogram_sort_rank,
    "histogram_balance": q_histogram_balance,
    "changed_ranges": q_changed_ranges,
    "manifest_verdict": q_manifest_verdict,
    "key_range_read": q_key_range_read,
    "observed_phases": q_observed_phases,
    "two_level_sort": q_two_level_sort,
}
