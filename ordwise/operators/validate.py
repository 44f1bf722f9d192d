"""Checksums, per-partition summaries and order validation.

Everything row-level is a narrow pass (JVM expressions or one ``mapInArrow``
per partition); only summaries with one row per partition, or one row per
group, are shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from ordwise.functions.u128 import U128, to_hex_u128
from ordwise.operators.partition import TIEBREAK, partition_sampled
from ordwise.schema import KEY_LEN, RECORD_LEN
from ordwise.sources.fixed_record import default_fs_of, list_summarised_files, qualified, read_records

def summary_schema(key_type: T.DataType = T.BinaryType()) -> T.StructType:
    """Schema of ``partition_summary``; key bounds have the key's own type."""
    return T.StructType([
        T.StructField("pid", T.IntegerType(), False),
        T.StructField("file", T.StringType(), True),
        T.StructField("file_index", T.IntegerType(), True),
        T.StructField("start_index", T.LongType(), True),
        T.StructField("n", T.LongType(), False),
        T.StructField("first", key_type, True),
        T.StructField("last", key_type, True),
        T.StructField("min_key", key_type, True),
        T.StructField("max_key", key_type, True),
        T.StructField("checksum", T.DecimalType(38, 0), False),
        T.StructField("violations", T.LongType(), False),
    ])


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def _less(a, b):
    """Element-wise a < b in Spark's ascending order: NULL below all, NaN above all numbers."""
    if pa.types.is_floating(a.type):
        plain = pc.and_(pc.invert(pc.is_nan(a)), pc.or_(pc.is_nan(b), pc.less(a, b)))
    else:
        plain = pc.less(a, b)
    return pc.if_else(pc.is_valid(a), pc.fill_null(plain, False), pc.is_valid(b))


def _same(a, b):
    """Element-wise equality that holds between NULLs and between NaNs."""
    plain = pc.equal(a, b)
    if pa.types.is_floating(a.type):
        plain = pc.or_(plain, pc.and_(pc.is_nan(a), pc.is_nan(b)))
    return pc.if_else(pc.and_(pc.is_valid(a), pc.is_valid(b)), pc.fill_null(plain, False),
                      pc.and_(pc.is_null(a), pc.is_null(b)))


def _less_py(a, b) -> bool:
    """Scalar a < b in the same order."""
    if a is None or b is None:
        return a is None and b is not None
    if isinstance(a, float) or isinstance(b, float):
        a_nan, b_nan = a != a, b != b
        return (not a_nan) and (b_nan or a < b)
    return a < b


def _below(a: Column, b: Column) -> Column:
    """a < b in the same order, never NULL."""
    return F.when(a.isNull(), b.isNotNull()).otherwise(F.coalesce(a < b, F.lit(False)))


def _min_max(keys):
    mm = pc.min_max(keys)
    lo, hi = mm["min"].as_py(), mm["max"].as_py()
    if pa.types.is_floating(keys.type) and pc.any(pc.is_nan(keys)).as_py():
        hi = float("nan")
        if lo is None:
            lo = float("nan")
    return lo, hi


def _c(col) -> Column:
    return col if isinstance(col, Column) else F.col(col)


def crc_bytes(df: DataFrame | None, cols) -> Column:
    """The bytes a checksum covers: binary columns as they are, other columns as
    their text; several columns are concatenated."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    parts = []
    for c in cols:
        is_bin = (df is None or not isinstance(c, str)
                  or isinstance(df.schema[c].dataType, T.BinaryType))
        parts.append(_c(c) if is_bin else _c(c).cast("string").cast("binary"))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def record_crc(cols=("key",), df: DataFrame | None = None) -> Column:
    """CRC-32 of the key (default, as the reference) or of several columns."""
    return F.crc32(crc_bytes(df, cols))


def checksum(df: DataFrame, cols=("key",)) -> DataFrame:
    """Order-independent checksum: one row ``n, checksum decimal(38,0), checksum_hex``.

    A sum of CRC-32 values: partial sums per task, one tiny final aggregate.
    """
    agg = df.agg(F.count(F.lit(1)).alias("n"),
                 F.coalesce(F.sum(record_crc(cols, df).cast(U128)), F.lit(0).cast(U128))
                 .cast(U128).alias("checksum"))
    return agg.select("n", "checksum", to_hex_u128("checksum").alias("checksum_hex"))


# --- per-partition summary (narrow) -----------------------------------------------

def _summary_kernel(pos_cols: list, out_schema: pa.Schema):
    """Per-partition pass; the partition id comes from the task, CRC-32 from Spark."""
    def kernel(batches):
        from decimal import Decimal

        from pyspark import TaskContext
        n = total = viol = 0
        first = last = kmin = kmax = None
        started = False
        pos = {}
        for b in batches:
            if b.num_rows == 0:
                continue
            keys = b.column("__k")
            if not started:
                first = keys[0].as_py()
                pos = {c: b.column(c)[0].as_py() for c in pos_cols}
            else:
                viol += int(_less_py(keys[0].as_py(), last))
            if len(keys) > 1:
                viol += int(pc.sum(_less(keys[1:], keys[:-1])).as_py() or 0)
            bmin, bmax = _min_max(keys)
            if bmin is not None and (kmin is None or _less_py(bmin, kmin)):
                kmin = bmin
            if bmax is not None and (kmax is None or _less_py(kmax, bmax)):
                kmax = bmax
            last = keys[-1].as_py()
            started = True
            n += b.num_rows
            total += pc.sum(b.column("__c")).as_py() or 0
        if n:
            row = {"pid": TaskContext.get().partitionId(), "file": pos.get("file"),
                   "file_index": pos.get("file_index"), "start_index": pos.get("record_index"),
                   "n": n, "first": first, "last": last, "min_key": kmin, "max_key": kmax,
                   "checksum": Decimal(total), "violations": viol}
            yield pa.RecordBatch.from_pylist([row], schema=out_schema)
    return kernel


def partition_summary(df: DataFrame, key="key", crc_cols=None) -> DataFrame:
    """One row per non-empty partition, in read order, without a shuffle:
    ``pid, file, file_index, start_index, n, first, last, min_key, max_key,
    checksum, violations``.

    ``first``/``last`` are positional (first and last row read), ``violations``
    counts neighbours that go down (a real comparison of consecutive keys,
    carried across Arrow batches). When the input comes from the fixed-record
    source, ``file_index``/``file`` and ``start_index`` locate the split, so
    checks order splits by file position rather than by partition number. Only
    the key and the row's CRC-32 (Spark's ``crc32``) cross into Python.
    """
    cols = [_c(key).alias("__k")]
    key_type = df.select(_c(key)).schema.fields[0].dataType
    if crc_cols is None:
        crc_cols = [key]
    crc_cols = [crc_cols] if isinstance(crc_cols, (str, Column)) else list(crc_cols)
    cols.append(record_crc(crc_cols, df).alias("__c"))
    pos_cols = []
    if "record_index" in df.columns and ("file_index" in df.columns or "file" in df.columns):
        pos_cols = ["file_index" if "file_index" in df.columns else "file", "record_index"]
    cols += [F.col(c) for c in pos_cols]
    schema = summary_schema(key_type)
    kernel = _summary_kernel(pos_cols, _arrow_schema(schema))
    return df.select(*cols).mapInArrow(kernel, schema)


def _segment_order(summary: DataFrame) -> list:
    return [F.col("file_index"), F.col("file"), F.col("start_index"), F.col("pid")]


def boundary_check(summary: DataFrame) -> DataFrame:
    """Adjacent-split checks on a summary (one row per partition, so bounded):
    ``prev_last <= first`` (else ``descent``) and ``first <= last``, with NULL first. Empty partitions are absent
    from the summary, so a gap never fails the check.
    """
    w = Window.orderBy(*_segment_order(summary))
    has_prev = F.coalesce(F.lag(F.lit(True)).over(w), F.lit(False))
    return (summary
            .withColumn("prev_last", F.lag("last").over(w))
            .withColumn("descent", has_prev & _below(F.col("first"), F.col("prev_last")))
            .withColumn("ok", ~F.col("descent") & ~_below(F.col("last"), F.col("first"))))


def validate(df: DataFrame, key="key", crc_cols=None) -> DataFrame:
    """One-row verdict ``n, checksum, checksum_hex, violations, bad_boundaries, ok``.

    ``violations`` counts every adjacent pair that goes down in the whole
    sequence (inside partitions and across their boundaries), so it does not
    depend on how the data is split; ``bad_boundaries`` counts failing splits.
    One pass over the data (the reference scans twice and only compares each
    partition's first row; see README).
    """
    return verdict(partition_summary(df, key, crc_cols))


def verdict(summary: DataFrame) -> DataFrame:
    """The row of ``validate`` from a partition summary."""
    checked = boundary_check(summary)
    descent = F.col("descent").cast("int")
    agg = checked.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n"),
        F.coalesce(F.sum("checksum"), F.lit(0)).cast(U128).alias("checksum"),
        F.coalesce(F.sum(F.col("violations") + descent), F.lit(0)).cast("bigint")
        .alias("violations"),
        F.coalesce(F.sum(F.when(~F.col("ok"), 1).otherwise(0)), F.lit(0)).cast("bigint")
        .alias("bad_boundaries"))
    return agg.select("n", "checksum", to_hex_u128("checksum").alias("checksum_hex"),
                      "violations", "bad_boundaries",
                      ((F.col("violations") == 0) & (F.col("bad_boundaries") == 0)).alias("ok"))


def files_summary(spark: SparkSession, path: str, record_crc: bool = False,
                  key_len: int = KEY_LEN, record_len: int = RECORD_LEN) -> DataFrame | None:
    """``partition_summary`` of record files, a row per file, from their manifests alone; None if
    some file has no summary there (other tools', other layouts, checksums not asked for)."""
    from decimal import Decimal
    rows = []
    for i, (name, size, s) in enumerate(list_summarised_files(qualified(path, default_fs_of(spark)))):
        if size == 0:
            continue
        if not s or "key_crc" not in s or s["key_len"] != key_len or size % record_len:
            return None
        first, last, low, high = (bytearray.fromhex(s[c]) for c in ("first", "last", "min", "max"))
        rows.append((i, name, i, 0, size // record_len, first, last, low, high,
                     Decimal(s["record_crc" if record_crc else "key_crc"]), s["descents"]))
    return spark.createDataFrame(rows, summary_schema())


def validate_files(spark: SparkSession, path: str, scan: bool = False, whole_records: bool = False,
                   key_len: int = KEY_LEN, record_len: int = RECORD_LEN) -> DataFrame:
    """``validate`` of record files without reading them: what the writer noted of every part
    (count, checksum, first and last key, descents) in the manifest is all it needs.

    Files without such notes are read, and ``scan`` forces a reading: the notes tell
    what was written, a scan what is there now (the manifest only sees a changed
    size). ``whole_records``: checksum over the record instead of the key.
    ``bad_boundaries`` counts files here, splits in a scan.
    """
    s = None if scan else files_summary(spark, path, whole_records, key_len, record_len)
    if s is not None:
        return verdict(s)
    df = read_records(spark, path, columns="key,value,file_index,record_index" if whole_records else
                      "key,file_index,record_index", record_len=record_len, key_len=key_len)
    return validate(df, crc_cols=["key", "value"] if whole_records else None)


def describe_verdict(v: dict) -> str:
    """One line of text for a ``validate`` row."""
    state = "in order" if v["ok"] else (f"out of order ({v['violations']} descents, "
                                        f"{v['bad_boundaries']} bad boundaries)")
    return f"{v['n']} rows, key checksum {v['checksum_hex']}, {state}"


def assert_sorted(df: DataFrame, key: str = "key") -> dict:
    """Raise ``AssertionError`` unless ``df`` is in total order; return the verdict."""
    row = validate(df, key).first().asDict()
    if not row["ok"]:
        raise AssertionError(f"not sorted: {row['violations']} neighbour violations, "
                             f"{row['bad_boundaries']} bad partition boundaries")
    return row


def compare_datasets(a: DataFrame, b: DataFrame, cols=("key",)) -> DataFrame:
    """Same record count and checksum? One row ``n_a, n_b,
    checksum_a_hex, checksum_b_hex, same_n, same_checksum``.

    Both sides reduce to one row; they are tagged, unioned and folded by a
    single aggregate (no join).
    """
    sa = checksum(a, cols).select(F.lit(0).alias("side"), "n", "checksum")
    sb = checksum(b, cols).select(F.lit(1).alias("side"), "n", "checksum")
    both = sa.unionByName(sb)

    def pick(side, col):
        return F.max(F.when(F.col("side") == side, F.col(col)))

    sides = both.agg(pick(0, "n").alias("n_a"), pick(1, "n").alias("n_b"),
                     pick(0, "checksum").alias("checksum_a"), pick(1, "checksum").alias("checksum_b"))
    return sides.select(
        "n_a", "n_b", to_hex_u128("checksum_a").alias("checksum_a_hex"),
        to_hex_u128("checksum_b").alias("checksum_b_hex"), (F.col("n_a") == F.col("n_b")).alias("same_n"),
        (F.col("checksum_a") == F.col("checksum_b")).alias("same_checksum"))


# --- grouped neighbour check (skew-proof) ------------------------------------------

def _violation_kernel():
    """Rows sorted by group -> one row (kind 0) for each group of the partition, and its
    first (1) and last (2) row. A group that goes on in the next batch is held open."""
    def kernel(batches):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        carry, held = None, 0       # the last row; descents of its group so far

        def rows(kinds, gs, ks, counts):
            return pa.RecordBatch.from_arrays(
                [pa.array([pid] * len(kinds), pa.int32()), pa.array(kinds, pa.int8()), gs, ks,
                 pa.array(counts, pa.int64())], names=["pid", "kind", "g", "k", "n_bad"])

        for b in batches:
            if b.num_rows == 0:
                continue
            g, k = b.column("__g"), b.column("__k")
            if carry is None:
                yield rows([1], g[:1], k[:1], [0])
                carry = g[:1], k[:1]
            pg, pk = pa.concat_arrays([carry[0], g[:-1]]), pa.concat_arrays([carry[1], k[:-1]])
            same = _same(g, pg)
            bad = pc.and_(same, _less(k, pk)).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(~same.to_numpy(zero_copy_only=False))
            sums = np.diff(np.r_[0, np.cumsum(bad)][np.r_[0, starts, len(bad)]])
            sums[0] += held
            held = int(sums[-1])
            if len(starts):         # the groups that ended in this batch
                done = pg.take(pa.array(starts))
                yield rows([0] * len(starts), done, pa.nulls(len(starts), k.type), sums[:-1])
            carry = (g[-1:], k[-1:])
        if carry is not None:
            yield rows([0, 2], pa.concat_arrays([carry[0], carry[0]]),
                       pa.concat_arrays([pa.nulls(1, carry[1].type), carry[1]]), [held, 0])
    return kernel


def order_violations(df: DataFrame, key: str, group: str | None = None,
                     position: str | None = None, num_partitions: int | None = None,
                     out_col: str = "n_bad") -> DataFrame:
    """Count rows whose ``key`` is smaller than the previous row's, per ``group``.

    "Previous" is by ``position`` within the group; without a group the whole
    table is one sequence (one output row). Without a position (and then without
    a group) the check runs in read order per partition (see
    ``partition_summary``). NULL keys are below all others, NULL is a group.

    Rows are range-partitioned by (group, position) - a hot group is spread
    over several partitions, never collected into one task - and each
    partition is scanned once in order. The pairs that straddle a partition
    boundary are found among two edge rows per partition (a bounded table), which
    travel with the counts, so the query is one lazy pass over one sort shuffle.
    Output: ``group, n_bad`` for every group present (0 when in order).
    """
    if position is None:
        if group is not None:
            raise ValueError("a group needs a position to order its rows by")
        s = partition_summary(df, key)
        return s.select("pid", F.col("violations").alias(out_col))
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grp = F.lit(0) if group is None else _c(group)   # no group: one global sequence
    src = df.select(grp.alias("__g"), _c(key).alias("__k"), _c(position).alias("__p"))
    gf = src.schema["__g"]
    kf = src.schema["__k"]
    ordered = (partition_sampled(src, n, "__g", "__p", tiebreak=True)
               .sortWithinPartitions("__g", "__p", TIEBREAK)
               .select("__g", "__k"))
    out_schema = T.StructType([
        T.StructField("pid", T.IntegerType(), False),
        T.StructField("kind", T.ByteType(), False),
        T.StructField("g", gf.dataType, True),
        T.StructField("k", kf.dataType, True),
        T.StructField("n_bad", T.LongType(), False)])
    parts = ordered.mapInArrow(_violation_kernel(), out_schema)
    # edges (two rows per partition, all in one window) and counts (a row per group and
    # partition, a window per group) go through one exchange, so nothing is computed twice
    edge = F.col("kind") > 0
    w = Window.partitionBy(edge, F.when(~edge, F.col("g"))).orderBy("pid", "kind")
    descent = (F.col("kind") == 1) & F.lag("pid").over(w).isNotNull() & F.lag("g").over(w).eqNullSafe(F.col("g")) \
        & _below(F.col("k"), F.lag("k").over(w))
    out = (parts.select("g", (F.col("n_bad") + F.when(descent, 1).otherwise(0)).alias("n_bad"))
           .groupBy("g").agg(F.sum("n_bad").cast("bigint").alias(out_col)))
    if group is None:
        return out.select(out_col)
    return out.withColumnRenamed("g", group if isinstance(group, str) else "group")
