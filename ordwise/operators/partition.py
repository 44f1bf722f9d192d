"""Range partitioning: even key-space ranges or sampled ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordwise.functions.keys import key_prefix56
from ordwise.schema import PREFIX_MAX

TIEBREAK = "__ordwise_tb"


def even_range_size(num_partitions: int) -> int:
    """ceil((2**56 - 1) / N): width of each partition's slice of the prefix space."""
    if num_partitions < 1:
        raise ValueError("num_partitions must be >= 1")
    return -(-PREFIX_MAX // num_partitions)


def even_partition_id(key, num_partitions: int, clamp: bool = True) -> Column:
    """Partition of a binary key under even ranges of its 56-bit prefix.

    When N divides 2**56 - 1 the top prefix maps to N itself; ``clamp`` keeps
    it in the last partition (``repartitionById`` would wrap it to 0).
    """
    pid = F.call_function("div", key_prefix56(key), F.lit(even_range_size(num_partitions)))
    if clamp:
        pid = F.least(pid, F.lit(num_partitions - 1))
    # NULL sorts first; least() would send it to the last partition
    k = key if isinstance(key, Column) else F.col(key)
    return F.when(k.isNull(), F.lit(0)).otherwise(pid).cast("int")


def partition_even(df: DataFrame, num_partitions: int, key="key") -> DataFrame:
    """Shuffle rows to the partition that owns their key range; no sampling job.

    Right for uniformly distributed binary keys (generated records, hashes).
    The partition id is a pure function of the key, so a re-run or a retried
    task sends every row to the same place.
    """
    return df.repartitionById(num_partitions, even_partition_id(even_key(df, key), num_partitions))


def even_key(df: DataFrame, key) -> Column:
    """The key of even ranges: binary only. Text shares prefixes, so its even ranges
    are empty or full (and a collation may order it differently than its bytes)."""
    col = key if isinstance(key, Column) else F.col(key)
    dtype = df.select(col).schema.fields[0].dataType
    if not isinstance(dtype, T.BinaryType):
        raise TypeError(f"even ranges need a binary key, not {dtype.simpleString()}; use strategy='sampled'")
    return col


def partition_sampled(df: DataFrame, num_partitions: int, *keys, tiebreak: bool = True) -> DataFrame:
    """Range partitioning with boundaries from a sample (``repartitionByRange``).

    With ``tiebreak`` a unique row id joins the range key, so a single hot key
    is split over several adjacent partitions instead of landing in one task;
    the key order is unchanged. The helper column is ``TIEBREAK``.
    """
    if not keys:
        raise ValueError("at least one key column is required")
    cols = [k if isinstance(k, Column) else F.col(k) for k in keys]
    if tiebreak:
        df = df.withColumn(TIEBREAK, F.monotonically_increasing_id())
        cols = cols + [F.col(TIEBREAK)]
    return df.repartitionByRange(num_partitions, *cols)


def hashable(df: DataFrame) -> list:
    """The columns of ``df`` in a form that Spark can hash (anything with a map as text)."""
    def has_map(t: T.DataType) -> bool:
        return "map<" in t.simpleString()
    return [df[f"`{f.name}`"].cast("string") if has_map(f.dataType) else df[f"`{f.name}`"] for f in df.schema.fields]
