"""Total-order sort and global rank without a single-partition step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ordwise.operators.histogram import partition_histogram
from ordwise.operators.partition import TIEBREAK, hashable, partition_even, partition_sampled

PID = "__ordwise_pid"
ROW_HASH = "__ordwise_hash"
STRATEGIES = ("even", "histogram", "sampled")


def _names(keys) -> list:
    return [k if isinstance(k, Column) else F.col(k) for k in keys]


def record_key(record: str = "record") -> Column:
    """Sort key of a whole fixed-length record column: its first KEY_LEN bytes."""
    from ordwise.schema import KEY_LEN
    return F.substring(F.col(record), 1, KEY_LEN)


def default_partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions; no job is run to choose it."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _static_ranges(df: DataFrame, n: int, keys: list, strategy: str) -> DataFrame:
    if len(keys) != 1:
        raise ValueError(f"{strategy} ranges need exactly one binary key column")
    return partition_even(df, n, keys[0]) if strategy == "even" else partition_histogram(df, n, keys[0])


def sort_records(df: DataFrame, keys=("key",), strategy: str = "sampled",
                 num_partitions: int | None = None, tiebreak: bool = True) -> DataFrame:
    """Totally order ``df``: partition i holds smaller keys than partition i+1 and
    every partition is sorted. Exactly one shuffle plus an in-partition sort.

    ``even``: static ranges of a binary key's 56-bit prefix, no sampling pass; for
    uniform keys, since rows of one key value stay together.
    ``histogram``: static ranges of a binary key of any distribution, from a count of
    its prefixes that runs when this is called (see ``partition_histogram``).
    ``sampled``: ``repartitionByRange`` (balanced for any key distribution; with
    ``tiebreak`` also when one key value is hot). NULL keys come first.
    """
    keys = [keys] if isinstance(keys, (str, Column)) else list(keys)
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    n = num_partitions or default_partitions(df)
    if strategy != "sampled":
        return _static_ranges(df, n, keys, strategy).sortWithinPartitions(*_names(keys))
    out = partition_sampled(df, n, *keys, tiebreak=tiebreak)
    order = _names(keys) + ([F.col(TIEBREAK)] if tiebreak else [])
    out = out.sortWithinPartitions(*order)
    return out.drop(TIEBREAK) if tiebreak else out


def _partition_counts(dealt: DataFrame) -> DataFrame:
    """(pid, n) of the shuffled ``dealt``, read from the same shuffle as its rows.

    Spark uses one exchange for both only if both want the same columns of it, so the
    count has to refer to every column: it adds up (hash & 0) + 1, which no optimizer
    rule takes apart.
    """
    one = F.xxhash64(*hashable(dealt)).bitwiseAND(F.lit(0)) + F.lit(1)
    return dealt.groupBy(F.spark_partition_id().alias("pid")).agg(F.sum(one).alias("n"))


def _partition_offsets(counts: DataFrame) -> DataFrame:
    """(pid, n) with one row per partition -> (pid, n, offset) with offset = rows before pid.

    The input has at most one row per partition, a bound fixed by the plan, so
    a single-partition window and a broadcast of the result are safe.
    """
    w = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("pid", "n", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("offset"))


def _attach_rank(sorted_df: DataFrame, offsets: DataFrame, rank_col: str) -> DataFrame:
    """Offset of the row's partition plus its position in it.

    The offsets have one row per shuffle partition, a bound that the plan sets. A
    partition without one, or with more rows than were counted, is an error: as
    both sides hold the same rows, any difference between them shows in some
    partition that is larger than its count, so a rank is right or there is none.
    """
    pos, pid, n, off = "__ordwise_pos", PID, "__ordwise_n", "__ordwise_off"
    local = sorted_df.withColumn(pos, F.monotonically_increasing_id()).withColumn(
        pid, F.spark_partition_id())
    ranked = local.join(F.broadcast(offsets.select(F.col("pid").alias(pid), F.col("n").alias(n),
                                                   F.col("offset").alias(off))), on=pid, how="left")
    # monotonically_increasing_id = (partition << 33) + position in partition
    place = F.col(pos) - F.shiftleft(F.col(pid).cast("bigint"), 33)
    known = F.when(place < F.col(n), F.col(off)).otherwise(F.raise_error(F.concat(
        F.lit("row count of partition "), F.col(pid).cast("string"), F.lit(" does not match"))).cast("bigint"))
    return ranked.withColumn(rank_col, known + place + 1).drop(pos, pid, n, off)


def with_global_rank(df: DataFrame, keys=("key",), strategy: str = "sampled",
                     num_partitions: int | None = None, rank_col: str = "rk") -> DataFrame:
    """Sort ``df`` and attach its 1-based position in the total order.

    One shuffle deals the rows to ranges; its files are read twice, for the rows per
    partition and for the rows (``ReusedExchange``): counts -> running offsets (one
    row per partition) -> broadcast join -> offset + position in the sorted
    partition. The input is read once (``sampled``: and once for Spark's sample of
    the keys), nothing is written besides the shuffle, and nothing runs before the
    result is used. For sorted output written as record files, the source's
    ``global_index`` gives the rank for free.

    ``even``, ``histogram``: static ranges of a binary key. ``sampled``: ranges from a sample,
    ties of the key in order of a hash of the whole row, then of a row id, so that
    a hot key, even of equal rows, is spread over partitions.
    """
    keys = [keys] if isinstance(keys, (str, Column)) else list(keys)
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    n = num_partitions or default_partitions(df)
    if strategy != "sampled":
        order = _names(keys)
        dealt = _static_ranges(df, n, keys, strategy)
    else:
        order = _names(keys) + [F.col(ROW_HASH), F.col(TIEBREAK)]
        dealt = partition_sampled(df.withColumn(ROW_HASH, F.xxhash64(*hashable(df))), n, *keys, ROW_HASH)
    sorted_df = dealt.sortWithinPartitions(*order).drop(ROW_HASH, TIEBREAK)
    return _attach_rank(sorted_df, _partition_offsets(_partition_counts(dealt)), rank_col)
