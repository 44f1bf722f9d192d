"""A tree of checksums by key range, which names the ranges in which two data sets differ.

Node p of level d covers the binary keys that start with the d bytes p. Its
digest is the number of its rows and the sum of their CRC-32 values, so a parent's
digest is the sum of its children's: the leaves are one aggregate over the rows,
everything above them is summed from the leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordwise.functions.u128 import U128, to_hex_u128
from ordwise.operators.partition import even_key
from ordwise.operators.validate import record_crc

DEPTH = 2


def _leaf(df: DataFrame, key, depth: int, within: bytes) -> tuple[DataFrame, Column]:
    k = even_key(df, key)
    if within:
        df = df.filter(F.substring(k, 1, len(within)) == F.lit(within))
    # NULL keys are a leaf of their own, outside the tree's root
    return df, F.hex(F.substring(k, 1, len(within) + depth))


def range_digests(df: DataFrame, key="key", cols=None, depth: int = DEPTH, within: bytes = b"") -> DataFrame:
    """``level, prefix, n, checksum, checksum_hex`` of every node down to ``depth`` bytes.

    ``prefix`` is in hex; the root has level 0 and an empty prefix, rows with a NULL
    key are one node with a NULL prefix. ``within`` starts the tree at a node (its
    levels count from there). ``cols``: what the checksum covers, default the key. At
    most 256 ** ``depth`` leaves are shuffled, whatever the number of rows.
    """
    cols = [key] if cols is None else cols
    df, leaf = _leaf(df, key, depth, within)
    leaves = df.groupBy(leaf.alias("leaf")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(record_crc(cols, df).cast(U128)).cast(U128).alias("checksum"))
    nodes = _up(leaves, depth, within).groupBy("level", "prefix").agg(
        F.sum("n").alias("n"), F.sum("checksum").cast(U128).alias("checksum"))
    return nodes.withColumn("checksum_hex", to_hex_u128("checksum"))


def _up(leaves: DataFrame, depth: int, within: bytes) -> DataFrame:
    """Every leaf once for each node above it and for itself."""
    first = len(within)
    levels = F.sequence(F.lit(0), F.greatest(F.least(F.lit(depth), F.length("leaf") / 2 - first), F.lit(0)).cast("int"))
    nodes = F.when(F.col("leaf").isNull(), F.array(F.lit(None).cast("int"))).otherwise(levels)
    return (leaves.withColumn("level", F.explode(nodes))
            .withColumn("prefix", F.col("leaf").substr(F.lit(1), 2 * (F.col("level") + first))))


def differing_ranges(a: DataFrame, b: DataFrame, key="key", cols=None, depth: int = DEPTH,
                     within: bytes = b"") -> DataFrame:
    """The nodes over which ``a`` and ``b`` differ: ``level, prefix, n_a, n_b, checksum_a_hex,
    checksum_b_hex, leaves`` (differing leaves below). Equal data sets give no rows.

    Both sides are reduced to leaves and meet in one aggregate. A node is listed if
    one of its leaves differs, also where sums further up happen to agree. To go
    deeper, call it again ``within`` a prefix of the result: only rows of that
    range are compared.
    """
    cols = [key] if cols is None else cols

    def side(df, s):
        df, leaf = _leaf(df, key, depth, within)
        return df.select(F.lit(s).alias("s"), leaf.alias("leaf"), record_crc(cols, df).cast(U128).alias("c"))

    def one(s, value):
        return F.coalesce(F.sum(F.when(F.col("s") == s, value)), F.lit(0))

    leaves = side(a, 0).unionByName(side(b, 1)).groupBy("leaf").agg(
        one(0, F.lit(1)).alias("n_a"), one(1, F.lit(1)).alias("n_b"),
        one(0, F.col("c")).cast(U128).alias("a"), one(1, F.col("c")).cast(U128).alias("b"))
    differs = (F.col("n_a") != F.col("n_b")) | (F.col("a") != F.col("b"))
    nodes = _up(leaves.withColumn("d", differs.cast("bigint")), depth, within).groupBy("level", "prefix").agg(
        F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"), F.sum("a").cast(U128).alias("a"),
        F.sum("b").cast(U128).alias("b"), F.sum("d").alias("leaves"))
    return nodes.filter("leaves > 0").select(
        "level", "prefix", "n_a", "n_b", to_hex_u128("a").alias("checksum_a_hex"),
        to_hex_u128("b").alias("checksum_b_hex"), "leaves")
