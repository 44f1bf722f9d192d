"""Static key ranges from a histogram of key prefixes, for binary keys of any distribution.

Even ranges cut the key space evenly and so need uniform keys. Here rows are
counted by the two bytes that follow the prefix all keys share; prefixes that
hold too many rows are counted again by their next two bytes, and so on: a trie
whose leaves are small, or a single key value. Leaves in key order fill the
partitions evenly; a hot key value gets several adjacent partitions. The ranges
are a table by two-byte prefix, at most 65,536 rows, that rows meet in a
broadcast join; within a prefix a short list of cuts settles the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ordwise.operators.partition import even_key, hashable

STEP = 2                   # key bytes of a level
WIDTH = 1 << 8 * STEP
#: A leaf is split while it holds more than this part of a partition, at most this many levels deep.
LEAF_SHARE = 4
LEVELS = 8


def _step(key: Column, skip: int) -> Column:
    """The two bytes after ``skip`` bytes as 0..65,535, zero padded."""
    return F.conv(F.hex(F.rpad(F.substring(key, skip + 1, STEP), STEP, F.lit(b"\x00"))), 16, 10).cast("int")


def _common(a: bytes, b: bytes) -> bytes:
    n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[:n]


@dataclass
class KeyRanges:
    """Ranges of a binary key: keys start with ``common``; ``bases[p]`` is the partition at the
    start of prefix p, ``cuts[p]`` lists (key, hot, add) in key order. A key's partition
    is the base plus ``add`` for every cut below or at it; at a hot cut, which is one key
    value, 0 to ``add`` as the row's salt says. So it never falls as the key grows."""
    num_partitions: int
    common: bytes
    bases: list[int]
    cuts: dict[int, list[tuple]]
    null: tuple[int, int]

    def _table(self, df: DataFrame) -> DataFrame:
        import pyarrow as pa
        cut = pa.list_(pa.struct([("key", pa.binary()), ("hot", pa.bool_()), ("add", pa.int32())]))
        rows = [[{"key": k, "hot": h, "add": a} for k, h, a in self.cuts.get(p, [])] for p in range(WIDTH)]
        return df.sparkSession.createDataFrame(pa.table({
            "__p": pa.array(range(WIDTH), pa.int32()), "__base": pa.array(self.bases, pa.int32()),
            "__cuts": pa.array(rows, cut)}))

    def with_partition_id(self, df: DataFrame, key: Column, out: str) -> DataFrame:
        salt = F.xxhash64(*hashable(df))
        head = F.substring(key, 1, len(self.common))
        # keys outside the common prefix (of other data than was counted) come first or last
        place = (F.when(key.isNull(), F.lit(None).cast("int")).when(head < F.lit(self.common), F.lit(0))
                 .when(head > F.lit(self.common), F.lit(WIDTH - 1)).otherwise(_step(key, len(self.common))))
        rows = df.withColumns({"__k": key, "__s": salt, "__p": place})
        met = rows.join(F.broadcast(self._table(df)), "__p", "left")

        def more(acc, c):
            return acc + (F.when((c["key"] == F.col("__k")) & c["hot"], F.pmod(F.col("__s"), c["add"] + 1).cast("int"))
                          .when(c["key"] <= F.col("__k"), c["add"]).otherwise(F.lit(0)))

        own = F.when(F.size("__cuts") > 0, F.aggregate("__cuts", F.col("__base"), more)).otherwise(F.col("__base"))
        start, wide = self.null
        pid = F.when(F.col("__k").isNull(), F.lit(start) + F.pmod("__s", F.lit(wide + 1))).otherwise(own)
        return met.withColumn(out, pid.cast("int")).select(*df.columns, out)


def _groups(rows: DataFrame, by: list, skip: Column | int) -> DataFrame:
    """Rows per ``by`` and next step, and whether they are one key value (then that value)."""
    same = (F.min(F.xxhash64("k")) == F.max(F.xxhash64("k"))) & (F.min(F.crc32("k")) == F.max(F.crc32("k")))
    return (rows.groupBy(*by, _step(F.col("k"), skip).alias("step"))
            .agg(F.count(F.lit(1)).alias("n"), F.when(same, F.any_value("k")).alias("one")))


def _leaves(rows: DataFrame, common: bytes, limit: int) -> tuple[list, dict]:
    """(rows of each two-byte prefix; {prefix: [(key bytes, rows, single value or None), ...]} of the
    prefixes that were split further, in key order).

    Below the first level, neighbouring small leaves are merged up to ``limit`` rows
    where they are counted, so a level brings at most about twice total / ``limit``
    leaves to the driver.
    """
    first = _groups(rows, [], len(common)).collect()
    counts, split = [0] * WIDTH, {}
    open_ = []
    for r in first:
        counts[r.step] = r.n
        if r.n > limit:
            name = r.step.to_bytes(STEP, "big")
            split[r.step] = [(name, r.n, None if r.one is None else bytes(r.one))]
            if r.one is None:
                open_.append(name)
    size = len(common) + STEP
    for _ in range(LEVELS - 1):
        if not open_:
            break
        # the rows of open leaves: a semi-join with fewer than total / limit prefixes
        of = F.substring(F.rpad("k", size, F.lit(b"\x00")), len(common) + 1, size - len(common))
        names = rows.sparkSession.createDataFrame([(bytearray(x),) for x in open_], "leaf binary")
        inside = rows.withColumn("leaf", of).join(F.broadcast(names), "leaf", "left_semi")
        groups = _groups(inside, ["leaf"], size)
        w = Window.partitionBy("leaf").orderBy("step")
        big = F.col("n") > limit
        # runs of small leaves between big ones, cut where their rows pass a multiple of the limit
        small = F.sum(F.when(big, 0).otherwise(F.col("n"))).over(w)
        run = groups.withColumn("run", F.struct(F.sum(big.cast("int")).over(w), big,
                                                F.call_function("div", small - F.when(big, 0).otherwise(F.col("n")), F.lit(limit))))
        found = (run.groupBy("leaf", "run").agg(F.min("step").alias("step"), F.sum("n").alias("n"),
                                                F.when(F.count(F.lit(1)) == 1, F.any_value("one")).alias("one"))
                 .orderBy("leaf", "step").collect())
        below, again = {}, []
        for r in found:
            name = bytes(r.leaf) + r.step.to_bytes(STEP, "big")
            below.setdefault(bytes(r.leaf), []).append((name, r.n, None if r.one is None else bytes(r.one)))
            if r.run[1] and r.one is None:        # a large group of several keys, not a run of small ones
                again.append(name)
        for p, leaves in split.items():
            split[p] = [x for leaf in leaves for x in (below.get(leaf[0], [leaf]) if leaf[0] in open_ else [leaf])]
        open_, size = again, size + STEP
    return counts, split


def key_ranges(df: DataFrame, num_partitions: int, key="key") -> KeyRanges:
    """Ranges that split the rows of ``df`` evenly by a binary key: one pass for the keys' common
    prefix, one count by the next two bytes, and, where keys are skewed, one count a level over
    the rows of prefixes that hold more than a quarter of a partition.

    What reaches the driver is bounded by the prefixes (65,536) and the number of
    partitions. Different keys that agree in 16 bytes beyond the common prefix
    are not told apart.
    """
    k = F.col("k")
    rows = df.select(even_key(df, key).alias("k"))
    ends = rows.agg(F.min("k").alias("a"), F.max("k").alias("z"), F.count(F.lit(1)).alias("n"),
                    F.count("k").alias("known")).first()
    total, null, n = ends.n, ends.n - ends.known, num_partitions
    if not ends.known:
        return KeyRanges(n, b"", [0] * WIDTH, {}, (0, n - 1))
    common = _common(bytes(ends.a), bytes(ends.z))
    limit = max(1, total // (LEAF_SHARE * n))
    counts, split = _leaves(rows.filter(k.isNotNull()), common, limit)

    def at(place: int) -> int:
        return min(place * n // total, n - 1)

    null_range = (0, at(max(null - 1, 0)))
    done, now, bases, cuts = null, null_range[1], [], {}
    for p in range(WIDTH):
        leaves = split.get(p)
        if not leaves:         # a small prefix lies in one partition
            now = max(now, at(done + counts[p] // 2))
            bases.append(now)
            done += counts[p]
            continue
        bases.append(now)
        for name, rows_, one in leaves:
            hot = one is not None and rows_ > limit
            goal = at(done) if hot else at(done + rows_ // 2)
            if goal > now:
                cuts.setdefault(p, []).append((one if hot else common + name, False, goal - now))
                now = goal
            done += rows_
            if hot and at(done - 1) > now:
                cuts.setdefault(p, []).append((one, True, at(done - 1) - now))
                now = at(done - 1)
    return KeyRanges(n, common, bases, cuts, null_range)


def partition_histogram(df: DataFrame, num_partitions: int, key="key", ranges: KeyRanges | None = None) -> DataFrame:
    """Shuffle rows to even ranges of a binary key of any distribution; NULL first.

    The counts run when this is called, unless ``ranges`` of an earlier call are
    given. Rows of a hot key value (or NULL) are spread over adjacent partitions by
    a hash of the row; rows equal in every column stay together.
    """
    pid = "__ordwise_range"
    ranges = ranges or key_ranges(df, num_partitions, key)
    dealt = ranges.with_partition_id(df, even_key(df, key), pid)
    return dealt.repartitionById(num_partitions, F.col(pid)).drop(pid)
