"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordwise.session import checkpoint_root


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there.

    Reliable checkpoints survive lost executors; their files go when the frame
    is garbage collected (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def string_buffers(array):
    """(bytes as uint8, offsets as int64) of an Arrow string array without nulls.

    Offsets are relative to the returned byte view; no value is copied.
    """
    import numpy as np
    import pyarrow as pa

    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    n = len(array)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = array.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[array.offset:array.offset + n + 1]
    offsets = offsets.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    raw = raw[offsets[0]:offsets[-1]]
    return raw, offsets - offsets[0]


def tidy(kernel):
    """``kernel`` (Arrow batches in, batches out) that gives freed memory back when it ends.

    Python workers live on between tasks and stages; without this the largest
    task's working memory would stay with every worker.
    """
    def run(batches):
        import ctypes

        import pyarrow as pa
        yield from kernel(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):      # not glibc
            pass
    return run


def text_source(docs: DataFrame, carry: bool):
    """(doc_id and either the text or the whole ``row``; how to get the text of an Arrow batch).

    A carried row holds the text already, so it is not sent to Python twice.
    """
    cols = [F.col("doc_id").cast("long").alias("doc_id")]
    if not carry:
        return docs.select(*cols, text_of().alias("__text")), lambda b: b.column("__text")
    is_text = docs.schema["text"].dataType.simpleString() == "string"
    row = F.struct(*[docs[c] if is_text or c != "text" else docs[c].cast("string").alias(c) for c in docs.columns])

    def text(b):
        import pyarrow.compute as pc
        rows = b.column("row")
        return pc.fill_null(rows.flatten()[rows.type.get_field_index("text")], "")

    return docs.select(*cols, row.alias("row")), text


def small_batches(batches, column, max_bytes: int = 2 << 20):
    """Slices of Arrow batches that hold at most ``max_bytes`` of ``column`` each, or one row.

    ``column`` is a name or a function from a batch to its string column.
    """
    for b in batches:
        if b.num_rows == 0:
            continue
        _, off = string_buffers(column(b) if callable(column) else b.column(column))
        at = 0
        while at < b.num_rows:
            to = int(off.searchsorted(off[at] + max_bytes, side="right")) - 1
            to = min(max(to, at + 1), b.num_rows)
            yield b.slice(at, to - at)
            at = to


def spread_lookup(rows: DataFrame, key: str, table: DataFrame, salt: Column, salts: int | None = None) -> DataFrame:
    """``rows`` left-joined with ``table``, which has one row per ``key``; a hot key is no hot task.

    ``salt`` is a hash of the row (a retried task gives it again). The distinct
    (key, salt) pairs, combined before they are shuffled, fetch the table's row: at
    most ``salts`` of a key. The rows then meet them by key and salt, so the rows of
    one key come to ``salts`` tasks. Rows without a key find nothing and stay.
    """
    n = salts or max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salted = rows.withColumn("__salt", F.pmod(salt, F.lit(n)).cast("int"))
    pairs = salted.filter(F.col(key).isNotNull()).select(key, "__salt").distinct()
    return salted.join(pairs.join(table, key), [key, "__salt"], "left").drop("__salt")


def arrow_schema(ddl: str):
    """Arrow schema of a DDL string; on the driver only, tasks get it by closure."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))
