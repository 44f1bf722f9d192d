"""Packing along a space-filling curve.

Every document becomes a vector: the mean of a fixed random direction per token
id. The vector is squashed into a small grid whose cells a Hilbert curve visits
so that neighbours on the curve are neighbours in the grid. Documents are
range-sorted by their place on the curve and laid end to end into sequences, so
a sequence holds documents that resemble each other.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordwise.llm.common import cut, small_batches, text_of, tidy

SEQUENCE = 1024
END_ID = 0
DIMS = 4
GRID_BITS = 12
SEED = 7


def directions(size: int, dims: int = DIMS, seed: int = SEED) -> np.ndarray:
    """One +1/-1 vector per token id, the same in every process."""
    rng = np.random.Generator(np.random.PCG64(seed))
    return (rng.integers(0, 2, (size, dims)) * 2 - 1).astype(np.float32)


def hilbert_key(cells: np.ndarray, bits: int = GRID_BITS) -> np.ndarray:
    """Place on the Hilbert curve of grid cells (rows of ``dims`` integers below 2**bits).

    The cell's axes are turned into the transposed index (undoing, from the top
    bit down, the reflection or exchange that each quadrant brings), Gray-coded,
    and the bits of all axes are interleaved.
    """
    x = cells.astype(np.int64).copy()
    n, d = x.shape
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(d):
            turned = (x[:, i] >> b) & 1 == 1
            swap = np.where(turned, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(turned, low, swap)
            x[:, i] ^= swap
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(n, np.int64)
    for b in range(bits - 1, 0, -1):
        t ^= np.where((x[:, d - 1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= t[:, None]
    key = np.zeros(n, np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


def curve_keys(ids: np.ndarray, off: np.ndarray, table: np.ndarray, bits: int = GRID_BITS) -> np.ndarray:
    """Hilbert key of every document from its token ids (at least one each)."""
    n = len(off) - 1
    mean = np.empty((n, table.shape[1]))
    for j in range(table.shape[1]):
        total = np.add.reduceat(table[:, j][ids], off[:-1], dtype=np.float64) if n else np.zeros(0)
        mean[:, j] = total / np.maximum(np.diff(off), 1)
    cells = np.floor((np.tanh(4 * mean) + 1) / 2 * (1 << bits)).astype(np.int64)
    return hilbert_key(np.clip(cells, 0, (1 << bits) - 1), bits)


def tokenized(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, place (on the curve), ids (16-bit little-endian, end id included) per row."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("__text"))

    def kernel(batches):
        import pyarrow as pa

        from ordwise.llm.tokens import append_id, encoder
        made, table = encoder(path, False), directions(1 << 16)
        for b in small_batches(batches, "__text"):
            ids, off = append_id(*made.encode(b.column("__text")), end_id)
            data = pa.Array.from_buffers(pa.binary(), b.num_rows, [
                None, pa.py_buffer((off * 2).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(ids))])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(curve_keys(ids, off, table)), data],
                                             names=["doc_id", "place", "ids"])

    return src.mapInArrow(tidy(kernel), "doc_id long, place long, ids binary")


def _tail_lengths(n: int) -> list[int]:
    """A short rest as sequences of a power of two each, largest first: no padding at all."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pieces(rows, sequence: int, first_id: int):
    """(doc_id, start, length, doc_tokens, sequence_id, offset, bytes) from (doc_id, ids) rows.

    Rows are laid end to end; every full ``sequence`` is one sequence, and the
    rest at the end is cut into sequences of a power of two.
    """
    held, size, number = [], 0, first_id      # held: what the open sequence has so far

    def close(parts, lengths, number):
        """Lay parts into sequences of the given lengths."""
        at, room = 0, list(lengths)
        for doc, start, total, data in parts:
            done, n = 0, len(data) // 2
            while done < n:
                take = min(n - done, room[0] - at)
                yield doc, start + done, take, total, number, at, data[2 * done:2 * (done + take)]
                done, at = done + take, at + take
                if at == room[0]:
                    room, number, at = room[1:], number + 1, 0

    for doc, data in rows:
        total, done = len(data) // 2, 0
        while total - done >= sequence - size:
            take = sequence - size
            held.append((doc, done, total, data[2 * done:2 * (done + take)]))
            yield from close(held, [sequence], number)
            held, size, number, done = [], 0, number + 1, done + take
        if done < total:
            held.append((doc, done, total, data[2 * done:]))
            size += total - done
    if size:
        yield from close(held, _tail_lengths(size), number)


def pack(docs: DataFrame, path: str, sequence: int = SEQUENCE, end_id: int = END_ID,
         partitions: int | None = None, with_ids: bool = True) -> DataFrame:
    """Pieces of packed sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset and (``with_ids``) the ids of the piece.

    Each id of every row lies in exactly one piece. A null or empty text is its end id alone;
    a null doc_id and repeated rows are packed like any other; an empty table
    gives no rows. Sequence ids are unique; each range of the curve fills its
    sequences on its own and its rest is cut into powers of two, so nothing is
    padded. ``partitions``: ranges of the curve (default: the session's shuffle
    partitions). Equal places are split between ranges by a row number, so
    copies do not meet in one task.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # written once: the ranges are found from it and it is read again to be dealt out
    made = cut(tokenized(docs, path, end_id).withColumn("row", F.monotonically_increasing_id()))
    along = made.repartitionByRange(n, "place", "row").sortWithinPartitions("place", "row")
    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "offset long" + (", ids binary" if with_ids else ""))
    names = [c.split()[0] for c in schema.split(", ")]

    def kernel(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        def rows():
            for b in batches:
                yield from zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist())

        def batch(out):
            cols = [pa.array(c, pa.int64()) for c in list(zip(*out))[:7]]
            if with_ids:
                cols.append(pa.array([r[7] for r in out], pa.binary()))
            return pa.RecordBatch.from_arrays(cols, names=names)

        out = []
        for doc, start, length, total, number, at, data in pieces(
                rows(), sequence, TaskContext.get().partitionId() << 33):
            wide = np.frombuffer(data, "<u2").astype("<u4").tobytes()
            out.append((doc, start, length, zlib.crc32(wide), total, number, at, wide))
            if len(out) == 4096:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    return along.select("doc_id", "ids").mapInArrow(tidy(kernel), schema)
