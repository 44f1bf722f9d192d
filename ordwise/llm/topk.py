"""Exact top-k inner products by columnar branch-and-bound.

Candidates are laid out dimension by dimension. Scores are accumulated a block
of dimensions at a time; after each block the mass that is left in the other
dimensions bounds what a candidate can still gain, and only candidates whose
bound reaches the k-th best assured score stay in the working set.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

K = 10
SCALE = 1024
#: Largest number of candidates and of queries that meet in one task.
SLAB_ROWS = 65_536
QUERY_ROWS = 16_384
#: Slabs are made smaller, down to this, to give every core work.
LEAST_SLAB_ROWS = 2_048
DIM_BLOCK = 8


def quantised(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and v, the components as floor(scale * x); vectors that are null or hold a
    null or non-finite component, and rows without a vec_id, are left out."""
    x = F.col("embedding").cast("array<double>")
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding"))
            .filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(good, F.lit(False)))
            .select("vec_id", F.transform("embedding", lambda c: F.floor(c * F.lit(float(scale)))).alias("v")))


def numbered(vectors: DataFrame) -> DataFrame:
    """``vectors`` with a ``row`` of their own, by which a query knows itself among the candidates.

    Write or checkpoint the result before it is used as queries and as candidates.
    """
    return vectors.withColumn("row", F.monotonically_increasing_id())


def _matrix(column, dims: int):
    """Rows of an Arrow list column as an int64 matrix, short vectors padded with zeros."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), dims), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def search_block(query_ids, queries, ids, vectors, k: int = K, dim_block: int = DIM_BLOCK, own=None):
    """(query index, candidate index, score) of each query's best k among ``vectors``.

    Highest score first, ties to the smaller id; a candidate with the query's
    own id does not count (or, with ``own`` = (query rows, candidate rows), its own row).
    Scores are exact integers; those beyond 64 bits count as the largest or smallest long.
    """
    import numpy as np

    n, d = vectors.shape
    if n == 0 or len(queries) == 0:
        return [np.zeros(0, np.int64)] * 3
    q_rows, c_rows = own or (query_ids, ids)
    # vectors whose products could leave 64 bits take a path of their own
    limit = math.isqrt((1 << 62) // max(d, 1))
    wide_q, wide_c = ((m > limit).any(axis=1) | (m < -limit).any(axis=1) for m in (queries, vectors))
    if not wide_q.any() and not wide_c.any():
        return _search(q_rows, queries, c_rows, ids, vectors, k, dim_block)
    fast_q, fast_c = np.flatnonzero(~wide_q), np.flatnonzero(~wide_c)
    found: list = [[] for _ in range(len(queries))]
    for i, j, s in zip(*(x.tolist() for x in _search(q_rows[fast_q], queries[fast_q], c_rows[fast_c], ids[fast_c],
                                                     vectors[fast_c], k, dim_block))):
        found[fast_q[i]].append((-s, int(ids[fast_c[j]]), int(fast_c[j])))
    exact = vectors.astype(object)
    for i, q in enumerate(queries.astype(object)):
        for j in (range(n) if wide_q[i] else np.flatnonzero(wide_c).tolist()):
            if c_rows[j] != q_rows[i]:
                s = min(max(sum(a * b for a, b in zip(q, exact[j])), -(1 << 63)), (1 << 63) - 1)
                found[i].append((-s, int(ids[j]), int(j)))
    best = [(i, j, -s) for i, rows in enumerate(found) for s, _, j in sorted(rows)[:k]]
    return [np.array([x[c] for x in best], np.int64) for c in range(3)]


def _search(q_rows, queries, c_rows, ids, vectors, k: int, dim_block: int):
    """``search_block`` of vectors whose scores fit 64 bits."""
    import numpy as np

    n, d = vectors.shape
    if n == 0 or len(queries) == 0:
        return [np.zeros(0, np.int64)] * 3
    # dimensions with most mass first
    order = np.argsort(-np.square(vectors.astype(float)).sum(axis=0), kind="stable")
    largest = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(d, 1)
    kind = np.float64 if largest < 2.0 ** 53 else np.int64    # exact either way
    columns = np.ascontiguousarray(vectors.T[order]).astype(kind)       # vertical layout
    q = queries[:, order].astype(kind)

    def rest(m, axis):
        """Root of the squared mass from each block boundary on, rounded up."""
        sq = np.square(m.astype(float))
        left = np.flip(np.cumsum(np.flip(sq, axis), axis), axis)
        return np.sqrt(left) * (1 + 1e-9)

    rest_c, rest_q = rest(columns, 0), rest(q, 1)
    found = []
    first = min(dim_block, d)
    for at in range(0, len(q), 64):
        head = q[at:at + 64, :first] @ columns[:first]
        for i in range(at, min(at + 64, len(q))):
            alive = np.flatnonzero(c_rows != q_rows[i])
            score = head[i - at][alive]
            done = first
            while True:
                if len(alive) > k:
                    slack = rest_q[i, done] * rest_c[done, alive] if done < d else 0.0
                    sure = np.partition(score - slack, len(alive) - k)[len(alive) - k]
                    stay = np.flatnonzero(score + slack >= sure)
                    if len(stay) < len(alive):
                        alive, score = alive[stay], score[stay]       # compact the survivors
                if done >= d:
                    break
                to = min(done + dim_block, d)
                score = score + q[i, done:to] @ columns[done:to, alive]
                done = to
            best = np.lexsort((ids[alive], -score))[:k]
            found.append((np.full(len(best), i), alive[best], score[best].astype(np.int64)))
    return [np.concatenate(x) for x in zip(*found)]


def query_block(blocks: int):
    """The block of a query, from its own values: a retried task may meet rows in another order."""
    return F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: every query's ``k`` best among all ``vectors``.

    Both have vec_id and v (longs). Queries and candidates are dealt to blocks of
    bounded size and each pair of blocks meets in one task, so neither side is
    ever whole in one place; the k best of each pair are merged per query. With a
    column ``row`` in both (see ``numbered``) every row is a query of its own, and a
    candidate of every other, repeated ids and rows too. Without it a query is its id:
    where that repeats, its smallest vector is used, and candidates of this id do not
    count. Repeated candidates all count; vectors of different length are compared as if padded with zeros.
    Fewer candidates than k give fewer rows, empty tables none.
    """
    spark = vectors.sparkSession
    by_row = "row" in vectors.columns and "row" in queries.columns
    if by_row:
        vectors, asked = vectors.select("vec_id", "v", "row"), queries.select("vec_id", "v", "row")
    else:
        vectors = vectors.select("vec_id", "v", F.col("vec_id").alias("row"))
        asked = queries.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("row", F.col("vec_id"))
    n, n_q = vectors.count(), asked.count()
    cores = spark.sparkContext.defaultParallelism
    slabs = max(1, -(-n // SLAB_ROWS), min(-(-n // LEAST_SLAB_ROWS), 2 * cores))
    blocks = max(1, -(-n_q // QUERY_ROWS))

    def spread(df, own, block, other, others):
        return df.select("vec_id", "v", "row", block.alias(own)).select(
            "vec_id", "v", "row", own, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))).alias(other))

    # candidates may repeat, so they are dealt by place
    left = spread(vectors, "s", F.pmod(F.monotonically_increasing_id(), F.lit(slabs)), "b", blocks)
    right = spread(asked, "b", query_block(blocks), "s", slabs)

    def meet(c, q):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        dims = max([0, *(pc.max(pc.list_value_length(t.column("v"))).as_py() or 0 for t in (c, q))])
        ids, qids = (t.column("vec_id").to_numpy().astype(np.int64) for t in (c, q))
        if dims == 0:     # empty vectors: every score is 0
            dims = 1
        own = tuple(t.column("row").to_numpy().astype(np.int64) for t in (q, c))
        i, j, s = search_block(qids, _matrix(q.column("v"), dims), ids, _matrix(c.column("v"), dims), k, own=own)
        return pa.table({"query_id": pa.array(qids[i], pa.int64()), "query_row": pa.array(own[0][i], pa.int64()),
                         "vec_id": pa.array(ids[j], pa.int64()), "score": pa.array(s, pa.int64())})

    pairs = left.groupBy("s", "b").cogroup(right.groupBy("s", "b")).applyInArrow(
        meet, "query_id long, query_row long, vec_id long, score long")
    w = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    return (pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
