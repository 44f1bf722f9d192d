"""SimHash near-duplicates with covering locality-sensitive hashing.

A fingerprint has one bit per hash bit that is set in over half of the
document's shingle hashes. For a radius r, every bit position gets a non-zero
vector of r+1 bits; table v (any non-zero vector of r+1 bits) keeps the
positions whose vector has an odd inner product with v. Two fingerprints that
differ in at most r positions agree on all kept positions of some table, since
r linear conditions in r+1 unknowns have a non-zero solution: no pair within
the radius is missed, whatever the data.

The tables say which fingerprints have a partner at all; the buckets are not
expanded into pairs. The links among these fingerprints come from middle values
(see ``links``), which keeps them linear in the size of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordwise.llm.common import cut, spread_lookup, text_of, tidy
from ordwise.llm.components import connected_components

BITS = 64
SHINGLE = 3
SEED = 42
MAX_DISTANCE = 2
_ROWS = 1 << 16   # shingle hashes whose bits are counted at a time


def covering_masks(max_distance: int = MAX_DISTANCE, bits: int = BITS) -> list[int]:
    """The 2**(r+1) - 1 masks; position i has the vector 1 + i mod (2**(r+1) - 1)."""
    vectors = (1 << (max_distance + 1)) - 1
    of = [1 + i % vectors for i in range(bits)]
    return [sum(1 << i for i in range(bits) if bin(of[i] & v).count("1") % 2)
            for v in range(1, vectors + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def simhash_bytes(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Fingerprint of one UTF-8 text as an unsigned integer (see ``fingerprints``)."""
    from itertools import repeat

    import numpy as np
    from xxhash import xxh64_intdigest

    words = text.lower().split()          # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        return xxh64_intdigest(b" ".join(words), seed)
    n = len(words) - shingle + 1
    rows = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    counts = np.zeros(BITS, np.int64)
    hashes = map(xxh64_intdigest, rows, repeat(seed))
    for at in range(0, n, _ROWS):
        h = np.fromiter(hashes, np.uint64, min(_ROWS, n - at))
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, text_key (hash of the text), fp (the fingerprint as a signed long), a row per row.

    A-Z are lower-cased, words are runs of other than ASCII white space, shingles
    of ``shingle`` words (repeats included) are joined by one space and hashed
    with XXH64. Fewer words: the whole sequence is the one shingle; no words or
    a null text: fingerprint 0.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    src = src.select("doc_id", F.xxhash64("text").alias("text_key"), "text")

    def kernel(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            text = b.column("text").cast(pa.binary())
            fp = np.fromiter((simhash_bytes(t.as_py(), shingle, seed) for t in text), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_key"), pa.array(fp.view(np.int64))],
                names=["doc_id", "text_key", "fp"])

    return src.mapInArrow(tidy(kernel), "doc_id long, text_key long, fp long")


def candidates(fps: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """The distinct fingerprints that share a table bucket with another one."""
    masks = covering_masks(max_distance)
    keys = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k"))
                     for t, m in enumerate(masks)])
    rows = fps.select("fp", F.explode(keys).alias("x")).select("fp", "x.t", "x.k")
    full = rows.groupBy("t", "k").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).filter("lo <> hi")
    return rows.join(full.select("t", "k"), ["t", "k"]).select("fp").distinct()


def _flips(max_flips: int) -> Column:
    """The fingerprint with every set of at most ``max_flips`` bits turned over."""
    from itertools import combinations
    flips = [0] + [sum(1 << i for i in c) for n in range(1, max_flips + 1)
                   for c in combinations(range(BITS), n)]
    return F.transform(F.array(*[F.lit(_signed(x)).cast("long") for x in flips]),
                       lambda x: F.col("fp").bitwiseXOR(x))


def links(cand: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Exact links (a, b) among candidate fingerprints, without forming pairs.

    Two fingerprints are within 2 bits if and only if some value is within 1 bit
    of both. Each candidate is dealt to its 65 such middle values; a middle
    value is met by at most 65 distinct fingerprints, all within 2 bits of each
    other, and they are linked to the smallest of them. So the links of a group
    of any size stay linear in it, and their components are those of all pairs.
    """
    if max_distance % 2:
        raise ValueError("the middle-value check needs an even distance")
    met = cand.select("fp", F.explode(_flips(max_distance // 2)).alias("mid")).groupBy("mid").agg(
        F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    return (met.select(F.array_min("fps").alias("b"), F.explode("fps").alias("a"))
            .filter("a <> b").select("a", "b").distinct())


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE,
                    seed: int = SEED) -> DataFrame:
    """doc_id, text_key, fp, root, component_id for every row of ``docs``; root names
    the component by one of its fingerprints.

    Fingerprints link at ``max_distance`` or fewer differing bits; component_id is
    the smallest doc_id reachable, the document's own included. Repeated rows get
    one row each; null doc_ids take no part in the minimum (a component of null
    ids only has a null component_id); an empty table gives no rows. Equal
    fingerprints are combined before anything is linked, so copies cost one
    aggregate however many there are.
    """
    fps = cut(fingerprints(docs, shingle, seed))
    distinct = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    comp = connected_components(links(candidates(distinct.select("fp"), max_distance), max_distance))
    linked = comp.join(distinct, comp["node"] == distinct["fp"]).select("fp", "root", "first_id")
    lowest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = linked.join(lowest, "root").select("fp", "root", "component_id")
    of = (distinct.join(named, "fp", "left")
          .select("fp", F.coalesce("root", "fp").alias("root"),
                  F.when(F.col("root").isNull(), F.col("first_id"))
                  .otherwise(F.col("component_id")).alias("component_id")))
    # one fingerprint may be that of a third of all rows
    return spread_lookup(fps, "fp", of, F.xxhash64("doc_id", "text_key")).select(
        "doc_id", "text_key", "fp", "root", "component_id")


def fingerprint_hex(column: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE,
                         max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest doc_id (nulls
    last; ties: the smallest text hash; repeated rows: one of them). All columns stay."""
    found = near_duplicates(docs, shingle, max_distance)
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.coalesce("doc_id", F.lit(0)).alias("i"),
                     F.col("text_key").alias("k"))
    keys = ["__n", "__i", "__k"]
    stay = (found.groupBy("root").agg(F.min(order).alias("w"))
            .select(F.col("w.n").alias("__n"), F.col("w.i").alias("__i"), F.col("w.k").alias("__k")))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"),
                       docs["doc_id"].isNull().alias("__n"),
                       F.coalesce(docs["doc_id"].cast("long"), F.lit(0)).alias("__i"),
                       F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))).alias("__k"))
    # repeated rows become one before the shuffle; the join then uses the partitions of that
    once = rows.groupBy(*keys).agg(F.first("__row").alias("__row"))
    return once.join(stay, keys, "left_semi").select("__row.*")
