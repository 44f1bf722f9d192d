"""Ranked lexical search by presence-mask grouping.

Documents become postings of the terms that some item asks for. In a block of
documents every term has a presence bitmap; the bitmaps of an item's terms,
laid side by side, give every document its mask of matched terms, and documents
with one mask form a group. A mask's score is bounded by the best its terms
reach in the block, so masks are worked through by descending bound and the
rest is left as soon as the bound cannot reach the k-th best score any more.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ordwise.llm.common import cut, small_batches, text_of, tidy

K = 50
#: A term is a longest run of these: ASCII letters and digits, and everything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# fixed values of the score
IDF_SCALE, TF_SCALE, TF_WEIGHT, LENGTH_WEIGHT, LENGTH_BASE, LENGTH_SLOPE = 1000, 1_000_000_000, 1000, 20, 50, 50
#: Text of the items that are searched together; more are searched block by block.
QUERY_BYTES = 1 << 20
#: Documents in a block, and cells of its presence matrix.
BLOCK_DOCS = 8192
BLOCK_BITS = 1 << 25

_A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def terms_of(text: Column) -> Column:
    """The terms of a text in order, repeats included; only A-Z are lower-cased."""
    return F.regexp_extract_all(F.translate(text, _A_Z, _A_Z.lower()), F.lit(TERM), F.lit(0))


def term_table() -> bytes:
    """Byte table: A-Z to a-z, what separates terms to a blank; bytes beyond ASCII are parts of terms."""
    keep = [chr(c).isalnum() for c in range(128)] + [True] * 128
    return bytes(ord(chr(c).lower()) if c < 128 and ok else c if ok else 0x20 for c, ok in enumerate(keep))


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms of the text, repeats included), t (ids of the document's vocabulary
    terms, ascending), tf (their counts): a row per document with at least one term."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    table = term_table()

    def kernel(batches):
        from collections import Counter

        import pyarrow as pa
        known = vocabulary.keys()
        for b in small_batches(batches, "text", 8 << 20):
            ids, ns, off, ts, tfs = [], [], [0], [], []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary())):
                words = text.as_py().translate(table).split()
                if not words:
                    continue
                found = Counter(words)
                hits = sorted((vocabulary[w], found[w]) for w in found.keys() & known)
                ids.append(doc)
                ns.append(len(words))
                ts += [t for t, _ in hits]
                tfs += [c for _, c in hits]
                off.append(len(ts))
            offsets = pa.array(off, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(ts, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64()))], names=["doc_id", "n", "t", "tf"])

    return src.mapInArrow(tidy(kernel), "doc_id long, n long, t array<int>, tf array<long>")


def weight(n_docs: int, df: int) -> int:
    """floor(1000 * ln((2N + 2) / (2 df + 1)))"""
    return math.floor(IDF_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def contributions(tf, n, w, total_docs: int, total_terms: int):
    """Score of one term in one document, for arrays of counts, document lengths and weights."""
    import numpy as np
    if LENGTH_SLOPE * int(n.max(initial=0)) * total_docs >= 1 << 63:
        raise OverflowError("document lengths times documents exceed 64 bits")
    m = 100 - LENGTH_BASE + (LENGTH_SLOPE * n * total_docs) // max(total_terms, 1)
    return (w * ((TF_SCALE * tf) // (TF_WEIGHT * tf + LENGTH_WEIGHT * m))).astype(np.int64)


def _rank_key(doc_ids, valid):
    """Order of equal scores: ascending doc_id, null last."""
    import numpy as np
    return np.where(valid, doc_ids, np.iinfo(np.int64).max), ~valid


class Block:
    """Postings of some documents, with presence bitmaps and exact contributions."""

    def __init__(self, doc_ids, valid, n, off, t, tf, weights, total_docs, total_terms):
        import numpy as np
        self.doc_ids, self.valid, self.off, self.t = doc_ids, valid, off, t
        of = np.repeat(np.arange(len(n)), np.diff(off))
        self.score = contributions(tf, n[of], weights[t], total_docs, total_terms)
        self.best = np.zeros(len(weights), np.int64)        # the most a term scores in this block
        np.maximum.at(self.best, t, self.score)
        present = np.zeros((len(weights), len(n)), bool)
        present[t, of] = True
        self.bits = np.packbits(present, axis=1, bitorder="little")

    def masks(self, terms):
        """(documents with a term, their masks as rows of 64-bit words) for the item's terms."""
        import numpy as np
        rows = self.bits[terms]
        docs = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(rows, axis=0), bitorder="little"))
        here = np.unpackbits(rows, axis=1, bitorder="little")[:, docs]
        packed = np.packbits(here, axis=0, bitorder="little")
        words = np.zeros((len(docs), -(-len(packed) // 8) * 8), np.uint8)
        words[:, :len(packed)] = packed.T
        return docs, words.view(np.uint64)

    def exact(self, docs, slot):
        """Scores of ``docs`` over the terms with a ``slot`` of 1."""
        import numpy as np
        sizes = self.off[docs + 1] - self.off[docs]
        at = np.repeat(self.off[docs] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        out = np.zeros(len(docs), np.int64)
        np.add.at(out, np.repeat(np.arange(len(docs)), sizes), self.score[at] * slot[self.t[at]])
        return out

    def search(self, terms, k: int, held):
        """``held`` (scores, doc_ids, valid: an item's best so far) merged with this block's best.

        Returns it with the number of masks that were evaluated.
        """
        import numpy as np
        docs, words = self.masks(terms)
        if not len(docs):
            return held, 0
        # group by mask
        order = np.lexsort(words.T)
        cut_ = np.flatnonzero(np.r_[True, (words[order][1:] != words[order][:-1]).any(axis=1)])
        mask = words[order[cut_]]
        set_bits = np.unpackbits(mask.view(np.uint8), axis=1, bitorder="little")[:, :len(terms)]
        bound = set_bits.astype(np.int64) @ self.best[terms]
        slot = np.zeros(len(self.best), np.int64)
        slot[terms] = 1
        ends = np.r_[cut_[1:], len(order)]
        done = 0
        turn = np.argsort(-bound, kind="stable")
        scores, ids, valid = held
        while done < len(turn):
            floor = scores[k - 1] if len(scores) >= k else 1
            if bound[turn[done]] < floor:
                break       # no later mask can reach the k-th best
            group, size = [], 0
            while done < len(turn) and size < 2 * k and bound[turn[done]] >= floor:
                g = turn[done]
                group.append(order[cut_[g]:ends[g]])
                size += len(group[-1])
                done += 1
            some = docs[np.concatenate(group)]
            s = self.exact(some, slot)
            keep = s >= max(floor, 1)
            scores, ids, valid = best_of(np.r_[scores, s[keep]], np.r_[ids, self.doc_ids[some[keep]]],
                                         np.r_[valid, self.valid[some[keep]]], k)
        return (scores, ids, valid), done


def best_of(scores, ids, valid, k: int):
    import numpy as np
    key, null = _rank_key(ids, valid)
    top = np.lexsort((key, null, -scores))[:k]
    return scores[top], ids[top], valid[top]


def _search_kernel(items: list, weights, total_docs: int, total_terms: int, k: int):
    """Postings -> every item's best ``k`` in the partition."""
    def kernel(batches):
        import numpy as np
        import pyarrow as pa
        w = np.asarray(weights, np.int64)
        asked = [np.asarray(t, np.int64) for _, t in items]
        nothing = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
        held = [nothing] * len(items)
        rows = int(max(64, min(BLOCK_DOCS, BLOCK_BITS // max(1, len(w)))))

        def run(parts):
            nonlocal held
            t = pa.Table.from_batches(parts).combine_chunks()
            lists, counts = (t.column(c).chunk(0) for c in ("t", "tf"))
            ids, n = t.column("doc_id"), t.column("n").to_numpy().astype(np.int64)
            block = Block(ids.fill_null(0).to_numpy().astype(np.int64), ids.is_valid().to_numpy(), n,
                          np.r_[0, np.cumsum(np.asarray(lists.value_lengths(), np.int64))],
                          lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                          counts.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                          w, total_docs, total_terms)
            held = [block.search(a, k, h)[0] for a, h in zip(asked, held)]

        parts, size = [], 0
        for b in batches:
            for at in range(0, b.num_rows, rows):
                piece = b.slice(at, min(rows, b.num_rows - at))
                if size + piece.num_rows > rows:
                    run(parts)
                    parts, size = [], 0
                parts.append(piece)
                size += piece.num_rows
        if size:
            run(parts)
        for (item, _), (scores, ids, valid) in zip(items, held):
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(scores), pa.int64()), pa.array(ids, pa.int64(), mask=~valid),
                     pa.array(scores, pa.int64())], names=["item_id", "doc_id", "score"])
    return kernel


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item, of score above 0.

    ``items`` (item_id, text) are the queries: rows of one item_id are one item
    with the terms of all of them, null texts have no terms, a null item_id is an
    item. They are taken to the tasks in blocks of about ``query_bytes`` of text;
    each block reads the documents once. Every row of ``docs`` is a document of its
    own, repeated rows too; a null doc_id comes last among equal scores. No terms,
    no match or an empty table: no rows.

    A document's postings are written once to the shared folder; document
    frequencies are sums over them, and each partition keeps the best of each
    item, so what is shuffled is ``k`` rows per item and partition.
    """
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text"))
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // query_bytes))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    terms = asked.select("item_id", block.alias("b"), F.explode(terms_of(F.col("text"))).alias("term")).distinct()
    if blocks > 1:
        terms = cut(terms)
    found, totals = None, None
    for b in range(blocks):
        # bounded: a block holds about query_bytes of text
        rows = terms.filter(F.col("b") == b).groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("t"))
        rows = sorted(((r.item_id, r.t) for r in rows.collect()), key=lambda r: (r[0] is None, r[0] or 0))
        vocabulary = {t.encode(): i for i, t in enumerate(sorted({t for _, ts in rows for t in ts}))}
        index = cut(postings(docs, vocabulary))
        if totals is None:
            r = index.agg(F.count(F.lit(1)).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
            totals = r["N"], r["L"]
        df = dict(index.select(F.explode("t").alias("t")).groupBy("t").count().collect())
        weights = [weight(totals[0], df.get(i, 0)) for i in range(len(vocabulary))]
        asks = [(item, [vocabulary[t.encode()] for t in ts if vocabulary[t.encode()] in df]) for item, ts in rows]
        kernel = _search_kernel([a for a in asks if a[1]], weights, *totals, k)
        part = index.mapInArrow(tidy(kernel), "item_id long, doc_id long, score long")
        found = part if found is None else found.unionByName(part)
    w = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
