"""Token counts by a linear longest-match automaton.

Words (runs of other than ASCII white space, each led by one space) are cut
greedily into the longest vocabulary pieces. The vocabulary is a trie with
failure links: the link of a node leads to the node of what is left after the
pieces that must be cut off have been popped, and the number of those pieces is
kept with it. Links are resolved for every byte beforehand, so a text costs one
table look-up per byte and no piece is ever built.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordwise.llm.common import small_batches, text_of, tidy

SPACE = 32


def load_pieces(path: str) -> list[bytes]:
    """Pieces of a rank file (base64 piece, rank), those with inner white space left out."""
    with open(path, "rb") as f:
        pieces = [base64.b64decode(line.split()[0]) for line in f if line.strip()]
    return [p for p in pieces if len(p[1:].split()) <= 1 and p[1:] == p[1:].strip() and (p == b" " or p.strip())]


class Automaton:
    """step[node, byte], popped[node, byte] and at_end[node] over all pieces.

    Every single byte is a piece (added where the vocabulary lacks it), so a
    word is always fully cut.
    """

    def __init__(self, pieces):
        children, final, depth_of, parent, label = [{}], [False], [0], [0], [0]
        for p in {*pieces, *(bytes([b]) for b in range(256))}:
            at = 0
            for c in p:
                to = children[at].get(c)
                if to is None:
                    to = len(children)
                    children[at][c] = to
                    children.append({}), final.append(False)
                    depth_of.append(depth_of[at] + 1), parent.append(at), label.append(c)
                at = to
            final[at] = True
        n = len(children)
        depth, par, lab, fin = (np.array(x) for x in (depth_of, parent, label, final))
        self.step = np.zeros((n, 256), np.int32)
        self.popped = np.zeros((n, 256), np.uint16)
        fail, pops = np.zeros(n, np.int32), np.ones(n, np.int64)
        self.at_end = np.zeros(n, np.int32)
        self.step[par[1:], lab[1:]] = np.arange(1, n)
        for d in range(1, int(depth.max()) + 1):
            v = np.flatnonzero(depth == d)
            inner = v[~fin[v]]           # no piece ends here: go on from the parent's link
            u, c = par[inner], lab[inner]
            fail[inner] = self.step[fail[u], c]
            pops[inner] = pops[u] + self.popped[fail[u], c]
            own = self.step[v] > 0       # children are set, all other bytes follow the link
            self.step[v] = np.where(own, self.step[v], self.step[fail[v]])
            self.popped[v] = np.where(own, 0, pops[v][:, None] + self.popped[fail[v]])
            self.at_end[v] = pops[v] + self.at_end[fail[v]]
        self.start = int(self.step[0, SPACE])

    def count(self, raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Pieces of every word raw[start:start+length]; all words advance byte by byte together."""
        order = np.argsort(-length, kind="stable")
        begin, lengths = start[order], length[order]
        state = np.full(len(order), self.start, np.int64)
        total = np.zeros(len(order), np.int64)
        step, popped = self.step.reshape(-1), self.popped.reshape(-1)
        alive = np.searchsorted(-lengths, -np.arange(int(lengths[0]) if len(lengths) else 0), side="left")
        for k, n in enumerate(alive.tolist()):
            at = state[:n] * 256 + raw[begin[:n] + k]
            total[:n] += popped[at]
            state[:n] = step[at]
        total += self.at_end[state]
        out = np.empty(len(order), np.int64)
        out[order] = total
        return out


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    return Automaton(load_pieces(path))


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_words, n_tokens for every row of ``docs``; ``path`` is the vocabulary file.

    The file must be at ``path`` on every executor. Null and empty texts have no
    words and no tokens; a null doc_id and repeated rows are kept; words of any
    length are counted whole.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("__text"))

    def kernel(batches):
        import pyarrow as pa

        from ordwise.llm.common import string_buffers
        from ordwise.llm.quality import word_runs

        made = automaton(path)
        for b in small_batches(batches, "__text"):
            raw, off = string_buffers(b.column("__text"))
            start, end, doc = word_runs(raw, off)
            pieces = made.count(raw, start, end - start)
            n_words = np.bincount(doc, minlength=b.num_rows)
            n_tokens = np.bincount(doc, pieces, minlength=b.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n_words.astype(np.int64)), pa.array(n_tokens)],
                names=["doc_id", "n_words", "n_tokens"])

    return src.mapInArrow(tidy(kernel), "doc_id long, n_words long, n_tokens long")
