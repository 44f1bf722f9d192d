"""Quality rules: gradient-boosted trees over document statistics.

The statistics of every document come from one pass over Arrow batches; the
trees are fitted on a bounded sample of labelled rows, flattened into numpy node
arrays and scored for a whole batch at a time. On chosen features the trees are
monotone: more symbols, repeats or duplicate lines can never lower the
probability of low quality.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordwise.llm.common import small_batches, string_buffers, text_of, text_source, tidy

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Bound of the labelled rows the trees are fitted on: those with the smallest hash of doc_id.
MAX_LABELLED = 20_000
#: Documents whose probability of low quality is above this are rejected.
THRESHOLD = 0.5

#: name -> direction in which the probability of low quality may move (0: free).
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbol_rate": 1, "dup_line_rate": 1, "repeat_rate": 1,
    "upper_rate": 1, "digit_rate": 1, "punct_rate": 0, "line_words": 0, "distinct_rate": -1,
    "top_rate": 1,
}
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

_UPPER, _DIGIT, _PUNCT, _SYMBOL, _SPACE, _CONT = 1, 2, 4, 8, 16, 32


def _byte_classes() -> np.ndarray:
    t = np.zeros(256, np.uint8)
    t[65:91] |= _UPPER
    t[48:58] |= _DIGIT
    for c in b"!?.,;:'\"()[]{}-_/\\@^~`+=":
        t[c] |= _PUNCT
    for c in SYMBOLS.encode():
        t[c] |= _SYMBOL
    t[32] |= _SPACE
    t[9:14] |= _SPACE
    t[128:192] |= _CONT
    return t


_CLASSES = _byte_classes()


def _runs(raw: np.ndarray, off: np.ndarray, cls: np.ndarray):
    """Start and end of every word (run of other than ASCII white space) and its document."""
    inside = (cls & _SPACE) == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = off[:-1][off[:-1] < off[1:]]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = off[1:][off[:-1] < off[1:]] - 1
    last[tails] = inside[tails]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(off, start, side="right") - 1


def word_runs(raw: np.ndarray, off: np.ndarray):
    """Start, end and document of every word of the concatenated texts."""
    return _runs(raw, off, _CLASSES[raw])


def word_array(raw: np.ndarray, off: np.ndarray):
    """The words of the concatenated texts as an Arrow binary array, and their documents."""
    import pyarrow as pa

    cls = _CLASSES[raw]
    start, end, doc = _runs(raw, off, cls)
    bounds = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=bounds[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(start), [
        None, pa.py_buffer(bounds), pa.py_buffer(raw[(cls & _SPACE) == 0])]), doc


def _per_doc(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How many flags are set in every document."""
    out = np.zeros(len(off) - 1, np.int64)
    live = np.flatnonzero(off[:-1] < off[1:])
    if len(live):
        out[live] = np.add.reduceat(flags, off[:-1][live], dtype=np.int64)
    return out


def _codes(values) -> np.ndarray:
    import pandas as pd
    return pd.factorize(values)[0].astype(np.int64)


def statistics(texts) -> dict[str, np.ndarray]:
    """Base counts and features of an Arrow string array without nulls, whole texts."""
    import pyarrow as pa

    raw, off = string_buffers(texts)
    n = len(off) - 1
    cls = _CLASSES[raw]
    words, doc = word_array(raw, off)
    n_words = np.bincount(doc, minlength=n)
    not_cont = (cls & _CONT) == 0
    out = {
        "n_words": n_words,
        "word_chars": _per_doc(not_cont & ((cls & _SPACE) == 0), off),
        "n_symbols": _per_doc((cls & _SYMBOL) > 0, off),
    }

    # words as codes, by Arrow's hash table
    code = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = int(code.max()) + 1 if len(code) else 1

    # three-word windows inside one document; a word counts if any of its windows occurs twice
    repeat = np.zeros(len(code), bool)
    if len(code) > 2:
        whole = doc[2:] == doc[:-2]
        at = np.flatnonzero(whole)
        pair = _codes(code[at] * size + code[at + 1])
        window = _codes(pair * size + code[at + 2])
        key = _codes(window * n + doc[at])
        again = np.bincount(key)[key] > 1 if len(key) else np.zeros(0, bool)
        for k in range(3):
            repeat[at[again] + k] = True
    out["n_repeat_words"] = np.bincount(doc[repeat], minlength=n)

    dup = np.zeros(n, np.int64)
    n_lines = np.ones(n, np.int64)
    nl = np.flatnonzero(raw == 10)
    nl_doc = np.searchsorted(off, nl, side="right") - 1
    n_lines += np.bincount(nl_doc, minlength=n)
    if len(nl):
        # every line of every document, the part after the last break included
        cuts = np.sort(np.concatenate([off[:-1], nl + 1]), kind="stable")
        stops = np.sort(np.concatenate([off[1:], nl]), kind="stable")
        line_doc = np.sort(np.concatenate([np.arange(n), nl_doc]), kind="stable")
        word_at = np.zeros(len(raw) + 1, np.int32)
        np.cumsum((cls & _SPACE) == 0, dtype=np.int32, out=word_at[1:])
        has = word_at[stops] > word_at[cuts]
        cuts, stops, line_doc = cuts[has], stops[has], line_doc[has]
        view = memoryview(raw)
        lines = [bytes(view[a:b]) for a, b in zip(cuts.tolist(), stops.tolist())]
        if lines:
            line_code = pa.array(lines, pa.large_binary()).dictionary_encode().indices.to_numpy(
                zero_copy_only=False).astype(np.int64)
            seen = np.unique(line_code * n + line_doc)
            dup = np.bincount(line_doc, minlength=n) - np.bincount(seen % n, minlength=n)
    out["n_dup_lines"] = dup

    chars = np.maximum(_per_doc(not_cont, off), 1)
    per_word = np.maximum(n_words, 1)
    seen = _codes(code * n + doc) if len(code) else np.zeros(0, np.int64)
    counts = np.bincount(seen) if len(seen) else np.zeros(0, np.int64)
    owner = np.zeros(len(counts), np.int64)
    owner[seen] = doc
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner, counts)
    f = {
        "log_words": np.log1p(n_words), "mean_word": out["word_chars"] / per_word,
        "symbol_rate": out["n_symbols"] / chars, "dup_line_rate": out["n_dup_lines"] / n_lines,
        "repeat_rate": out["n_repeat_words"] / per_word,
        "upper_rate": _per_doc((cls & _UPPER) > 0, off) / chars,
        "digit_rate": _per_doc((cls & _DIGIT) > 0, off) / chars,
        "punct_rate": _per_doc((cls & _PUNCT) > 0, off) / chars,
        "line_words": np.log1p(n_words / n_lines),
        "distinct_rate": np.bincount(owner, minlength=n) / per_word, "top_rate": top / per_word,
    }
    out["x"] = np.stack([f[k] for k in FEATURES], axis=1) if n else np.zeros((0, len(FEATURES)))
    return out


# --- trees ---------------------------------------------------------------------------------

@dataclass
class Trees:
    """All trees in one set of node arrays; a leaf points at itself on both sides."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Probability of low quality; every tree advances all rows one level at a time."""
        score = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
            score += self.value[at]
        return 1 / (1 + np.exp(-score))


def fit_trees(x: np.ndarray, y: np.ndarray, directions=None, n_trees: int = 40, depth: int = 3,
              rate: float = 0.2, bins: int = 48, reg: float = 2.0, min_weight: float = 2.0) -> Trees:
    """Logistic boosting on histograms. ``directions`` holds -1, 0 or 1 per feature.

    A split that would break a direction is refused, and both children inherit
    value bounds from the midpoint, so the whole function is monotone. Without
    rows, or with one class only, the trees are empty and the bias decides.
    """
    directions = np.asarray(list(FEATURES.values()) if directions is None else directions)
    n, d = x.shape if x.ndim == 2 else (0, len(directions))
    p = (y.sum() + 0.5) / (n + 1) if n else 0.0
    empty = n == 0 or y.min() == y.max()
    bias = -20.0 if n == 0 else float(np.log(p / (1 - p)))
    feature, cut_at, left, right, value, roots = [], [], [], [], [], []

    def leaf(v):
        i = len(feature)
        feature.append(0), cut_at.append(0.0), left.append(i), right.append(i), value.append(v)
        return i

    if not empty:
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
        binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(d)], axis=1)
        score = np.full(n, bias)
    for _ in range(0 if empty else n_trees):
        q = 1 / (1 + np.exp(-score))
        g, h = q - y, np.maximum(q * (1 - q), 1e-6)

        def best_value(rows, lo, hi):
            return float(np.clip(-g[rows].sum() / (h[rows].sum() + reg), lo, hi))

        def grow(rows, level, lo, hi):
            if level < depth and h[rows].sum() >= 2 * min_weight:
                best = None
                gt, ht = g[rows].sum(), h[rows].sum()
                for j in range(d):
                    k = len(edges[j])
                    if not k:
                        continue
                    gl = np.cumsum(np.bincount(binned[rows, j], g[rows], k + 1))[:-1]
                    hl = np.cumsum(np.bincount(binned[rows, j], h[rows], k + 1))[:-1]
                    gr, hr = gt - gl, ht - hl
                    vl, vr = np.clip(-gl / (hl + reg), lo, hi), np.clip(-gr / (hr + reg), lo, hi)
                    gain = -(gl * vl + 0.5 * (hl + reg) * vl ** 2 + gr * vr + 0.5 * (hr + reg) * vr ** 2)
                    good = (hl >= min_weight) & (hr >= min_weight) & (directions[j] * (vr - vl) >= 0)
                    if good.any():
                        b = int(np.argmax(np.where(good, gain, -np.inf)))
                        if best is None or gain[b] > best[0] + 1e-12:
                            best = (gain[b], j, b, vl[b], vr[b])
                v = best_value(rows, lo, hi)
                if best and best[0] > -(gt * v + 0.5 * (ht + reg) * v ** 2) + 1e-6:
                    _, j, b, vl, vr = best
                    i = leaf(0.0)
                    mid = (vl + vr) / 2
                    go = binned[rows, j] <= b
                    lows, highs = {1: ((lo, mid), (mid, hi)), -1: ((mid, hi), (lo, mid))}.get(
                        int(directions[j]), ((lo, hi), (lo, hi)))
                    feature[i], cut_at[i] = j, float(edges[j][b])
                    left[i] = grow(rows[go], level + 1, *lows)
                    right[i] = grow(rows[~go], level + 1, *highs)
                    return i
            return leaf(rate * best_value(rows, lo, hi))

        roots.append(grow(np.arange(n), 0, -4.0, 4.0))
        made = Trees(*map(np.array, (feature, cut_at, left, right, value)), np.array(roots[-1:]), depth, 0.0)
        p1 = made.probability(x)
        score += np.log(p1 / (1 - p1))
    ints = [np.array(v, np.int64) for v in (feature, left, right)]
    return Trees(ints[0], np.array(cut_at, float), ints[1], ints[2], np.array(value, float),
                 np.array(roots, np.int64), depth, bias)


# --- operator ------------------------------------------------------------------------------


def _base_failed(n_words, n_repeat):
    return (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)


def labelled_sample(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED):
    """(x, y) of at most ``max_labelled`` labelled documents; y is 1 for low quality.

    The documents with the smallest hash of doc_id are taken; a doc_id with
    several labels uses the lowest quality, repeated documents count once.
    """
    spark = docs.sparkSession
    chosen = (labels.filter("doc_id is not null and quality is not null")
              .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled).collect())
    if not chosen:
        return np.zeros((0, len(FEATURES))), np.zeros(0)
    quality = {r["doc_id"]: r["quality"] for r in chosen}
    ids = spark.createDataFrame([(i,) for i in quality], "doc_id long")   # at most max_labelled longs
    src = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
           .join(F.broadcast(ids), "doc_id"))
    names = list(FEATURES)

    def kernel(batches):
        import pyarrow as pa
        for b in small_batches(batches, "text"):
            x = statistics(b.column("text"))["x"]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(x[:, j]) for j in range(len(names))]], names=["doc_id", *names])

    rows = (src.mapInArrow(tidy(kernel), "doc_id long, " + ", ".join(f"{c} double" for c in names))
            .groupBy("doc_id").agg(*[F.max(c).alias(c) for c in names]).orderBy("doc_id").collect())
    x = np.array([[r[c] for c in names] for r in rows]).reshape(len(rows), len(names))
    return x, np.array([1.0 - min(1, max(0, quality[r["doc_id"]])) for r in rows])


def fit_quality(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Trees:
    return fit_trees(*labelled_sample(docs, labels, max_labelled))


def score_quality(docs: DataFrame, trees: Trees, threshold: float = THRESHOLD,
                  carry: bool = False) -> DataFrame:
    """doc_id, the base counts, p_low, base_failed, kept for every row of ``docs``.

    With ``carry`` the result also has the whole input row in the struct ``row``.
    A null text counts as empty (no words, so it fails the base rule); a null
    doc_id and repeated rows are scored like any other; an empty table gives no
    rows. p_low is the trees' probability of low quality.
    """
    src, text = text_source(docs, carry)
    schema = src.drop("__text").schema
    for c in BASE:
        schema = schema.add(c, "long")
    schema = schema.add("p_low", "double").add("base_failed", "boolean").add("kept", "boolean")
    names = [f.name for f in schema.fields]

    def kernel(batches):
        import pyarrow as pa
        for b in small_batches(batches, text):
            s = statistics(text(b))
            p = trees.probability(s["x"])
            failed = _base_failed(s["n_words"], s["n_repeat_words"])
            own = [b.column(c) for c in names[:len(names) - len(BASE) - 3]]
            yield pa.RecordBatch.from_arrays(
                [*own, *[pa.array(s[c].astype(np.int64)) for c in BASE], pa.array(p), pa.array(failed),
                 pa.array(~failed & (p <= threshold))], names=names)

    return src.mapInArrow(tidy(kernel), schema)


def quality_rules(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED,
                  threshold: float = THRESHOLD) -> DataFrame:
    return score_quality(docs, fit_quality(docs, labels, max_labelled), threshold)


def keep_quality(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED,
                 threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the trees, all columns unchanged."""
    scored = score_quality(docs, fit_quality(docs, labels, max_labelled), threshold, carry=True)
    return scored.filter("kept").select("row.*")
