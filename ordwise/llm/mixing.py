"""Mixing documents to target weights with soft membership of domains.

A classifier fitted on a labelled table gives every document a posterior over
domains. The expected tokens of a domain are the sum over documents of rate x
tokens x posterior; non-negative rates are fitted so that these totals meet
their targets, by projected-gradient least squares over the whole table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordwise.llm.common import cut, small_batches, string_buffers, text_of, text_source, tidy
from ordwise.session import scratch_path

#: Bound of the labelled rows the classifier is fitted on: those with the smallest hash of doc_id.
MAX_LABELLED = 8_000
BUCKETS = 1 << 16
#: A word is used if it is this many standard deviations off between a domain and the rest.
MIN_Z = 4.0
MIN_DOCS = 5
MAX_STEPS = 40
TOLERANCE = 1e-4
SEED = 11

RATES = ["upper", "symbol", "bare", "again", "short", "digit"]


def _words(texts):
    """(code of every word, document of every word, distinct words as bytes, n)."""
    from ordwise.llm.quality import word_array
    raw, off = string_buffers(texts)
    words, doc = word_array(raw, off)
    coded = words.dictionary_encode()
    view, at = string_buffers(coded.dictionary)
    view, at = view.tobytes(), at.tolist()
    distinct = [view[i:j] for i, j in zip(at, at[1:])]
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), doc, distinct, len(off) - 1


_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
#: Marks a word of prose does not end with.
_SYMBOLS = [bytes([c]) for c in _MARKS if chr(c) not in ".,!?:;)]}\"'-"]


def bucket_of(word: bytes) -> int:
    """Hash bucket of a word without the marks around it, A-Z in lower case."""
    import zlib
    return zlib.crc32(word.strip(_MARKS).lower()) % BUCKETS


def _rates(code, doc, distinct, n) -> np.ndarray:
    """Shares of word shapes per document, and log(1 + words)."""
    flags = np.array([[w.isupper(), w[-1:] in _SYMBOLS, not w.strip(_MARKS), len(w) < 3, w[:1].isdigit()]
                      for w in distinct], float).reshape(len(distinct), 5)
    words = np.bincount(doc, minlength=n)
    per = np.maximum(words, 1)
    again = np.zeros(len(code))
    again[1:] = (code[1:] == code[:-1]) & (doc[1:] == doc[:-1])
    cols = [np.bincount(doc, flags[code, j], n) / per for j in range(3)]
    cols.append(np.bincount(doc, again, n) / per)
    cols += [np.bincount(doc, flags[code, j], n) / per for j in (3, 4)]
    return np.stack([*cols, np.log1p(words) / 10], axis=1)


@dataclass
class Domains:
    """names; weights[bucket, domain] of chosen words; softmax layer over scores and rates."""
    names: list
    weights: np.ndarray
    chosen: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layer: np.ndarray

    def posterior(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(words per text, posterior matrix) of an Arrow string array without nulls."""
        code, doc, distinct, n = _words(texts)
        words = np.bincount(doc, minlength=n)
        if len(self.names) == 1:
            return words, np.ones((n, 1))
        bucket = np.fromiter(map(bucket_of, distinct), np.int64, len(distinct))
        score = np.zeros((n, len(self.names)))
        hit = np.flatnonzero(self.chosen[bucket][code]) if len(code) else np.zeros(0, np.int64)
        if len(hit):
            seen = np.unique(doc[hit] * BUCKETS + bucket[code[hit]])
            for k in range(len(self.names)):
                score[:, k] = np.bincount(seen // BUCKETS, self.weights[seen % BUCKETS, k], n)
        return words, _softmax(self._inputs(np.hstack([score, _rates(code, doc, distinct, n)])) @ self.layer)

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.clip((x - self.mean) / self.scale, -8, 8), np.ones((len(x), 1))])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True, initial=0))
    return e / e.sum(axis=1, keepdims=True)


def _word_weights(docs, buckets, y, k_all) -> np.ndarray:
    """Log odds of a word's presence per domain, zero where the difference is not sure."""
    n = len(y)
    w = np.zeros((BUCKETS, k_all))
    total = np.bincount(buckets, minlength=BUCKETS)
    for k in range(k_all):
        own, size = np.bincount(buckets[y[docs] == k], minlength=BUCKETS), max((y == k).sum(), 1)
        rest = max(n - size, 1)
        p, q, both = own / size, (total - own) / rest, total / n
        z = np.abs(p - q) / np.sqrt(np.maximum(both * (1 - both) * (1 / size + 1 / rest), 1e-12))
        sure = (z >= MIN_Z) & (total >= MIN_DOCS)
        w[sure, k] = (np.log((own + 0.5) / (size + 1)) - np.log((total - own + 0.5) / (rest + 1)))[sure]
    return w


def fit_domains(presence, rates: np.ndarray, y: np.ndarray, names: list) -> Domains:
    """``presence``: (document, bucket) pairs, each once. Word scores for the softmax layer come
    from the other half of the sample, so the layer learns how far to trust them."""
    k, n = len(names), len(y)
    if k < 2 or n == 0:
        names = names or ["all"]
        return Domains(names[:1], np.zeros((BUCKETS, 1)), np.zeros(BUCKETS, bool), np.zeros(1), np.ones(1),
                       np.zeros((1, 1)))
    docs, buckets = presence
    half = np.arange(n) % 2
    score = np.zeros((n, k))
    for side in (0, 1):
        own = half[docs] == side
        kept = np.flatnonzero(half == side)
        place = np.zeros(n, np.int64)
        place[kept] = np.arange(len(kept))
        w = _word_weights(place[docs[own]], buckets[own], y[kept], k)
        for j in range(k):
            score[:, j] += np.bincount(docs[~own], w[buckets[~own], j], n)
    x = np.hstack([score, rates])
    weights = _word_weights(docs, buckets, y, k)
    made = Domains(names, weights, np.abs(weights).sum(axis=1) > 0, x.mean(axis=0),
                   np.maximum(x.std(axis=0), 1e-3), np.zeros((x.shape[1] + 1, k)))
    inputs, goal = made._inputs(x), np.eye(k)[y]
    step = 4.0 / max(np.linalg.norm(inputs, 2) ** 2 / n, 1e-9)
    ahead, before = made.layer, made.layer
    for i in range(400):     # accelerated gradient with a small ridge
        grad = inputs.T @ (_softmax(inputs @ ahead) - goal) / n + 1e-4 * ahead
        now = ahead - step / 2 * grad
        ahead, before = now + i / (i + 3) * (now - before), now
    made.layer = before
    return made


def labelled_sample(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Domains:
    """Classifier from ``labels`` (doc_id, domain), at most ``max_labelled`` of them.

    A doc_id with several labels takes the first in order; null ids and domains
    are left out; repeated documents count once.
    """
    spark = docs.sparkSession
    chosen = (labels.filter("doc_id is not null and domain is not null")
              .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(F.min(F.col("domain").cast("string")).alias("domain"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled).collect())
    if not chosen:
        return fit_domains(None, None, np.zeros(0, np.int64), [])
    ids = spark.createDataFrame([(r["doc_id"],) for r in chosen], "doc_id long")  # at most max_labelled
    src = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("__text"))
           .join(F.broadcast(ids), "doc_id"))

    def kernel(batches):
        import pyarrow as pa
        for b in small_batches(batches, "__text"):
            code, doc, distinct, n = _words(b.column("__text"))
            bucket = np.fromiter(map(bucket_of, distinct), np.int64, len(distinct))
            seen = np.unique(doc * BUCKETS + bucket[code]) if len(code) else np.zeros(0, np.int64)
            parts = np.split((seen % BUCKETS).astype("<u2"), np.searchsorted(seen // BUCKETS, np.arange(1, n)))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([p.tobytes() for p in parts], pa.binary()),
                 pa.array(list(_rates(code, doc, distinct, n)), pa.list_(pa.float64()))],
                names=["doc_id", "buckets", "rates"])

    rows = (src.mapInArrow(tidy(kernel), "doc_id long, buckets binary, rates array<double>")
            .groupBy("doc_id").agg(F.max(F.struct("buckets", "rates")).alias("x")).orderBy("doc_id").collect())
    label = {r["doc_id"]: r["domain"] for r in chosen}
    names = sorted({label[r["doc_id"]] for r in rows})
    if len(names) < 2:
        return fit_domains(None, None, np.zeros(0, np.int64), names)
    parts = [np.frombuffer(r["x"]["buckets"], "<u2") for r in rows]
    presence = (np.repeat(np.arange(len(rows)), [len(p) for p in parts]), np.concatenate(parts).astype(np.int64))
    return fit_domains(presence, np.array([r["x"]["rates"] for r in rows]),
                       np.array([names.index(label[r["doc_id"]]) for r in rows]), names)


def posteriors(docs: DataFrame, model: Domains, carry: bool = False, vocabulary: str | None = None) -> DataFrame:
    """doc_id, draw, n_tokens and p (array of posteriors) per row, ``row`` too with ``carry``.

    ``n_tokens`` are the word pieces of the text under ``vocabulary`` (see ``tokencount``),
    its words without one. ``draw`` in [0, 1) follows from doc_id, text and the row's
    position, so repeated rows and rows without an id have draws of their own.
    """
    src, text = text_source(docs, carry)
    place = F.monotonically_increasing_id()
    body = F.col("row.text") if carry else F.col("__text")
    draw = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", body, place), F.lit(1 << 30)) / F.lit(float(1 << 30))
    src = src.withColumn("draw", draw)
    schema = src.drop("__text").schema.add("n_tokens", "long").add("p", T.ArrayType(T.DoubleType()))
    names = [f.name for f in schema.fields]

    def kernel(batches):
        import pyarrow as pa

        from ordwise.llm.quality import word_runs
        from ordwise.llm.tokencount import automaton
        for b in small_batches(batches, text):
            texts = text(b)
            tokens, p = model.posterior(texts)
            if vocabulary:
                raw, off = string_buffers(texts)
                start, end, doc = word_runs(raw, off)
                tokens = np.bincount(doc, automaton(vocabulary).count(raw, start, end - start), minlength=len(p))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * p.shape[1], pa.int32()),
                                            pa.array(p.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names[:-2]],
                                              pa.array(tokens.astype(np.int64)), flat], names=names)

    return src.mapInArrow(tidy(kernel), schema)


# --- rates -----------------------------------------------------------------------------------

def _dot(p: str, s) -> str:
    return " + ".join(f"element_at({p}, {i + 1}) * {float(x)!r}D" for i, x in enumerate(s))


def rate_after(steps: list, base: str = "1.0D") -> Column:
    """The rate of a row after projected-gradient steps: r <- max(0, r - p . s), from 1."""
    r = base
    for s in steps:
        r = f"greatest(0.0D, {r} - ({_dot('p', s)}))"
    return F.expr(r)


@dataclass
class Fit:
    steps: list           # one vector per step; the rates of all documents follow from them
    expected: np.ndarray  # expected tokens per domain at the fitted rates
    target: np.ndarray
    names: list

    @property
    def residual(self) -> np.ndarray:
        """What the domains' expected tokens lack or have too much."""
        return self.expected - self.target

    @property
    def met(self) -> bool:
        """Whether every target is met within ``TOLERANCE`` of all tokens."""
        return bool(np.abs(self.residual).max(initial=0) <= TOLERANCE * max(self.target.sum(), 1.0))


def fit_rates(scored: DataFrame, names: list, weights: dict, total: float | None = None,
              at_least: dict | None = None, max_steps: int = MAX_STEPS) -> Fit:
    """Projected-gradient least squares over ``scored`` (n_tokens, p).

    Targets are ``weights`` (by domain, scaled to sum 1; missing: 0) times
    ``total`` (default: all tokens). ``at_least`` raises the total until the given
    domains keep that multiple of their present tokens. Rates start at 1. Distances between rates
    count by tokens, and residuals by the inverse of the domains' token matrix:
    in these measures a step of 1 is the exact Lipschitz step, so the only
    thing to iterate for is the bound at 0. A step needs one sum per domain over
    all documents; only these sums come to the driver. Empty input: no steps.
    Targets that no rates meet, or that ``max_steps`` steps do not reach, are a
    warning that names them; ``Fit.residual`` has the difference.
    """
    k = len(names)
    w = np.array([max(0.0, float(weights.get(n, 0.0))) for n in names])
    if w.sum() <= 0:
        w = np.ones(k)
    pair = [(i, j) for i in range(k) for j in range(i, k)]
    scored = scored.select("n_tokens", "p")
    first = scored.agg(
        *[F.sum(F.expr(f"n_tokens * element_at(p, {i + 1})")).alias(f"c{i}") for i in range(k)],
        *[F.sum(F.expr(f"n_tokens * element_at(p, {i + 1}) * element_at(p, {j + 1})")).alias(f"g{i}_{j}")
          for i, j in pair]).first()
    have = np.array([first[f"c{i}"] or 0.0 for i in range(k)])
    w = w / w.sum()
    total = have.sum() if total is None else total
    for name, times in (at_least or {}).items():
        if name in names and w[names.index(name)] > 0:
            total = max(total, times * have[names.index(name)] / w[names.index(name)])
    target = w * total
    gram = np.zeros((k, k))
    for i, j in pair:
        gram[i, j] = gram[j, i] = first[f"g{i}_{j}"] or 0.0
    steps, expected = [], have
    if have.sum() <= 0:
        return Fit(steps, expected, target, names)
    inverse = np.linalg.pinv(gram + 1e-9 * np.trace(gram) * np.eye(k))
    state = scored.select("n_tokens", "p", F.lit(1.0).alias("r"))
    goal = TOLERANCE * target.sum()
    for i in range(max_steps):
        if np.abs(expected - target).max() <= goal:
            break
        steps.append(inverse @ (expected - target))
        state = state.select("n_tokens", "p", rate_after(steps[-1:], "r").alias("r"))
        if i % 6 == 5:
            state = cut(state)
        sums = state.agg(*[F.sum(F.expr(f"n_tokens * r * element_at(p, {j + 1})")).alias(f"c{j}")
                           for j in range(k)]).first()
        now = np.array([sums[f"c{j}"] or 0.0 for j in range(k)])
        still = np.abs(now - expected).max() <= goal * 1e-3
        expected = now
        if still:      # targets out of reach: the least-squares point
            break
    fit = Fit(steps, expected, target, names)
    if not fit.met:
        import warnings
        off = ", ".join(f"{n}: {x:+.0f}" for n, x in zip(names, fit.residual))
        warnings.warn(f"targets not met after {len(steps)} steps ({off} of {target.sum():.0f} tokens)", stacklevel=2)
    return fit


def copies(rate: Column, draw: Column | None = None) -> Column:
    """Whole copies of a row at a rate: its draw settles the fraction."""
    return F.floor(rate + (F.col("draw") if draw is None else draw)).cast("long")


def mix(docs: DataFrame, labels: DataFrame, weights: dict, total: float | None = None,
        max_labelled: int = MAX_LABELLED, vocabulary: str | None = None) -> tuple[DataFrame, Fit]:
    """(doc_id, n_tokens, p, rate, copies per row of ``docs``; the fit).

    Null text counts as empty (no tokens); a null doc_id and repeated rows are
    rated like any other; an empty table gives no rows. Rows of equal text get
    equal rates. ``vocabulary``: whose tokens are counted (none: words).
    """
    model = labelled_sample(docs, labels, max_labelled)
    scored = cut(posteriors(docs, model, vocabulary=vocabulary))
    fit = fit_rates(scored, model.names, weights, total)
    rate = rate_after(fit.steps)
    return scored.select("doc_id", "n_tokens", "p", rate.alias("rate"), copies(rate).alias("copies")), fit


def resample(docs: DataFrame, labels: DataFrame, weights: dict, total: float | None = None,
             at_least: dict | None = None, max_labelled: int = MAX_LABELLED,
             vocabulary: str | None = None) -> DataFrame:
    """``docs`` with every row as often as its fitted rate asks for; all columns unchanged.

    Texts are classified once: rows go to a scratch table with their posteriors, the fit
    reads two of its columns, and the rates, a short list of steps, are worked out
    beside the rows that are read back. No text is shuffled.
    """
    model = labelled_sample(docs, labels, max_labelled)
    spark = docs.sparkSession
    path = scratch_path(spark, "mixing")
    posteriors(docs, model, carry=True, vocabulary=vocabulary).write.parquet(path)
    scored = spark.read.parquet(path)
    fit = fit_rates(scored, model.names, weights, total, at_least)
    rated = scored.select("row", copies(rate_after(fit.steps)).alias("n"))
    return (rated.filter("n > 0").select("row", F.explode(F.expr("sequence(1L, n)")).alias("i")).select("row.*"))
