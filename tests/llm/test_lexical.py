"""Lexical search against a plain scan of all documents."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordwise.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, c) for d, c in bags if c]
    n_docs, n_terms = len(bags), sum(sum(c.values()) for _, c in bags)
    df = Counter(t for _, c in bags for t in c)
    out = []
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    for item, ts in asked.items():
        scored = []
        for d, c in bags:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in ts if c[t])
            if s > 0:
                scored.append((-s, d is None, d or 0))
        for rank, (s, none, d) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if none else d, -s))
    return out


def rows_of(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


@pytest.mark.parametrize("text", ["", "Ab-cD 12é_ÀB\x00x\ty", "日本 ÀÉ A.b", "A" * 5, " a\u0085b", "{x}~y\x7fz"])
def test_terms(spark, text):
    by_sql = spark.createDataFrame([(text,)], "t string").select(lexical.terms_of(F.col("t"))).first()[0]
    assert by_sql == terms(text) == [w.decode() for w in text.encode().translate(lexical.term_table()).split()]


def _corpus(rng, n, words):
    pool = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    return [(i, " ".join(rng.choices(pool, weights, k=rng.randint(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("k,query_bytes", [(3, 1 << 20), (50, 1 << 20), (7, 60)])
def test_equals_plain_scan(spark, monkeypatch, k, query_bytes):
    rng = random.Random(k)
    docs = _corpus(rng, 700, 120)
    docs += [(1000 + i, docs[5][1]) for i in range(90)] + [(7, docs[7][1]), (None, docs[5][1]), (None, None), (2000, None)]
    items = [(i, " ".join(rng.choices([f"W{j}" for j in range(130)], k=rng.randint(1, 90)))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "unknown words"), (None, "w1 w2"), (3, "w7 extra"), (3, "w7 extra")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({"term": F.lit("x"), "b": F.lit(1)})
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 64)
    got = lexical.ranked_search(frame.withColumns({"n": F.lit(1), "t": F.lit("t"), "tf": F.lit(2)}), asked, k, query_bytes)
    assert rows_of(got) == sorted(brute(docs, items, k), key=repr)


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "word1 other7 one 日本 password"), (2, "x")], "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = brute(docs, [(r.item_id, r.text) for r in items.collect()], 50)
    assert rows_of(lexical.ranked_search(odd_docs, items)) == sorted(want, key=repr)
    assert rows_of(lexical.ranked_search(no_docs, items)) == []
    assert rows_of(lexical.ranked_search(odd_docs, items.limit(0))) == []


def _block(bags, weights):
    n = np.array([sum(b.values()) for b in bags], np.int64)
    t = [sorted(b) for b in bags]
    off = np.r_[0, np.cumsum([len(x) for x in t])].astype(np.int64)
    return lexical.Block(np.arange(len(bags)), np.ones(len(bags), bool), n, off,
                         np.array([x for y in t for x in y], np.int64),
                         np.array([b[x] for b in bags for x in sorted(b)], np.int64), weights, len(bags), int(n.sum()))


def test_masks_beyond_the_best_are_not_evaluated():
    """Rare terms first: masks of common terms alone cannot reach the best and are left."""
    bags = [Counter({0: 1, 1 + i % 40: 1, 41 + i % 7: 2}) for i in range(2000)]
    bags[17] = Counter({t: 3 for t in range(48)})
    weights = np.array([1] * 48, np.int64)
    block = _block(bags, weights)
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
    (scores, ids, _), evaluated = block.search(np.arange(48), 1, none)
    assert ids[0] == 17
    docs, words = block.masks(np.arange(48))
    assert evaluated < len(np.unique(words, axis=0)) / 10


@settings(max_examples=60, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 149), st.integers(1, 5), min_size=1, max_size=20), min_size=1, max_size=40),
       st.sets(st.integers(0, 149), min_size=1, max_size=150), st.integers(1, 6))
def test_block_search_is_exact(bags, asked, k):
    """Masks of any width; ties to the smaller id."""
    weights = np.arange(1, 151, dtype=np.int64) % 7
    block = _block([Counter(b) for b in bags], weights)
    slot = np.isin(np.arange(150), list(asked)).astype(np.int64)
    all_scores = block.exact(np.arange(len(bags)), slot)
    want = sorted(((-s, i) for i, s in enumerate(all_scores.tolist()) if s > 0))[:k]
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
    (scores, ids, _), _ = block.search(np.array(sorted(asked)), k, none)
    assert [(-s, i) for s, i in zip(scores.tolist(), ids.tolist())] == want
