"""Document statistics against plain loops; trees against their promises."""
import collections
import re

import numpy as np
import pyarrow as pa

from ordwise.llm import quality as Q
from ordwise.llm.queries import op9_quality


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    c = collections.Counter(zip(w, w[1:], w[2:]))
    hit = {k for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(text.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit))


def test_query_equals_brute_force(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = op9_quality(spark, small).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = plain(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_statistics_of_odd_texts():
    texts = ["", " ", "\n\n", "a b c a b c", "x\nx\n x\nx", "é é é é", "\n a", "a \n", "a b c d", "# | a", "日本 日本",
             "a b c", "one", "l\n\nl\n \nl", "a b c a b", "w " * 3000]
    got = Q.statistics(pa.array(texts))
    for i, t in enumerate(texts):
        assert tuple(int(got[c][i]) for c in Q.BASE) == plain(t), t
    assert len(Q.statistics(pa.array([], pa.string()))["n_words"]) == 0


def test_trees_learn_and_are_monotone():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 3))
    y = ((x[:, 0] + 0.3 * x[:, 1] > 0.8) ^ (rng.random(3000) < 0.05)).astype(float)
    t = Q.fit_trees(x[:2000], y[:2000], [1, 1, 0])
    assert ((t.probability(x[2000:]) > 0.5) == (y[2000:] > 0.5)).mean() > 0.88
    at = rng.random((200, 3))
    for j in (0, 1):
        low, high = at.copy(), at.copy()
        high[:, j] += rng.random(200)
        assert (t.probability(high) >= t.probability(low) - 1e-12).all()


def test_trees_without_two_classes():
    none = Q.fit_trees(np.zeros((0, 11)), np.zeros(0))
    assert (none.probability(np.zeros((3, 11))) < 1e-6).all()
    one = Q.fit_trees(np.random.rand(20, 11), np.zeros(20))
    assert (one.probability(np.random.rand(5, 11)) < 0.5).all()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    trees = Q.fit_quality(docs, labels.filter("doc_id % 2 = 0"))
    rows = Q.score_quality(docs, trees).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    low = [r for r in rows if r.quality == 0]
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    assert sum(not r.kept for r in low) >= 0.9 * len(low)
    assert sum(r.kept for r in good) >= 0.98 * len(good)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 0), (None, 1, 0), (4, None, 0), (99, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = Q.quality_rules(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.base_failed for r in rows if r.doc_id in (1, 2, 3))
    kept = Q.keep_quality(odd_docs, labels)
    assert kept.dtypes == odd_docs.dtypes and kept.count() <= len(rows)
    assert Q.quality_rules(no_docs, labels).count() == 0
    assert Q.quality_rules(odd_docs, labels.limit(0)).filter("kept").count() > 0
