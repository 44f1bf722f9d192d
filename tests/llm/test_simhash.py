"""SimHash near-duplicates against plain bit counting and all-pairs union-find."""
import itertools
import random
import re

import xxhash
from pyspark.sql import functions as F

from ordwise.llm import simhash as S
from ordwise.llm.components import connected_components
from ordwise.llm.queries import op8_simhash


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    rows = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in rows]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def plain_components(fps, radius=2):
    """Union-find over all pairs: index -> smallest index reachable."""
    at = list(range(len(fps)))

    def find(i):
        while at[i] != i:
            i = at[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= radius:
            a, b = find(i), find(j)
            at[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_query_equals_brute_force(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rows = {r.doc_id: r for r in op8_simhash(spark, small).collect()}
    assert len(rows) == len(docs)
    fps = [plain_fingerprint(t) for _, t in docs]
    assert all(rows[i].fingerprint == f"{f:016x}" for (i, _), f in zip(docs, fps))
    group = plain_components(fps)
    low = {}
    for (i, _), g in zip(docs, group):
        low[g] = min(low.get(g, i), i)
    assert all(rows[i].component_id == low[g] for (i, _), g in zip(docs, group))


def test_masks_cover_every_pair_within_the_radius():
    masks = S.covering_masks()
    assert len(masks) == 7
    for bits in itertools.combinations(range(64), 2):
        assert any(not (m >> bits[0] & 1 or m >> bits[1] & 1) for m in masks)


def test_components_of_crafted_fingerprints(spark):
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(30)]
    chain = [fps[0]]
    for _ in range(40):      # a chain of small steps, its ends far apart
        chain.append(chain[-1] ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    hub = [fps[1] ^ (1 << i) for i in range(64)]
    every = sorted({*fps, *chain, *hub})
    df = spark.createDataFrame([(S._signed(f),) for f in every], "fp long")
    links = S.links(S.candidates(df))
    got = {r.node: r.root for r in connected_components(links).collect()}
    want = plain_components(every)
    groups = {}
    for f, g in zip(every, want):
        groups.setdefault(g, set()).add(got.get(S._signed(f), S._signed(f)))
    assert all(len(v) == 1 for v in groups.values())
    assert len({next(iter(v)) for v in groups.values()}) == len(groups)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = S.near_duplicates(odd_docs).select("doc_id", S.fingerprint_hex().alias("f"), "component_id").collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    assert by[1].f == by[2].f == by[3].f == "0" * 16
    assert by[1].component_id == by[2].component_id == by[3].component_id == 1
    assert by[7].component_id == by[6].component_id == 6
    assert by[None].component_id is None or by[None].component_id in by
    assert S.near_duplicates(no_docs).count() == 0


def test_drop_keeps_one_row_of_each_group(spark, odd_docs, no_docs):
    out = S.drop_near_duplicates(odd_docs)
    assert out.dtypes == odd_docs.dtypes
    ids = [r.doc_id for r in out.collect()]
    assert ids.count(None) == 1 and ids.count(1) == 1 and 2 not in ids and 3 not in ids
    assert ids.count(6) == 1 and 7 not in ids and {4, 5, -5, 9, 10, 12} <= set(ids)
    assert S.drop_near_duplicates(no_docs).collect() == []


def test_a_row_of_each_id_less_text_stays(spark, docs_schema):
    far = ["completely different words in this one text here", "nothing at all in common with the other row"]
    df = spark.createDataFrame([(None, t, None, None, None) for t in far + far], docs_schema)
    assert sorted(r.text for r in S.drop_near_duplicates(df).collect()) == sorted(far)


def test_components_long_path_and_empty(spark):
    path = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in connected_components(path).collect()} == {0}
    assert connected_components(path.filter("a < 0")).count() == 0
