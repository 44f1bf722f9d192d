"""The stages of the corpus pipeline, each held to what its operator promises."""
import corpus_pipeline as C
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ordwise.llm import quality, simhash


def test_stages_and_run(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["quality_rules", "simhash_dedup", "pii", "mixing", "packing"]
    kept = {}
    at = docs
    for name, stage in C.STAGES:
        out = stage(spark, at, small)
        if name != "packing":
            assert out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{name}")
        at = kept[name] = spark.read.parquet(f"{tmp_path}/{name}")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    want = {r.doc_id for r in quality.quality_rules(docs, labels).filter("kept").collect()}
    assert {r.doc_id for r in kept["quality_rules"].collect()} == want
    groups = simhash.near_duplicates(kept["quality_rules"]).collect()
    assert sorted(r.doc_id for r in kept["simhash_dedup"].collect()) == sorted({r.component_id for r in groups})
    before = {r.doc_id: r for r in kept["simhash_dedup"].collect()}
    for r in kept["pii"].collect():
        assert "@mail" not in r.text
        assert r == before[r.doc_id] or r.n_chars == len(r.text)
    assert {r.doc_id for r in kept["mixing"].collect()} <= set(before)
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    n = sum(len(e.ids) + 1 for e in t.encode_batch([r.text for r in kept["mixing"].collect()], add_special_tokens=False))
    assert sum(r.length for r in kept["packing"].collect()) == n
    again = sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in C.run(spark, small).collect())
    first = {(r.doc_id, r.start) for r in kept["packing"].collect() if r.start == 0}
    assert {(a, b) for a, b, _, _ in again if b == 0} == first
    assert sum(a[2] for a in again) == n


def test_odd_rows_pass_every_stage(spark, odd_docs, no_docs, small):
    for docs in (odd_docs, no_docs):
        for name, stage in C.STAGES:
            out = stage(spark, docs, small)
            assert out.count() <= max(np.inf if name in ("mixing", "packing") else docs.count(), 0)
            if name != "packing":
                assert out.dtypes == docs.dtypes, name
