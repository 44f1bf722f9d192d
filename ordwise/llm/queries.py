"""The production queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordwise.llm import (extraction, lexical, mixing, oracle, packing, pii, prefixtrie, quality, secrets, simhash, tokencount,
                         tokenfile, topk, warc)
from ordwise.llm.common import cut, read
from ordwise.session import scratch_path, ship_package


def op1_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return extraction.extract_main_text(read(spark, sf_dir, "pages"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(read(spark, sf_dir, "documents")).drop("span_list")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    ship_package(spark)
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        with_ids=False)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_into_ledger(read(spark, sf_dir, "documents"), scratch_path(spark, "secret-ledger"))
    return secrets.digest(found).drop("blob")


#: Token shares the mixture is fitted to, by domain: quality and toxicity label of a document.
MIX_WEIGHTS = {"q1t0": 0.86, "q1t1": 0.05, "q0t0": 0.08, "q0t1": 0.01}


def domain_labels(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", F.concat(F.lit("q"), F.col("quality"), F.lit("t"), F.col("toxic")).alias("domain"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    ship_package(spark)
    out, fit = mixing.mix(read(spark, sf_dir, "documents"), domain_labels(read(spark, sf_dir, "labels")),
                          MIX_WEIGHTS, vocabulary=public_tokenizers.path("byte_bpe_50k.tiktoken"))
    p = [F.round(F.element_at("p", i + 1), 6).alias(f"p_{n}") for i, n in enumerate(fit.names)]
    return out.select("doc_id", "n_tokens", *p, F.round("rate", 6).alias("rate"), "copies")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    out = quality.quality_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.select("doc_id", *quality.BASE, "base_failed", "kept", F.round("p_low", 6).alias("p_low"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    ship_package(spark)
    out = scratch_path(spark, "token-files")
    tokenfile.write_tokens(read(spark, sf_dir, "documents"), out, public_tokenizers.path("word_bpe_49k.json"))
    return tokenfile.read_tokens(spark, out)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    ship_package(spark)
    return tokencount.count_tokens(read(spark, sf_dir, "documents"),
                                   public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    vectors = cut(topk.numbered(topk.quantised(read(spark, sf_dir, "embeddings"))))
    return topk.top_k(vectors, vectors.filter("vec_id % 100 = 0"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return prefixtrie.prefix_trie(prefixtrie.rebuilt(read(spark, sf_dir, "conversations")))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return lexical.ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    out = scratch_path(spark, "warc")
    warc.convert(warc.arc_of_pages(read(spark, sf_dir, "pages")), out)
    back = warc.resolved(cut(warc.read_warc(spark, out))).filter("kind IN ('response', 'revisit')")
    return back.select("page_id", "payload_bytes", F.lower(F.hex("digest")).alias("payload_digest"),
                       F.col("kind").alias("record_type"), F.col("refers_page").alias("refers_to"))


QUERIES = {f.__name__: f for f in (op1_extraction, op2_pii, op3_packing, op4_secrets, op5_token_files,
                                   op6_token_counts, op7_mixing, op8_simhash, op9_quality, op10_topk, op11_prefix_trie,
                                   op12_lexical, op13_warc)}
ORACLE_SQL: dict[str, str] = oracle.oracle_sql()
