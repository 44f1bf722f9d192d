"""From raw documents to packed sequences: five stages, each one operator.

Every stage reads what its predecessor wrote to Parquet, so a lost executor
costs at most part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordwise.llm import mixing, packing, pii, quality, simhash
from ordwise.llm.common import read
from ordwise.llm.queries import domain_labels
from ordwise.session import scratch_path, ship_package

#: Token shares after mixing, by quality and toxicity label: no low quality, few toxic documents.
MIX_WEIGHTS = {"q1t0": 0.96, "q1t1": 0.04}
#: The mixture is made large enough for clean prose to keep all its tokens and a little more.
MIX_AT_LEAST = {"q1t0": 1.05}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the trees go."""
    ship_package(spark)
    return quality.keep_quality(docs, read(spark, sf_dir, "labels"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    ship_package(spark)
    return simhash.drop_near_duplicates(docs)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redact_pii(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay, go or repeat by their fitted rates."""
    ship_package(spark)
    return mixing.resample(docs, domain_labels(read(spark, sf_dir, "labels")), MIX_WEIGHTS,
                           at_least=MIX_AT_LEAST)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of at most 1024, as pieces with their ids."""
    import public_tokenizers
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("pii", redact_pii),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The stages hash, train and tokenize in ways SQL has no words for; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; stage results are Parquet in the shared folder."""
    ship_package(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
