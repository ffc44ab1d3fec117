"""From raw documents to token ids: five stages, each on all rows its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffloom.llm import bpe, mixing, secrets, simhash, toxicity
from staffloom.sources.workspace import Workspace

VOCABULARY = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go; the machine learns from the labelled ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.harmless(docs, toxicity.learn(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints at most two bits apart stays."""
    return simhash.one_of_each(docs, Workspace(spark), shingle=3, max_bits=2)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; what looks like a secret is replaced in its text."""
    return secrets.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; each source comes near its target."""
    return mixing.expanded(docs, Workspace(spark))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the text."""
    encoded = bpe.encode(docs, public_tokenizers.path(VOCABULARY))
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scan", hide_secrets),
    ("source_mixing", mix_sources),
    ("bpe", to_tokens),
]

# A fitted model, 64-bit hashes of shingles and merges have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written before the next one reads."""
    ws = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = ws.settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
