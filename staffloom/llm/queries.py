"""The operators over the given tables, by name, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from staffloom.llm import (
    bpe,
    chat,
    html,
    licences,
    mixing,
    negatives,
    periods,
    pii,
    quality,
    secrets,
    simhash,
    syncmers,
    toxicity,
)
from staffloom.sources.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
VOCABULARY = "byte_bpe_50k.json"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


@query
def op1_quality_rules(spark, folder):
    return quality.judged(documents(spark, folder), Workspace(spark))


SQL["op1_quality_rules"] = quality.SQL


@query
def op2_html_extraction(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return html.extracted(pages, html.learn(pages))


@query
def op3_source_mixing(spark, folder):
    return mixing.mixed(documents(spark, folder), Workspace(spark))


SQL["op3_source_mixing"] = mixing.SQL


@query
def op4_pii(spark, folder):
    return pii.report(documents(spark, folder), Workspace(spark))


SQL["op4_pii"] = pii.SQL


@query
def op5_syncmer_fingerprints(spark, folder):
    return syncmers.compared(documents(spark, folder), Workspace(spark))


@query
def op6_secret_scan(spark, folder):
    return secrets.report(documents(spark, folder))


SQL["op6_secret_scan"] = secrets.SQL


@query
def op7_licence_scan(spark, folder):
    docs = documents(spark, folder)
    return licences.scanned(docs, licences.learn(docs))


@query
def op8_simhash_near_dedup(spark, folder):
    return simhash.near_duplicates(documents(spark, folder), Workspace(spark))


@query
def op9_bpe_round_trip(spark, folder):
    return bpe.round_trip(documents(spark, folder), public_tokenizers.path(VOCABULARY))


@query
def op10_toxicity(spark, folder):
    return toxicity.rated(documents(spark, folder), labels(spark, folder))


@query
def op11_chat_formatting(spark, folder):
    said = spark.read.parquet(f"{folder}/conversations.parquet")
    return chat.read_back(chat.formatted(chat.with_trap(said)))


SQL["op11_chat_formatting"] = chat.SQL


@query
def op12_hard_negatives(spark, folder):
    return negatives.every(spark.read.parquet(f"{folder}/embeddings.parquet"), Workspace(spark))


SQL["op12_hard_negatives"] = negatives.SQL


@query
def op13_periodic_runs(spark, folder):
    return periods.report(documents(spark, folder))
