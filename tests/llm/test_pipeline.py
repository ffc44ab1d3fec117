"""The registered queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from staffloom.llm import mixing, queries, secrets, simhash, toxicity

sys.path.insert(0, str(Path(__file__).parent))
import messy  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def table(result):
    names = sorted(result.column_names)
    columns = [result.column(n).to_pylist() for n in names]
    return names, sorted((tuple(map(str, r)) for r in zip(*columns)))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for given in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {given} AS SELECT * FROM '{FOLDER}/{given}.parquet'")
    ours, theirs = queries.QUERIES[name](spark, FOLDER).toArrow(), con.sql(queries.SQL[name]).to_arrow_table()
    assert table(ours) == table(theirs)
    assert {f.name: str(f.type) for f in ours.schema} == {f.name: str(f.type) for f in theirs.schema}


def test_all_are_registered():
    names = entry_points.queries()
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) < set(names) and names["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", [n for n in sorted(queries.QUERIES) if n not in queries.SQL])
def test_one_row_per_input(spark, name):
    source = "pages" if name.startswith("op2_") else "documents"
    want = spark.read.parquet(f"{FOLDER}/{source}.parquet").count()
    assert queries.QUERIES[name](spark, FOLDER).count() == want


def test_stages_by_brute_force(spark, ws):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    machine = toxicity.learn(docs, labels)
    terms = toxicity.Terms()
    stages = dict(corpus_pipeline.STAGES)

    kept = ws.settle(stages["toxicity"](spark, docs, FOLDER), "a")
    assert kept.columns == docs.columns
    want = {i for i, r in rows.items() if machine.score(terms.of(r["text"])) < 0.5}
    assert {r["doc_id"] for r in kept.collect()} == want

    single = ws.settle(stages["simhash_near_dedup"](spark, kept, FOLDER), "b")
    prints = {i: simhash.fingerprint(rows[i]["text"]) for i in want}
    group = {i: i for i in want}
    changed = True
    while changed:
        changed = False
        for a in want:
            for b in want:
                if group[b] < group[a] and (prints[a] ^ prints[b]).bit_count() <= 2:
                    group[a], changed = group[b], True
    assert {r["doc_id"] for r in single.collect()} == set(group.values()) and single.columns == docs.columns

    hidden = ws.settle(stages["secret_scan"](spark, single, FOLDER), "c")
    assert hidden.columns == docs.columns and hidden.count() == single.count()
    spans = {r["doc_id"]: r["spans"] for r in secrets.report(single).collect()}
    for r in hidden.collect():
        assert (r["text"] != rows[r["doc_id"]]["text"]) == bool(spans[r["doc_id"]])
        assert r["n_chars"] == len(r["text"])

    mixed = ws.settle(stages["source_mixing"](spark, hidden, FOLDER), "d")
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mixed(hidden, ws).collect() if r["taken"]}
    times = {}
    for r in mixed.collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert mixed.columns == docs.columns and times == taken

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text_of = {r["doc_id"]: r["text"] for r in hidden.collect()}
    out = stages["bpe"](spark, mixed, FOLDER).collect()
    assert len(out) == sum(times.values())
    for r in out:
        assert r["ids"] == library.encode(text_of[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(r["ids"])
    whole = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(map(str, whole)) == sorted(map(str, out))


def test_messy_documents(spark, ws):
    docs = messy.frame(spark)
    for start in (docs, messy.empty(spark)):
        now = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = ws.settle(stage(spark, now, FOLDER), name)
            assert now.columns == start.columns
        out = corpus_pipeline.STAGES[-1][1](spark, now, FOLDER).collect()
        assert len(out) == now.count()
        assert all(np.all(np.array(r["ids"]) >= 0) for r in out)
