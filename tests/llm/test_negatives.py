"""Hard negatives against all scores worked out one by one."""

from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from staffloom.llm import negatives
from staffloom.sources.workspace import Workspace

SCHEMA = "vec_id long, embedding array<float>, label int, uid long, score double, lane int, key string"


def plain(rows, is_anchor, take_p=5, take_n=5):
    """Rows are (key, vector, label) after the contract's change of labels."""
    sound = []
    for key, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        sound.append((key, label, tuple(math.floor(256 * float(np.float32(x))) for x in vector)))
    out = []
    for key, label, vector in sorted({r for r in sound if r[0] is not None and is_anchor(r[0])}):
        scored = sorted(
            ((sum(a * b for a, b in zip(vector, v)), k, x == label) for k, x, v in sound if k != key),
            key=lambda s: (-s[0], s[1] is None, s[1] or 0),
        )
        for p_score, p_key, _ in [s for s in scored if s[2]][:take_p]:
            fit = [s for s in scored if not s[2] and 80 * p_score <= 100 * s[0] <= 100 * p_score]
            out += [(key, p_key, i + 1, n, p_score, s) for i, (s, n, _) in enumerate(fit[:take_n])]
    return sorted(out, key=str)


def moved(rows):
    return [(k, v, (x + 1) % 10 if x is not None and k is not None and k % 7 == 0 else x) for k, v, x in rows]


def some_rows(rng, n, width=6):
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    rows = []
    for i in range(n):
        size = rng.choice([0.1, 1, 1, 1, 30])
        vector = [size * (c + rng.gauss(0, 0.4)) for c in rng.choice(centres)]
        rows.append((i * 10, vector, rng.randrange(3)))
    return rows


def frame(spark, rows):
    whole = [(k, None if v is None else [None if x is None else float(x) for x in v], label) for k, v, label in rows]
    return spark.createDataFrame([(*r, 1, 0.5, 2, "k") for r in whole], SCHEMA)


@pytest.mark.parametrize("lane_rows,block_anchors,bucket_rows", [(8_192, 8_192, 2_048), (60, 7, 8)])
def test_against_all_scores(spark, monkeypatch, lane_rows, block_anchors, bucket_rows):
    monkeypatch.setattr(negatives, "BUCKET_ROWS", bucket_rows)
    rows = some_rows(random.Random(lane_rows), 300)
    # A third of the rows one vector, one label, partly one key; some equal scores.
    rows += [(7_000 + i % 5, [1.0, 0.5, 0, 0, 0, 0], 1) for i in range(150)]
    rows += [(100, [0.0] * 6, 0), (100, [0.0] * 6, 0), (200, [3.0] * 6, 2)]
    df = frame(spark, rows)
    out = negatives.mined(
        df, Workspace(spark), F.col("vec_id") % 100 == 0, lane_rows=lane_rows, block_anchors=block_anchors
    )
    want = plain(rows, lambda k: k % 100 == 0)
    assert sorted(map(tuple, out.collect()), key=str) == want and len(want) > 300


def test_messy_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [
        (None, [1.0, 1, 1, 1, 1, 1], 1), (1, None, 1), (2, [1.0, None], 1), (3, [nan] * 6, 1), (4, [inf] * 6, 1),
        (5, [1.0] * 6, None), (6, [], 1), (900, [], 2), (8, [2.0, 1.0], 1), (9, [0.5] * 9, 2), (1_000, [-1.0] * 6, 0),
        (11, [1e30, 0, 0, 0, 0, 0], 1), (1_100, [1e12, 1e12, 0, 0, 0, 0], 1),
    ]
    rows = [r for r in some_rows(random.Random(5), 60)] + odd + odd
    ws = Workspace(spark)
    out = negatives.every(frame(spark, rows), ws).collect()
    known = [r for r in rows if r[0] not in (11, 1_100)]
    got = negatives.every(frame(spark, known), ws).collect()
    assert sorted(map(tuple, got), key=str) == plain(moved(known), lambda k: k % 100 == 0)
    assert {r["anchor_id"] for r in got} <= {r["anchor_id"] for r in out} | {1_100}
    assert negatives.every(frame(spark, []), ws).count() == 0
    assert negatives.every(frame(spark, [(None, None, None)]), ws).count() == 0


def test_scores_beyond_doubles(spark):
    """Whole numbers that a double can't hold are still told apart."""
    rows = [(100, [2.0**22, 1.0], 1), (1, [2.0**22, 1.0], 1), (2, [2.0**22, 0.0], 2), (3, [2.0**22, -1.0], 2)]
    out = negatives.mined(frame(spark, rows), Workspace(spark), F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(tuple, out), key=str) == plain(rows, lambda k: k % 100 == 0)


def test_sql_says_the_same(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.01/embeddings.parquet'")
    want = sorted(con.execute(negatives.SQL).fetchall())
    assert sorted(map(tuple, negatives.every(df, Workspace(spark)).collect())) == want and want


def test_candidates_lose_nothing_and_are_few():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    real = centres[rng.integers(0, 40, 2_000)] + 0.2 * rng.normal(size=(2_000, 16))
    size = rng.uniform(0.95, 1, (2_000, 1)) / np.sqrt((real**2).sum(axis=1, keepdims=True))
    rows = np.floor(256 * real * size).astype(np.int64)
    length = np.sqrt((rows.astype(float) ** 2).sum(axis=1))
    order = np.argsort(-length)
    rows, length = rows[order], length[order]
    bucket = negatives.Bucket(rows, np.arange(2_000), np.zeros(2_000), length)
    found = 0
    for i in range(0, 2_000, 40):
        anchor = negatives.Anchor(rows[i], i, 0)
        scores = rows @ rows[i]
        for place in (1, 5, 50):
            least = int(np.sort(scores)[-place])
            some = bucket.candidates(anchor, least)
            kept = np.arange(2_000) if some is None else some
            assert set(np.flatnonzero(scores >= least)) <= set(kept.tolist())
            found += len(kept) if place == 5 else 0
    assert found < 0.3 * 50 * 2_000
    far = negatives.Anchor(rows[0] // 1_000, 0, 0)
    assert len(bucket.candidates(far, int(scores.max()) * 10)) == 0
