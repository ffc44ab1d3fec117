"""Periodic runs against a search of all periods at all places."""

from __future__ import annotations

import random
import sys
from hashlib import sha256
from pathlib import Path
from zlib import crc32

import numpy as np
import pytest

from staffloom.llm import periods

sys.path.insert(0, str(Path(__file__).parent))
import messy  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def plain_runs(words, least=12):
    """(start, length, period) of all runs: for each period all stretches that keep it."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        x = 0
        while x < n - q:
            if words[x] != words[x + q]:
                x += 1
                continue
            y = x
            while y < n - q and words[y] == words[y + q]:
                y += 1
            if y - x >= q and y - x + q >= least:
                found.setdefault((x, y + q), q)
            x = y
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_report(key, text):
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    h, n = crc32(str(key).encode()), len(words)
    if key is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        key,
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        sha256(listed.encode()).hexdigest(),
        sha256(left.encode()).hexdigest(),
    )


def some_text(rng):
    n, kind = rng.randrange(300), rng.randrange(6)
    if kind == 0:
        return [rng.randrange(2) for _ in range(n)]
    if kind == 1:
        return [0] * n
    if kind == 2:
        return ([rng.randrange(30) for _ in range(rng.randrange(1, 60))] * 300)[:n]
    if kind == 3 and n:
        text, a = [rng.randrange(100) for _ in range(n)], rng.randrange(n)
        p = 1 + (n - a) // 3
        return [x if i < a else text[a + (i - a) % p] for i, x in enumerate(text)]
    if kind == 4:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    return [rng.randrange(1_000) for _ in range(n)]


def test_the_cover_meets_every_difference():
    differences = {(a - b) % periods.COVER for a in periods.RESIDUES for b in periods.RESIDUES}
    assert differences == set(range(periods.COVER))


def test_common_words():
    rng = random.Random(2)
    for _ in range(60):
        codes = np.array(some_text(rng) + some_text(rng) + [5_000])
        made = periods.Suffixes(codes)
        assert len(made.rank) == len(periods.RESIDUES) * -(-len(codes) // periods.COVER)
        i = np.array([rng.randrange(len(codes)) for _ in range(200)])
        j = np.array([rng.randrange(len(codes)) for _ in range(200)])
        i, j = i[i != j], j[i != j]
        for a, b, got in zip(i, j, made.common(i, j)):
            n = 0
            while max(a, b) + n < len(codes) and codes[a + n] == codes[b + n]:
                n += 1
            assert got == n


@pytest.mark.parametrize("pairs", [50, periods.GROUP_PAIRS])
def test_all_runs(pairs, monkeypatch):
    monkeypatch.setattr(periods, "GROUP_PAIRS", pairs)
    rng = random.Random(3)
    for least in (12, 2, 30):
        for _ in range(40):
            texts = [some_text(rng) for _ in range(rng.randrange(1, 7))]
            texts += texts[:1]
            found = periods.runs_of([np.array(t, np.int64) for t in texts], least)
            for text, got in zip(texts, found):
                assert sorted(zip(*(c.tolist() for c in got))) == plain_runs(text, least)


def test_a_long_text_alone():
    words = ["a", "b", "c"] * 30_000 + [f"w{i}" for i in range(50_000)] + ["x"] * 40_000
    (got,) = periods.runs_of([np.unique(words, return_inverse=True)[1]])
    assert list(zip(*(c.tolist() for c in got))) == [(0, 90_000, 3), (140_000, 40_000, 1)]
    assert len(periods.collapsed(words, got)) == 3 + 50_000 + 1


def test_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = [plain_report(r["doc_id"], r["text"]) for r in docs.collect() if len(r["text"]) < 20_000]
    got = {r["doc_id"]: tuple(r) for r in periods.report(docs).collect()}
    assert len(got) == docs.count()
    assert [got[w[0]] for w in want] == want
    assert any(w[1] for w in want)


def test_messy_rows(spark):
    rows = [r for r in messy.rows() if r[0] != 9]
    out = periods.report(messy.frame(spark).filter("doc_id IS NULL OR doc_id <> 9")).collect()
    want = [plain_report(r[0], r[1]) for r in rows]
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)
    assert periods.report(messy.frame(spark)).count() == len(messy.rows())
    assert periods.report(messy.empty(spark)).count() == 0


def test_clashing_columns_and_real_outputs(spark):
    text = "so it began " + "round and round " * 5 + "until the end"
    df = spark.createDataFrame([(text, 1, "x", None), (None, 2, "y", 3)], "text string, runs int, collapsed string, n int")
    out = periods.with_runs(df)
    assert out.columns == ["text", "n", "runs", "collapsed"]
    first, second = out.collect()
    assert [tuple(r) for r in first["runs"]] == [(3, 15, 3)]
    assert first["collapsed"] == "so it began round and round until the end"
    assert second["runs"] == [] and second["collapsed"] == "" and second["n"] == 3
