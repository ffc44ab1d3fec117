"""Fingerprints and groups against brute force."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest
import xxhash

from staffloom.llm import simhash
from staffloom.llm.components import components

sys.path.insert(0, str(Path(__file__).parent))
import messy  # noqa: E402


def plain(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints, most):
    """doc -> least doc reachable, by comparing all."""
    ids = list(prints)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if (prints[a] ^ prints[b]).bit_count() <= most and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def test_fingerprint():
    for row in messy.rows():
        assert simhash.fingerprint(row[1]) == plain(row[1])
    assert simhash.fingerprint("ÀB c") == plain("ÀB c") != simhash.fingerprint("àb c")


def test_ball():
    assert len(simhash.ball(1)) == 65 and len(set(simhash.ball(2))) == 1 + 64 + 64 * 63 // 2


@pytest.mark.parametrize("most", [0, 2, 4])
def test_links_lose_no_connection(spark, ws, most):
    rng = random.Random(most)
    prints, value = {}, rng.getrandbits(64)
    for i in range(120):
        # A walk: chains of near ones, now and then a jump.
        flips = rng.choice([1, 2, 2, 3, 5])
        for bit in rng.sample(range(64), flips):
            value ^= 1 << bit
        prints[i] = value if rng.random() > 0.1 else 0
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in prints.items()]
    frame = ws.settle(spark.createDataFrame(signed, "doc_id long, fingerprint long"), "p")
    found = simhash.groups(frame, ws, most).collect()
    first = {r["fingerprint"]: r["first"] for r in found}
    assert {i: first[p] for i, p in signed} == grouped(prints, most)


def test_odd_distance_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([], "fingerprint long"), 3)


def test_components(spark, ws):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(5, 5), (300, 301), (301, 300)]
    edges += [(400 + i, 401 + i) for i in range(40)]  # a long path
    label = {n: n for e in edges if e[0] != e[1] for n in e}
    for _ in range(500):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = components(spark.createDataFrame(edges + [(None, 3)], "a long, b long"), ws).collect()
    assert {r["node"]: r["component"] for r in got} == label and len(got) == len(label)
    assert components(spark.createDataFrame([], "a long, b long"), ws).count() == 0


def test_messy_rows(spark, ws):
    got = simhash.near_duplicates(messy.frame(spark), ws).collect()
    assert len(got) == len(messy.rows())
    first = {}
    for row in messy.rows():
        print_ = f"{plain(row[1]):016x}"
        first[print_] = min((x for x in (first.get(print_), row[0]) if x is not None), default=None)
    by_key = {r["doc_id"]: r for r in got}
    assert by_key[2]["component_id"] == by_key[6]["component_id"] == 1
    assert by_key[3]["component_id"] == by_key[5]["component_id"] == 3
    assert by_key[3]["fingerprint"] == "0" * 16
    assert by_key[None]["component_id"] is None
    assert simhash.near_duplicates(messy.empty(spark), ws).count() == 0

    docs = messy.frame(spark)
    kept = simhash.one_of_each(docs, ws)
    assert kept.columns == docs.columns
    groups = len({r["component_id"] for r in got})
    assert kept.count() == groups
    assert simhash.one_of_each(messy.empty(spark), ws).count() == 0
