"""Document fingerprints from closed syncmers.

A k-mer of characters is chosen if the least of its s-mers, by hash, is its first or its
last. That depends on the k-mer alone, so the same passage gives the same anchors wherever
it stands, and neighbours cannot unselect each other; about 2 / (k - s + 1) of all places
are anchors. A fingerprint keeps every anchor, each hash once at its first place, in text
order, so that a passage is as well covered in a long text as in a short one.

Likeness of two fingerprints: of the anchors of both together, the share that both hold,
counting only anchors that keep their order in both texts (the longest chain of rising
places). 1 for equal texts, 0 without a common anchor.

A text shorter than k is one anchor, its whole hash; an empty text has none. Nulls: a NULL
text is empty; two empty fingerprints are alike (1.0). A NULL key comes before all others.
Keys may be of any type that has an order. Rows of one key are ordered by a hash of their
text. Repeated rows follow each other. Empty tables give empty results; a single row is its
own successor. Other columns are not looked at.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffloom.sources.workspace import Workspace

# K and S are powers of two: hashes of longer pieces are made from those of halves.
K, S = 32, 8
# Rows that are meant to be sorted beside each other, and characters hashed at once.
ROWS_PER_RANGE = 4_000
# There are never more ranges than this; beyond it they hold more rows. A task goes through
# its range in order and holds two rows of it at a time.
MOST_RANGES = 20_000
CHUNK = 1 << 18
_STEP = np.uint64(0x9E3779B97F4A7C15)

Anchors = tuple[np.ndarray, np.ndarray]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of SplitMix64)."""
    x = x + _STEP
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pieces(codes: np.ndarray, longest: int) -> dict[int, np.ndarray]:
    """Length -> polynomial hash of the piece of that length from every place."""
    found, size, base = {1: codes}, 1, int(_STEP)
    while size < longest:
        half = found[size]
        found[2 * size] = half[:-size] * np.uint64(base) + half[size:]
        size, base = 2 * size, base * base % (1 << 64)
    return found


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` neighbours."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def anchors(text: str) -> Anchors:
    """Hashes and places of all closed syncmers, in text order."""
    codes = _codes(text)
    if not len(codes):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(codes) < K:
        whole = np.uint64(len(codes))
        with np.errstate(over="ignore"):
            for c in codes:
                whole = whole * _STEP + c
            return _mixed(np.array([whole])), np.zeros(1, np.int64)
    hashes, places = [], []
    with np.errstate(over="ignore"):
        for at in range(0, len(codes) - K + 1, CHUNK):
            found = _pieces(codes[at : at + CHUNK + K - 1], K)
            inner = _mixed(found[S])
            least, width = _least(inner, K - S + 1), K - S + 1
            chosen = np.flatnonzero((least == inner[: len(least)]) | (least == inner[width - 1 :]))
            hashes.append(_mixed(found[K][chosen]))
            places.append(chosen + at)
    return np.concatenate(hashes), np.concatenate(places)


def kept(all_anchors: Anchors) -> Anchors:
    """The first place of every hash, in text order."""
    first = np.sort(np.unique(all_anchors[0], return_index=True)[1])
    return all_anchors[0][first], all_anchors[1][first]


def likeness(a: Anchors, b: Anchors) -> float:
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    _, in_a, in_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = len(a[0]) + len(b[0]) - len(in_a)
    chain: list[int] = []
    for place in b[1][in_b[np.argsort(in_a)]].tolist():
        if not chain or place > chain[-1]:
            chain.append(place)
        else:
            chain[bisect_left(chain, place)] = place
    return len(chain) / both


def written(a: Anchors) -> str:
    """Anchors as hash:place in text order."""
    return ",".join(f"{h:016x}:{p}" for h, p in zip(a[0].tolist(), a[1].tolist()))


def fingerprint(text: str | None) -> str:
    return written(kept(anchors(text or "")))


def fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """`df` with the fingerprint of `text` in column `out`, which is replaced if there."""
    if out in df.columns:
        df = df.drop(out)
    names = df.columns

    def run(batches):
        for batch in batches:
            made = [fingerprint(t) for t in batch.column(names.index(text)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=[*names, out])

    return df.mapInArrow(run, df.withColumn(out, F.lit("")).schema)


def _order(key: object) -> tuple:
    """Keys in Spark's order: NULL first, NaN last."""
    if key is None:
        return (0, 0)
    return (2, 0) if key != key else (1, key)


def _heads(narrow: DataFrame, rows: int, rows_per_range: int) -> list:
    """First key and hash of each of some even ranges of (key, hash): bounded in number."""
    n = max(1, min(-(-rows // rows_per_range), MOST_RANGES))
    ranged = narrow.repartitionByRange(n, "key", "h")
    firsts = ranged.groupBy(F.spark_partition_id().alias("at")).agg(F.min(F.struct("key", "h")).alias("f"))
    return [r["f"] for r in sorted(firsts.collect(), key=lambda r: r["at"])]


def beside_next(df: DataFrame, ws: Workspace, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """`df` (key, text) dealt into ranges and sorted, `ghost` false; and at the end of each
    range, as a ghost, a copy of the row that follows (after the last: the first).

    Ranges are of key and hash of the text, so a key that many rows share is cut like any
    other; only equal rows stay together. Their bounds come from a table of keys and hashes.
    One shuffle of the texts, each range to a task of its own.
    """
    hashed = df.withColumn("h", F.xxhash64("text"))
    narrow, rows = ws.settle_counted(hashed.select("key", "h"), "keys")
    heads = _heads(narrow, rows, rows_per_range)
    if not heads:
        return hashed.withColumns({"range": F.lit(0), "ghost": F.lit(False)})
    bounds = [(_order(f["key"]), f["h"]) for f in heads]

    @F.arrow_udf("int")
    def range_of(keys: pa.Array, hashes: pa.Array) -> pa.Array:
        pairs = zip(keys.to_pylist(), hashes.to_pylist())
        found = [max(0, bisect_right(bounds, (_order(k), h)) - 1) for k, h in pairs]
        return pa.array(found, pa.int32())

    kind = df.schema["key"].dataType.simpleString()
    wanted = df.sparkSession.createDataFrame(
        [(f["key"], f["h"], (i - 1) % len(heads)) for i, f in enumerate(heads)],
        f"head {kind}, head_h long, range int",
    )
    same = F.col("key").eqNullSafe(F.col("head")) & (F.col("h") == F.col("head_h"))
    ghosts = (
        hashed.join(F.broadcast(wanted), same)
        .groupBy("range", "key", "h")
        .agg(F.min("text").alias("text"))
        .select("key", "text", "h", "range", F.lit(True).alias("ghost"))
    )
    placed = hashed.withColumns({"range": range_of("key", "h"), "ghost": F.lit(False)})
    return (
        placed.unionByName(ghosts)
        .repartitionById(len(heads), F.col("range"))
        .sortWithinPartitions("range", "ghost", "key", "h", "text")
    )


def compared(
    df: DataFrame,
    ws: Workspace,
    key: str = "doc_id",
    text: str = "text",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Per row: its fingerprint, that of its edited text, and how alike they and the next
    row's are.

    The edited text: the last half of the characters (rounded down) gives way to the first
    as many of the next row, in order of key, or to all of it.
    """
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = df.schema[key].dataType.simpleString()
    names = [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = (
        f"`{key}` {kind}, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )

    def run(batches):
        out: list[tuple] = []
        kept_type = None
        for type_, found in _compared(batches):
            kept_type = type_
            out.append(found)
            if len(out) >= 1_000:
                yield _batch(out, names, kept_type)
                out = []
        if out:
            yield _batch(out, names, kept_type)

    dealt = beside_next(rows, ws, rows_per_range)
    return dealt.select("key", "text", "range", "ghost").mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str], key: pa.DataType) -> pa.RecordBatch:
    kinds = [key, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _compared(batches) -> Iterator[tuple[pa.DataType, tuple]]:
    """Type of the keys and what is said of each row, in the order of the rows."""
    last, edit = None, None
    for batch in batches:
        type_ = batch.column(0).type
        columns = (c.to_pylist() for c in batch.columns)
        for key, text, range_, ghost in zip(*columns):
            # A crowd of copies is worked on once.
            copy = last is not None and last[1] == text
            own = last[4] if copy else kept(anchors(text))
            if last is not None and last[2] == range_ and not last[3]:
                old_key, old_text, _, _, old = last
                if not (copy and edit and edit[0] == text):
                    half = len(old_text) // 2
                    edited = old_text[: len(old_text) - half] + text[:half]
                    new = kept(anchors(edited))
                    said = (written(old), written(new), likeness(old, new), likeness(old, own))
                    edit = (text if copy else None, sha256(edited.encode()).hexdigest(), said)
                yield type_, (old_key, len(old_text), edit[1], *edit[2])
            last = (key, text, range_, ghost, own)
