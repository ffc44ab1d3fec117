"""SimHash near-duplicates, found by hashing balls that meet in the middle.

Two fingerprints at most 2r bits apart have a value between them that is at most r bits
from either. So every distinct fingerprint emits all values within r bits, rows meet by
value, and whoever shares one is a candidate; the distance is verified. All that meet at a
value lie within r bits of it, so they are pairwise within 2r bits and there are no more
than the ball holds (65 for r = 1): a bucket is bounded by its nature, and linking each
member to the next one loses no connection. Copies of a text are one fingerprint before
anything is emitted.

Nulls: a NULL text is an empty text; texts without words have fingerprint 0 and are linked
like any other. A NULL key is a key of its own, above all others. Repeated rows give
repeated rows. Empty tables give empty results. Other columns are not looked at.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staffloom.llm.components import components
from staffloom.sources.workspace import Workspace

SEED = 42
BITS = 64
# Hashes whose bits are counted at once.
CHUNK = 1 << 14


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64 bits: a bit is set if it is set in over half the shingles' XXH64.

    Letters A-Z are lowered, words are split at ASCII white space, shingles keep their
    repeats; fewer words than `shingle` make one shingle, no words make 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = min(shingle, len(words)) - 1
    spans = zip(starts[: len(words) - last].tolist(), ends[last:].tolist())
    hash_of = xxhash.xxh64_intdigest
    hashes = np.array([hash_of(joined[a:b], SEED) for a, b in spans], "<u8")
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(
    df: DataFrame, text: str = "text", shingle: int = 3, out: str = "fingerprint"
) -> DataFrame:
    """`df` with the fingerprint of `text` as a signed 64-bit number in column `out`."""
    if out in df.columns:
        df = df.drop(out)
    names = df.columns

    def run(batches):
        for batch in batches:
            texts = batch.column(names.index(text)).to_pylist()
            found = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*names, out])

    return df.mapInArrow(run, df.withColumn(out, F.lit(0).cast("bigint")).schema)


def ball(radius: int) -> list[int]:
    """Masks of up to `radius` set bits, as signed numbers."""
    masks = [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(BITS), r)]
    return np.array(masks, np.uint64).view(np.int64).tolist()


def links(prints: DataFrame, max_bits: int = 2, of: str = "fingerprint") -> DataFrame:
    """Edges (a, b) between distinct fingerprints at most `max_bits` apart.

    Not every such pair, but enough that whoever is in reach of each other is connected.
    `max_bits` must be even, see the module's text.
    """
    if max_bits < 0 or max_bits % 2:
        raise ValueError("max_bits must be even and not negative")
    masks = ball(max_bits // 2)
    each = prints.select(F.col(of).alias("b")).distinct()
    variants = each.select("b", F.explode(F.lit(masks)).alias("mask")).select(
        "b", F.col("b").bitwiseXOR(F.col("mask")).alias("variant")
    )
    before = F.lag("b").over(Window.partitionBy("variant").orderBy("b"))
    met = variants.select(before.alias("a"), "b").filter("a IS NOT NULL").distinct()
    return met.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def groups(prints: DataFrame, ws: Workspace, max_bits: int = 2, key: str = "doc_id") -> DataFrame:
    """Per distinct fingerprint its `group`, the fingerprint that names the group, and
    `first`, the least `key` in the group (NULL counts as the greatest).

    `prints` (key, fingerprint) should be settled: it is read twice.
    """
    label = components(links(prints, max_bits), ws)
    each = prints.groupBy("fingerprint").agg(F.min(key).alias("first"))
    named = each.join(label, each["fingerprint"] == label["node"], "left").select(
        "fingerprint", F.coalesce("component", "fingerprint").alias("group"), "first"
    )
    named = ws.settle(named, "named")
    least = named.groupBy("group").agg(F.min("first").alias("first"))
    return named.drop("first").join(least, "group")


def near_duplicates(
    df: DataFrame,
    ws: Workspace,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
) -> DataFrame:
    """Per row of `df`: key, fingerprint (16 hex digits) and component_id, the least key
    of the row's group."""
    rows = fingerprints(df.select(F.col(key).alias("key"), F.col(text).alias("text")), "text", shingle)
    prints = ws.settle(rows.select("key", "fingerprint"), "prints")
    found = groups(prints, ws, max_bits, "key")
    return prints.join(found, "fingerprint").select(
        F.col("key").alias(key),
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.col("first").alias("component_id"),
    )


def one_of_each(
    df: DataFrame,
    ws: Workspace,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
) -> DataFrame:
    """The rows of `df` with one row of each group: that of the least key, then of the
    least hash of the text. Columns and values are as they were.

    Who stays is decided on keys, hashes and row numbers; the rows with their texts are
    written once, so that the numbers are fixed, and meet the decision in one join, which
    is a sorted one at every size: who stays grows with the documents.
    """
    print_of, number = "__fingerprint", "__row"
    marked = fingerprints(df, text, shingle, print_of).withColumn(number, F.monotonically_increasing_id())
    marked = ws.settle(marked, "marked")
    order = F.struct(F.col(key).isNull(), F.col(key), F.xxhash64(text), F.col(number).alias("row"))
    prints = ws.settle(marked.select(order.alias("key"), F.col(print_of).alias("fingerprint")), "prints")
    stays = groups(prints, ws, max_bits, "key").select(F.col("first.row").alias(number)).distinct()
    stays = ws.settle(stays, "stays").hint("merge")
    return marked.join(stays, number, "left_semi").select(*df.columns)
