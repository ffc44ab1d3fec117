"""Finding keys that hold too many rows for one task, and spreading them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffloom.sources.workspace import Workspace

# A key below this many rows is left to one task.
HOT_ROWS = 2_000_000
# The tasks are sketched in SKETCH_FAN parts, each naming its PART_KEYS most frequent
# keys, or more where more keys than that can be hot, up to what a sketch can hold.
SKETCH_FAN = 512
PART_KEYS, MOST_PART_KEYS = 4_096, 1 << 18
# So many hot keys are listed on the driver and in expressions. Where there can be more, they
# are a table.
LISTED_KEYS = 4_096


def key_hash(*keys: Column) -> Column:
    """One number per key; keys that collide are merely spread together."""
    return F.xxhash64(*keys)


def hot_parts(
    df: DataFrame, keys: Sequence[Column], hot_rows: int = HOT_ROWS
) -> dict[int, int]:
    """Hash of each key with more than `hot_rows` rows -> how many parts to cut it into.

    NULL keys count as a key.
    """
    return hot_parts_of(df, [key_hash(*keys)], hot_rows)[0]


def hot_parts_of(
    df: DataFrame, hashes: Sequence[Column], hot_rows: int = HOT_ROWS, rows: int | None = None
) -> list[dict[int, int]]:
    """For each of several keys, given as its hash: hot hash -> how many parts.

    A part is meant to hold at most `hot_rows` / 2 rows, so all parts together number
    no more than the rows of the table over that, whatever the skew.

    A table of up to `hot_rows` rows has no hot key; rows are counted, not bytes, for
    alike rows pack into next to nothing. Beyond that all keys are counted in one pass by
    sketches. Every task fills one of bounded size for each key. Sketches are merged per part
    of the tasks, so that no task merges those of all others, and their counts are added up.
    All keys above `hot_rows` reach the driver as numbers: no more than rows / `hot_rows` of
    them for each key; where these may be many, see `hot_keys_of`. Rows whose hash is NULL are
    left out. The answer steers where rows go, never what the result is, so a key the sketch
    estimates badly costs time and nothing else. The caller may know how many `rows` there are.
    """
    rows = df.count() if rows is None else rows
    if rows <= hot_rows:
        return [{} for _ in hashes]
    listed = min(max(PART_KEYS, 1 << (2 * rows // hot_rows).bit_length()), MOST_PART_KEYS)
    named = [h.alias(f"h{i}") for i, h in enumerate(hashes)]
    sketch = "approx_top_k({0}, {1}, {2}) FILTER (WHERE {0} IS NOT NULL)"
    sketched = (
        df.select(*named, (F.spark_partition_id() % SKETCH_FAN).alias("part"))
        .groupBy("part")
        .agg(
            *[
                F.expr(sketch.format(f"h{i}", listed, 2 * listed)).alias(f"top{i}")
                for i in range(len(hashes))
            ]
        )
    )
    tops = [F.struct(F.lit(i).alias("of"), F.col(f"top{i}").alias("top")) for i in range(len(hashes))]
    hot = (
        sketched.select(F.explode(F.array(*tops)).alias("t"))
        .select("t.of", F.inline("t.top"))
        .groupBy("of", "item")
        .agg(F.sum("count").alias("rows"))
        .filter(F.col("rows") > hot_rows)
    )
    found = hot.agg(F.collect_list(F.struct("of", "item", "rows"))).first()[0]
    parts: list[dict[int, int]] = [{} for _ in hashes]
    for of, item, n in found:
        parts[of][item] = 1 << (2 * n // hot_rows).bit_length()
    return parts


@dataclass(frozen=True)
class HotKeys:
    """The hot hashes of one key: those `listed` with their parts, and a settled table of the
    others, (`_hash`, `_parts`), where there are too many to list."""

    listed: dict[int, int] = field(default_factory=dict)
    others: DataFrame | None = None


def hot_keys_of(
    df: DataFrame, hashes: Sequence[Column], hot_rows: int = HOT_ROWS
) -> list[HotKeys]:
    """`hot_parts_of` for any number of hot keys, none of which is left out.

    Up to `LISTED_KEYS` that can be hot are found by sketches and listed. Where there can be
    more, all keys are counted, in tables, and only keys with more than one in `LISTED_KEYS` of
    all rows are listed: so few that the list is bounded, and each of the others so small that
    one task can take it while it meets its number of parts.
    """
    rows = df.count()
    if rows // hot_rows <= LISTED_KEYS:
        return [HotKeys(listed) for listed in hot_parts_of(df, hashes, hot_rows, rows)]
    boxed = [F.struct(F.lit(i).alias("of"), h.alias("_hash")) for i, h in enumerate(hashes)]
    counted = (
        df.select(F.inline(F.array(*boxed)))
        .filter("_hash IS NOT NULL")
        .groupBy("of", "_hash")
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > hot_rows)
    )
    # The power of two above twice the rows over `hot_rows`: bin() has one digit per power.
    power = F.length(F.bin(F.expr(f"rows * 2 div {hot_rows}")))
    sized = counted.withColumn("_parts", F.pow(F.lit(2), power).cast("int"))
    hot = Workspace(df.sparkSession).settle(sized, "hot-keys")
    heavy = F.col("rows") > rows // LISTED_KEYS
    found = hot.filter(heavy).agg(F.collect_list(F.struct("of", "_hash", "_parts"))).first()[0]
    listed: list[dict[int, int]] = [{} for _ in hashes]
    for of, item, parts in found:
        listed[of][item] = parts
    others = hot.filter(~heavy)
    return [
        HotKeys(listed[i], others.filter(F.col("of") == i).select("_hash", "_parts"))
        for i in range(len(hashes))
    ]


def with_parts(
    df: DataFrame, hot: HotKeys, keys: Sequence[str], unmatched: Column, spread: Column
) -> DataFrame:
    """All rows with `_parts`, into how many parts their key is cut: 1 unless it is hot.

    Rows that need not meet the table of hot keys, `unmatched` ones or by a listed key, go by
    `spread` instead of their key.
    """
    columns = [F.col(k) for k in keys]
    parts = parts_of(hot.listed, *columns)
    if hot.others is None:
        return df.withColumn("_parts", parts)
    apart = unmatched | (parts > 1)
    hashed = df.withColumn("_hash", F.when(apart, spread).otherwise(key_hash(*columns)))
    met = hashed.join(hot.others, "_hash", "left").drop("_hash")
    return met.withColumn("_parts", F.when(apart, parts).otherwise(F.coalesce("_parts", F.lit(1))))


def parts_of(hot: Mapping[int, int], *keys: Column) -> Column:
    """Into how many parts the key of a row is cut: 1 unless it is hot.

    Part counts are powers of two, so a handful of hash lists says it all.
    """
    by_parts: dict[int, list[int]] = {}
    for item, parts in hot.items():
        by_parts.setdefault(parts, []).append(item)
    cut = [
        F.when(key_hash(*keys).isin(items), F.lit(parts)) for parts, items in by_parts.items()
    ]
    return F.coalesce(*cut, F.lit(1))
