"""Lookup joins: many rows against a table with at most one row per key."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffloom.operators.hotkeys import HOT_ROWS, HotKeys, hot_keys_of, key_hash, with_parts
from staffloom.sources.workspace import is_broadcastable

# Rows without a key are scattered over so many values; they have no table rows to
# repeat, so the number costs nothing.
NULL_PARTS = 1 << 20
# A broadcast of so many keys is small whatever their size on disk said.
SMALL_KEYS = 1_000_000


def lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    spread_by: str,
    hot_rows: int = HOT_ROWS,
    keys_from: DataFrame | None = None,
    small_rows: bool | None = None,
    small_table: bool | None = None,
) -> DataFrame:
    """Left join on `keys`, which `table` holds at most once; NULL keys never match.

    - A table within the broadcast limit is left to Spark to broadcast; `rows` stay
      where they are.
    - Rows within the limit, by size and with at most `SMALL_KEYS` different keys, have
      their keys broadcast to cut the table down first; the table is read but not
      shuffled whole.
    - Beyond the limit on both sides the join is salted, see `_salted`.

    The planned sizes decide unless the caller has checked and says. Hot keys are
    looked for in `keys_from`, a cheaper frame in which the keys occur as they do
    in `rows`, where there is one.
    """
    small_tables = None if small_table is None else [small_table]
    return lookups(rows, [(table, keys)], spread_by, hot_rows, keys_from, small_rows, small_tables)


def lookups(
    rows: DataFrame,
    tables: Sequence[tuple[DataFrame, Sequence[str]]],
    spread_by: str,
    hot_rows: int = HOT_ROWS,
    keys_from: DataFrame | None = None,
    small_rows: bool | None = None,
    small_tables: Sequence[bool] | None = None,
) -> DataFrame:
    """`lookup` of several tables in turn, each by columns that `rows` has from the start.

    The hot keys of all joins that must be salted are looked for in one pass.
    """
    keys_from = rows if keys_from is None else keys_from
    small_tables = [is_broadcastable(t) for t, _ in tables] if small_tables is None else small_tables
    ways = [_way(rows, keys, small, small_rows) for (_, keys), small in zip(tables, small_tables)]
    salted = [keys for (_, keys), way in zip(tables, ways) if way == "salted"]
    hashes = [F.when(~_unmatched(keys), key_hash(*map(F.col, keys))) for keys in salted]
    hot = iter(hot_keys_of(keys_from, hashes, hot_rows) if hashes else ())
    for (table, keys), way in zip(tables, ways):
        if way == "salted":
            rows = _salted(rows, table, keys, spread_by, next(hot))
            continue
        if way == "cut":
            # A batch known to be small is broadcast with its repeats, which saves a shuffle.
            wanted = rows.select(*keys).dropna() if small_rows else _wanted(rows, keys)
            table = table.join(F.broadcast(wanted), list(keys), "left_semi")
        rows = rows.join(table, list(keys), "left")
    return rows


def _wanted(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.select(*keys).dropna().distinct()


def _unmatched(keys: Sequence[str]) -> Column:
    return reduce(operator.or_, [F.col(k).isNull() for k in keys])


def _way(rows: DataFrame, keys, small_table: bool, small_rows: bool | None) -> str:
    if small_table:
        return "plain"
    if is_broadcastable(rows) if small_rows is None else small_rows:
        # Alike rows pack into few bytes: what counts is the number of keys.
        if small_rows or _wanted(rows, keys).limit(SMALL_KEYS + 1).count() <= SMALL_KEYS:
            return "cut"
    return "salted"


def _salted(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], spread_by: str, hot: HotKeys
) -> DataFrame:
    """Both sides shuffle. A key holding many rows is cut into parts by `spread_by`
    and its one table row repeated per part; rows with a NULL key need no partner and
    are spread over all partitions."""
    unmatched, spread = _unmatched(keys), F.xxhash64(spread_by)
    parts = F.when(unmatched, F.lit(NULL_PARTS)).otherwise(F.col("_parts"))
    left = with_parts(rows, hot, keys, unmatched, spread)
    left = left.withColumn("_part", F.pmod(spread, parts).cast("int")).drop("_parts")
    right = with_parts(table, hot, keys, unmatched, key_hash(*map(F.col, keys)))
    right = right.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return left.join(right.drop("_parts"), [*keys, "_part"], "left").drop("_part")
