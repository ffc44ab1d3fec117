"""Latest row per key, latest row overall, and marking the latest of each key."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staffloom.sources.workspace import broadcast_limit

# Row numbers are kept as bits, so many words of 64 of them in one row.
_WORDS, _WORD_BITS = 16, 6
_BLOCK_BITS = _WORD_BITS + 4
_BLOCK_BYTES = 160

EPOCH = dt.datetime(1970, 1, 1)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by `order`.

    The `= 1` filter right above the ranking lets Spark keep one row per key on
    the map side, so a key with many versions does not reach one task whole.
    """
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rn = 1").drop("_rn")


def latest_overall(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The first row of the whole table: a top-1 per task, then of those."""
    return df.orderBy(*order).limit(1)


def newest_first(name: str) -> Column:
    """A value that is the smaller the later the time; no time is the greatest."""
    age = F.lit(EPOCH).cast("timestamp_ntz") - F.col(name)
    return F.struct(F.col(name).isNull().alias("none"), age.alias("age"))


def mark_latest(
    df: DataFrame,
    key: str,
    order: Sequence[Column],
    row: str,
    flag: str = "is_latest",
    large: bool = False,
    total: int | None = None,
) -> DataFrame:
    """All rows, with `flag` true on exactly one row per key: the one of least `order`.

    `order` are values to be compared one after the other, NULL first; `row` names a number
    no two rows share, which decides between equals. No key is a key as well.

    Every task brings each of its keys down to one row before anything is shuffled, so a hot
    key costs no more than another. The numbers of the winners become bits, and the rows meet
    them by number: `df` stays where it is where its `total` of rows, if the caller knows it,
    lets the bits be broadcast, unless they are said to be a `large` number. Numbers should lie
    close together, as those of `monotonically_increasing_id` do. `df` is read twice, so it
    should be a settled table.
    """
    values = [value.alias(f"_{i}") for i, value in enumerate(order)]
    best = F.min(F.struct(*values, F.col(row).alias("row")))
    won = df.groupBy(key).agg(best.alias("_best")).select(F.col("_best.row").alias("_won"))
    marks = _as_bits(won)
    if large:
        marks = marks.hint("merge")
    elif total is not None and (total >> _BLOCK_BITS) * _BLOCK_BYTES <= broadcast_limit(df.sparkSession):
        marks = F.broadcast(marks)
    met = df.join(marks, F.shiftright(row, _BLOCK_BITS) == F.col("_block"), "left")
    number = F.col(row)
    word = F.shiftright(row, _WORD_BITS).bitwiseAND(_WORDS - 1).cast("int")
    bit = F.getbit(F.col("_words")[word], number.bitwiseAND((1 << _WORD_BITS) - 1).cast("int"))
    return met.withColumn(flag, F.coalesce(bit == 1, F.lit(False))).drop("_block", "_words")


def _as_bits(won: DataFrame) -> DataFrame:
    """Row numbers in `_won` as bits of `_words` by `_block`."""
    word = F.shiftright("_won", _WORD_BITS).bitwiseAND(_WORDS - 1)
    bit = F.expr(f"shiftleft(1L, cast(_won & {(1 << _WORD_BITS) - 1} AS int))")
    words = [F.bit_or(F.when(word == i, bit)) for i in range(_WORDS)]
    # Numbers are moved before they become bits: bits of half-filled blocks would be more bytes.
    placed = won.withColumn("_block", F.shiftright("_won", _BLOCK_BITS)).repartition("_block")
    return placed.groupBy("_block").agg(F.array(*words).alias("_words"))
