"""Dense numbering and ranking without putting an unbounded group in one task.

Rows, or what orders them and a number that finds them again, are range-partitioned by
the wanted order and sorted inside each partition; `monotonically_increasing_id` then
holds (partition, position). They are settled, so that counting and numbering see the same
partitions, and the counts of the earlier partitions are added.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staffloom.operators.hotkeys import HOT_ROWS
from staffloom.operators.lookup import lookup
from staffloom.sources.workspace import Workspace

_POSITION_BITS = 33
# So many keys are put in order in one task.
FEW_ROWS = 250_000


def _slice(at: str) -> Column:
    return F.shiftright(at, _POSITION_BITS)


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    id_col: str,
    ws: Workspace,
    after: Column | None = None,
    row: str | None = None,
    keys_from: DataFrame | None = None,
    total: int | None = None,
) -> DataFrame:
    """All rows with `id_col` = `after` + 1, 2, 3, ... in `order` (NULL first).

    `row` names a number no two rows share, given with settled rows; without one the rows are
    settled here and get it. Only `order` and that number are put in order, read from `df` or
    from `keys_from`, a cheaper frame of the same rows, and the places find their rows by the
    number. So whatever made the rows runs once and wide rows are not sorted. Rows equal by
    `order` go by the number, which also keeps a crowd of copies from making one range. Up to
    `FEW_ROWS` rows, where the caller knows their `total`, are put in order in one task.
    `after` may use columns of `df`; without it numbers start at 1.
    """
    own = row is None
    if own:
        row = "_row"
        with_row = df.withColumn(row, F.monotonically_increasing_id())
        df, total = ws.settle_counted(with_row, "rows")
        keys_from = df
    narrow = (df if keys_from is None else keys_from).select(*order, F.col(row).alias("_id"))
    places = _places(narrow, [*order, "_id"], ws, total is not None and total <= FEW_ROWS)
    number = F.col("_place") if after is None else after + F.col("_place")
    met = df.join(places, F.col(row) == F.col("_id")).withColumn(id_col, number.cast("bigint"))
    return met.drop("_id", "_place", *([row] if own else []))


def _places(narrow: DataFrame, order: Sequence[str], ws: Workspace, few: bool) -> DataFrame:
    """`_id` and `_place`, from 1 on, of rows in `order`, whose last column is `_id`."""
    if few:
        nth = F.row_number().over(Window.orderBy(*order)).cast("bigint")
        return ws.settle(narrow.select("_id", nth.alias("_place")), "places")
    ranged = (
        narrow.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("_id", F.monotonically_increasing_id().alias("_at"))
    )
    settled = ws.settle(ranged, "places").withColumn("_slice", _slice("_at"))
    return _with_offsets(settled).select("_id", "_place")


def _with_offsets(settled: DataFrame) -> DataFrame:
    """Rows with (partition, position) in `_at` and the partition in `_slice`, and their
    place in the whole, `_place`: the counts of the earlier partitions are added."""
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: bounded by the number of tasks that wrote.
    offsets = (
        settled.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    position = F.col("_at").bitwiseAND((1 << _POSITION_BITS) - 1)
    return (
        settled.join(F.broadcast(offsets), "_slice")
        .withColumn("_place", (F.col("_before") + position + 1).cast("bigint"))
        .drop("_before")
    )


def ntile_of(place: Column, rows: Column, tiles: int) -> Column:
    """The `ntile(tiles)` a row at `place` (from 1) of `rows` falls in."""
    size, extra = F.floor(rows / tiles), rows % tiles
    long_part = extra * (size + 1)
    in_long = F.floor((place - 1) / (size + 1)) + 1
    in_short = extra + F.floor(F.try_divide(place - 1 - long_part, size)) + 1
    return F.when(place <= long_part, in_long).otherwise(in_short).cast("int")


def rank_in_groups(
    df: DataFrame,
    group: str,
    value: str,
    key: str,
    ws: Workspace,
    largest_group: int | None = None,
    hot_rows: int = HOT_ROWS,
    tiles: int = 4,
) -> DataFrame:
    """All rows with `value_rank` and `value_tile` of `value` inside `group`.

    `value_rank` is the dense rank by falling value (NULL last), `value_tile` the
    ntile by rising value (NULL first), ties broken by `key`; of rows that tie on the
    key too it is not said which comes first. No group is a group as well.

    Rows are counted per (group, value), and what is ranked are the values. They are looked
    up by the rows, which stay where they are; only rows of values that straddle the border
    of a tile are put in order by `key`. `df` is read for the counts, for the rows and for
    those few, so it should be settled or cheap. The caller may know the `largest_group`;
    beyond `hot_rows` values or rows of one value are put in order over ranges.
    """
    few = largest_group is not None and largest_group <= hot_rows
    counted = df.groupBy(F.col(group).alias("_group"), F.col(value).alias("_value")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    if few:
        placed = _placed_values(counted)
    else:
        counted, kinds = ws.settle_counted(counted, "values")
        placed = _placed_values(counted) if kinds <= hot_rows else _placed_in_ranges(counted, ws)
    low, high = F.col("_upto") - F.col("_n") + 1, F.col("_upto")
    placed = placed.select(
        F.struct("_group", "_value").alias("_of"),
        (F.col("_kinds") - F.col("_nth") + 1).cast("int").alias("value_rank"),
        ntile_of(low, F.col("_rows"), tiles).alias("_low"),
        ntile_of(high, F.col("_rows"), tiles).alias("_high"),
        (low - 1).alias("_before"),
        "_rows",
        "_n",
    )
    straddling = F.max(F.when(F.col("_low") < F.col("_high"), F.col("_n")))
    placed, largest_mixed = ws.settle_counted(placed, "placed", straddling)
    boxed = df.withColumn("_of", F.struct(F.col(group).alias("_group"), F.col(value).alias("_value")))
    found = lookup(boxed, placed, ["_of"], key, hot_rows)
    whole = found.filter("_low = _high").withColumn("value_tile", F.col("_low"))
    mixed = found.filter("_low < _high")
    if largest_mixed <= hot_rows:
        nth = F.row_number().over(Window.partitionBy("_of").orderBy(key))
        mixed = mixed.withColumn("_nth", nth)
    else:
        mixed = _nth_in_ranges(mixed, "_of", [key], ws)
    place = F.col("_before") + F.col("_nth")
    mixed = mixed.withColumn("value_tile", ntile_of(place, F.col("_rows"), tiles))
    columns = [*df.columns, "value_rank", "value_tile"]
    return whole.select(*columns).unionByName(mixed.select(*columns))


def _placed_values(counted: DataFrame) -> DataFrame:
    """Values with how many rows (`_upto`) and values (`_nth`) their group has up to them, and
    how many in all (`_rows`, `_kinds`)."""
    rising = Window.partitionBy("_group").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("_group")
    return counted.withColumns(
        {
            "_upto": F.sum("_n").over(rising),
            "_nth": F.count(F.lit(1)).over(rising),
            "_rows": F.sum("_n").over(whole),
            "_kinds": F.count(F.lit(1)).over(whole),
        }
    )


def _ranged(df: DataFrame, order: Sequence[str], ws: Workspace) -> DataFrame:
    """Rows settled in ranges of `order`, with (partition, position) and the partition."""
    wholly = [*order, "_from"]
    ranged = (
        df.withColumn("_from", F.spark_partition_id())
        .repartitionByRange(*wholly)
        .sortWithinPartitions(*wholly)
        .drop("_from")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    return ws.settle(ranged, "ranges").withColumn("_slice", _slice("_at"))


def _along(group: str):
    along = Window.partitionBy(group).orderBy("_slice")
    return along.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(group)


def _placed_in_ranges(counted: DataFrame, ws: Workspace) -> DataFrame:
    """`_placed_values` over ranges: counted inside the slice a range holds of a group, then
    shifted by what the group's earlier slices hold."""
    in_slice = Window.partitionBy("_group", "_slice").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    settled = _ranged(counted, ["_group", "_value"], ws)
    earlier, whole = _along("_group")
    slices = settled.groupBy("_group", "_slice").agg(
        F.sum("_n").alias("_r"), F.count(F.lit(1)).alias("_k")
    )
    slices = slices.select(
        F.col("_group").alias("_g"),
        F.col("_slice").alias("_s"),
        F.coalesce(F.sum("_r").over(earlier), F.lit(0)).alias("_r_before"),
        F.coalesce(F.sum("_k").over(earlier), F.lit(0)).alias("_k_before"),
        F.sum("_r").over(whole).alias("_rows"),
        F.sum("_k").over(whole).alias("_kinds"),
    )
    running = settled.withColumns(
        {"_r": F.sum("_n").over(in_slice), "_k": F.count(F.lit(1)).over(in_slice)}
    )
    same = F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_slice") == F.col("_s"))
    return running.join(slices, same).select(
        "_group",
        "_value",
        "_n",
        (F.col("_r") + F.col("_r_before")).alias("_upto"),
        (F.col("_k") + F.col("_k_before")).alias("_nth"),
        "_rows",
        "_kinds",
    )


def _nth_in_ranges(df: DataFrame, group: str, order: Sequence[str], ws: Workspace) -> DataFrame:
    """All rows with `_nth`, their place from 1 on in their group by `order`, over ranges."""
    settled = _ranged(df, [group, *order], ws)
    earlier, _ = _along(group)
    slices = (
        settled.groupBy(group, "_slice")
        .agg(F.min("_at").alias("_start"), F.count(F.lit(1)).alias("_k"))
        .select(
            F.col(group).alias("_g"),
            F.col("_slice").alias("_s"),
            "_start",
            F.coalesce(F.sum("_k").over(earlier), F.lit(0)).alias("_k_before"),
        )
    )
    same = F.col(group).eqNullSafe(F.col("_g")) & (F.col("_slice") == F.col("_s"))
    nth = F.col("_at") - F.col("_start") + 1 + F.col("_k_before")
    return settled.join(slices, same).withColumn("_nth", nth)


def dense_ranks(
    df: DataFrame, values: Mapping[str, Column], key: str, ws: Workspace, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """All rows with, for each name, the dense rank of its value by falling value, NULL last.

    The different values of all names are one table, ranked together in one go and settled
    once; each name's ranks are then looked up by value.
    """
    types = {name: df.select(value).schema[0].dataType for name, value in values.items()}

    def boxed(name: str) -> Column:
        # One field per name, so that no type is bent to another; only its own is filled.
        fields = [(values[n] if n == name else F.lit(None)).cast(types[n]).alias(n) for n in values]
        return F.struct(*fields)

    listed = [F.struct(F.lit(n).alias("_group"), boxed(n).alias("_value")) for n in values]
    counted = (
        df.select(F.inline(F.array(*listed)))
        .groupBy("_group", "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = _placed_in_ranges(counted, ws)
    rank = (F.col("_kinds") - F.col("_nth") + 1).cast("int")
    found = df.withColumns({f"_of_{n}": boxed(n) for n in values})
    for name in values:
        of = F.col("_value").alias(f"_of_{name}")
        ranks = ranked.filter(F.col("_group") == name).select(of, rank.alias(name))
        found = lookup(found, ranks, [f"_of_{name}"], key, hot_rows)
    return found.select(*df.columns, *values)


def previous_in_order(
    df: DataFrame, group: str, order: str, value: str, previous: str, ws: Workspace
) -> DataFrame:
    """All rows with `previous`: a struct of the `value` of the row before in `group`.

    The struct is NULL on a group's first row, so a NULL value before a row is told
    apart from no row before it. (group, order) must be unique.
    """
    ranged = (
        df.repartitionByRange(group, order)
        .sortWithinPartitions(group, order)
        .withColumn("_slice", F.spark_partition_id())
    )
    in_slice = Window.partitionBy(group, "_slice").orderBy(order)
    boxed = F.struct(F.col(value).alias("value"))
    settled = ws.settle(ranged.withColumn(previous, F.lag(boxed).over(in_slice)), "previous")
    along = Window.partitionBy(group).orderBy("_slice")
    carried = (
        settled.groupBy(group, "_slice")
        .agg(F.max_by(boxed, F.col(order)).alias("_last"))
        .withColumn("_carried", F.lag("_last").over(along))
        .select(group, "_slice", "_carried")
    )
    carried = ws.settle(carried.filter("_carried IS NOT NULL"), "carried")
    return (
        settled.join(carried, [group, "_slice"], "left")
        .withColumn(previous, F.coalesce(previous, "_carried"))
        .drop("_slice", "_carried")
    )
