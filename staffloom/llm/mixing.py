"""Mixing sources to target weights by Pareto order sampling.

Each source is due a share of all words by its weight, but no more than `cap` times its
own; what it cannot take is shared again by weight among the others (`fill`). Inside a
source longer documents get better odds: the weight of a document is the number of binary
digits of its size, so documents of one source and digit count form a group. The words due
are shared among the groups in the same way, which gives every document of a group the
same expected number of copies, at most `cap`. Its whole part is allotted for certain; the
fraction is the inclusion odds of a Pareto sample: rank by u/(1-u) over p/(1-p), u a fixed
number from the key and the text, and take the front of the order whose words come nearest
to what is still due.

No source is sorted whole. The order is cut into `BINS` even bins per source, the words of
bins are added up, and only the one bin in which the cut falls is looked at: a source's
rows over `BINS` on average, brought down to their different places in the order before
they are ranked. Equal rows share a place, and the cut may fall between them: of the place
it falls in, the tasks' counts say in whose part, and only that part is numbered. The cut
is then a bound per source, so that any row is judged by itself. Nothing but tables of
sources, groups and bins is joined to the rows; they are settled, so Spark broadcasts them
when they are small by measure.

Nulls: a NULL text has size 0; a NULL source is a source, the last in order; a NULL key is
a key of its own. Of equal rows it is not said which are taken, only how many, so reruns
give the same rows. Repeated keys with other texts are judged one by one. Documents of size 0
are taken with 0 words (`expanded` keeps one row for each whole copy their group gets).
Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staffloom.sources.workspace import Workspace

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
CAP = 3
BINS = 1 << 12


def measured(df: DataFrame, key: str, text: str, source: str) -> dict[str, Column]:
    """What the rows are judged by: key as text, source, size, u, and a number of the row
    (task and position) that holds once the rows are settled."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    said = F.concat(name, F.lit("\n"), F.coalesce(F.col(text), F.lit("")))
    drawn = F.conv(F.substring(F.md5(said), 1, 13), 16, 10).cast("bigint")
    return {
        "m_key": name,
        "m_source": F.col(source),
        "m_size": size,
        "m_u": (drawn + F.lit(0.5)) / F.lit(float(1 << 52)),
        "m_id": F.monotonically_increasing_id(),
    }


def digits(size: Column) -> Column:
    return F.length(F.bin(size)).cast("bigint")


def fill(table: DataFrame, within: Sequence[str], total: str, weight: str, cap: str, out: str) -> DataFrame:
    """Share `total` by `weight` inside `within`, nobody more than `cap`.

    Taken in order of cap / weight, the level at a row is what is left once those before
    it have their caps, by the weight that is left; the greatest level is the one at which
    all is shared. Without any weight the level is 0.
    """
    order = Window.partitionBy(*within).orderBy(F.try_divide(cap, weight).asc_nulls_first(), cap)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col(total) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    level = F.coalesce(F.try_divide(left, F.sum(weight).over(onward)), F.lit(0.0))
    table = table.withColumn("m_level", level)
    most = F.max("m_level").over(Window.partitionBy(*within))
    return table.withColumn(out, F.least(F.col(cap).cast("double"), F.col(weight) * most)).drop("m_level")


def plan(
    rows: DataFrame, ws: Workspace, weights: Sequence[int] = WEIGHTS, cap: int = CAP, bins: int = BINS
) -> DataFrame:
    """Per source and group: sizes, target, whole copies, odds, and where the order is cut.

    `rows` holds what `measured` says, settled. Sources are ranked in one task: one row
    per source. Bins are summed per source: `bins` rows each at most.
    """
    groups = ws.settle(
        rows.groupBy("m_source", digits(F.col("m_size")).alias("m_digits")).agg(
            F.sum("m_size").alias("m_words")
        ),
        "groups",
    )
    place = F.row_number().over(Window.orderBy(F.col("m_source").asc_nulls_last())) - 1
    sources = groups.groupBy("m_source").agg(F.sum("m_words").alias("m_source_size"))
    sources = sources.withColumns(
        {
            "m_weight": F.lit([int(w) for w in weights])[(place % len(weights)).cast("int")].cast("bigint"),
            "m_cap": F.col("m_source_size") * cap,
            "m_all": F.sum("m_source_size").over(Window.partitionBy()),
        }
    )
    sources = fill(sources, [], "m_all", "m_weight", "m_cap", "m_target")
    sources = sources.select(F.col("m_source").alias("s"), "m_source_size", "m_target")
    # Caps and weights in words, so that what a group gets is in words too.
    due = groups.join(sources, F.col("m_source").eqNullSafe(F.col("s"))).drop("s")
    due = due.withColumns(
        {"m_cap": F.col("m_words") * cap, "m_weight": F.col("m_words") * F.col("m_digits")}
    )
    due = fill(due, ["m_source"], "m_target", "m_weight", "m_cap", "m_due")
    copies = F.coalesce(F.try_divide("m_due", "m_words"), F.lit(0.0))
    due = due.withColumn("m_whole", F.floor(copies).cast("bigint")).withColumn(
        "m_odds", copies - F.col("m_whole")
    )
    of = Window.partitionBy("m_source")
    rest = F.col("m_target") - F.sum(F.col("m_whole") * F.col("m_words")).over(of)
    drawn = F.sum(F.when(F.col("m_odds") > 0, F.col("m_words")).otherwise(0)).over(of)
    due = due.withColumns({"m_rest": rest, "m_share": F.try_divide(rest, drawn)}).select(
        "m_source", "m_digits", "m_source_size", "m_target", "m_whole", "m_odds", "m_rest", "m_share"
    )
    due = ws.settle(due, "due")

    ranked = _ranked(_beside(rows, due), bins).filter("m_q IS NOT NULL")
    along = Window.partitionBy("m_source").orderBy("m_bin")
    summed = ranked.groupBy("m_source", "m_bin").agg(
        F.sum("m_size").alias("m_words"), F.max("m_rest").alias("m_due")
    )
    summed = summed.withColumn("m_upto", F.sum("m_words").over(along))
    # The first bin that reaches what is due, also if it ends just there.
    cut = summed.filter("m_upto >= m_due AND m_upto - m_words < m_due").select(
        F.col("m_source").alias("s"), F.col("m_bin").alias("b"), (F.col("m_upto") - F.col("m_words")).alias("m_before")
    )
    cut = ws.settle(cut, "cut")
    same = F.col("m_source").eqNullSafe(F.col("s"))
    opened = ranked.join(cut, same & (F.col("m_bin") == F.col("b")))
    ends = cut.join(_last_taken(opened, ws), F.col("s").eqNullSafe(F.col("t")), "left")
    ends = ends.select("s", F.col("b").alias("m_open"), "m_last")
    whole = due.join(ends, same, "left").drop("s")
    return ws.settle(whole, "plan")


def _last_taken(opened: DataFrame, ws: Workspace) -> DataFrame:
    """Per source (`t`) the last row taken of its open bin, `m_last`: place and number."""
    place = ["m_source", "m_q", "m_key", "m_size"]
    kinds = opened.groupBy(*place).agg(
        F.count(F.lit(1)).alias("m_n"), F.max("m_rest").alias("m_rest"), F.max("m_before").alias("m_before")
    )
    before = Window.partitionBy("m_source").orderBy(*place[1:]).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.col("m_before") + F.coalesce(F.sum(F.col("m_n") * F.col("m_size")).over(before), F.lit(0))
    size, n = F.col("m_size"), F.col("m_n")
    half = F.floor((2 * (F.col("m_rest") - F.col("m_before")) + size) / (2 * size)).cast("bigint")
    all_fit = 2 * (F.col("m_before") + n * size) - size <= 2 * F.col("m_rest")
    taken = F.when(all_fit, n).otherwise(F.least(n - 1, F.greatest(half, F.lit(0))))
    kinds = kinds.withColumn("m_before", earlier).withColumn("m_taken", taken).filter("m_taken > 0")
    last = kinds.groupBy("m_source").agg(F.max(F.struct(*place[1:], "m_taken")).alias("m_at"))
    last = ws.settle(last.select(F.col("m_source").alias("t"), "m_at"), "last-places")
    # Of the rows at that place, those up to the one with number `m_taken`.
    same = F.col("m_source").eqNullSafe(F.col("t"))
    for name in place[1:]:
        same &= F.col(name) == F.col(f"m_at.{name}")
    there = opened.join(last, same).select("t", "m_at", "m_id", F.shiftright("m_id", 33).alias("m_task"))
    tasks = there.groupBy("t", "m_task").agg(F.count(F.lit(1)).alias("m_n"), F.max("m_at.m_taken").alias("m_taken"))
    along = Window.partitionBy("t").orderBy("m_task")
    tasks = tasks.withColumn("m_upto", F.sum("m_n").over(along))
    tasks = tasks.filter("m_upto >= m_taken AND m_upto - m_n < m_taken").select(
        F.col("t").alias("o"), F.col("m_task").alias("m_in"), (F.col("m_taken") - F.col("m_upto") + F.col("m_n")).alias("m_nth")
    )
    part = there.join(tasks, F.col("t").eqNullSafe(F.col("o")) & (F.col("m_task") == F.col("m_in")))
    nth = F.row_number().over(Window.partitionBy("t").orderBy("m_id"))
    one = part.withColumn("m_place", nth).filter("m_place = m_nth")
    end = F.struct("m_at.m_q", "m_at.m_key", "m_at.m_size", "m_id")
    return one.select("t", end.alias("m_last"))


def _beside(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Rows beside the row of their source and group."""
    keyed = table.withColumnsRenamed({"m_source": "s", "m_digits": "d"})
    same = F.col("m_source").eqNullSafe(F.col("s")) & (digits(F.col("m_size")) == F.col("d"))
    return rows.join(keyed, same, "left").drop("s", "d")


def _ranked(rows: DataFrame, bins: int) -> DataFrame:
    """Rows with their place in the order, `m_q`, and its bin; NULL without odds."""
    u, p, share = F.col("m_u"), F.col("m_odds"), F.col("m_share")
    q = F.when((p > 0) & (F.col("m_size") > 0), (u / (1 - u)) / (p / (1 - p)))
    # A document of the source's mean odds has even chances for every bin.
    even = F.col("m_q") * F.try_divide(share, 1 - share)
    bin_of = F.floor(F.coalesce(even / (1 + even), F.lit(0.0)) * bins)
    return rows.withColumn("m_q", q).withColumn("m_bin", F.when(F.col("m_q").isNotNull(), bin_of))


def allotted(rows: DataFrame, table: DataFrame, bins: int = BINS) -> DataFrame:
    """Rows (with what `measured` says) beside the plan and `m_copies`."""
    ranked = _ranked(_beside(rows, table), bins)
    # Without an open bin a source takes all that have odds, or none if nothing is due.
    inside = F.when(F.col("m_open").isNull(), F.col("m_rest") > 0).otherwise(
        (F.col("m_bin") < F.col("m_open"))
        | (
            (F.col("m_bin") == F.col("m_open"))
            & (F.struct("m_q", "m_key", "m_size", "m_id") <= F.col("m_last"))
        )
    )
    drawn = F.when(F.col("m_q").isNotNull() & inside, 1).otherwise(0)
    return ranked.withColumn("m_copies", (F.col("m_whole") + drawn).cast("bigint"))


def mixed(
    df: DataFrame,
    ws: Workspace,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    cap: int = CAP,
    bins: int = BINS,
) -> DataFrame:
    """Per row: key, size, source_size, target, taken (words the mix takes of it)."""
    made = measured(df, key, text, source)
    rows = ws.settle(df.select(F.col(key).alias("k"), *(c.alias(n) for n, c in made.items())), "sizes")
    out = allotted(rows, plan(rows, ws, weights, cap, bins), bins)
    return out.select(
        F.col("k").alias(key),
        F.col("m_size").alias("size"),
        F.col("m_source_size").alias("source_size"),
        F.col("m_target").alias("target"),
        (F.col("m_copies") * F.col("m_size")).alias("taken"),
    )


def expanded(
    df: DataFrame,
    ws: Workspace,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    cap: int = CAP,
    bins: int = BINS,
) -> DataFrame:
    """The mix itself: every row of `df` as often as it is taken, columns as they were.

    The rows are settled whole, since the numbers that tell equal rows apart are theirs.
    """
    made = measured(df, key, text, source)
    held = F.struct(*df.columns).alias("m_row")
    rows = ws.settle(df.select(held, *(c.alias(n) for n, c in made.items())), "measured")
    wide = allotted(rows, plan(rows.drop("m_row"), ws, weights, cap, bins), bins)
    times = F.explode(F.sequence(F.lit(1), F.col("m_copies").cast("int")))
    kept = wide.filter("m_copies > 0").select("m_row", times.alias("m_time"))
    return kept.select("m_row.*")


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(doc_id::VARCHAR, '') AS k,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || chr(10) || coalesce(text, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents),
rows AS (SELECT *, length(bin(size))::BIGINT AS digits FROM sized),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum(size)::BIGINT * 3 AS cap,
    ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM rows GROUP BY source),
levels AS (
  SELECT *, (sum(source_size) OVER ()::BIGINT
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, cap ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
    / sum(weight) OVER (ORDER BY cap / weight, cap ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS level
  FROM per_source),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, weight * max(level) OVER ()) AS target FROM levels),
summed AS (
  SELECT r.source, r.digits, t.source_size, t.target, sum(r.size)::BIGINT AS words
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source GROUP BY ALL),
grouped AS (SELECT *, words * 3 AS cap, words * digits AS weight FROM summed),
group_levels AS (
  SELECT *, coalesce((target
      - coalesce(sum(cap) OVER (PARTITION BY source ORDER BY CASE WHEN weight > 0 THEN cap / weight END NULLS FIRST, cap
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
    / nullif(sum(weight) OVER (PARTITION BY source ORDER BY CASE WHEN weight > 0 THEN cap / weight END NULLS FIRST, cap
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT, 0), 0) AS level
  FROM grouped),
due AS (
  SELECT *, coalesce(least(cap::DOUBLE, weight * max(level) OVER (PARTITION BY source)) / nullif(words, 0), 0) AS copies
  FROM group_levels),
odds AS (SELECT *, floor(copies)::BIGINT AS whole, copies - floor(copies)::BIGINT AS p FROM due),
rests AS (SELECT *, target - (sum(whole * words) OVER (PARTITION BY source))::BIGINT AS rest FROM odds),
ranked AS (
  SELECT r.doc_id, r.k, r.size, g.source, g.source_size, g.target, g.whole, g.rest,
    CASE WHEN g.p > 0 AND r.size > 0 THEN (r.u / (1 - r.u)) / (g.p / (1 - g.p)) END AS q
  FROM rows r JOIN rests g ON r.source IS NOT DISTINCT FROM g.source AND r.digits = g.digits),
cut AS (
  SELECT *, CASE WHEN q IS NOT NULL THEN
    (sum(size) FILTER (q IS NOT NULL) OVER (PARTITION BY source ORDER BY q NULLS LAST, k, size
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT END AS upto
  FROM ranked)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN 2 * upto - size <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM cut
"""
