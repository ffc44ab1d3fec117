"""Quality rules whose limits come from the data of each language and source.

Every document is measured once (`measures`). For each of four signals a mergeable
quantile sketch is kept per language and source: counts in bins whose width grows with
the value, so a quantile is off by less than 1/32 of itself and merging two sketches is
adding counts. A limit lies `REACH` interquartile ranges beyond the quartile, the range
taken as at least the signal's `least` spread, so that a group in which nearly all are
alike does not refuse the rest. A group of fewer than `ENOUGH` documents takes the sketch
of its language, and that too being small, of all: they are merged from the same counts.
The limits, one row per group, are joined to the measures and every rule must hold.

Documents that fail the base rules have no say in the sketches. Nulls: a NULL text has no
words and fails; NULL language or source is a group of its own; a NULL key is passed
through. Repeated rows are judged one by one. Empty tables give empty results. Columns of
other names are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staffloom.llm.spans import let, words
from staffloom.sources.workspace import Workspace

SYMBOLS = r"[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED = 50
# Bins per doubling of a value: 2 ** FINE.
FINE = 5
REACH = 3
ENOUGH = 200
# Signal -> (numerator, denominator, scale, least spread, judged from below too).
SIGNALS = {
    "word_length": ("word_chars", "n_words", 100, 60, True),
    "symbols": ("n_symbols", "word_chars", 10_000, 100, False),
    "line_copies": ("n_dup_lines", "n_lines", 1_000, 150, False),
    "repeats": ("n_repeat_words", "n_words", 1_000, 110, False),
}


def _repeated(hashes: Column) -> Column:
    """How many words stand in three-word windows that occur twice or more.

    Windows sorted by hash have their equals beside them; the places of those that have
    equals, in order, each add what they cover beyond the one before.
    """

    def places(found: Column) -> Column:
        size = F.size(found)

        def has_equal(x: Column, i: Column) -> Column:
            before = F.when(i > 0, found[F.greatest(i - 1, F.lit(0))]["h"] == x["h"])
            after = F.when(i + 1 < size, found[F.least(i + 1, size - 1)]["h"] == x["h"])
            return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

        return F.sort_array(F.transform(F.filter(found, has_equal), lambda x: x["at"]))

    def covered(at: Column) -> Column:
        gaps = F.transform(
            at, lambda x, i: F.when(i > 0, F.least(x - at[F.greatest(i - 1, F.lit(0))], F.lit(3))).otherwise(3)
        )
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, x: a + x)

    marked = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    all_differ = F.size(F.array_distinct(hashes)) == F.size(hashes)
    return F.when(all_differ, F.lit(0).cast("bigint")).otherwise(
        let(F.sort_array(marked), lambda found: let(places(found), covered))
    )


def measures(df: DataFrame, key: str, text: str, lang: str, source: str) -> DataFrame:
    """key, lang, source and the counts of each row's whole text. Windows are compared by
    64-bit hashes of their words."""
    rows = df.select(
        F.col(key).alias("key"),
        F.col(lang).alias("lang"),
        F.col(source).alias("source"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )

    def windows(w: Column) -> Column:
        last = F.size(w) - 3
        return F.when(
            last >= 0,
            F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])),
        ).otherwise(F.array().cast("array<bigint>"))

    counted = let(
        words(F.col("text")),
        lambda w: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            let(windows(w), _repeated).alias("n_repeat_words"),
        ),
    )
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    line_counts = let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("bigint").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        ),
    )
    symbols = F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint")
    found = rows.select(
        "key", "lang", "source", counted.alias("w"), line_counts.alias("l"), symbols.alias("n_symbols")
    )
    return found.select("key", "lang", "source", "w.*", "l.*", "n_symbols")


def base_failed() -> Column:
    few = F.col("n_words") < LEAST_WORDS
    return few | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def signal(name: str) -> Column:
    above, below, scale, _, _ = SIGNALS[name]
    return F.coalesce(F.expr(f"try_divide({scale} * {above}, {below})"), F.lit(0.0)).cast("bigint")


def bin_of(value: Column) -> Column:
    """The bin of a whole number from 0: exact up to 2 ** FINE, then as many per doubling."""
    up = F.greatest(F.length(F.bin(value)) - (FINE + 1), F.lit(0))
    return (up * (1 << FINE) + F.call_function("shiftright", value, up)).cast("bigint")


def bin_floor(bin_: Column) -> Column:
    """The least value of a bin."""
    up = F.greatest(F.floor(bin_ / (1 << FINE)) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", bin_ - up * (1 << FINE), up)


def limits(rows: DataFrame, ws: Workspace) -> DataFrame:
    """Per language and source: least and greatest value of each signal.

    The sketches are one table of (lang, source, signal, bin, count). Merging over sources
    and over all is a sum of counts by `grouping sets`. What a window holds together is one
    sketch, a few hundred bins.
    """
    names = [*SIGNALS]
    long = rows.filter(~F.col("base_failed")).select(
        "lang", "source", F.posexplode(F.array(*(bin_of(signal(n)) for n in names))).alias("signal", "bin")
    )
    sketch = ws.settle(
        long.groupBy("lang", "source", "signal", "bin").agg(F.count(F.lit(1)).alias("n")), "sketches"
    )
    groups = rows.select("lang", "source").distinct()
    by_lang = sketch.groupBy("lang", "signal", "bin").agg(F.sum("n").alias("n"))
    by_all = by_lang.groupBy("signal", "bin").agg(F.sum("n").alias("n"))
    own, wider, widest = (
        _quartiles(table, keys, f"{level}_")
        for level, (table, keys) in enumerate(
            [(sketch, ["lang", "source"]), (by_lang, ["lang"]), (by_all, [])]
        )
    )
    own = own.withColumnsRenamed({"lang": "gl", "source": "gs"})
    wider = wider.withColumnRenamed("lang", "wl")
    each = groups.withColumn("signal", F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1))))
    met = (
        each.join(
            own,
            F.col("lang").eqNullSafe(F.col("gl")) & F.col("source").eqNullSafe(F.col("gs")) & (F.col("signal") == F.col("0_signal")),
            "left",
        )
        .join(wider, F.col("lang").eqNullSafe(F.col("wl")) & (F.col("signal") == F.col("1_signal")), "left")
        .join(F.broadcast(widest), F.col("signal") == F.col("2_signal"), "left")
    )
    enough = F.col("0_n") >= ENOUGH, F.col("1_n") >= ENOUGH

    def chosen(what: str) -> Column:
        return F.when(enough[0], F.col(f"0_{what}")).when(enough[1], F.col(f"1_{what}")).otherwise(F.col(f"2_{what}"))

    low, high = chosen("low"), chosen("high")
    least = F.lit([SIGNALS[n][3] for n in names])[F.col("signal")]
    spread = F.greatest(high - low, least) * REACH
    two_sided = F.lit([SIGNALS[n][4] for n in names])[F.col("signal")]
    met = met.select(
        "lang",
        "source",
        "signal",
        F.when(two_sided, low - spread).alias("from"),
        (high + spread).alias("to"),
    )
    at = [F.col("signal") == i for i in range(len(names))]
    return met.groupBy("lang", "source").agg(
        *(F.max(F.when(at[i], F.col("from"))).alias(f"from_{n}") for i, n in enumerate(names) if SIGNALS[n][4]),
        *(F.max(F.when(at[i], F.col("to"))).alias(f"to_{n}") for i, n in enumerate(names)),
    )


def _quartiles(sketch: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """Count and both quartiles of every sketch: the floor of the bin that holds them."""
    of = Window.partitionBy(*keys, "signal")
    upto = F.sum("n").over(of.orderBy("bin"))
    summed = sketch.withColumns({"upto": upto, "all": F.sum("n").over(of)})
    return summed.groupBy(*keys, "signal").agg(
        F.max("all").alias(f"{prefix}n"),
        bin_floor(F.min(F.when(4 * F.col("upto") >= F.col("all"), F.col("bin")))).alias(f"{prefix}low"),
        bin_floor(F.min(F.when(4 * F.col("upto") >= 3 * F.col("all"), F.col("bin")))).alias(f"{prefix}high"),
    ).withColumnRenamed("signal", f"{prefix}signal")


def judged(
    df: DataFrame,
    ws: Workspace,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """Per row: key, counts, base_failed, kept. The measures are settled, so texts are
    read once; what is settled holds numbers only."""
    rows = measures(df, key, text, lang, source).withColumn("base_failed", base_failed())
    rows = ws.settle(rows, "measures")
    bounds = ws.settle(limits(rows, ws), "limits").withColumnsRenamed({"lang": "l", "source": "s"})
    same = F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s"))
    kept = ~F.col("base_failed")
    for name, rule in SIGNALS.items():
        kept = kept & F.coalesce(signal(name) <= F.col(f"to_{name}"), F.lit(True))
        if rule[4]:
            kept = kept & F.coalesce(signal(name) >= F.col(f"from_{name}"), F.lit(True))
    return rows.join(bounds, same, "left").select(
        F.col("key").alias(key),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        kept.alias("kept"),
    )


def _sql() -> str:
    """The same in SQL, for unique keys: quantiles over the counts of the same bins."""
    value = {
        n: f"coalesce({scale} * {above} // nullif({below}, 0), 0)"
        for n, (above, below, scale, _, _) in SIGNALS.items()
    }
    up = f"greatest(length(bin(v)) - {FINE + 1}, 0)"

    def floor_of(b: str) -> str:
        shift = f"greatest({b} // {1 << FINE} - 1, 0)"
        return f"(({b} - {shift} * {1 << FINE}) << {shift})"

    long = " UNION ALL ".join(
        f"SELECT lang, source, {i} AS signal, ({v})::BIGINT AS v FROM measured WHERE NOT base_failed"
        for i, v in enumerate(value.values())
    )

    def quartiles(table: str, keys: str) -> str:
        part = f"PARTITION BY {keys}signal"
        return f"""
          SELECT {keys}signal, max(total) AS n, min(b) FILTER (4 * upto >= total) AS low,
            min(b) FILTER (4 * upto >= 3 * total) AS high
          FROM (SELECT *, sum(n) OVER ({part} ORDER BY b) AS upto, sum(n) OVER ({part}) AS total FROM {table})
          GROUP BY {keys}signal"""

    least = " ".join(f"WHEN {i} THEN {s[3]}" for i, s in enumerate(SIGNALS.values()))
    rules = " AND ".join(
        f"coalesce({value[n]} <= max(hi) FILTER (signal = {i}), true)"
        + (f" AND coalesce({value[n]} >= max(lo) FILTER (signal = {i}), true)" if s[4] else "")
        for i, (n, s) in enumerate(SIGNALS.items())
    )
    measured = "doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed"
    return rf"""
WITH worded AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM worded)),
repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + o) AS n FROM repeated, (SELECT unnest([0, 1, 2]) AS o) GROUP BY doc_id),
counted AS (
  SELECT d.doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '{SYMBOLS}'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM worded d LEFT JOIN covered c ON d.doc_id = c.doc_id),
measured AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM counted),
long AS ({long}),
binned AS (SELECT lang, source, signal, {up} * {1 << FINE} + (v >> {up}) AS b FROM long),
sketch AS (SELECT lang, source, signal, b, count(*) AS n FROM binned GROUP BY ALL),
by_lang AS (SELECT lang, signal, b, sum(n) AS n FROM sketch GROUP BY ALL),
by_all AS (SELECT signal, b, sum(n) AS n FROM sketch GROUP BY ALL),
own AS ({quartiles("sketch", "lang, source, ")}),
wider AS ({quartiles("by_lang", "lang, ")}),
widest AS ({quartiles("by_all", "")}),
chosen AS (
  SELECT g.lang, g.source, s.signal,
    CASE WHEN o.n >= {ENOUGH} THEN o.low WHEN w.n >= {ENOUGH} THEN w.low ELSE a.low END AS bl,
    CASE WHEN o.n >= {ENOUGH} THEN o.high WHEN w.n >= {ENOUGH} THEN w.high ELSE a.high END AS bh
  FROM (SELECT DISTINCT lang, source FROM measured) g
  CROSS JOIN (SELECT unnest(range(0, {len(SIGNALS)})) AS signal) s
  LEFT JOIN own o ON g.lang IS NOT DISTINCT FROM o.lang AND g.source IS NOT DISTINCT FROM o.source AND s.signal = o.signal
  LEFT JOIN wider w ON g.lang IS NOT DISTINCT FROM w.lang AND s.signal = w.signal
  LEFT JOIN widest a ON s.signal = a.signal),
valued AS (
  SELECT lang, source, signal, {floor_of("bl")} AS low, {floor_of("bh")} AS high
  FROM chosen),
bounds AS (
  SELECT lang, source, signal, low - {REACH} * greatest(high - low, CASE signal {least} END) AS lo,
    high + {REACH} * greatest(high - low, CASE signal {least} END) AS hi
  FROM valued)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {rules} AS kept
FROM measured m LEFT JOIN bounds b ON m.lang IS NOT DISTINCT FROM b.lang AND m.source IS NOT DISTINCT FROM b.source
GROUP BY {", ".join("m." + c.strip() for c in measured.split(","))}
"""


SQL = _sql()
