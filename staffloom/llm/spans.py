"""Column builders for words and for places of matches, without Python code in tasks.

Places count code points from 0, ends are exclusive. A regular expression is matched twice,
once for what matches and once for what stands between, so a place is a sum of lengths.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
SPAN = "array<struct<start:bigint,end:bigint,text:string>>"
SPAN_AROUND = "array<struct<start:bigint,end:bigint,text:string,before:string,after:string>>"
# Lengths that are summed together, so that the i-th place costs few additions.
BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is worked out once however often `body` names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space; NULL has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def _sums(lengths: Column) -> Callable[[Column, Column], Column]:
    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def before(blocks: Column, i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        return total(F.slice(blocks, F.lit(1), block)) + total(
            F.slice(lengths, block * BLOCK + 1, i - block * BLOCK)
        )

    return before


def _block_sums(lengths: Column) -> Column:
    count = F.floor((F.size(lengths) + BLOCK - 1) / BLOCK).cast("int")
    return F.transform(
        F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))),
        lambda b: F.aggregate(
            F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)), F.lit(0).cast("bigint"), lambda a, x: a + x
        ),
    )


def found(text: Column, pattern: str | Column, around: int = 0) -> Column:
    """Start, end and text of each match, leftmost first, none overlapping; with `around`
    also up to so many characters before and after, as far as the neighbouring matches.

    A match must not be empty. Text without a match is looked at once.
    """
    regex = F.lit(pattern) if isinstance(pattern, str) else pattern
    kind = SPAN_AROUND if around else SPAN
    both = F.struct(
        F.split(text, regex, -1).alias("between"),
        F.regexp_extract_all(text, regex, F.lit(0)).alias("hits"),
    )

    def place(v: Column) -> Column:
        lengths = F.transform(
            v["hits"], lambda m, i: (F.length(v["between"][i]) + F.length(m)).cast("bigint")
        )

        def spans(size: Column) -> Column:
            def each(blocks: Column) -> Column:
                def span(m: Column, i: Column) -> Column:
                    beside = [
                        F.right(v["between"][i], F.lit(around)).alias("before"),
                        F.left(v["between"][i + 1], F.lit(around)).alias("after"),
                    ]
                    start = _sums(size)(blocks, i) + F.length(v["between"][i])
                    return let(
                        start,
                        lambda s: F.struct(
                            s.cast("bigint").alias("start"),
                            (s + F.length(m)).cast("bigint").alias("end"),
                            m.alias("text"),
                            *(beside if around else []),
                        ),
                    )

                return F.transform(v["hits"], span)

            return let(_block_sums(size), each)

        return let(lengths, spans)

    none = F.array().cast(kind)
    return F.when(F.rlike(text, regex), let(both, place)).otherwise(none).cast(kind)


def labelled(kinds: Sequence[tuple[str, Column]]) -> Column:
    """All spans of (kind, spans) pairs as one array in order of start, then kind as listed."""
    def mark(n: int, kind: str) -> Callable[[Column], Column]:
        return lambda s: F.struct(
            s["start"].alias("start"), F.lit(n).alias("n"), s["end"].alias("end"), F.lit(kind).alias("kind")
        )

    each = [F.transform(spans, mark(n, kind)) for n, (kind, spans) in enumerate(kinds)]
    return F.array_sort(F.concat(*each))


def written(marks: Column) -> Column:
    """`labelled` spans as kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(marks, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def replaced(text: Column, marks: Column, by: Callable[[Column], Column]) -> Column:
    """`text` with every labelled span replaced; of spans that overlap the first is replaced
    as far as they reach together."""
    start = F.struct(
        F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts")
    )

    def step(a: Column, s: Column) -> Column:
        fresh = s["start"] >= a["at"]
        gap = F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        return F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(a["parts"], F.array(gap, by(s)))).otherwise(a["parts"]).alias("parts"),
        )

    def finish(a: Column) -> Column:
        rest = F.substring(text, (a["at"] + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(a["parts"], ""), rest)

    return F.when(F.size(marks) > 0, F.aggregate(marks, start, step, finish)).otherwise(text)
