"""Periodic runs of words: stretches that repeat themselves, and the text without the repeats.

A run is a stretch of consecutive words with smallest period q (words q apart are the same)
that no neighbouring word extends keeping the period, of at least `min_words` words and at
least two periods. All of them are found, exactly, whatever their period:

- `Suffixes` answers how many words two places have in common from there on. Only suffixes
  at places whose remainder by `COVER` is in `RESIDUES` are sorted. Those remainders are a
  difference cover: from any two places the same small step, under `COVER`, leads to two
  sampled ones. So an answer takes the comparison of a few words up to there, and then the
  least common prefix between the two in sorted order, from a sparse table.
- For each period q the words at 0, q, 2q, ... are a grid, n / q places, harmonically many
  in all. A run of period q holds two neighbours of that grid, so extending each pair of
  equal neighbours to both sides finds it. Multiples of a run's period find the same stretch
  again; the least period of a stretch is kept.

Texts are worked on in groups of some ten thousand words, with a word of its own between two
texts, so that short ones share the array work; a text longer than that is a group alone.
Rows stay where they are; there is no shuffle. A task holds a group and a batch of rows,
a text of n words takes some hundred bytes a word, and time grows as n log n.

Nulls: a NULL text has no words. Empty texts and texts without words have no runs and
collapse to ''. Repeated rows are worked on one by one. Columns other than the text are
passed through, whatever their names; `runs` and `collapsed` replace columns so named.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A perfect difference set: every difference modulo COVER occurs between two residues.
COVER = 31
RESIDUES = (0, 1, 3, 8, 12, 18)
MIN_WORDS = 12
# Words of short texts worked on at once, and grid pairs.
GROUP_WORDS = 1 << 15
GROUP_PAIRS = 1 << 20

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


def _meetings() -> np.ndarray:
    """Steps from a pair of remainders to the next pair that is sampled on both sides."""
    sampled = np.isin(np.arange(COVER), RESIDUES)
    steps = np.arange(COVER)
    on = sampled[(steps[:, None] + steps) % COVER]
    return (on[:, None, :] & on[None, :, :]).argmax(axis=2)


_MEET = _meetings()
_SLOT = np.searchsorted(RESIDUES, np.arange(COVER))


class Suffixes:
    """Common prefixes of suffixes of `codes`, whose last code occurs nowhere else."""

    def __init__(self, codes: np.ndarray):
        blocks = -(-len(codes) // COVER)
        # Every place beyond the end has a code of its own, so no two suffixes are alike.
        beyond = int(codes.max()) + 1 + np.arange((blocks + 1) * COVER - len(codes))
        self.codes = np.concatenate([codes, beyond]).astype(np.int64)
        self.places = (np.arange(blocks)[:, None] * COVER + np.array(RESIDUES)).ravel()
        levels = self._sort(int(beyond[-1]) + 1)
        self.rank = levels[-1]
        self._common_prefixes(levels)

    def _sort(self, kinds: int) -> list[np.ndarray]:
        """Ranks of the sampled suffixes by their first COVER words, twice as many, ..."""
        rank = np.zeros(len(self.places), np.int64)
        tied = np.arange(len(rank))
        at_once = max(1, (62 - len(rank).bit_length()) // kinds.bit_length())
        for at in range(0, COVER, at_once):
            if not len(tied):
                break
            key = rank[tied]
            for step in range(at, min(at + at_once, COVER)):
                key = key * kinds + self.codes[self.places[tied] + step]
            tied = _refine(rank, tied, key)
        levels, step = [rank.copy()], len(RESIDUES)
        while len(tied):
            # The suffix so many words on is sampled too.
            after = tied + step
            inside = after < len(rank)
            follows = np.where(inside, rank[np.where(inside, after, 0)] + 1, 0)
            tied = _refine(rank, tied, rank[tied] * (len(rank) + 1) + follows)
            levels.append(rank.copy())
            step *= 2
        return levels

    def _common_prefixes(self, levels: list[np.ndarray]) -> None:
        order = np.empty_like(self.rank)
        order[self.rank] = np.arange(len(order))
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        for power in range(len(levels) - 2, -1, -1):
            same = levels[power][a] == levels[power][b]
            a[same] += len(RESIDUES) << power
            b[same] += len(RESIDUES) << power
            common[same] += COVER << power
        left, right, alive = self.places[a], self.places[b], np.arange(len(a))
        for step in range(COVER):
            alive = alive[self.codes[left[alive] + step] == self.codes[right[alive] + step]]
            common[alive] += 1
        self.table = [common.astype(np.int32)]
        width = 1
        while 2 * width <= len(common):
            below = self.table[-1]
            self.table.append(np.minimum(below[:-width], below[width:]))
            width *= 2

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words are the same from places `i` and from places `j` on."""
        out = _MEET[i % COVER, j % COVER]
        going = np.arange(len(i))
        met = [going[out == 0]]
        steps = out.copy()
        for step in range(COVER):
            going = going[steps[going] > step]
            if not len(going):
                break
            same = self.codes[i[going] + step] == self.codes[j[going] + step]
            out[going[~same]] = step
            going = going[same]
            met.append(going[steps[going] == step + 1])
        met = np.concatenate(met)
        out[met] += self._sampled(i[met] + steps[met], j[met] + steps[met])
        return out

    def _sampled(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = (self.rank[p // COVER * len(RESIDUES) + _SLOT[p % COVER]] for p in (i, j))
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp(high - low)[1] - 1
        out = np.empty(len(i), np.int64)
        for power in np.unique(level):
            of = level == power
            row = self.table[power]
            out[of] = np.minimum(row[low[of]], row[high[of] - (1 << int(power))])
        return out


def _refine(rank: np.ndarray, tied: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Rank the `tied` anew by `key`, which sorts by rank first; returns those still tied.

    A rank is the number of suffixes before all that are still alike.
    """
    order = np.argsort(key, kind="stable")
    tied, key = tied[order], key[order]
    old = rank[tied]
    at = np.arange(len(tied))
    new_old = np.r_[True, old[1:] != old[:-1]]
    new = np.r_[True, key[1:] != key[:-1]]
    first_old = np.maximum.accumulate(np.where(new_old, at, 0))
    first = np.maximum.accumulate(np.where(new, at, 0))
    rank[tied] = old + first - first_old
    alone = new & np.r_[new[1:], True]
    return tied[~alone]


def runs_of(texts: list[np.ndarray], min_words: int = MIN_WORDS) -> list[Runs]:
    """Per text, given as word codes from 0 on: starts, lengths and periods of its runs."""
    sizes = np.array([len(t) for t in texts])
    kinds = max((int(t.max()) for t in texts if len(t)), default=0) + 1
    parts = [np.array([kinds])]
    for i, t in enumerate(texts):
        parts += [t, np.array([kinds + 1 + i])]
    codes = np.concatenate(parts)
    begins = 1 + np.r_[0, np.cumsum(sizes + 1)[:-1]]
    start, end, period = _grid(codes, begins, sizes, min_words)
    out = []
    upto = np.searchsorted(start, begins + sizes)
    low = np.searchsorted(start, begins)
    for a, b, begin in zip(low, upto, begins):
        out.append((start[a:b] - begin, end[a:b] - start[a:b], period[a:b]))
    return out


def _grid(codes, begins, sizes, min_words) -> Runs:
    """Start, end and least period of all runs, by start and then period."""
    found = []
    which = np.flatnonzero(sizes >= min_words)
    forward = backward = None
    most = sizes[which] // 2
    text = np.repeat(which, most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    pairs = (sizes[text] - 1) // period
    upto = np.cumsum(pairs)
    at = 0
    while at < len(text):
        before = upto[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(upto, before + GROUP_PAIRS, "right")))
        n = pairs[at:to]
        of = np.repeat(np.arange(at, to), n)
        k = np.arange(len(of)) - np.repeat(upto[at:to] - n - before, n)
        q = period[of]
        i = begins[text[of]] + k * q
        same = codes[i] == codes[i + q]
        i, q = i[same], q[same]
        at = to
        if not len(i):
            continue
        if forward is None:
            forward, backward = Suffixes(codes), Suffixes(codes[::-1].copy())
        after = forward.common(i, i + q)
        before = backward.common(len(codes) - i, len(codes) - i - q)
        fits = (after + before >= q) & (after + before + q >= min_words)
        found.append(_least((i - before)[fits], (i + q + after)[fits], q[fits]))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, end, q = _least(*map(np.concatenate, zip(*found)))
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def _least(start, end, q) -> Runs:
    """One row per stretch, with its least period."""
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    first = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])][: len(start)]
    return start[first], end[first], q[first]


def collapsed(words: list, runs: Runs) -> list:
    """The words but those that lie in a run after its first period."""
    if not len(runs[0]):
        return words
    start, length, period = runs
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def words_of(text: str | None) -> list[bytes]:
    """Words between white space of U+0020 and U+0009 to U+000D."""
    return (text or "").encode().split()


def _in_groups(texts: list[list[bytes]], min_words: int) -> Iterator[tuple[list[bytes], Runs]]:
    at = 0
    while at < len(texts):
        known: dict[bytes, int] = {}
        coded, total, begin = [], 0, at
        while at < len(texts) and (not coded or total + len(texts[at]) <= GROUP_WORDS):
            coded.append(np.array([known.setdefault(w, len(known)) for w in texts[at]], np.int64))
            total += len(texts[at])
            at += 1
        yield from zip(texts[begin:at], runs_of(coded, min_words))


def with_runs(
    df: DataFrame,
    text: str = "text",
    min_words: int = MIN_WORDS,
    rewrite: tuple[str, Callable[[object, list[bytes]], list[bytes]]] | None = None,
) -> DataFrame:
    """`df` with `runs` (start, length and period in words, by start, then period) and
    `collapsed`, the words outside of runs and of their first periods, one space between.

    `rewrite`, a column and a function of its value and the words of the text, changes the
    words before they are looked at.
    """
    if clash := [c for c in ("runs", "collapsed") if c in df.columns and c != text]:
        df = df.drop(*clash)
    names = df.columns
    kept = [c for c in names if c not in ("runs", "collapsed")]

    def run(batches):
        for batch in batches:
            # Few rows at once: their words are objects.
            for at in range(0, len(batch), 256):
                yield one(batch.slice(at, 256))

    def one(batch):
        texts = [words_of(t) for t in batch.column(names.index(text)).to_pylist()]
        if rewrite:
            values = batch.column(names.index(rewrite[0])).to_pylist()
            texts = [rewrite[1](value, words) for value, words in zip(values, texts)]
        left, starts, ends, periods, upto = [], [], [], [], [0]
        for words, runs in _in_groups(texts, min_words):
            left.append(b" ".join(collapsed(words, runs)).decode())
            for column, values in zip((starts, ends, periods), runs):
                column.append(values)
            upto.append(upto[-1] + len(runs[0]))
        fields = [np.concatenate(c).astype(np.int64) for c in (starts, ends, periods)]
        structs = pa.StructArray.from_arrays([pa.array(f) for f in fields], fields=list(_RUN))
        lists = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), structs)
        columns = [batch.column(names.index(c)) for c in kept]
        return pa.RecordBatch.from_arrays(
            [*columns, lists, pa.array(left, pa.string())], names=[*kept, "runs", "collapsed"]
        )

    empty = df.select(*kept, F.lit(None).cast(RUNS).alias("runs"), F.lit("").alias("collapsed"))
    return df.mapInArrow(run, empty.schema)


def planted(key: object, words: list[bytes]) -> list[bytes]:
    """The contract's change: in a tenth of the rows, by the CRC of the key, the words from
    some place on become a period. No key changes nothing."""
    if key is None or not words:
        return words
    h = crc32(str(key).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, number of runs, the longest one and digests of all that was found."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = with_runs(rows, "text", rewrite=("key", planted)).withColumn(
        "best",
        F.expr("array_min(transform(runs, r -> struct(-r.length AS l, r.start AS s, r.period AS p)))"),
    )
    listed = "transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n'))"
    return found.select(
        F.col("key").alias(key),
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.s").alias("start"),
        (-F.col("best.l")).alias("length"),
        F.col("best.p").alias("period"),
        F.expr("-1000 * best.l DIV best.p").alias("exponent_milli"),
        F.sha2(F.expr(f"array_join({listed}, '')"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
