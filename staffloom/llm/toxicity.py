"""Toxicity by a factorization machine over hashed terms.

A document is the set of its terms: words in lower case without marks around them, and
their first four and five characters, which stand for their stems; hashed to 2^18 places. The score is the logistic of

    bias + sum of w[i] + sum over pairs i < j of v[i] . v[j],

so that two terms that say little alone can say much together. Every term that
`MIN_PAIRED` documents of the sample hold gets a weight and factors, and so does one that
`MIN_DOCUMENTS` hold and whose share in the two classes differs by `MIN_Z` standard errors.
The latter are pulled towards zero lightly. The others are pulled as a whole, each weight
and each row of factors by a threshold below which it is exactly zero; which of `PULLS`
that is, is decided by the loss on an inner fifth of the sample. So the noise of the many
terms of a long text is kept out, and terms that say nothing alone but something in pairs
are not.

The machine is fitted on the driver on a bounded sample (`max_rows` labelled rows, up to
half of them of either class, the first by a hash of the key, weighted back to their
shares), by minibatches over the terms that the documents hold; scoring reads every whole
text in tasks. Nothing but the text is an input.

Nulls: a NULL text is an empty text and gets the score of the bias; NULL labels and NULL
keys teach nothing. Several labels of a key count as the highest. Repeated rows are scored
one by one, ties in the sample's order cannot occur since its keys are distinct. With no
labelled rows every score is 0.5 less a hair, predicted 0. Other columns are not inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLACES = 1 << 18
FACTORS = 4
MIN_DOCUMENTS = 4
MIN_Z = 3.5
# Documents that hold a term which gets parameters whatever its shares are.
MIN_PAIRED = 20
MAX_ROWS = 6_000
EPOCHS = 40
BATCH = 256
RATE = 0.1
# Strength of the pull towards zero, for weights and for factors of terms that tell alone.
PULL = 2e-5
FACTOR_PULL = 1e-4
# For all other terms one of these, the best on the inner split after so many epochs.
PULLS = (1e-3, 3e-3, 1e-2)
TRIAL_EPOCHS = 12
# Spread of the factors at the start.
START, START_OTHERS = 0.01, 0.03
UNTAUGHT = -1e-9
# Distinct words whose places a worker remembers.
REMEMBERED = 150_000
# Lengths of the word beginnings that are terms of their own.
STEMS = (4, 5)
_MARKS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())


class Terms:
    """Text to the sorted places of its terms."""

    def __init__(self):
        self.known: dict[bytes, tuple[int, ...]] = {}

    def of(self, text: str | None) -> np.ndarray:
        words = set((text or "").lower().encode().split())
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, places = self.known, set()
        for word in words:
            if (found := known.get(word)) is None:
                found = known[word] = self._places(word.strip(_MARKS))
            places.update(found)
        return np.array(sorted(places), np.int32)

    @staticmethod
    def _places(word: bytes) -> tuple[int, ...]:
        if not word:
            return ()
        letters = word.decode()
        stems = [f"{n} {letters[:n]}" for n in STEMS if len(letters) > n]
        return tuple(xxhash.xxh32_intdigest(t) % PLACES for t in (word, *stems))


@dataclass
class Machine:
    """Parameters by place; places without any hold zeros."""

    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def score(self, places: np.ndarray) -> float:
        v = self.factor[places]
        pairs = 0.5 * float((v.sum(axis=0) ** 2).sum() - (v**2).sum())
        x = self.bias + float(self.weight[places].sum()) + pairs
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def fit(
    rows: list[np.ndarray],
    labels: np.ndarray,
    weights: np.ndarray | None = None,
    factors: int = FACTORS,
    epochs: int = EPOCHS,
    seed: int = 7,
) -> Machine:
    """Logistic loss; the pull of terms that do not tell alone by an inner split."""
    n = len(rows)
    weight, factor = np.zeros(PLACES, np.float32), np.zeros((PLACES, factors), np.float32)
    if not n or labels.min() == labels.max():
        sure = 4.0 if n and labels[0] else UNTAUGHT if not n else -4.0
        return Machine(sure, weight, factor)
    weights = np.ones(n) if weights is None else weights * n / weights.sum()
    inner = np.random.default_rng(seed).permutation(n)
    tried, kept = inner[: n // 5], inner[n // 5 :]
    pull = PULLS[len(PULLS) // 2]
    if len(set(labels[kept])) == 2 and len(tried):
        losses = []
        for candidate in PULLS:
            made = _trained([rows[i] for i in kept], labels[kept], weights[kept], factors, TRIAL_EPOCHS, seed, candidate)
            scores = np.clip([made.score(rows[i]) for i in tried], 1e-9, 1 - 1e-9)
            miss = -np.log(np.where(labels[tried] == 1, scores, 1 - scores))
            losses.append(float((weights[tried] * miss).sum()))
        pull = PULLS[int(np.argmin(losses))]
    return _trained(rows, labels, weights, factors, epochs, seed, pull)


def _trained(rows, labels, weights, factors, epochs, seed, pull) -> Machine:
    """Minibatches with a step size per parameter that shrinks as it learns.

    After each step a weight moves towards zero by its pull and stays there if it would
    cross it; so does the length of a row of factors. Terms other than those that tell
    alone, once all their parameters are zero, are left out of the later epochs.
    """
    n = len(rows)
    tells, held = _telling(rows, labels)
    places = np.flatnonzero(tells | (held >= MIN_PAIRED))
    tells, k = tells[places], len(places)
    index = np.full(PLACES, -1, np.int32)
    index[places] = np.arange(k)
    rows = [i[i >= 0] for i in (index[r] for r in rows)]

    rng = np.random.default_rng(seed)
    w = np.zeros(k)
    v = rng.normal(0, 1, (k, factors)) * np.where(tells, START, START_OTHERS)[:, None]
    pull_w, pull_v = np.where(tells, PULL, pull), np.where(tells, FACTOR_PULL, pull)
    share = float((weights * labels).sum() / weights.sum())
    bias = float(np.log(share / (1 - share)))
    seen_w, seen_v, seen_b = np.full(k, 1e-2), np.full(v.shape, 1e-2), 1e-2
    for epoch in range(epochs):
        alive = tells | (w != 0) | v.any(axis=1)
        if epoch and not alive.all():
            rows = [r[alive[r]] for r in rows]
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            batch = order[at : at + BATCH]
            m = len(batch)
            ids = np.concatenate([rows[i] for i in batch])
            doc = np.repeat(np.arange(m), [len(rows[i]) for i in batch])
            vi = v[ids]
            total = np.stack([np.bincount(doc, vi[:, f], m) for f in range(factors)], 1)
            square = np.bincount(doc, (vi**2).sum(axis=1), m)
            x = bias + np.bincount(doc, w[ids], m) + 0.5 * ((total**2).sum(1) - square)
            miss = weights[batch] * (1 / (1 + np.exp(-np.clip(x, -30, 30))) - labels[batch])
            touched = np.bincount(ids, minlength=k) > 0
            g = np.bincount(ids, miss[doc], k) / m
            side = miss[:, None] * total
            gv = np.stack([np.bincount(ids, side[doc, f], k) for f in range(factors)], 1) / m - v * g[:, None]
            seen_w += g * g
            seen_v += gv * gv
            step, step_v = RATE / np.sqrt(seen_w), RATE / np.sqrt(seen_v)
            w -= step * g
            w = np.sign(w) * np.maximum(np.abs(w) - touched * step * pull_w, 0)
            v -= step_v * gv
            length = np.sqrt((v**2).sum(axis=1))
            shrink = touched * step_v.mean(axis=1) * pull_v
            v *= np.maximum(1 - shrink / np.maximum(length, 1e-12), 0)[:, None]
            gb = miss.mean()
            seen_b += gb * gb
            bias -= RATE * gb / np.sqrt(seen_b)
    weight, factor = np.zeros(PLACES, np.float32), np.zeros((PLACES, factors), np.float32)
    weight[places], factor[places] = w, v
    return Machine(bias, weight, factor)


def _telling(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per place whether documents enough hold it and it is unlike in the two classes, and
    how many documents hold it."""
    sides = [[r for r, y in zip(rows, labels) if bool(y) is side] for side in (True, False)]
    held = [np.bincount(np.concatenate(s), minlength=PLACES) for s in sides]
    n = [len(s) for s in sides]
    both = held[0] + held[1]
    share = both / sum(n)
    spread = np.sqrt(np.maximum(share * (1 - share) * (1 / n[0] + 1 / n[1]), 1e-12))
    unlike = np.abs(held[0] / n[0] - held[1] / n[1]) / spread
    return (both >= MIN_DOCUMENTS) & (unlike >= MIN_Z), both


def held_out(key: str = "doc_id"):
    """Rows that teach nothing: a fifth by the CRC of the key written as text."""
    return F.crc32(F.col(key).cast("string")) % 5 == 0


def learn(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_rows: int = MAX_ROWS,
) -> Machine:
    """Fit on up to `max_rows` labelled rows that are not held out.

    Keys are chosen from the labels alone; then their texts are read, and only sets of
    places reach the driver.
    """
    known = (
        labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
        .dropna()
        .filter(~held_out("key"))
        .groupBy("key")
        .agg(F.max("label").alias("label"))
    )
    of_class = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("key").alias("n")).collect()}
    chosen = None
    for value in of_class:
        some = known.filter(F.col("label") == value).orderBy(F.xxhash64("key"), "key").limit(max_rows // 2)
        chosen = some if chosen is None else chosen.unionByName(some)
    if chosen is None:
        return fit([], np.array([]))
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches):
        terms = Terms()
        for batch in batches:
            rows = [terms.of(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("key"), pa.array([r.tobytes() for r in rows], pa.binary())],
                names=["label", "key", "places"],
            )

    kind = known.schema["key"].dataType.simpleString()
    found = texts.join(F.broadcast(chosen), "key").select("key", "label", "text")
    told = found.mapInArrow(run, f"label int, key {kind}, places binary")
    # One row of a key reaches the driver, however often it is repeated.
    told = told.groupBy("key", "label").agg(F.min("places").alias("places")).toPandas().sort_values("key")
    answer = told["label"].to_numpy().astype(float)
    sampled = {value: max(1, int((answer == value).sum())) for value in of_class}
    weights = np.array([of_class[int(a)] / sampled[int(a)] for a in answer])
    return fit([np.frombuffer(p, np.int32) for p in told["places"]], answer, weights)


def score(df: DataFrame, machine: Machine, text: str = "text", out: str = "score") -> DataFrame:
    """`df` with the score of `text` in column `out`, which is replaced if it is there."""
    if out in df.columns:
        df = df.drop(out)
    names = df.columns

    def run(batches):
        terms = Terms()
        for batch in batches:
            texts = batch.column(names.index(text)).to_pylist()
            scores = pa.array([machine.score(terms.of(t)) for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*names, out])

    return df.mapInArrow(run, df.withColumn(out, F.lit(None).cast("double")).schema)


def rated(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, whether it is held out, score and predicted label."""
    machine = learn(docs, labels, key, text)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    scored = score(rows, machine, "text", "score")
    return scored.select(
        F.col("key").alias(key),
        F.coalesce(held_out("key"), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def harmless(docs: DataFrame, machine: Machine, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of `docs` that score below `limit`; columns and values are as they were."""
    kept = "__toxicity"
    return score(docs, machine, text, kept).filter(F.col(kept) < limit).select(*docs.columns)
