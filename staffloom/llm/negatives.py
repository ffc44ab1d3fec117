"""Hard negatives for anchors by exact inner products with pruned candidates.

An anchor's positives are the rows of its label it scores highest; for each positive, its
hard negatives are the highest rows of other labels whose score lies between `low` percent
of the positive's and the positive's. Components become integers, floor(scale * x), so
scores are exact; ties go to the smaller key, no key last.

Anchors meet all rows in blocks: rows are dealt into lanes by where they stand in a settled
table, not by what they hold, so that neither a hot label, a hot key nor copies of a vector
make a lane large; anchors are dealt into blocks; each pair of lane and block is one group.
In a group (`Lane`) rows stand in buckets by falling length. In a bucket, for the score
`least` that still matters to an anchor:

- a bucket whose longest row cannot reach `least` is left out;
- the cosine must be at least c = least / (length of anchor * longest row). Seen from the
  anchor's focus coordinates, the `FOCUS` largest of its direction, a row at that angle has
  its own coordinate between cos(a + b) and cos(a - b), where cos a is the anchor's
  coordinate and cos b = c. The sorted list of the coordinate gives these rows by two binary
  searches, and the rows found for all focus coordinates are the candidates;
- candidates are scored exactly, and `least` rises with the best ones so far.

Each group returns at most `take` rows per anchor and positive, and these are ranked over all
groups. No row is left out by a cap: pruning is exact, its bounds are widened by `SLACK`.

Rows with no label, no vector, or a missing or non-finite component take no part. Vectors of
unequal size are filled with zeros; components are held within 2^53, scores within a long.
Rows that share the anchor's key are not its positives nor negatives; other repeated rows
count one by one. Repeated anchors (same key, label and vector) are one. A row without a key
is no anchor. Empty tables give empty results, other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staffloom.sources.workspace import Workspace

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100
FOCUS = 3
# Rows of a lane, anchors of a block, rows of a bucket, and the shortest row of a bucket
# as a share of its longest.
LANE_ROWS, BLOCK_ANCHORS, BUCKET_ROWS = 8_192, 8_192, 2_048
SHORTEST = 0.9
SLACK = 1e-9
_LARGEST = 1 << 53
_NO_KEY = np.iinfo(np.int64).max


def whole_vectors(df: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """key, label and whole-numbered vector of the rows that take part."""
    sound = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    limit = F.lit(_LARGEST)

    def whole(x: Column) -> Column:
        return F.greatest(F.least(F.floor(x.cast("double") * scale), limit), -limit)

    return df.filter(F.col(label).isNotNull() & F.col(vector).isNotNull() & sound).select(
        F.col(key).cast("bigint").alias("key"), F.col(label).alias("label"), F.transform(vector, whole).alias("vector")
    )


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of whole numbers as rows, short ones filled with zeros."""
    lists = column.combine_chunks()
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values
    return out


class Bucket:
    """Rows of like length with, per coordinate asked for, a sorted list of its values."""

    def __init__(self, rows: np.ndarray, keys: np.ndarray, labels: np.ndarray, length: np.ndarray):
        self.rows, self.keys, self.labels = rows, keys, labels
        self.longest = float(length[0])
        with np.errstate(invalid="ignore", divide="ignore"):
            self.directions = np.where(length[:, None] > 0, rows / length[:, None], 0.0)
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def list_of(self, coordinate: int) -> tuple[np.ndarray, np.ndarray]:
        if coordinate not in self.lists:
            order = np.argsort(self.directions[:, coordinate])
            self.lists[coordinate] = order, self.directions[order, coordinate]
        return self.lists[coordinate]

    def candidates(self, anchor: Anchor, least: float) -> np.ndarray | None:
        """Places of the rows that may score `least` or more; None stands for all."""
        if least <= 0:
            return None
        if anchor.length * self.longest * (1 + SLACK) < least:
            return np.zeros(0, np.int64)
        angle = np.arccos(min(1.0, least / (anchor.length * self.longest)) * (1 - SLACK)) + SLACK
        # The longest row may stand off furthest; shorter ones need a smaller angle still.
        seen = np.zeros(len(self.keys), np.int8)
        used = 0
        for coordinate, own in anchor.focus:
            low = np.cos(min(np.pi, own + angle)) - SLACK
            high = np.cos(max(0.0, own - angle)) + SLACK
            order, values = self.list_of(coordinate)
            a, b = np.searchsorted(values, low), np.searchsorted(values, high, "right")
            if b - a < len(order):
                seen[order[a:b]] += 1
                used += 1
        return np.flatnonzero(seen == used) if used else None


class Anchor:
    def __init__(self, vector: np.ndarray, key: int, label):
        self.vector, self.key, self.label = vector, key, label
        self.length = float(np.sqrt((vector.astype(float) ** 2).sum()))
        self.focus: list[tuple[int, float]] = []
        if self.length:
            direction = vector / self.length
            largest = np.argsort(-np.abs(direction), kind="stable")[:FOCUS]
            self.focus = [(int(f), float(np.arccos(np.clip(direction[f], -1, 1)))) for f in largest]


class Lane:
    """Rows in buckets by falling length; with `by_label`, each label's rows for themselves."""

    def __init__(self, table: pa.Table, by_label: bool):
        rows = matrix(table.column("vector"))
        keys = table.column("key").fill_null(_NO_KEY).to_numpy()
        labels = table.column("label").to_numpy()
        self.width = rows.shape[1]
        self.largest = int(np.abs(rows).max(initial=0))
        length = np.sqrt((rows.astype(float) ** 2).sum(axis=1))
        group = np.unique(labels, return_inverse=True)[1] if by_label else np.zeros(len(rows), np.int64)
        order = np.lexsort((-length, group))
        self.buckets: dict[object, list[Bucket]] = {}
        at = 0
        while at < len(order):
            of_group = at + int(np.searchsorted(group[order[at : at + BUCKET_ROWS]], group[order[at]], "right"))
            like = -length[order[at:of_group]]
            to = at + max(1, int(np.searchsorted(like, SHORTEST * like[0], "right")))
            some = order[at:to]
            name = labels[some[0]] if by_label else None
            made = Bucket(rows[some], keys[some], labels[some], length[some])
            self.buckets.setdefault(name, []).append(made)
            at = to

    def scores(self, bucket: Bucket, some: np.ndarray | None, anchor: Anchor) -> np.ndarray:
        """Exact inner products of some rows of the bucket."""
        rows = bucket.rows if some is None else bucket.rows[some]
        width = min(self.width, len(anchor.vector))
        rows, vector = rows[:, :width], anchor.vector[:width]
        if self.largest * int(np.abs(vector).max(initial=0)) * max(1, width) < _LARGEST:
            return (rows.astype(float) @ vector.astype(float)).astype(np.int64)
        # Beyond the whole numbers a double holds: in Python's own.
        limits = np.iinfo(np.int64)
        exact = rows.astype(object) @ vector.astype(object)
        return np.array([min(max(int(x), limits.min), limits.max) for x in exact], np.int64)


class Best:
    """The `take` highest scores at most `high` and at least `low`, smaller keys first."""

    def __init__(self, take: int, low=-np.inf, high=np.inf):
        self.take, self.least, self.high = take, low, high
        self.scores, self.keys = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def offer(self, scores: np.ndarray, keys: np.ndarray) -> None:
        fit = (scores >= self.least) & (scores <= self.high)
        scores, keys = np.r_[self.scores, scores[fit]], np.r_[self.keys, keys[fit]]
        if len(scores) > self.take:
            edge = np.partition(scores, -self.take)[-self.take]
            near = scores >= edge
            scores, keys = scores[near], keys[near]
        order = np.lexsort((keys, -scores))[: self.take]
        self.scores, self.keys = scores[order], keys[order]
        if len(order) == self.take:
            self.least = max(self.least, int(self.scores[-1]))


def _search(lane: Lane, buckets: list[Bucket], anchor: Anchor, bests: list[Best], other_labels: bool) -> None:
    for bucket in buckets:
        some = bucket.candidates(anchor, min(b.least for b in bests))
        if some is not None and not len(some):
            continue
        keys = bucket.keys if some is None else bucket.keys[some]
        scores = lane.scores(bucket, some, anchor)
        fit = keys != anchor.key
        if other_labels:
            fit &= (bucket.labels if some is None else bucket.labels[some]) != anchor.label
        for best in bests:
            best.offer(scores[fit], keys[fit])


def _keys(keys: list[int]) -> pa.Array:
    return pa.array([None if k == _NO_KEY else k for k in keys], pa.int64())


def _met(rows: DataFrame, anchors: DataFrame, lanes: int, blocks: int, work, schema: str) -> DataFrame:
    """`work` on every pair of a lane of rows and a block of anchors."""
    left = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = anchors.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    return left.groupBy("block", "lane").cogroup(right.groupBy("block", "lane")).applyInArrow(work, schema)


def _first(df: DataFrame, by: list[str], take: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("found").asc_nulls_last())
    return df.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= take)


def mined(
    df: DataFrame,
    ws: Workspace,
    is_anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    lane_rows: int = LANE_ROWS,
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """Per anchor, positive and rank the hard negative and both scores.

    `is_anchor` says of a row of `df` whether it is one. A score is between `low` and `high`
    percent of the positive's, ends included.
    """
    rows = ws.settle(whole_vectors(df, key, vector, label, scale), "vectors")
    chosen = df.filter(is_anchor & F.col(key).isNotNull())
    wanted = whole_vectors(chosen, key, vector, label, scale).distinct()
    anchors = ws.settle(wanted.withColumn("uid", F.monotonically_increasing_id()), "anchors")
    lanes = max(1, -(-rows.count() // lane_rows))
    blocks = max(1, -(-anchors.count() // block_anchors))
    rows = rows.withColumn("lane", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(lanes)).cast("int"))
    anchors = anchors.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int"))

    def of_block(table: pa.Table):
        vectors = matrix(table.column("vector"))
        keys, labels = table.column("key").to_numpy(), table.column("label").to_numpy()
        uids = table.column("uid").to_numpy()
        return [(int(u), Anchor(v, k, x)) for u, v, k, x in zip(uids, vectors, keys, labels)]

    def find_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [], [], []
        if left.num_rows and right.num_rows:
            lane = Lane(left, by_label=True)
            for uid, anchor in of_block(right):
                best = Best(positives)
                _search(lane, lane.buckets.get(anchor.label, []), anchor, [best], other_labels=False)
                for column, values in zip(out, ([uid] * len(best.keys), best.keys.tolist(), best.scores.tolist())):
                    column.extend(values)
        columns = [pa.array(out[0], pa.int64()), _keys(out[1]), pa.array(out[2], pa.int64())]
        return pa.table(columns, names=["uid", "found", "score"])

    near = _met(rows, anchors, lanes, blocks, find_positives, "uid long, found long, score long")
    near = ws.settle(_first(near, ["uid"], positives, "slot"), "positives")
    # Below zero `low` percent is above `high` percent: nothing lies between.
    bands = near.filter("score >= 0").groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("slot", "score"))).alias("bands"))
    aimed = anchors.join(bands, "uid")

    def find_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [], [], [], []
        if left.num_rows and right.num_rows:
            lane = Lane(left, by_label=False)
            for (uid, anchor), band in zip(of_block(right), right.column("bands").to_pylist()):
                bests = [Best(negatives, -(-low * b["score"] // 100), high * b["score"] // 100) for b in band]
                _search(lane, lane.buckets[None], anchor, bests, other_labels=True)
                for b, best in zip(band, bests):
                    n = len(best.keys)
                    for column, values in zip(out, ([uid] * n, [b["slot"]] * n, best.keys.tolist(), best.scores.tolist())):
                        column.extend(values)
        columns = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), _keys(out[2]), pa.array(out[3], pa.int64())]
        return pa.table(columns, names=["uid", "slot", "found", "score"])

    hard = _met(rows, aimed, lanes, blocks, find_negatives, "uid long, slot int, found long, score long")
    hard = _first(hard, ["uid", "slot"], negatives, "rank")
    named = near.select("uid", "slot", F.col("found").alias("positive_id"), F.col("score").alias("positive_score"))
    owner = anchors.select("uid", F.col("key").alias("anchor_id"))
    return (
        hard.select("uid", "slot", "rank", F.col("found").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(named, ["uid", "slot"])
        .join(owner, "uid")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def every(df: DataFrame, ws: Workspace) -> DataFrame:
    """The contract's mining: labels moved on for keys divisible by 7, anchors by 100."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = df.select("vec_id", "embedding", moved.alias("label"))
    return mined(rows, ws, F.col("vec_id") % 100 == 0)


SQL = """
WITH sound AS (
    SELECT
        vec_id AS key,
        CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.key AS anchor_id, a.label = r.label AS alike, r.key,
        CAST(list_inner_product(a.vector, r.vector) AS BIGINT) AS score
    FROM (SELECT DISTINCT * FROM sound WHERE key % 100 = 0) a JOIN sound r ON r.key <> a.key
),
positives AS (
    SELECT anchor_id, key, score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, key) <= 5
),
ranked AS (
    SELECT p.anchor_id, p.key AS positive_id, n.key AS negative_id, p.score AS positive_score, n.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY p.anchor_id, p.key ORDER BY n.score DESC, n.key) AS INTEGER) AS rank
    FROM positives p JOIN scored n
      ON n.anchor_id = p.anchor_id AND NOT n.alike AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""
