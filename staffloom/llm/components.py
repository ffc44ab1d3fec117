"""Connected components by alternating stars, on settled edge tables.

Large-star moves every neighbour above a node to the node's least neighbour, small-star
does so with those below; both keep the components. Repeated until nothing changes, every
node points at the least of its component. Rounds grow with the logarithm of the longest
path, each is two aggregations and joins. A node with very many neighbours is summed on
the map side, and its join is one that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffloom.sources.workspace import Workspace


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (a, b), a > b. Large: a node sees both directions; small: those below only."""
    down = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    seen = down.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))) if large else down
    least = seen.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = seen.join(least, "u")
    moved = joined.filter("v > u") if large else joined.filter("v <> m")
    links = moved.select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        links = links.unionByName(least.filter("u <> m").select(F.col("u").alias("a"), F.col("m").alias("b")))
    return links.filter("a <> b").distinct()


def components(edges: DataFrame, ws: Workspace) -> DataFrame:
    """(node, component) of every node on an edge (a, b) of `edges`; the component is named
    by its least node. Loops, repeated edges and either direction are welcome; an edge with
    a NULL end is none. An empty table gives an empty table."""
    kind = edges.schema["a"].dataType
    edges = ws.settle(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b")
        .select("a", "b")
        .distinct(),
        "edges",
    )
    before = None
    while True:
        edges = ws.settle(_star(_star(edges, large=True), large=False), "stars")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionByName(roots).select(F.col("node").cast(kind), F.col("component").cast(kind))
