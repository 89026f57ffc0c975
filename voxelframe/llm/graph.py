"""Connected components of an edge table by alternating star contractions.

Every step is a partially aggregated minimum per node and an equi-join that
sends it to the node's neighbours.  A node with more than its share of the
edges, a hub, would bring them all into one task of that join: the minima of
hubs are broadcast instead, so a hub's edges stay where they lie.  There are
at most ``HUB_SHARE`` hubs a partition.  No task or driver ever holds a
component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelframe.llm.common import shuffle_parts, staged

MAX_ROUNDS = 60
HUB_LEAST = 32
HUB_SHARE = 4


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _hub_edges(n_edges: int, parts: int) -> int:
    """Edges from which a node is a hub: fewer than ``HUB_SHARE`` a partition
    can have so many."""
    return max(HUB_LEAST, 2 * n_edges // (HUB_SHARE * parts) + 1)


def _with_minimum(pairs: DataFrame, least: DataFrame, hub: int) -> tuple[DataFrame, DataFrame]:
    """(v, m): every pair (u, v) with the minimum m of u, from ``least``
    (u, m, n edges), which is computed once and returned too."""
    least = staged(least, "node-minima")
    hubs = F.broadcast(least.filter(F.col("n") > hub).select("u", F.col("m").alias("hub_m")))
    marked = pairs.join(hubs, "u", "left")
    plain = marked.filter("hub_m is null").select("u", "v").join(least.select("u", "m"), "u").select("v", "m")
    return marked.filter("hub_m is not null").select("v", F.col("hub_m").alias("m")).unionAll(plain), least


def _large_star(edges: DataFrame, hub: int) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n"))
    spread, _ = _with_minimum(both.filter("v > u"), least, hub)
    return spread.select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, hub: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    spread, least = _with_minimum(down, down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), hub)
    return spread.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(least.select("u", "m"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(a bigint, b bigint) -> (node, component): the smallest node reachable
    from every node that has an edge to another one.  Repeated edges, both
    directions and self loops are allowed; rows with a null end are no edges.
    Raises if the labels have not settled after ``MAX_ROUNDS`` rounds."""
    edges = (edges.select(F.col(edges.columns[0]).cast("bigint").alias("a"),
                          F.col(edges.columns[1]).cast("bigint").alias("b"))
             .filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    edges = staged(edges, "edges")
    seen = _signature(edges)
    parts = shuffle_parts(edges.sparkSession)
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        # a large star has at most two edges for each that goes in
        pulled = staged(_large_star(edges, _hub_edges(seen[0], parts)), "large-star")
        edges = staged(_small_star(pulled, _hub_edges(2 * seen[0], parts)).filter("a <> b").distinct(), "edges")
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        edges.select("b", "b").distinct())
