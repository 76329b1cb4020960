"""Connected components by alternating large and small stars, with every round cut off in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.durable import checkpoint

#: Centres of large stars are broadcast: at most so many, as each takes more than its share of all edges.
MOST_CENTRES, LEAST_DEGREE = 10_000, 1000


def _state(edges: DataFrame) -> tuple[int, int]:
    """The number of edges, and of nodes that keep them from being stars: with two edges up, or with one up and one down."""
    end = lambda node, up, down: F.struct(F.col(node).alias("node"), F.lit(up).alias("up"), F.lit(down).alias("down"))
    ends = edges.select(F.inline(F.array(end("u", 1, 0), end("v", 0, 1))))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    row = nodes.agg(F.coalesce(F.sum("up"), F.lit(0)).alias("n"), F.expr("count_if(up > 1 OR up > 0 AND down > 0)").alias("open")).first()
    return row.n, row.open


def _with_least(edges: DataFrame, n: int) -> DataFrame:
    """(u, v, m): each edge with the least v of its u.

    A u with more than n / MOST_CENTRES edges would land in one task; there are fewer than MOST_CENTRES of them, so
    these are broadcast, and only the others' edges are shuffled."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree"))
    most = max(LEAST_DEGREE, -(-n // MOST_CENTRES))
    centres = F.broadcast(least.where(F.col("degree") > most).select("u", "m"))
    marked = edges.join(centres, "u", "left")
    others = marked.where("m IS NULL").select("u", "v").join(least.where(F.col("degree") <= most).select("u", "m"), "u")
    return marked.where("m IS NOT NULL").unionByName(others)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has an edge; the component is its least node. `edges`: u, v (long).

    Each round hangs the larger neighbours of a node on its least one, then the smaller ones; the graph's edges never
    grow beyond two for each node and neighbour, and a path of n nodes takes a number of rounds like log(n). The rounds
    end when all edges are stars around their least node, so that no round is spent on seeing that nothing changes."""
    edges = checkpoint(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    (n, unsettled), rounds = _state(edges), 0
    while unsettled:
        if rounds == most_rounds:
            raise RuntimeError(f"components did not settle within {most_rounds} rounds")
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = F.least("u", "m")
        large = _with_least(both, 2 * n).where("v > u").select(F.col("v").alias("u"), m.alias("v")).where("u <> v")
        large = checkpoint(large.distinct())
        small = _with_least(large, 2 * n)
        edges = checkpoint(small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct())
        (n, unsettled), rounds = _state(edges), rounds + 1
    # Every edge now ends at its component. Least values combine before the shuffle, so that a centre's edges don't meet.
    ends = edges.select(F.explode(F.array("u", "v")).alias("node"), F.col("v").alias("component"))
    return ends.groupBy("node").agg(F.min("component").alias("component"))
