"""Connected components of an edge table by alternating stars at larger and at smaller neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.session import cut


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(id, component): for each node of an edge the smallest node that it can reach.

    A round hangs the larger neighbours of every node on the least of it and its neighbours (large star), then every
    node and its smaller neighbours on the least of these (small star). Both keep what is connected, and the number of
    rounds follows the logarithm of the longest path. Minima are aggregates that are joined back, so that a node of very many edges
    is never one group in one task. It ends when all edges lead from a leaf to the centre of its star; edges that are
    such stars from the start take no round. Edges are cut from their lineage each round in the shared checkpoint
    folder. Null ends and self edges link nothing.
    """
    pairs = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    pairs = cut(pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    for _ in range(max_rounds):
        if not _unfinished(pairs):
            centres = pairs.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(centres)
        ends = F.array(F.struct(F.col("u").alias("x"), F.col("v").alias("y")), F.struct(F.col("v").alias("x"), F.col("u").alias("y")))
        both = pairs.select(F.explode(ends).alias("e")).select("e.*")
        lowest = both.groupBy("x").agg(F.least("x", F.min("y")).alias("low"))
        large = both.where("y > x").join(lowest, "x").select(F.col("y").alias("u"), F.col("low").alias("v"))
        lowest = large.groupBy("u").agg(F.min("v").alias("low"))
        nodes = large.join(lowest, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("low").alias("v"))
        pairs = cut(nodes.where("u <> v").distinct())
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")


def _unfinished(pairs: DataFrame) -> bool:
    """Whether some node has two smaller neighbours, or a smaller and a larger one."""
    ends = F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up")), F.struct(F.col("v").alias("x"), F.lit(0).alias("up")))
    told = pairs.select(F.explode(ends).alias("e")).groupBy("e.x").agg(F.sum("e.up").alias("ups"), F.count("*").alias("n"))
    return told.where("ups > 1 or (ups = 1 and n > 1)").limit(1).count() > 0


def roots(nodes: DataFrame, node: str = "id", parent: str = "parent") -> DataFrame:
    """(id, root, depth): for each node of a forest the end of its line of parents, and how many steps lead there.

    nodes: (id, parent), parent null at a root. Pointers are doubled: a round joins every node's pointer with the pointer's own, so
    that rounds follow the logarithm of the longest line. Nodes whose line leads to a parent that isn't there, or into a circle, have no row.
    """
    top = F.col(parent).isNull()
    first = nodes.where(F.col(node).isNotNull()).select(F.col(node).alias("id"), F.coalesce(F.col(parent), F.col(node)).alias("up"), F.when(top, 0).otherwise(1).cast("long").alias("depth"), top.alias("done"))
    state = cut(first.dropDuplicates(["id"]))
    nodes_n, span = state.count(), 1
    while span <= nodes_n and state.where("not done").limit(1).count():  # a longer line than there are nodes goes round
        open_ = state.where("not done")
        ends = state.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("done").alias("ends"))
        moved = open_.join(ends, "up").select("id", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), F.col("ends").alias("done"))
        state, span = cut(state.where("done").unionByName(moved)), 2 * span
    return state.where("done").select("id", F.col("up").alias("root"), "depth")
