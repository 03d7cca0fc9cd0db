"""Connected components of an undirected graph, by alternating large and small stars.

Labels never leave the executors; every round is checkpointed in the shared folder, so a lost executor costs one round.
In large graphs what each node sees is checkpointed before it is joined: a hub's edges are then one side of a plain join,
which adaptive execution splits over several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from utterloom.llm.common import cut

#: Edges from which the steps of a round are checkpointed one by one; the result is the same.
LARGE = 5_000_000


def _with_least(edges: DataFrame, large: bool) -> DataFrame:
    """Adds m, the smallest v of each u: by a window, or where a hub may be large by partial minima and a join."""
    if not large:
        return edges.withColumn("m", F.min("v").over(Window.partitionBy("u")))
    edges = cut(edges)
    return edges.join(cut(edges.groupBy("u").agg(F.min("v").alias("m"))), "u")


def _large_star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node links its larger neighbours to the smallest node that it sees, itself included."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both, large).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    ends = F.explode(F.array("u", "v")).alias("u")
    return _with_least(down, large).select(ends, F.col("m").alias("v")).where("u <> v").distinct()


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the links (u, v): component is the smallest node reachable.

    Loops and repeated links do no harm; rows with a null end are dropped; no links give no rows.
    """
    edges = cut(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    for _ in range(max_rounds):
        sums = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not sums[0] or tuple(sums) == state:
            break
        state = tuple(sums)
        large = sums[0] > LARGE
        edges = cut(_small_star(_large_star(edges, large), large))
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
