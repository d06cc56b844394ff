"""Connected components by alternating stars, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import durable

MOST_ROUNDS = 100
#: Edges that one task takes; small edge sets use few tasks, whatever the session's shuffle partitions.
EDGES_A_TASK, LEAST_TASKS = 50_000, 8


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 31)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable from every node that has an edge (columns a, b of long).

    Large stars join each node's larger neighbours to its smallest one, small stars join the smaller ones; both
    only ever take minima by key, which combine before the shuffle, so a hub needs no collected neighbour list.
    The edge set is at rest when all edges point at the roots, after a number of rounds that grows with the
    logarithm of the longest path.  Self-edges and repeated edges change nothing; no edge gives no row.
    """
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = durable(e)
    before = _signature(e)
    for _ in range(MOST_ROUNDS):
        if not before[0]:
            break
        tasks = max(LEAST_TASKS, before[0] // EDGES_A_TASK)
        e = e.coalesce(tasks)
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).coalesce(tasks).distinct().coalesce(tasks)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").coalesce(tasks).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = durable(small.unionByName(low.coalesce(tasks).select("a", F.col("m").alias("b"))).distinct().coalesce(tasks))
        after = _signature(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not come to rest")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
