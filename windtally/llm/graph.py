"""Connected components by repeated contraction, on DataFrames alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` (undirected, no nulls) -> ``(node, root)`` for every node
    of an edge; nodes of one component share one root.

    Each round hooks a node to the neighbour of least hash (or itself), maps
    both ends of every edge, and drops loops and repeats.  An edge (u, hook(u))
    maps to (hook(u), hook(hook(u))), so no connection is lost.  A star is gone
    after two rounds; random order makes a path at least halve.  Group minima
    are pre-aggregated before the shuffle, so a hub costs no task more than its
    share; every round ends in a stored table.
    """
    order = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
    cur = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    maps: list[DataFrame] = []
    while not cur.isEmpty():
        both = cur.union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.min(order("b")).alias("m"))
        hook = stored(hook.select("a", F.least(order("a"), F.col("m"))["v"].alias("r")), "hooks")
        maps.append(hook)
        ra, rb = hook.toDF("a", "ra"), hook.toDF("b", "rb")
        cur = stored(cur.join(ra, "a").join(rb, "b").where("ra <> rb")
                     .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
    if not maps:
        return cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = maps[0].toDF("node", "root")
    for m in maps[1:]:
        out = (out.join(m.toDF("root", "next"), "root", "left")
               .select("node", F.coalesce("next", "root").alias("root")))
    return out
