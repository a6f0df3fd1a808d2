"""Connected components by alternating large-star and small-star over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelight.llm.common import cut, join_skewed, uncut

def _with_minimum(pairs: DataFrame, n_pairs: int) -> DataFrame:
    """(u, v) rows with m, the least of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("degree"))
    return join_skewed(pairs, least, "u", n_pairs)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (u long, v long): component is the least node reachable.

    Rows with a null end take no part, loops and repeated edges are allowed, and an empty table gives none.
    Every round is written to the shared folder, so a lost executor costs one round at most.
    """
    ends = edges.where("u is not null and v is not null").select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v"))
    loops = ends.where("u = v").select(F.col("u").alias("node"))
    now = cut(ends.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_minimum(both, 2 * state[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large)
        small = _with_minimum(large, state[0])
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        new = cut(small.where("u <> v").distinct())
        uncut(large)
        uncut(now)
        now, before, state = new, state, _state(new)
        if before == state:
            break
    found = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node")).unionByName(loops.join(now.select(F.col("u").alias("node")), "node", "left_anti")).distinct()
    return found.unionByName(roots.select("node", F.col("node").alias("component")))
