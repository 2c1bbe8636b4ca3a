"""Lineage over a table of edges (``node_id`` is computed from ``child_node_id``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stage, unstage


def stages(edges: DataFrame) -> DataFrame:
    """Every node with its stage: root (feeds nothing), leaf (reads nothing) or intermediate."""
    up = edges.select(F.col("node_id").alias("node"), F.lit(1).alias("reads"), F.lit(0).alias("feeds"))
    down = edges.select(F.col("child_node_id").alias("node"), F.lit(0).alias("reads"), F.lit(1).alias("feeds"))
    roles = up.unionByName(down).groupBy("node").agg(F.max("reads").alias("reads"), F.max("feeds").alias("feeds"))
    stage_name = F.when(F.col("feeds") == 0, "root").when(F.col("reads") == 0, "leaf").otherwise("intermediate")
    return roles.select("node", stage_name.alias("stage"))


def reachable(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """Pairs (start, node): all that ``starts.node`` depends on, directly or not.

    Paths are doubled: after k rounds pairs have walks of at most 2**k edges, and ``jumps`` the
    pairs of nodes with a walk of exactly 2**k, which the next round puts behind them. So the rounds are
    the logarithm of the depth. A round without a new pair ends it, on cycles too: the shortest walk
    to a node further away would pass a new one. On chains and trees jumps are no more than
    nodes. Each round is written out to cut the lineage.
    """
    jumps = stage(edges.select(F.col("node_id").alias("_from"), F.col("child_node_id").alias("_to")).distinct(), "jumps")
    steps = starts.select(F.col("node").alias("start")).distinct().join(jumps, F.col("start") == F.col("_from"))
    rounds = [stage(steps.select("start", F.col("_to").alias("node")), "lineage")]
    while not rounds[-1].isEmpty() and not jumps.isEmpty():
        known = reduce(DataFrame.unionByName, rounds)
        further = known.join(jumps, F.col("node") == F.col("_from")).select("start", F.col("_to").alias("node"))
        rounds.append(stage(further.distinct().join(known, ["start", "node"], "left_anti"), "lineage"))
        left, right = jumps.alias("l"), jumps.alias("r")
        doubled = left.join(right, F.col("l._to") == F.col("r._from")).select("l._from", "r._to").distinct()
        doubled = stage(doubled, "jumps")
        unstage(jumps)
        jumps = doubled
    result = stage(reduce(DataFrame.unionByName, rounds), "lineage")
    for part in [jumps, *rounds]:
        unstage(part)
    return result


def impact(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """Pairs (start, node): all that is computed from ``sources.node``."""
    reverse = edges.select(F.col("child_node_id").alias("node_id"), F.col("node_id").alias("child_node_id"))
    return reachable(reverse, sources)
