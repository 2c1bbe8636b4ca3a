"""Connected components of an edge table, by alternating star contractions.

Every round replaces each node's larger neighbours, then its smaller ones, by stars around the
smallest node in reach. Edges never grow in number, and the rounds grow with the logarithm of
the nodes. Joins to a node's minimum are such that Spark splits a node of very many edges. Nothing is gathered on the driver but one row of counts a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import drop, stage
from millrace.operators.joins import join_groups


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) of every node of ``edges``.

    ``edges`` has the columns ``a`` and ``b`` (long); loops, repeats and both directions may
    occur, nulls are left out. No edges give no rows.
    """
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stage(edges, "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.select("u", "v").union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), F.least("u", "m").alias("m"))
        large = join_groups(edges, low, ["v"], "inner").select("u", F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = join_groups(large, low, ["u"], "inner").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        turned = stage(small.union(low.select("u", "m")).distinct(), "edges")
        drop(edges)
        edges, before, mark = turned, mark, _mark(turned)
        if mark == before:
            break
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
