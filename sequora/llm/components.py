"""Connected components of a graph that is a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sequora.llm.common import stage


def _are_stars(edges: DataFrame) -> bool:
    """Whether every edge (u, v) leads straight to the centre of a star: each u once, and no v is a u."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).union(edges.select("v", F.lit(0), F.lit(1)))
    each = ends.groupBy("x").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre"))
    return each.where((F.col("leaf") > 1) | ((F.col("leaf") > 0) & (F.col("centre") > 0))).isEmpty()


def connected_components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """Columns node and component (its least node) for every node of edges (a, b).

    Alternates the large-star and small-star steps (Kiveris et al., 2014), each a minimum by node and
    a join, until the edges are stars; every round's edges are staged in the shared folder. Steps keep
    what is connected, and lead from larger to smaller nodes, so stars are the components. The
    number of rounds grows with the logarithm of the longest path. Nodes without an edge to another
    node aren't returned; nulls are left out.
    """
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(rounds):
        if _are_stars(now):
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        now = stage(small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", "m")).where("u <> v").distinct(), "edges")
    raise RuntimeError(f"components not found in {rounds} rounds")
