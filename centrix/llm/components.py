"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _large_star(e: DataFrame) -> DataFrame:
    """Each node sends its larger neighbours to the smallest node it knows."""
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    low = low.select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    return (both.join(low, both.u == low.c).where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """Each node sends its smaller neighbours and itself to the smallest one."""
    low = e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
    sent = e.join(low, e.u == low.c).select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = low.select(F.col("c").alias("u"), F.col("m").alias("v"))
    return sent.union(own).where("u <> v").distinct()


def _stars(e: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, which has none itself."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        e.select(F.col("v").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    each = ends.groupBy("x").agg(F.sum("down").alias("down"), F.sum("up").alias("up"))
    return each.where("down > 1 or (down = 1 and up > 0)").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "cc") -> DataFrame:
    """``(node, root)`` for every node of an undirected edge table, ``root``
    the smallest node reachable (under Spark's order of the column's type).

    Edges with a null end and loops are ignored (a node with a loop only has
    no row); repeated edges count once.  An empty table gives an empty table.
    Each round is grouped by partial aggregates and skew-splittable joins (a
    hub's edges are never one task's group) and is written to the shared
    folder; rounds grow with the logarithm of the largest component.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"),
                     F.col(a).isNull().alias("an"), F.col(b).isNull().alias("bn"))
    e = cut(e.where("not an and not bn and u <> v").select("u", "v").distinct(), name)
    while not _stars(e):
        e = cut(_small_star(_large_star(e)), name)
    node = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return node.union(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
