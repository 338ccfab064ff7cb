"""Scoring (A8, A9, J4, P1): contingency, NMI, cost reduction, profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def join_truth(assigned: DataFrame, partition: DataFrame) -> DataFrame:
    """Prediction next to the true label, joined on point_id."""
    return assigned.select("point_id", "cluster_id").join(partition.select("point_id", "label"), "point_id")


def contingency(pairs: DataFrame, a: str = "label", b: str = "cluster_id") -> DataFrame:
    """``(a, b, n)`` counts (partial + final aggregate)."""
    return pairs.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def nmi(pairs: DataFrame, a: str = "label", b: str = "cluster_id") -> DataFrame:
    """Normalised mutual information of two labelings, one row ``(nmi)``.

    NMI = I(a; b) / mean(H(a), H(b)) with natural logs; 1.0 when the labelings
    are the same but for names, 0.0 when I = 0 (up to rounding).  The pairs are
    counted once; cells, both marginals and the total are grouping sets of the
    contingency table, and all terms are sums of ``n ln n`` over one of them.
    """
    cells = contingency(pairs, a, b)
    sets = cells.groupingSets([[a, b], [a], [b], []], a, b).agg(F.sum("n").cast("double").alias("m"), F.grouping_id().alias("g"))
    term = F.col("m") * F.log("m")
    per = {"ab": 0, "a": 1, "b": 2, "all": 3}
    row = sets.agg(*[F.sum(F.when(F.col("g") == g, term)).alias(f"x{name}") for name, g in per.items()],
                   *[F.count_if(F.col("g") == g).alias(f"k{name}") for name, g in per.items()],
                   F.max(F.when(F.col("g") == 3, F.col("m"))).alias("n"))
    both = 2 * F.col("xall") - F.col("xa") - F.col("xb")     # n (H(a) + H(b))
    shared = F.col("xall") - F.col("xa") - F.col("xb") + F.col("xab")     # n I(a; b)
    return row.select(
        F.when((F.col("ka") == F.col("kab")) & (F.col("kb") == F.col("kab")), F.lit(1.0))
         .when(shared <= 1e-13 * F.col("xall"), F.lit(0.0))
         .otherwise(shared / (both / 2.0)).alias("nmi"))


def cost_reduction(costs: DataFrame) -> DataFrame:
    """``round((c[-2] - c[-1]) / c[-2] * 100, 2)`` over ``(iter, cost)``;
    null when the cost before was 0.

    Only the last two rows matter: a top-2 by iteration, then one row."""
    last2 = costs.orderBy(F.col("iter").desc()).limit(2)
    w = Window.orderBy("iter")
    prev = last2.select("iter", "cost", F.lag("cost").over(w).alias("prev"))
    prev = prev.filter(F.col("prev").isNotNull())
    c, p = F.col("cost").cast("double"), F.col("prev").cast("double")
    return prev.select(F.round(F.try_divide(p - c, p) * 100, 2).cast("decimal(10,2)").alias("cost_reduction_pct"))


def dataset_info(points: DataFrame, true_centroids: DataFrame | None = None,
                 labels: DataFrame | None = None) -> DataFrame:
    """``(n_samples, n_features, n_clusters)`` in one pass over points.

    k is the number of true centroids, or of distinct true labels.  Points of
    different lengths, or with a null, fail the job."""
    low, high = F.min(F.size("coord")), F.max(F.size("coord"))
    bad = (low != high) | (F.count_if(F.col("coord").isNull() | F.exists("coord", lambda x: x.isNull())) > 0)
    prof = points.agg(F.count(F.lit(1)).alias("n_samples"),
                      F.when(bad, F.raise_error(F.lit("ragged points or null features"))).otherwise(high).cast("int").alias("n_features"))
    if true_centroids is not None:
        k = true_centroids.agg(F.count(F.lit(1)).cast("int").alias("n_clusters"))
    elif labels is not None:
        k = labels.agg(F.countDistinct("label").cast("int").alias("n_clusters"))
    else:
        return prof
    # the cluster count is a scalar subquery: one value, no join
    return prof.select("*", k.scalar().alias("n_clusters"))
