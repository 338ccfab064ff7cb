"""Headline timings at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS].  Prints one JSON line.

Shapes follow the reference's published runs (100 Lloyd iterations each; the
times of the Lloyd rows include every point's final label):
  kmeanspp_points2_k50     greedy k-means++ seeding, k=50, on events points (d=2)
  lloyd100_points2_k50     n = events rows (1e5 at sf0.1), d=2, k=50   (like a3e2)
  lloyd100_points64_k10    n = embeddings rows, d=64, k=10
  expand_points64_x50      embeddings enlarged 50x with synthetic points
  lloyd100_expanded64_k10  n = 50 x embeddings rows (1e5 at sf0.1), d=64, k=10
  nmi_expanded64           NMI of that clustering against the labels
  expand_points2_x10       events points enlarged 10x (1e6 at sf0.1)
  lloyd100_points2x10_k50  n = 10 x events rows, d=2, k=50                (like a3e3)
  lloyd100_points128_k10   n = embeddings rows, d=128, k=10
  lloyd100_points512_k10   n = embeddings rows, d=512, k=10
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import StorageLevel  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from centrix.operators import expand as X  # noqa: E402
from centrix.operators import metrics as M  # noqa: E402
from centrix.operators.seed import kmeanspp  # noqa: E402
from centrix.plans.lloyd import fit  # noqa: E402
from centrix.session import get_spark  # noqa: E402
from centrix.sources import testdata as td  # noqa: E402


def _sf_value(sf_dir: str):
    name = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        return float(name)
    except ValueError:
        return name


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(master=f"local[{cpus}]", app="centrix-bench", shuffle_partitions=int(cpus),
                      driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        return out

    def train(points, start):
        res = fit(points, start, max_iter=100)
        res.labels().write.format("noop").mode("overwrite").save()
        return res

    # warm the JVM and Python workers once (not timed)
    fit(td.points64(spark, sf_dir), td.start64(spark, sf_dir), max_iter=2).centroids().collect()

    pts2 = td.points2(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    pts2.count()
    start50 = timed("kmeanspp_points2_k50", lambda: kmeanspp(pts2, 50, seed=222).cache())
    start50.count()
    res2 = timed("lloyd100_points2_k50", lambda: train(pts2, start50.select("cluster_id", "coord")))
    cost2 = res2.costs().orderBy("iter").collect()

    pts64 = td.points64(spark, sf_dir)
    timed("lloyd100_points64_k10", lambda: train(pts64, td.start64(spark, sf_dir)))

    for times64 in (2, 8):   # wider vectors: the 64 features in turn, forward and back
        parts = [F.col("coord") if i % 2 == 0 else F.reverse("coord") for i in range(times64)]
        wide, first = (df.withColumn("coord", F.concat(*parts)) for df in (pts64, td.start64(spark, sf_dir)))
        timed(f"lloyd100_points{64 * times64}_k10", lambda w=wide, f=first: train(w, f)).unpersist()

    lab64 = td.partition64(spark, sf_dir)

    def make_big():
        n = pts64.count()
        big, big_lab = X.expand(pts64, lab64, X.true_centroids_from_labels(pts64, lab64), 50 * n, seed=222)
        big = big.persist(StorageLevel.MEMORY_AND_DISK)
        big.count()
        return big, big_lab

    big, big_lab = timed("expand_points64_x50", make_big)
    res_big = timed("lloyd100_expanded64_k10", lambda: train(big, td.start64(spark, sf_dir)))
    nmi = timed("nmi_expanded64", lambda: M.nmi(M.join_truth(res_big.labels(), big_lab)).first()["nmi"])
    res_big.unpersist()
    big.unpersist()

    lab2 = td.partition2(spark, sf_dir)

    def make_big2():
        n = pts2.count()
        b, _ = X.expand(pts2, lab2, X.true_centroids_from_labels(pts2, lab2), 10 * n, seed=222)
        b = b.persist(StorageLevel.MEMORY_AND_DISK)
        b.count()
        return b

    big2 = timed("expand_points2_x10", make_big2)
    timed("lloyd100_points2x10_k50", lambda: train(big2, start50.select("cluster_id", "coord")))

    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": _sf_value(sf_dir),
        "notes": {"nmi_expanded64": round(float(nmi), 6),
                  "cost_drop_points2_pct": round((cost2[0]["cost"] - cost2[-1]["cost"]) / cost2[0]["cost"] * 100, 3),
                  "n_points2": pts2.count(), "n_expanded64": big.count(), "n_points2x10": big2.count()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
