"""Training many data sets with a resumable record (K4) and the
local-score record (K8)."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from centrix.operators.history import pending
from centrix.operators.metrics import cost_reduction, dataset_info, join_truth, nmi
from centrix.plans.ledger import Ledger
from centrix.plans.lloyd import fit
from centrix.sources.csv import TIME_SCHEMA, read_history, write_history
from centrix.sources.dataset import load_dataset
from centrix.sources.fs import path_exists
from centrix.sources.text import load_output


def train_many(spark: SparkSession, root: str, names: list[str], history_path: str,
               max_iter: int = 100, method: str = "arrow", ledger: Ledger | None = None) -> DataFrame:
    """K4: train every data set not yet in the history, each once.

    Any number of drivers may do so at a time with one history: a data set is
    claimed before it is trained and its record is published as a whole (see
    ``plans.ledger``).  A set that another driver works on is waited for; if that
    driver dies, it is taken over.  Nothing written is ever rewritten.
    """
    def history() -> DataFrame:
        there = path_exists(spark, history_path)
        return read_history(spark, history_path, TIME_SCHEMA) if there else spark.createDataFrame([], TIME_SCHEMA)

    ledger = ledger or Ledger(spark, history_path)
    todo = spark.createDataFrame([(n,) for n in dict.fromkeys(names)], "dataset STRING")
    left = [row["dataset"] for row in pending(todo, history()).collect()]   # one row per data-set name
    while left:
        for name in list(left):
            if ledger.recorded(name):
                left.remove(name)
                continue
            claim = ledger.claim(name)
            if claim is None:
                continue
            if not ledger.recorded(name):   # by the holder of an earlier claim
                ms = ledger.work(claim, lambda name=name: _trained_ms(spark, root, name, max_iter, method))
                ledger.record(name, ["dataset", "time"], [name, ms])
            left.remove(name)
        if left:
            ledger.wait()
    return history()


def _trained_ms(spark: SparkSession, root: str, name: str, max_iter: int, method: str) -> float:
    ds = load_dataset(spark, root, name)
    t0 = time.time()
    res = fit(ds.points, ds.start_centroids, max_iter=max_iter, method=method)
    res.centroids().collect()
    ms = round((time.time() - t0) * 1000.0, 3)
    res.unpersist()
    return ms


def write_dataset(root: str, name: str, points: DataFrame, partition: DataFrame | None = None,
                  true_centroids: DataFrame | None = None, start: DataFrame | None = None) -> None:
    """Write the roles of one data set as text files under ``root``
    (``name.txt``, ``-pa``, ``-c``, ``-ic``), each in id order (S5).  Start
    centroids keep their fractions; the other roles are integers."""
    from centrix.sources import dataset as DS
    from centrix.sources.text import write_points
    base = f"{root.rstrip('/')}/{name}"
    write_points(points, base + DS.SUFFIX_POINTS)
    if partition is not None:
        write_points(partition.select("point_id", F.array("label").alias("coord")), base + DS.SUFFIX_PARTITION)
    if true_centroids is not None:
        write_points(true_centroids.withColumnRenamed("cluster_id", "point_id"), base + DS.SUFFIX_TRUE_CENTROIDS)
    if start is not None:
        write_points(start.withColumnRenamed("cluster_id", "point_id"), base + DS.SUFFIX_START_CENTROIDS, integer=False)


def time_fits(named_sets: dict, max_iter: int, method: str) -> list[tuple[str, float]]:
    """Wall time (ms, 3 decimals) of one fit per data set: ``{name: (points, start)}``."""
    out = []
    for name, (points, start) in named_sets.items():
        t0 = time.time()
        res = fit(points, start, max_iter=max_iter, method=method)
        res.centroids().collect()
        out.append((name, round((time.time() - t0) * 1000.0, 3)))
        res.unpersist()
    return out


def score_record(name: str, points: DataFrame, partition: DataFrame, labels: DataFrame,
                 time_ms: float | None = None) -> DataFrame:
    """K8: one row ``(dataset, n_samples, n_features, n_clusters,
    training_time_ms, nmi)`` — profile, time and NMI together."""
    prof = dataset_info(points, labels=partition)
    score = nmi(join_truth(labels, partition))
    return prof.select(F.lit(name).alias("dataset"), "n_samples", "n_features", "n_clusters",
                       F.lit(time_ms).cast("double").alias("training_time_ms"),
                       score.scalar().alias("nmi"))


def local_record(score: DataFrame) -> DataFrame:
    """A :func:`score_record` row under the column names of the local run
    history (``LOCAL_SCHEMA``), ready to append."""
    return score.withColumnsRenamed({"training_time_ms": "training_time (ms)", "nmi": "NMI score"})


def append_local_record(score: DataFrame, path: str) -> None:
    """Append one scored run to the local history CSV."""
    write_history(local_record(score), path, mode="append")


def score_output(spark: SparkSession, path: str, partition: DataFrame, fmt: str = "parquet") -> DataFrame:
    """Score a saved result in one step: ``(nmi, cost_reduction_pct)``, the NMI
    of its labels rounded to 4 places and the last cost drop in % at 2."""
    out = load_output(spark, path, fmt)
    score = nmi(join_truth(out["label"], partition)).select(F.round("nmi", 4).alias("nmi"))
    return score.select("nmi", cost_reduction(out["cost"]).scalar().alias("cost_reduction_pct"))


def prepare_datasets(spark: SparkSession, root: str, out: str, sizes: list[int], k: int, seed: int = 0) -> list[str]:
    """Data preparation: every data set of ``root`` enlarged to each size,
    seeded, and saved with its four roles under ``out`` as ``<name>e<i>``."""
    from centrix.operators.expand import expand
    from centrix.operators.seed import kmeanspp
    from centrix.sources.dataset import list_datasets
    names = []
    for row in list_datasets(spark, root).collect():
        ds = load_dataset(spark, root, row["dataset"])
        for i, size in enumerate(sizes, start=1):
            points, partition = expand(ds.points, ds.partition, ds.true_centroids, size, seed=seed)
            name = f"{row['dataset']}e{i}"
            start = kmeanspp(points, k, seed=seed).select("cluster_id", "coord")
            write_dataset(out, name, points, partition, ds.true_centroids, start)
            names.append(name)
    return names
