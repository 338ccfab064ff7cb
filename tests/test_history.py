"""Run history and reports on inline history rows (shapes of the published
files, unsorted, with missing runs)."""

from centrix.operators.history import combine_times, pending, append_record, make_record
from centrix.operators.report import by_dimension, by_sample_size, system_columns


def _catalogue(spark):
    return spark.createDataFrame(
        [("a3", 7500, 2, 50), ("a3e1", 10000, 2, 50), ("dim032e1", 10000, 32, 16), ("dim032", 1024, 32, 16)],
        "dataset STRING, n_samples BIGINT, n_features INT, n_clusters INT")


def test_combine_by_name_not_position(spark):
    cat = _catalogue(spark)
    py = spark.createDataFrame([("dim032", 2.0), ("a3", 3.3), ("a3e1", 4.4)], "dataset STRING, time DOUBLE")
    sp = spark.createDataFrame([("a3e1", 20.0), ("dim032e1", 30.0)], "dataset STRING, time DOUBLE")
    out = {r.dataset: (r.python, r.spark2) for r in combine_times(cat, {"python": py, "spark2": sp}).collect()}
    assert out == {"a3": (3.3, None), "a3e1": (4.4, 20.0), "dim032e1": (None, 30.0), "dim032": (2.0, None)}


def test_pending_and_append(spark):
    todo = spark.createDataFrame([("a3",), ("a3e1",), ("a3e2",)], "dataset STRING")
    hist = make_record(spark, "a3", 1.0)
    assert sorted(r.dataset for r in pending(todo, hist).collect()) == ["a3e1", "a3e2"]
    assert append_record(hist, make_record(spark, "a3e1", 2.0)).count() == 2


def test_reports(spark):
    cat = _catalogue(spark)
    py = spark.createDataFrame([("dim032", 2.0), ("a3", 3.3), ("a3e1", 4.4), ("dim032e1", 27.0)],
                               "dataset STRING, time DOUBLE")
    comb = combine_times(cat, {"python": py})
    assert system_columns(comb) == ["python"]
    rows = sorted(tuple(r) for r in by_sample_size(comb, ["a3", "dim032"]).collect())
    assert ("a3", "python", 7500, 3.3) in rows and ("dim032", "python", 10000, 27.0) in rows
    dims = sorted(tuple(r) for r in by_dimension(comb, [10000]).collect())
    assert dims == [(10000, "python", 2, 4.4), (10000, "python", 32, 27.0)]
