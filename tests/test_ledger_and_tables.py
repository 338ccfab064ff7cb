"""Shared run history and durable tables: once, whole, or not at all."""

import threading

import pytest
from pyspark.sql import functions as F

from centrix.plans import runs
from centrix.plans.ledger import Ledger
from centrix.plans.runs import train_many, write_dataset
from centrix.sources.csv import TIME_SCHEMA, read_history
from centrix.sources.fs import publish, touch
from centrix.sources.tables import clear_table, drop_table, replace_table
from tests.conftest import cents, pts


def _sets(spark, root, names):
    for name in names:
        write_dataset(root, name, pts(spark, [[0, 0], [0, 2], [9, 9]]), start=cents(spark, [[0, 0], [9, 9]]))


def test_a_file_is_published_once(spark, tmp_path):
    path, won = str(tmp_path / "deep" / "claim"), []
    threads = [threading.Thread(target=lambda i=i: won.append(i) if publish(spark, path, f"by {i}\n" * 1000) else None) for i in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and (tmp_path / "deep" / "claim").read_text() == f"by {won[0]}\n" * 1000
    assert [p.name for p in (tmp_path / "deep").iterdir()] == ["claim"]


def test_two_drivers_record_each_set_once(spark, tmp_path, monkeypatch):
    root, hist, names = str(tmp_path / "s"), str(tmp_path / "h"), ["a", "b", "c"]
    _sets(spark, root, names)
    trained, real = [], runs._trained_ms
    monkeypatch.setattr(runs, "_trained_ms", lambda s, r, name, *a: trained.append(name) or real(s, r, name, *a))
    out = {}
    threads = [threading.Thread(target=lambda i=i: out.update({i: train_many(spark, root, names, hist, max_iter=2).collect()})) for i in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(trained) == sorted(names)
    assert all(sorted(r.dataset for r in rows) == sorted(names) for rows in out.values())
    assert read_history(spark, hist, TIME_SCHEMA).count() == 3


def test_a_dead_drivers_claim_is_taken_over_and_a_late_record_is_refused(spark, tmp_path):
    root, hist = str(tmp_path / "s"), str(tmp_path / "h")
    _sets(spark, root, ["a"])
    dead = Ledger(spark, hist, beat=0.05, stale=0.4)
    claim = dead.claim("a")
    assert claim and dead.claim("a") is None      # held, while fresh
    touch(spark, claim)
    rows = train_many(spark, root, ["a"], hist, max_iter=2, ledger=Ledger(spark, hist, beat=0.05, stale=0.4)).collect()
    assert [r.dataset for r in rows] == ["a"]
    assert not dead.record("a", ["dataset", "time"], ["a", 1.0])
    assert read_history(spark, hist, TIME_SCHEMA).collect() == rows


def test_a_failed_run_gives_its_claim_up(spark, tmp_path, monkeypatch):
    root, hist = str(tmp_path / "s"), str(tmp_path / "h")
    _sets(spark, root, ["a"])
    with monkeypatch.context() as m:
        m.setattr(runs, "fit", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            train_many(spark, root, ["a"], hist, max_iter=2)
    assert [r.dataset for r in train_many(spark, root, ["a"], hist, max_iter=2).collect()] == ["a"]


def test_a_failed_replacement_leaves_the_old_rows(spark):
    name = "centrix_versions_test"
    try:
        old = replace_table(spark.range(5).toDF("x"), name, durable=True)
        with pytest.raises(Exception, match="no luck"):
            bad = F.when(F.col("id") == 700, F.raise_error(F.lit("no luck"))).otherwise(F.col("id"))
            replace_table(spark.range(1000).select(bad.alias("x")), name, durable=True)
        assert spark.table(name).count() == 5
        # from itself, with another column; who had the old version still reads it
        new = replace_table(spark.table(name).where("x > 2").withColumn("y", F.lit("b")), name, durable=True)
        assert sorted(map(tuple, new.collect())) == [(3, "b"), (4, "b")] and old.count() == 5
        clear_table(spark, name)
        assert spark.table(name).count() == 0 and spark.table(name).columns == ["x", "y"]
    finally:
        drop_table(spark, name)
    assert not spark.catalog.tableExists(name)
