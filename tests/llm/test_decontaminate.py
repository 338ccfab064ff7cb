"""Benchmark passages against a plain search for every window."""

import re

import numpy as np
from pyspark.sql import functions as F

from centrix.llm import decontaminate

from .helpers import EDGE, edge, empty

BENCH = "item_id STRING, text STRING"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, bench, window=10):
    out = []
    for key, text in docs:
        own, hit, items = words(text), set(), set()
        for item, passage in bench:
            p = words(passage)
            for i in range(max(1, len(p) - window + 1) if p else 0):
                w = p[i:i + window]
                for j in range(len(own) - len(w) + 1):
                    if own[j:j + len(w)] == w:
                        hit.update(range(j, j + len(w)))
                        items.add("" if item is None else str(item))
        starts = [i for i in sorted(hit) if i - 1 not in hit]
        spans = [(i, next(j for j in range(i, len(own) + 1) if j not in hit) - i) for i in starts]
        out.append((key, len(own), spans, sorted(items)))
    return sorted(out, key=str)


def found(docs, bench, **params):
    rows = decontaminate.find(docs, bench, **params).collect()
    return sorted([(r[0], r["n_words"], [tuple(s) for s in r["spans"]], r["items"]) for r in rows], key=str)


def planted(seed=3, n=60):
    rng = np.random.default_rng(seed)
    names = [f"W{i}" for i in range(12)] + ["Éa", "日本", "9-1", "x_y"]
    text = lambda size: " ".join(names[i] for i in rng.integers(0, len(names), size=size))
    bench = [(str(i), text(int(rng.integers(0, 40)))) for i in range(12)] + [("7", text(15)), (None, text(20)), ("short", "w1, W2!"), ("none", "-- _ --"), ("nil", None)]
    docs = []
    for i in range(n):
        parts = [text(int(rng.integers(0, 60)))]
        for _ in range(int(rng.integers(0, 3))):
            passage = words(bench[int(rng.integers(0, 14))][1])
            cut = int(rng.integers(0, 5))
            parts += [" ".join(passage[cut:]).upper(), text(int(rng.integers(0, 9)))]
        docs.append((i // 2, " ".join(parts)))  # ids in twos
    return docs, bench


def test_against_brute_force(spark):
    docs, bench = planted()
    d, b = spark.createDataFrame(docs, "doc_id BIGINT, text STRING").repartition(3), spark.createDataFrame(bench, BENCH)
    want = brute(docs, bench)
    assert any(len(r[3]) > 1 for r in want) and any(not r[3] for r in want)
    assert found(d, b) == want
    # several documents a shard or one, the benchmark in parts
    assert found(d, b, shard_bytes=300) == want
    assert found(d, b, shard_bytes=1, bench_bytes=200) == want
    assert found(d, b, window=4) == brute(docs, bench, 4)
    kept = sorted(r["doc_id"] for r in decontaminate.remove(d.withColumn("extra", F.lit(1)), b).collect())
    assert kept == sorted(r[0] for r in want if not r[3])


def test_edge_rows(spark):
    rows = [(r[0], r[1]) for r in EDGE]
    bench = [("1", "Line of text another LINE of it"), ("2", "words here"), ("3", None), ("4", ""), ("2", "one line of text another line of it one line of text"),
             ("5", " ".join(["long words here"] * 5))]
    b = spark.createDataFrame(bench, BENCH).withColumn("words", F.lit("clash")).withColumn("p", F.lit("clash"))
    long_free = [r if len(r[1] or "") < 1000 else (r[0], "long words here. " * 30) for r in rows]
    small = spark.createDataFrame(long_free, "doc_id BIGINT, text STRING").withColumn("_t", F.lit("clash"))
    assert found(small, b) == brute(long_free, bench)
    long = {r[0]: r for r in found(edge(spark), b)}[5]
    assert long[1] == 60_000 and long[2] == [(0, 60_000)] and long[3] == ["2", "5"]
    assert found(empty(spark), b) == []
    assert all(r[2:] == ([], []) for r in found(edge(spark), spark.createDataFrame([], BENCH)))
    assert decontaminate.remove(empty(spark), b).count() == 0


def test_longest_match_of_every_suffix(spark):
    docs, bench = planted(seed=9, n=30)
    bench = [(i, t) for n, (i, t) in enumerate(bench) if i != "7"]
    d = spark.createDataFrame([*docs, (None, bench[2][1])], "doc_id BIGINT, text STRING").repartition(2)
    want = {}
    for item, text in bench:
        p = words(text)
        for i in range(len(p)):
            best = None
            for key, t in [*docs, (None, bench[2][1])]:
                own = words(t)
                for j in range(len(own)):
                    size = 0
                    while i + size < len(p) and j + size < len(own) and p[i + size] == own[j + size]:
                        size += 1
                    if size:
                        got = (-size, key is None, key or 0, j)
                        best = min(best or got, got)
            if best:
                want[item, i] = (-best[0], None if best[1] else best[2], best[3])
    for params in ({}, {"shard_bytes": 400, "bench_bytes": 300}):
        rows = decontaminate.longest(d, spark.createDataFrame(bench, BENCH), **params).collect()
        assert {(r["item_id"], r["item_start"]): (r["n_words"], r["doc_id"], r["start"]) for r in rows} == want


def test_suffix_array_orders_to_its_depth():
    rng = np.random.default_rng(2)
    for size, kinds in ((0, 3), (1, 1), (2000, 2), (3000, 500)):
        row = rng.integers(1, kinds + 1, size=size).astype(np.int32)
        row[size // 2:] = row[:size - size // 2]  # a copy
        for depth in (1, 3, 10, 4096):
            order = decontaminate.suffix_array(row, kinds, depth)
            tails = [tuple(row[i:i + min(depth, 300)].tolist()) for i in order]
            assert tails == sorted(tails) and sorted(order.tolist()) == list(range(size))
