import hashlib

from pyspark.sql import functions as F

from centrix.llm import mixing
from centrix.llm.catalog import op7_mixing, word_count
from tests.llm.helpers import DIR1, EDGE, edge, empty


def _targets(sizes, weights=(5, 2, 1), percent=150, most=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, held, out = percent * sum(sizes.values()) / 100, set(), {}
    while True:
        rest = total - sum(most * sizes[s] for s in held)
        open_ = [s for s in order if s not in held]
        share = rest / sum(weight[s] for s in open_) if open_ else 0
        more = {s for s in open_ if most * sizes[s] < weight[s] * share}
        out = {s: most * sizes[s] if s in held else weight[s] * share for s in order}
        if not more:
            return out
        held |= more


def _mix(rows):
    """taken per (id, size, source) row."""
    sizes = {}
    for _, s, z in rows:
        sizes[s] = sizes.get(s, 0) + z
    goal, out = _targets(sizes), []
    for s in sizes:
        rate = min(2.0, goal[s] / sizes[s]) if sizes[s] else 0.0
        sure, p = int(rate), rate - int(rate)
        mine = sorted({(i, z) for i, t, z in rows if t == s}, key=str)
        count = {x: sum((i, z) == x and t == s for i, t, z in rows) for x in mine}
        left, ranked = goal[s] - sum(sure * z * count[i, z] for i, z in mine), []
        if p > 0:
            for i, z in mine:
                text = "|".join(["mix", *([] if i is None else [str(i)]), str(z)])
                u = (int(hashlib.md5(text.encode()).hexdigest()[:13], 16) + 0.5) / 2**52
                ranked.append((u * (1 - p) / ((1 - u) * p), i is not None, i or 0, z, (i, z)))
        ranked.sort()
        took, k = set(), 0
        while k < len(ranked) and ranked[k][3] * count[ranked[k][4]] <= left:
            left -= ranked[k][3] * count[ranked[k][4]]
            took.add(ranked[k][4])
            k += 1
        better = [(abs(left - r[3]), *r) for r in ranked[k:] if abs(left - r[3]) < abs(left)]
        if better:
            took.add(min(better)[-1])
        out += [(i, s, z, (sure + ((i, z) in took)) * z) for i, t, z in rows if t == s]
    return out, goal


def test_documents_and_edges(spark):
    docs = spark.read.parquet(f"{DIR1}/documents.parquet").select("doc_id", "source", word_count().alias("size"))
    for df in (docs, edge(spark).select("doc_id", "source", word_count().alias("size"), "target", "copies")):
        rows = [(r.doc_id, r.source, r["size"]) for r in df.collect()]
        want, goal = _mix(rows)
        got = mixing.mix(df).collect()
        assert sorted(((r.doc_id, r.source, r["size"], r.taken) for r in got), key=str) == sorted(want, key=str)
        assert all(abs(r.target - goal[r.source]) < 1e-6 and r.taken <= 2 * r["size"] for r in got)
    assert len(got) == len(EDGE)
    assert mixing.mix(empty(spark).select("doc_id", "source", F.lit(1).alias("size"))).count() == 0


def test_reruns_and_partitionings_agree(spark):
    docs = spark.read.parquet(f"{DIR1}/documents.parquet").select("doc_id", "source", word_count().alias("size"))
    assert sorted(op7_mixing(spark, DIR1).collect()) == sorted(op7_mixing(spark, DIR1).collect())
    a, b = (sorted((r.doc_id, r.taken) for r in mixing.mix(d).collect()) for d in (docs, docs.repartition(9, "size")))
    assert a == b


def test_unequal_odds(spark):
    rows = [(i, f"s{i % 2}", 10 + i % 5, 1.0 + 3 * (i % 10 == 0)) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, source STRING, size BIGINT, w DOUBLE")
    got = mixing.mix(df, weights=(1, 1), percent=40, odds_col="w").collect()
    by = {}
    for r in got:
        by.setdefault(r.source, [0, r.target])[0] += r.taken
    assert all(abs(taken - target) <= 10 for taken, target in by.values())
    heavy = [r.copies for r in got if r.w > 1 and r.source == "s0"]
    light = [r.copies for r in got if r.w == 1 and r.source == "s0"]
    assert sum(heavy) / len(heavy) > 2.5 * sum(light) / len(light) and max(r.copies for r in got) <= 2


def test_targets_stop_at_their_sources(spark):
    sizes = {"a": 10, "b": 1000, "c": 5000, None: 7, "é": 0}
    df = spark.createDataFrame(list(sizes.items()), "source STRING, source_size BIGINT")
    got = {r.source: r.target for r in mixing.targets(df, (5, 2, 1), 150, 2).collect()}
    want = _targets(sizes)
    assert all(abs(got[s] - want[s]) < 1e-6 for s in sizes) and abs(sum(got.values()) - 1.5 * sum(sizes.values())) < 1e-6
