"""Collocations against a plain count of all phrases."""

import re
from collections import Counter

import numpy as np

from centrix.llm import phrases

from .helpers import EDGE, edge, empty


def brute(rows, longest=3, least=10, top=2000, inside=50):
    total, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            f.update((lang, tuple(words[i:i + m])) for m in range(1, longest + 1) for i in range(len(words) - m + 1))
    held = [(lang, p, a) for (lang, p), a in f.items() if len(p) > 1 and a >= least]
    out = {}
    for lang, p, a in held:
        if any(100 * b >= inside * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
               for other, q, b in held if other == lang and len(q) > len(p)):
            continue
        score, _, left, right = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return {(lang, rank, p.decode(), -a, left, right, total[lang], -score)
            for lang, rows in out.items() for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], start=1)}


def mined(docs, **params):
    return {tuple(r) for r in phrases.mine(docs, **params).collect()}


def sentences(seed, n, words, size=30):
    rng = np.random.default_rng(seed)
    names = [f"w{i}" for i in range(words)] + ["é", "日本", "x y", "A\tB", "end.", "a,b", "\n", "q\r\nr"]
    return [" ".join(names[i] for i in rng.zipf(1.4, size=size) % len(names)) for _ in range(n)]


def test_counts_and_ranks_against_brute_force(spark):
    rows = [(t, lang) for lang, seed in (("en", 1), (None, 2), ("und", 3)) for t in sentences(seed, 60, 40)]
    docs = spark.createDataFrame(rows, "text STRING, lang STRING").repartition(5)
    want = brute(rows)
    assert len(want) > 100 and mined(docs) == want
    # many shards and groups, a short list, longer phrases
    assert mined(docs, shard_bytes=200, group_bytes=300) == want
    assert mined(docs, top=7, shard_bytes=500) == brute(rows, top=7)
    assert mined(docs, longest=5, least=4, shard_bytes=900, group_bytes=2000) == brute(rows, longest=5, least=4)


def test_edge_rows(spark):
    rows = [(r[1], r[2]) for r in EDGE]
    assert mined(edge(spark)) == brute(rows)
    assert mined(edge(spark), least=1) == brute(rows, least=1)
    assert mined(empty(spark)) == set()


def test_a_pair_and_a_passage_that_fill_the_corpus(spark):
    rows = [("very common " * 50, "en")] * 40 + [(f"one passage that all share {i % 7}", "en") for i in range(60)]
    docs = spark.createDataFrame(rows, "text STRING, lang STRING").repartition(6)
    assert mined(docs, shard_bytes=1000, group_bytes=1000) == brute(rows)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3_000_000_000_000
    found = spark.range(1).selectExpr(
        f"cast(1000000 as decimal(7,0)) * cast({big}L as decimal(19,0)) * cast({big}L as decimal(19,0)) div (cast({big + 7}L as decimal(19,0)) * cast({big + 1}L as decimal(19,0))) AS x")
    assert found.first()["x"] == 1000000 * big * big // ((big + 7) * (big + 1))


def test_quicksort_finds_each_heavy_suffix_once():
    rng = np.random.default_rng(5)
    for width in (1, 2, 4):
        words = rng.zipf(1.5, size=3000 * width).astype(np.int64) % 30
        weight = rng.integers(1, 4, size=3000)
        want = Counter()
        for i, w in enumerate(weight.tolist()):
            want[tuple(words[i * width:(i + 1) * width].tolist())] += w
        at, totals = phrases.frequent(words, width, weight, 9)
        assert {tuple(words[p:p + width].tolist()): n for p, n in zip(at, totals)} == {k: n for k, n in want.items() if n >= 9}
        assert len(at) == len({tuple(words[p:p + width].tolist()) for p in at})
