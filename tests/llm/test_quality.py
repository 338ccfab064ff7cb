import collections
import math
import random
import re

import numpy as np

from centrix.llm import quality_model, quality_rules
from tests.llm.helpers import DIR2, EDGE, documents, edge, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _base(text):
    t = text or ""
    w = WORD.findall(t)
    windows = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered), failed


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id BIGINT, quality INT, toxic INT")


def test_base_counts(spark):
    none = _labels(spark, [])
    for df, texts in ((edge(spark), [r[1] for r in EDGE]), (documents(spark), None)):
        texts = texts or [r.text for r in df.collect()]
        got = quality_rules.apply_rules(df, none).collect()
        assert sorted(tuple(r[1:7]) for r in got) == sorted(_base(t) for t in texts)
        assert all(r.kept == (not r.base_failed) for r in got)   # nothing is proven without labels
    assert quality_rules.apply_rules(empty(spark), none).count() == 0


def test_repeated_words_on_random_sequences():
    rng = random.Random(2)
    for _ in range(200):
        w = [rng.choice("ab") for _ in range(rng.randint(0, 60))]
        ids = np.array([ord(c) for c in w], dtype=np.int64) % len(w) if w else np.array([], dtype=np.int64)
        assert quality_rules.repeated_words(np.unique(ids, return_inverse=True)[1] if w else ids) == _base(" ".join(w))[4]


def test_binomial_bound_is_exact():
    for n in (1, 10, 60):
        assert math.isclose(quality_rules.binomial_upper(0, n, 0.05), 1 - 0.05 ** (1 / n), rel_tol=1e-6)
        for k in range(n):
            p = quality_rules.binomial_upper(k, n, 0.05)
            at_most = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
            assert math.isclose(at_most, 0.05, rel_tol=1e-4)
        for p in (0.01, 0.1, 0.4):   # the bound falls short of the truth with probability 0.05 at most
            miss = sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1) if quality_rules.binomial_upper(k, n, 0.05) < p)
            assert miss <= 0.05 + 1e-9


def test_cutoffs_hold_their_risk(spark):
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta"]
    rows, labels = [], []
    for i in range(2400):
        good = i % 4 > 0
        body = [rng.choice(words) + str(rng.randint(0, 999)) for _ in range(40)]
        rows.append((i, " ".join(w + ("" if good or rng.random() < 0.3 else "###") for w in body), "en", "s", 0))
        labels.append((i, int(good), 0))
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    got = {r.doc_id: r for r in quality_rules.apply_rules(df, _labels(spark, labels + labels[:50] + [(None, 1, 0), (7, None, None)])).collect()}
    good = [got[i].kept for i, y, _ in labels if y]
    bad = [got[i].kept for i, y, _ in labels if not y]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.05 * len(bad)
    # too few labels prove nothing
    few = quality_rules.apply_rules(df, _labels(spark, labels[:60])).collect()
    assert all(r.kept for r in few)


def test_quality_model_on_labels(spark):
    got = {r.doc_id: r for r in quality_model.classify(documents(spark, DIR2)).select("doc_id", "quality_score", "kept").collect()}
    labels = spark.read.parquet(f"{DIR2}/labels.parquet").collect()
    good = [got[r.doc_id].kept for r in labels if r.quality == 1]
    bad = [got[r.doc_id].kept for r in labels if r.quality == 0]
    assert sum(good) >= 0.995 * len(good) and sum(bad) <= 0.05 * len(bad)
    again = {r.doc_id: r.quality_score for r in quality_model.classify(documents(spark, DIR2).repartition(7)).collect()}
    assert all(abs(again[i] - r.quality_score) < 1e-9 for i, r in got.items())


def test_quality_model_edges(spark):
    rows = quality_model.classify(edge(spark)).select("doc_id", "text", "quality_score", "kept", "score").collect()
    assert len(rows) == len(EDGE) and all(0 <= r.quality_score <= 1 and r.score == "clash" for r in rows)
    assert len({r.quality_score for r in rows if r.text in (None, "")}) == 1
    assert quality_model.classify(empty(spark)).count() == 0


def test_label_model_finds_the_rare_bad_votes():
    rng = random.Random(9)
    m = len(quality_model.LABELLERS)
    counts, truth = collections.Counter(), {}
    for _ in range(4000):
        bad = rng.random() < 0.1
        kind = rng.randrange(3)
        votes = [1 if (bad and j == kind) or rng.random() < 0.001 else 2 for j in range(m)]
        code = 0
        for v in votes:
            code = code * quality_model.VOTES + v
        counts[code] += 1
        truth.setdefault(code, []).append(bad)
    post = quality_model.fit_labellers(dict(counts))
    for code, n in counts.items():
        if n > 50:
            assert (post[code] < 0.5) == (sum(truth[code]) > n / 2)
