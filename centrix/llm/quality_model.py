"""Quality classifier without gold labels.

Overlapping heuristic labellers vote good, bad or nothing on every document.
Expectation-maximisation over the counts of all vote patterns estimates each
labeller's accuracy (the probability of each vote given the class) and the
share of good documents; the posterior of a pattern labels its documents, and
a linear scorer over hashed features is trained on those soft labels.  The
scorer sees more than the votes (the shapes of the words, whole-text rates),
so it also ranks documents on which every labeller is silent.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WS, cut, hash_share, map_batches, text_or_empty

DIMENSIONS = 1 << 12
SYMBOLS = "#*$%&|<>{}[]\\^~="

_CAPITALS = bytes(range(65, 91))
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_SHAPE = bytes(97 if b > 127 or 97 <= b < 123 else 65 if 65 <= b < 91 else 48 if 48 <= b < 58 else b for b in range(256))


def rates(text: str) -> dict[str, float]:
    """What the labellers and the scorer look at, of the whole text."""
    raw = text.encode()
    words = raw.split()
    n = max(len(words), 1)
    chars = max(len(text) - sum(map(text.count, WS)), 1)
    letters = max(len(raw) - len(raw.translate(None, _LETTERS)), 1)
    lines = [x for x in text.split("\n") if x.strip(WS)]
    return {
        "words": len(words),
        "symbol": sum(map(text.count, SYMBOLS)) / chars,
        "capital": (len(raw) - len(raw.translate(None, _CAPITALS))) / letters,
        "shout": text.count("!") / n,
        "again": sum(map(bytes.__eq__, words, words[1:])) / n,
        "distinct": len(set(words)) / n,
        "same_line": 1 - len(set(lines)) / max(len(lines), 1),
        "length": chars / n,
        "letter": letters / max(len(raw) - len(words) + 1, 1),
        "stop": sum(map(raw.count, (b". ", b".\n", b"? ", b"! ", b".\""))) / n,
    }


def _vote(bad: bool, good: bool) -> int:
    return 1 if bad else 2 if good else 0


#: The labellers: 1 votes bad, 2 good, 0 abstains.
LABELLERS = [
    lambda r: _vote(r["symbol"] > 0.05, r["words"] >= 20 and r["symbol"] < 0.01),
    lambda r: _vote(r["words"] >= 5 and r["capital"] > 0.4, r["words"] >= 20 and r["capital"] < 0.1),
    lambda r: _vote(r["shout"] > 0.3, r["words"] >= 20 and r["shout"] < 0.02),
    lambda r: _vote(r["words"] >= 10 and r["again"] > 0.2, r["words"] >= 20 and r["again"] < 0.03),
    lambda r: _vote(r["words"] >= 30 and r["distinct"] < 0.15 * min(1.0, 1000 / r["words"]), r["words"] >= 20 and r["distinct"] > 0.3),
    lambda r: _vote(r["same_line"] > 0.4, False),
    lambda r: _vote(r["words"] >= 10 and not 2 <= r["length"] <= 14, r["words"] >= 20 and 3 <= r["length"] <= 10),
    lambda r: _vote(r["words"] >= 10 and r["letter"] < 0.6, r["words"] >= 20 and r["letter"] > 0.85),
]
VOTES = 3


def votes(r: dict[str, float]) -> int:
    """All votes as one number, base three."""
    code = 0
    for label in LABELLERS:
        code = code * VOTES + label(r)
    return code


_FEATURE: dict[bytes, int] = {}


def _slot(name: bytes) -> int:
    """Hashed slot of a feature name (memo of bounded size)."""
    slot = _FEATURE.get(name)
    if slot is None:
        import xxhash
        if len(_FEATURE) > 100_000:
            _FEATURE.clear()
        slot = _FEATURE[name] = xxhash.xxh64_intdigest(name, 7) % DIMENSIONS
    return slot


_RUNS = re.compile(rb"(.)\1+")
_COLLAPSED: dict[bytes, bytes] = {}


def _collapse(shape: bytes) -> bytes:
    out = _COLLAPSED.get(shape)
    if out is None:
        if len(_COLLAPSED) > 100_000:
            _COLLAPSED.clear()
        out = _COLLAPSED[shape] = _RUNS.sub(rb"\1", shape)[:12]
    return out


def features(text: str, r: dict[str, float]) -> dict[int, float]:
    """Hashed features: shares of word shapes, and the rates in coarse steps."""
    shapes: Counter[bytes] = Counter()
    for shape, count in Counter(text.encode().translate(_SHAPE).split()).items():
        shapes[_collapse(shape)] += count
    n = max(sum(shapes.values()), 1)
    out: dict[int, float] = {}
    for shape, count in shapes.items():
        slot = _slot(b"s " + shape)
        out[slot] = out.get(slot, 0.0) + count / n
    for name, value in r.items():
        step = int(np.log2(1 + value)) if name == "words" else round(min(value, 20.0) * 10)
        out[_slot(b"r %s %d" % (name.encode(), step))] = 0.5
    return out


def fit_labellers(patterns: dict[int, int], rounds: int = 100, slip: float = 0.002, trust: float = 10.0) -> dict[int, float]:
    """Posterior of "good" for every vote pattern, from the patterns' counts.

    A labeller has, per class, a probability of voting bad where it votes at
    all; silence tells nothing.  The start (any bad vote: bad) names the
    classes.  Kinds of bad text exclude each other, so most labellers call a
    bad document good; the prior that a labeller rejects a share ``slip`` of
    the good documents, with ``trust`` times the weight of the data, keeps one
    kind from drifting into the good class, and the bad class is never taken
    to be larger than the documents with any bad vote.  A bad vote never
    speaks for the good class, and counts are smoothed by one vote."""
    codes = np.array(sorted(patterns))
    weight = np.array([patterns[c] for c in codes], dtype=float)
    m = len(LABELLERS)
    cast = np.array([[c // VOTES ** (m - 1 - j) % VOTES for j in range(m)] for c in codes]).reshape(len(codes), m)
    says_bad, votes_at_all = (cast == 1).astype(float), (cast > 0).astype(float)
    post = np.where(says_bad.any(axis=1), 0.02, 0.98)
    suspected = weight[says_bad.any(axis=1)].sum()
    for _ in range(rounds):
        bad, good = weight * (1 - post), weight * post
        of_bad = (says_bad.T @ bad + 1) / (votes_at_all.T @ bad + 2)
        held = votes_at_all.T @ good
        of_good = np.minimum((says_bad.T @ good + slip * trust * held + 1) / ((1 + trust) * held + 2), of_bad)
        share = min(bad.sum(), suspected) + 1
        logit = np.log(weight.sum() + 2 - share) - np.log(share)
        logit = logit + says_bad @ (np.log(of_good) - np.log(of_bad)) + (votes_at_all - says_bad) @ (np.log1p(-of_good) - np.log1p(-of_bad))
        now = 1 / (1 + np.exp(-np.clip(logit, -50, 50)))
        if np.abs(now - post).max(initial=0) < 1e-6:
            break
        post = now
    return dict(zip(codes.tolist(), post.tolist(), strict=True))


def fit_scorer(rows: list[tuple[list[int], list[float], float]], rounds: int = 60, ridge: float = 1e-4) -> np.ndarray:
    """Weights (the last one the bias) of a logistic scorer on soft labels, by
    full-batch AdaGrad; classes weigh alike."""
    w = np.zeros(DIMENSIONS + 1)
    if not rows:
        return w
    at = np.concatenate([np.full(len(i), k) for k, (i, _, _) in enumerate(rows)])
    slot = np.concatenate([np.asarray(i, dtype=np.int64) for i, _, _ in rows])
    value = np.concatenate([np.asarray(v) for _, v, _ in rows])
    y = np.array([p for _, _, p in rows])
    share = min(max(y.mean(), 0.02), 0.98)
    weight = y * 0.5 / share + (1 - y) * 0.5 / (1 - share)
    seen = np.full(DIMENSIONS + 1, 1e-8)
    for _ in range(rounds):
        z = np.bincount(at, value * w[slot], len(rows)) + w[-1]
        error = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) / len(rows)
        g = np.append(np.bincount(slot, value * error[at], DIMENSIONS), error.sum()) + ridge * w
        seen += g * g
        w -= 0.5 * g / np.sqrt(seen)
    return w


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = 20_000) -> np.ndarray:
    """Scorer weights.  Vote patterns are counted over all documents (at most
    3^8 of them); the scorer is fitted on a hash sample of about ``max_rows``
    documents with their patterns' posteriors."""
    schema = T.StructType([T.StructField("sampled", T.BooleanType()), T.StructField("votes", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("slots", T.ArrayType(T.IntegerType())), T.StructField("vals", T.ArrayType(T.DoubleType()))])
    share = min(1.0, max_rows / max(docs.count(), 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count: Counter[int] = Counter()
            rows = []
            for sampled, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                r = rates(text)
                code = votes(r)
                count[code] += 1
                if sampled:
                    x = features(text, r)
                    rows.append((True, code, 1, list(x), list(x.values())))
            rows += [(False, c, n, [], []) for c, n in count.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.bool_()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
                                              pa.array([r[3] for r in rows], pa.list_(pa.int32())), pa.array([r[4] for r in rows], pa.list_(pa.float64()))], names=schema.names)

    sample = hash_share(id_col, share, "quality")
    seen = cut(map_batches(docs.select(sample.alias("sampled"), text_or_empty(text_col)), run, schema), "quality-votes")
    patterns = {r.votes: r.n for r in seen.where("not sampled").groupBy("votes").agg(F.sum("n").alias("n")).collect()}
    post = fit_labellers(patterns) if patterns else {}
    # sorted, so that the fit doesn't depend on the order in which tasks end
    rows = sorted((r.slots, r.vals, post[r.votes]) for r in seen.where("sampled").select("slots", "vals", "votes").collect())
    return fit_scorer(rows)


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cutoff: float = 0.4, max_rows: int = 20_000) -> DataFrame:
    """``docs`` with ``quality_score`` (0 to 1) and ``kept`` (score >= cutoff).

    Null texts count as empty.  Equal texts have equal scores.  Added columns
    replace input columns of the same name.  An empty table keeps its schema.
    Training reads all rows once, scoring once more; nothing is shuffled but
    vote counts.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, id_col, text_col, max_rows))
    d = docs.drop("quality_score", "kept")
    schema = T.StructType([*d.schema.fields, T.StructField("quality_score", T.DoubleType()), T.StructField("kept", T.BooleanType())])
    at = d.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        for batch in batches:
            scores = []
            for text in batch.column(at).to_pylist():
                text = "" if text is None else str(text)
                x = features(text, rates(text))
                z = w[-1] + sum(v * w[s] for s, v in x.items())
                scores.append(float(1 / (1 + np.exp(-np.clip(z, -50, 50)))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array([s >= cutoff for s in scores], pa.bool_())], names=schema.names)

    return map_batches(d, run, schema)
