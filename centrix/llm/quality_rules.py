"""Quality rules whose cutoffs carry a risk guarantee.

Five rules reject a document whose rate (symbols, capitals, exclamation marks,
repeated words, repeated lines) is above a cutoff.  Labelled documents are
split by their key's hash: the first half proposes a ladder of policies, from
lenient to strict, per stratum; the second half, the holdout, tests them.  For
each policy the good holdout documents it rejects give an exact binomial
(Clopper-Pearson) upper bound of its false-rejection rate.  Policies are tested
from the lenient end and the first failure stops the ladder (fixed-sequence
testing), strata share the error by Bonferroni, so with probability
``1 - delta`` every chosen policy, in every stratum, rejects at most ``risk``
of the good documents that pass the base checks.  A stratum with too few
labelled documents for any proof keeps everything.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WS, cut, map_batches, text_or_empty

#: Fixed value: the characters counted as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
RULES = ["symbol_rate", "capital_rate", "shout_rate", "repeat_rate", "dup_line_rate"]
BINS = 1000
#: Shares of good documents that the steps of the ladder give up at most.
LADDER = [0.0, 0.0005, 0.001, 0.002, 0.005, 0.01, 0.02]

_CAPITALS = bytes(range(65, 91))
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside a window (of a power of two words) that occurs twice or
    more: exact ranks of 2, 4, ... words from pairs of ranks."""
    n, size, rank = len(ids), 1, ids
    while size < window:
        if len(rank) <= size:
            return 0
        rank = np.unique(rank[:-size] * np.int64(n + 1) + rank[size:], return_inverse=True)[1]
        size *= 2
    twice = (np.bincount(rank) > 1)[rank]
    if not twice.any():
        return 0
    step = np.zeros(n + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(step, at, 1)
    np.add.at(step, at + window, -1)
    return int((np.cumsum(step[:-1]) > 0).sum())


def measure(text: str) -> tuple[int, int, int, int, int, list[float]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, rates."""
    raw = text.encode()
    words = raw.split()  # bytes split at ASCII white space only: 0x20, 0x09-0x0D
    n = len(words)
    chars = len(text) - sum(map(text.count, WS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(WS)]
    dup = len(lines) - len(set(lines))
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=n)
    again = repeated_words(ids) if len(number) < n else 0
    letters = len(raw) - len(raw.translate(None, _LETTERS))
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    rates = [symbols / max(chars, 1), capitals / max(letters, 1), min(1.0, text.count("!") / max(n, 1)), again / max(n, 1), dup / max(len(lines), 1)]
    return n, chars, symbols, dup, again, rates


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Counts and rule rates of every whole text; a null text has no words."""
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("stratum", T.StringType()),
                           *(T.StructField(c, T.LongType()) for c in counts), *(T.StructField(c, T.DoubleType()) for c in RULES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(t) for t in batch.column(2).to_pylist()]
            out = [pa.array([r[k] for r in rows], pa.int64()) for k in range(5)] + [pa.array([r[5][k] for r in rows], pa.float64()) for k in range(5)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *out], names=schema.names)

    return map_batches(docs.select(F.col(id_col), F.col(stratum_col).cast("string"), text_or_empty(text_col)), run, schema)


def binomial_upper(k: int, n: int, delta: float) -> float:
    """Exact upper bound: the largest rate at which ``k`` or fewer of ``n`` has
    probability ``delta`` or more."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(k + 1)]

    def at_most(p: float) -> float:
        terms = [c + i * math.log(p) + (n - i) * math.log1p(-p) for i, c in enumerate(logs)]
        top = max(terms)
        return math.exp(top) * sum(math.exp(t - top) for t in terms)

    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        if not 0 < mid < 1 or at_most(mid) >= delta:
            low = mid
        else:
            high = mid
    return high


def _base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def choose_cutoffs(labelled: DataFrame, risk: float, delta: float) -> tuple[list[str], dict[str, list[float]]]:
    """Strata, and per stratum the chosen cutoffs (rates above one reject).

    ``labelled``: features with ``good`` (boolean).  Only histograms of fixed
    size come to the driver: strata (those with 1 % of the labelled rows or
    more, so at most 100, and one for the rest) x rules x bins."""
    seen = labelled.groupBy("stratum").count().where("stratum is not null")
    total = labelled.count()
    strata = sorted(r.stratum for r in seen.where(F.col("count") >= max(1, 0.01 * total)).collect())
    x = labelled.withColumn("stratum", F.when(F.col("stratum").isin(strata), F.col("stratum")))
    x = x.withColumn("proposes", F.pmod(F.xxhash64("id", F.lit("half")), F.lit(2)) == 0)
    x = cut(x.where(~_base_failed()), "rules-labelled")
    binned = x.where("good and proposes").select("stratum", F.posexplode(F.array(*[F.ceil(F.col(r) * BINS) for r in RULES])).alias("rule", "bin"))
    counts = {}
    for r in binned.groupBy("stratum", "rule", "bin").count().collect():
        counts.setdefault((r.stratum, r.rule), np.zeros(BINS + 1, dtype=np.int64))[r.bin] += r["count"]
    ladder = {}
    for s in {s for s, _ in counts}:
        steps = []
        for q in LADDER:
            cutoffs = []
            for k in range(len(RULES)):
                above = counts[s, k].sum() - np.cumsum(counts[s, k])  # good documents above each bin's edge
                cutoffs.append(int(np.argmax(above <= q * counts[s, k].sum())) / BINS)
            steps.append(cutoffs)
        ladder[s] = steps
    spark = labelled.sparkSession
    rows = [(s, i, c) for s, steps in ladder.items() for i, c in enumerate(steps)]
    table = spark.createDataFrame(rows, "s string, step int, cutoffs array<double>")
    rejects = F.exists(F.arrays_zip(F.array(*[F.col(r) for r in RULES]).alias("rate"), F.col("cutoffs").alias("cutoff")), lambda z: z["rate"] > z["cutoff"])
    tested = (x.join(F.broadcast(table), F.col("stratum").eqNullSafe(F.col("s"))).groupBy("s", "step", "good", "proposes")
              .agg(F.count("*").alias("n"), F.sum(rejects.cast("int")).alias("k")).collect())
    found = {(r.s, r.step, r.good, r.proposes): (r.k, r.n) for r in tested}
    chosen = {}
    for s, steps in ladder.items():
        proven, caught = [], []
        for i in range(len(steps)):
            k, n = found.get((s, i, True, False), (0, 0))
            if not n or binomial_upper(k, n, delta / len(ladder)) > risk:
                break
            proven.append(i)
            caught.append(found.get((s, i, False, True), (0, 1))[0])
        if proven:  # the most lenient proven step that catches (nearly) all that any proven step does
            enough = max(caught) - 0.01 * found.get((s, 0, False, True), (0, 0))[1]
            chosen[s] = steps[next(i for i, c in zip(proven, caught, strict=True) if c >= enough)]
    return strata, chosen


def apply_rules(docs: DataFrame, labels: DataFrame, risk: float = 0.02, delta: float = 0.05, id_col: str = "doc_id",
                text_col: str = "text", stratum_col: str = "lang", label_col: str = "quality") -> DataFrame:
    """Base counts, ``base_failed``, ``kept`` and the first rule that failed.

    ``labels``: ``(id_col, label_col)``, 1 good, 0 not, others and nulls
    ignored; an id labelled more than once counts with its smallest label, and
    a null id has none.  ``base_failed``: fewer than 20 words, or over 30 % of
    the words in repeated windows.  Without labels ``kept`` is ``not
    base_failed``.  Repeated rows keep their rows and equal verdicts.
    """
    f = cut(features(docs, id_col, text_col, stratum_col), "rules-features")
    y = labels.select(F.col(id_col).alias("lid"), F.col(label_col).alias("y")).where("y in (0, 1)").groupBy("lid").agg(F.min("y").alias("y"))
    labelled = cut(f.join(y, f["id"] == F.col("lid")).withColumn("good", F.col("y") == 1).drop("lid", "y"), "rules-known")
    strata, chosen = choose_cutoffs(labelled, risk, delta)
    rows = [(s, c) for s, c in chosen.items()]
    table = f.sparkSession.createDataFrame(rows, "s string, cutoffs array<double>")
    of = F.when(F.col("stratum").isin(strata), F.col("stratum"))
    out = f.join(F.broadcast(table), of.eqNullSafe(F.col("s")), "left").withColumn("base_failed", _base_failed())
    failed = F.coalesce(*[F.when(F.col(r) > F.col("cutoffs")[k], F.lit(r)) for k, r in enumerate(RULES)])
    out = out.withColumn("failed_rule", F.when(F.col("base_failed"), F.lit("base")).otherwise(failed))
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", F.col("failed_rule").isNull().alias("kept"), "failed_rule")
