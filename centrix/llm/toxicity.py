"""Toxicity by a learned lexicon that forgives spelling, read in context.

The lexicon (words, and stems written ``stem*``) is learned from labelled
documents and kept as a trie.  A word is run through the intersection of that
trie with the Levenshtein automata of its entries: a state is a set of (trie
node, edits so far), states and moves are built when first needed, and words
that can't be within reach die after a few letters.  Each hit is weighed by the
words around it: quotation marks, reporting words and denials make it weaker,
address to a person makes it stronger.  A logistic function of a document's
strongest and summed hits, fitted on the labelled documents, gives the score.

Labels are the only thing learned from; language, source and id are no inputs.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, hash_share, map_batches, maybe_in, text_or_empty

#: Letters, with signs inside that stand for letters.
TOKEN = re.compile(r"[^\W_](?:[\w@$!*'’]*[^\W_])?")
#: Signs and digits read as letters inside a word with letters.
LOOKS_LIKE = str.maketrans("013457@$!", "oieastasi")
#: Words of report and denial, words of address, quotation marks.
REPORT = set("said says say called calls wrote writes quote quoted quoting word words term terms phrase allegedly reported according claimed "
             "not never isn't don't dit dire mot appelé sagte sagt wort nannte genannt dijo dice palabra llamó".split())
ADDRESS = set("you your you're youre yourself u ur du dich dein deine ihr euch tu te toi ton vous votre tú ti usted ustedes vosotros".split())
QUOTES = "\"“”„«»‹›"
REACH = 5  # words looked at on either side
STEM_MIN, STEM_MAX = 3, 7
FUZZY_MIN = 5  # letters an entry needs for a misspelling to count
WEAKER, STRONGER, MISSPELT = 0.35, 1.15, 0.7


def fold(token: str) -> str:
    """Lower case; signs and digits among letters read as letters."""
    t = token.lower()
    if t.isalpha():
        return t
    if not any(c.isalpha() for c in t):
        return ""
    return "".join(c for c in t.translate(LOOKS_LIKE) if c.isalpha() or c == "*")


@dataclass
class Lexicon:
    """Entries with weights (0 to 1) and the automaton over their trie."""

    weights: dict[str, float]
    exempt: frozenset[str] = frozenset()
    moves: list[dict[str, int]] = field(default_factory=list)
    states: dict[frozenset, int] = field(default_factory=dict)
    sets: list[frozenset] = field(default_factory=list)
    ends: list[tuple[str, int] | None] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.child: list[dict[str, int]] = [{}]
        self.entry: list[str | None] = [None]
        self.deep: list[int] = [0]  # length of the longest entry below a node
        for e in sorted(self.weights):
            at = 0
            for c in e.rstrip("*"):
                if c not in self.child[at]:
                    self.child[at][c] = len(self.child)
                    self.child.append({})
                    self.entry.append(None)
                    self.deep.append(0)
                at = self.child[at][c]
                self.deep[at] = max(self.deep[at], len(e.rstrip("*")))
            if self.entry[at] is None or self.weights[e] > self.weights[self.entry[at]]:
                self.entry[at] = e
        self.start = self._state({(0, 0)})

    def _state(self, at: set[tuple[int, int]]) -> int:
        """Number of a state; letters missing from the word are edits too."""
        best: dict[int, int] = {}
        for node, edits in at:
            best[node] = min(edits, best.get(node, 2))
        for node, edits in list(best.items()):
            if edits == 0:
                for child in self.child[node].values():
                    if self.deep[child] >= FUZZY_MIN:
                        best[child] = min(1, best.get(child, 2))
        key = frozenset(best.items())
        if key not in self.states:
            self.states[key] = len(self.moves)
            self.moves.append({})
            self.sets.append(key)
            found = [(self.entry[n], d) for n, d in key if self.entry[n] and (d == 0 or len(self.entry[n].rstrip("*")) >= FUZZY_MIN)]
            self.ends.append(max(found, key=lambda x: (self.weights[x[0]] * (MISSPELT if x[1] else 1.0), x[0]), default=None))
        return self.states[key]

    def _move(self, state: int, c: str) -> int:
        """The state after one more letter; -1: out of reach."""
        at: set[tuple[int, int]] = set()
        for node, edits in self.sets[state]:
            for letter, child in self.child[node].items():
                if letter == c or (c == "*" and edits == 0):
                    at.add((child, edits if letter == c else 1))
                elif edits == 0 and self.deep[child] >= FUZZY_MIN:
                    at.add((child, 1))  # another letter
            if edits == 0:
                at.add((node, 1))  # one letter too many
        new = self._state(at) if at else -1
        self.moves[state][c] = new
        return new

    def match(self, word: str) -> tuple[str, int] | None:
        """The best entry within one edit, and its edits.  Stems match any
        continuation: exactly, or (long stems) with one edit."""
        state, stem = self.start, None
        for c in word:
            state = self.moves[state][c] if c in self.moves[state] else self._move(state, c)
            if state < 0:
                break
            end = self.ends[state]
            if end and end[0][-1] == "*" and (stem is None or end[1] < stem[1]):
                stem = end
        whole = self.ends[state] if state >= 0 else None
        if whole and whole[0][-1] == "*":
            whole, stem = None, stem or whole
        found = [x for x in (whole, stem) if x and not (x[1] and word in self.exempt)]
        return max(found, key=lambda x: self.weights[x[0]] * (MISSPELT if x[1] else 1.0), default=None)


class Reader:
    """Per worker: a lexicon and a bounded memo of words."""

    MEMO = 300_000

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.memo: dict[str, tuple[str, int] | None] = {}

    def word(self, token: str) -> tuple[str, int] | None:
        if token in self.memo:
            return self.memo[token]
        if len(self.memo) >= self.MEMO:
            self.memo.clear()
        folded = fold(token)
        found = self.memo[token] = self.lexicon.match(folded) if folded else None
        return found

    def hits(self, text: str) -> list[tuple[int, str, int, float]]:
        """(code point, entry, edits, weight) of every hit, weighed by context."""
        tokens = TOKEN.findall(text)
        if not any(map(self.word, set(tokens))):
            return []
        spans = [(m.start(), m.end(), m[0]) for m in TOKEN.finditer(text)]
        out = []
        for k, (start, stop, token) in enumerate(spans):
            found = self.word(token)
            if not found:
                continue
            entry, edits = found
            around = {t.lower() for _, _, t in spans[max(0, k - REACH):k + REACH + 1]}
            low, high = spans[max(0, k - REACH)][0], spans[min(len(spans) - 1, k + REACH)][1]
            quoted = any(q in text[low:start] for q in QUOTES) and any(q in text[stop:high + 1] for q in QUOTES)
            weight = self.lexicon.weights[entry] * (MISSPELT if edits else 1.0)
            if quoted or around & REPORT:
                weight *= WEAKER
            elif around & ADDRESS:
                weight *= STRONGER
            out.append((start, entry, edits, min(1.0, weight)))
        return out

    def features(self, text: str) -> tuple[float, float]:
        """The strongest hit, and the sum over distinct entries, saturated."""
        best: dict[str, float] = {}
        for _, entry, _, w in self.hits(text):
            best[entry] = max(w, best.get(entry, 0.0))
        return max(best.values(), default=0.0), 1.0 - float(np.exp(-sum(best.values())))


def held_out(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _terms(text: str) -> set[str]:
    """Words of a text and their stems."""
    out = set()
    for t in set(TOKEN.findall(text)):
        w = fold(t)
        if len(w) >= STEM_MIN:
            out.add(w)
            out.update(w[:k] + "*" for k in range(STEM_MIN, min(STEM_MAX, len(w)) + 1))
    return out


def _count_terms(train: DataFrame) -> DataFrame:
    """``(term, bad, good)``: documents of each label with the term, counted
    per task before the shuffle."""
    schema = "term string, bad long, good long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            terms = list(counts[0].keys() | counts[1].keys())
            out = pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *(pa.array([counts[y][t] for t in terms], pa.int64()) for y in (1, 0))], names=["term", "bad", "good"])
            for c in counts:
                c.clear()
            return out

        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[y].update(_terms(text))
                if len(counts[0]) + len(counts[1]) > 400_000:
                    yield flush()
        yield flush()

    parts = map_batches(train.select("y", "text"), run, schema)
    return parts.groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def _contexts(train: DataFrame, counted: DataFrame) -> DataFrame:
    """``counted`` plus ``contexts``: distinct neighbouring words of each term
    in toxic documents.  Copies of one text share theirs, so a term needs many."""
    schema = "word string, context long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[str, int]] = set()

        def flush() -> pa.RecordBatch:
            rows = list(found)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], names=["word", "context"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = [fold(t) for t in TOKEN.findall(text)]
                for k, w in enumerate(words):
                    if len(w) >= STEM_MIN:
                        found.add((w, hash_pair(words[k - 1] if k else "", words[k + 1] if k + 1 < len(words) else "")))
                if len(found) > 400_000:
                    yield flush()
        yield flush()

    stems = [F.when(F.length("word") >= k, F.concat(F.substring("word", 1, k), F.lit("*"))) for k in range(STEM_MIN, STEM_MAX + 1)]
    met = map_batches(train.where("y = 1").select("text"), run, schema).select(F.explode(F.array("word", *stems)).alias("at"), "context").where("at is not null")
    met = maybe_in(met, "at", counted, "term").groupBy("at").agg(F.countDistinct("context").alias("contexts"))
    return counted.join(met, F.col("term") == F.col("at")).drop("at")


def hash_pair(a: str, b: str) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(f"{a}\0{b}") >> 1


def choose_entries(terms: dict[str, tuple[int, int, int]], bad: int, good: int, most: int = 2000) -> dict[str, float]:
    """Entries and weights from ``term: (toxic, clean, contexts)``.

    A term must be met in toxic documents far more often (20 times the share,
    and 19 in 20 of its documents toxic), in enough of them, and in at least
    half as many contexts as documents.  Of a word and its stems, the longest with (nearly) the reach of
    the shortest stays."""
    need = max(4, round(0.008 * bad))
    ok = {}
    for t, (x, y, contexts) in terms.items():
        ratio = ((x + 0.5) / (bad + 1)) / ((y + 0.5) / (good + 1))
        if x >= need and contexts >= max(4, need // 2, x // 2) and ratio >= 20 and x >= 19 * y:
            ok[t] = (x, float(np.clip(np.log(ratio) / 6, 0.6, 1.0)))
    longer: dict[str, int] = {}  # reach of the best longer form of each stem
    for t, (x, _) in ok.items():
        stem = t.rstrip("*")
        for k in range(STEM_MIN, len(stem) + (t[-1] != "*")):
            longer[stem[:k] + "*"] = max(x, longer.get(stem[:k] + "*", 0))
    kept = {t: w for t, (x, w) in ok.items() if t[-1] != "*" or longer.get(t, 0) < 0.98 * x}
    # a word or stem below a kept, shorter stem adds nothing
    kept = {t: w for t, w in kept.items() if not any(t.rstrip("*")[:k] + "*" in kept for k in range(STEM_MIN, len(t.rstrip("*")) + (t[-1] != "*")))}
    return dict(sorted(kept.items(), key=lambda e: (-ok[e[0]][0], e[0]))[:most])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights (the last one the bias) by Newton steps, classes alike."""
    a = np.column_stack([x, np.ones(len(x))])
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    w = np.zeros(a.shape[1])
    keep = ridge * np.diag([1.0] * x.shape[1] + [0.01])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (weight * p * (1 - p))[:, None]) + keep, a.T @ (weight * (y - p)) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    weights: dict[str, float]
    exempt: frozenset[str]
    logistic: tuple[float, ...]


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = 20_000) -> Model:
    """Lexicon, exempt words and logistic weights from about ``max_rows``
    labelled documents outside the held-out third (a hash sample where there
    are more); copies of a text in the sample count once for each label.  What
    comes to the driver is bounded by that sample."""
    y = labels.select(F.col(id_col).alias("lid"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1)")
    y = y.where(~held_out("lid")).groupBy("lid").agg(F.max("y").alias("y"))
    share = min(1.0, max_rows / max(y.count(), 1))
    d = docs.select(F.col(id_col).alias("lid"), text_or_empty(text_col).alias("text")).where("lid is not null")
    train = d.where(~held_out("lid") & hash_share("lid", share, "toxic")).join(y.hint("shuffle_hash"), "lid").select("y", "text")
    # copies of a text are one document of its class
    train = cut(train.groupBy("y", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("text"), "text").alias("h2")).agg(F.max("text").alias("text")).select("y", "text"), "toxic-train")
    size = {r.y: r.n for r in train.groupBy("y").agg(F.count("*").alias("n")).collect()}
    bad, good = size.get(1, 0), size.get(0, 0)
    if not bad or not good:
        return Model({}, frozenset(), (0.0, 0.0, -4.0))
    need = max(4, round(0.008 * bad))
    counted = cut(_count_terms(train).where((F.col("bad") >= need) & (F.col("bad") >= 19 * F.col("good"))), "toxic-terms")
    wide = _contexts(train, counted).where(F.col("contexts") >= F.greatest(F.lit(max(4, need // 2)), F.floor(F.col("bad") / 2)))
    few = wide.orderBy(F.desc("bad"), "term").limit(20_000)  # the lexicon's size bound, before stems are merged
    weights = choose_entries({r.term: (r.bad, r.good, r.contexts) for r in few.collect()}, bad, good)
    # near misses that clean documents hold are words of their own
    lexicon = train.sparkSession.sparkContext.broadcast(weights)

    def misses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(Lexicon(lexicon.value))
        for batch in batches:
            words: Counter = Counter()
            for text in batch.column(0).to_pylist():
                words.update({fold(t) for t in set(TOKEN.findall(text)) if (m := reader.word(t)) and m[1]})
            yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["word", "n"])

    near = map_batches(train.where("y = 0").select("text"), misses, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    exempt = frozenset(r.word for r in near.where("n >= 2").collect())
    shipped = train.sparkSession.sparkContext.broadcast((weights, exempt))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(Lexicon(*shipped.value))
        for batch in batches:
            f = [reader.features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in f], pa.float64()) for k in (0, 1))], names=["y", "a", "b"])

    seen = map_batches(train.select("y", "text"), measure, "y int, a double, b double").groupBy("y", F.round("a", 6).alias("a"), F.round("b", 6).alias("b")).count()
    rows = sorted((r.y, r.a, r.b, r["count"]) for r in seen.collect())
    table = np.repeat(np.array([r[:3] for r in rows]), [r[3] for r in rows], axis=0)
    w = fit_logistic(table[:, 1:], table[:, 0])
    return Model(weights, exempt, tuple(float(v) for v in w))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", cutoff: float = 0.7) -> DataFrame:
    """``(id_col, held_out, score, predicted, n_hits, hits)``, one row per row.

    ``hits`` lists (start, entry, edits, weight) by code point.  Null and empty
    texts score like any text without hits.  Texts are read whole, batch by
    batch; nothing is shuffled.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    hit = T.StructType([T.StructField("start", T.LongType()), T.StructField("entry", T.StringType()), T.StructField("edits", T.IntegerType()), T.StructField("weight", T.DoubleType())])
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType()), T.StructField("n_hits", T.LongType()), T.StructField("hits", T.ArrayType(hit))])
    arrow_hit = pa.struct([("start", pa.int64()), ("entry", pa.string()), ("edits", pa.int32()), ("weight", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        reader = Reader(Lexicon(m.weights, m.exempt))
        for batch in batches:
            hits = [reader.hits(t) for t in batch.column(2).to_pylist()]
            scores = []
            for found in hits:
                best: dict[str, float] = {}
                for _, entry, _, w in found:
                    best[entry] = max(w, best.get(entry, 0.0))
                z = m.logistic[0] * max(best.values(), default=0.0) + m.logistic[1] * (1.0 - float(np.exp(-sum(best.values())))) + m.logistic[2]
                scores.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
            rows = [[dict(zip(("start", "entry", "edits", "weight"), h, strict=True)) for h in found] for found in hits]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= cutoff) for s in scores], pa.int32()),
                                              pa.array([len(h) for h in hits], pa.int64()), pa.array(rows, pa.list_(arrow_hit))], names=schema.names)

    return map_batches(docs.select(F.col(id_col), held_out(id_col), text_or_empty(text_col)), run, schema)
