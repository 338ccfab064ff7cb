import random
import zlib

from centrix.llm import toxicity
from centrix.llm.toxicity import Lexicon, Reader
from tests.llm.helpers import DIR2, EDGE, documents, edge, edits, empty

WORDS = {"idiot": 1.0, "moron": 0.9, "scum": 0.8, "worthless": 1.0, "lowei*": 1.0, "ab*": 0.7}


def test_automaton_against_edit_distance():
    rng = random.Random(1)
    lex = Lexicon({w: v for w, v in WORDS.items() if w[-1] != "*"})
    tried = set(lex.weights)
    for w in lex.weights:
        for _ in range(400):
            v = list(w)
            for _ in range(rng.randint(1, 2)):
                k, kind = rng.randrange(len(v) + 1), rng.randrange(3)
                v[k:k + (kind > 0)] = [] if kind == 1 else [rng.choice("abdeioqrstuw")]
            tried.add("".join(v))
    for v in tried:
        near = {w: edits(list(w), list(v)) for w in lex.weights}
        want = {w: d for w, d in near.items() if d == 0 or (d == 1 and len(w) >= toxicity.FUZZY_MIN)}
        got = lex.match(v)
        assert (got is None) == (not want), v
        if got:
            assert want[got[0]] == got[1]


def test_stems_and_exemptions():
    lex = Lexicon(WORDS, frozenset({"idiom"}))
    assert lex.match("loweischaft") == ("lowei*", 0) and lex.match("abz") == ("ab*", 0)
    assert lex.match("idiom") is None and lex.match("idiott") == ("idiot", 1)
    assert lex.match("scun") is None                  # too short for a misspelling
    assert lex.match("") is None and Lexicon({}).match("idiot") is None


def test_context_separates_quotation_from_abuse():
    r = Reader(Lexicon(WORDS))
    plain, quoted, said, you = (r.features(t)[0] for t in ("what an idiot here", 'the "idiot" here', "he said idiot once", "you are a moron"))
    assert plain == 1.0 and quoted < 0.5 and said < 0.5 and you > 0.9
    assert r.hits("An 1d1ot and m0ron!!!")[0][1] == "idiot" and r.hits("A\nworthles thing")[0][2] == 1
    assert r.features("") == (0.0, 0.0)


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id BIGINT, quality INT, toxic INT")


def test_held_out_documents(spark):
    docs, labels = documents(spark, DIR2), spark.read.parquet(f"{DIR2}/labels.parquet")
    model = toxicity.learn(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for i, r in got.items())
    held = [(got[r.doc_id], r.toxic, r.doc_id) for r in labels.collect() if got[r.doc_id].held_out]
    text = {r.doc_id: r.lang for r in docs.collect()}
    toxic = [g.predicted for g, y, i in held if y and text[i] == "en"]
    clean = [g.predicted for g, y, i in held if not y]
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.05 * len(clean)
    # labels of the held-out third change nothing
    flipped = labels.selectExpr("doc_id", "quality", "CASE WHEN pmod(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)), 3) = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    assert toxicity.learn(docs, flipped) == model


def test_edges(spark):
    model = toxicity.Model(WORDS, frozenset(), (5.0, 4.0, -4.0))
    rows = toxicity.score(edge(spark), model).collect()
    assert len(rows) == len(EDGE) and all(0 <= r.score <= 1 and r.n_hits == 0 for r in rows)
    assert toxicity.score(empty(spark), model).count() == 0
    for labels in (_labels(spark, []), _labels(spark, [(1, 1, 0), (2, None, None), (None, 1, 1)])):
        m = toxicity.learn(edge(spark), labels)           # one class only: nothing to learn
        assert m.weights == {} and all(r.predicted == 0 for r in toxicity.score(edge(spark), m).collect())


def test_copies_of_a_text_count_once(spark):
    def word(k):
        return "".join("abcdefghij"[int(c)] for c in f"{k:05d}")
    toxic = [f"{word(3 * k)} grobnik {word(3 * k + 1)} {word(3 * k + 2)}" for k in range(30)]
    clean = [f"{word(50000 + 3 * k)} {word(50001 + 3 * k)} {word(50002 + 3 * k)}" for k in range(200)]
    texts = [(t, 1) for t in toxic] + [(toxic[0], 1)] * 1000 + [(t, 0) for t in clean]
    ids = [i for i in range(3 * len(texts)) if zlib.crc32(str(i).encode()) % 3 != 1][:len(texts)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in zip(ids, texts, strict=True)], "doc_id BIGINT, text STRING")
    labels = _labels(spark, [(i, 1, y) for i, (_, y) in zip(ids, texts, strict=True)])
    model = toxicity.learn(docs, labels)
    assert any("grobnik".startswith(e.rstrip("*")) for e in model.weights)
    assert toxicity.score(docs, model).where("n_hits > 0").count() == 1030
