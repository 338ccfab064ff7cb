import random

from pyspark.sql import functions as F

from centrix.llm import simhash
from centrix.llm.components import components
from tests.llm.helpers import EDGE, Groups, doc_fingerprint, documents, edge, empty


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def _classes(rows):
    """Smallest id of each class, nulls apart, by looking at every pair."""
    fps = sorted({fp for _, fp in rows})
    g = Groups()
    for i, a in enumerate(fps):
        g.root(a)
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= 4:
                g.tie(a, b)
    least = {}
    for i, fp in rows:
        if i is not None:
            r = g.root(fp)
            least[r] = min(i, least.get(r, i))
    return [(i, _signed(fp), least.get(g.root(fp))) for i, fp in rows]


def test_against_brute_force(spark):
    for df, pairs in ((edge(spark), [(r[0], r[1]) for r in EDGE]), (documents(spark), None)):
        pairs = pairs or [(r.doc_id, r.text) for r in df.collect()]
        want = _classes([(i, doc_fingerprint(t)) for i, t in pairs])
        got = [tuple(r) for r in simhash.near_classes(df).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert simhash.near_classes(empty(spark)).count() == 0


def test_pairs_of_close_fingerprints(spark):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(30)]
    fps = {c for c in centres}
    for c in centres:
        for _ in range(10):
            fps.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    df = spark.createDataFrame([(_signed(f),) for f in fps], "fp BIGINT")
    for distance in (0, 2, 4):
        got = {tuple(r) for r in simhash.near_pairs(df, distance).collect()}
        signed = sorted(map(_signed, fps))
        want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= distance}
        assert got == want


def test_unary_counts_bound_the_distance(spark):
    rng = random.Random(6)
    rows = [(_signed(rng.getrandbits(64)), _signed(rng.getrandbits(64))) for _ in range(300)]
    df = spark.createDataFrame(rows, "a BIGINT, b BIGINT")
    x = df.select("a", "b", simhash.unary_counts(F.col("a")).alias("x"), simhash.unary_counts(F.col("b")).alias("y")).collect()
    for r in x:
        counts = [[((v & (2**64 - 1)) >> 2 * s & 3).bit_count() for s in range(32)] for v in (r.a, r.b)]
        manhattan = sum(abs(p - q) for p, q in zip(*counts, strict=True))
        assert ((r.x ^ r.y) & (2**64 - 1)).bit_count() == manhattan <= ((r.a ^ r.b) & (2**64 - 1)).bit_count()


def test_long_text_in_chunks(monkeypatch):
    text = " ".join(f"w{k % 977}" for k in range(5000))
    whole = simhash.simhash_text(text, 4)
    monkeypatch.setattr(simhash, "CHUNK", 100)
    assert simhash.simhash_text(text, 4) == whole == doc_fingerprint(text)


def test_components(spark):
    rng = random.Random(7)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(300)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5), (2000, 2000)]
    edges += [(3000, 3000 + k) for k in range(1, 200)] + edges[:20]
    g = Groups()
    for a, b in edges:
        if a != b:
            g.tie(a, b)
    df = spark.createDataFrame([*edges, (None, 4)], "a BIGINT, b BIGINT")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {x: g.root(x) for x in list(g)}
    assert components(df.limit(0)).count() == 0
