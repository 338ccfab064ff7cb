import hashlib

from pyspark.sql import functions as F

from centrix.llm import fingerprint
from tests.llm.helpers import EDGE, documents, edge, empty


def _edited(rows):
    """(id, n, sha of the edited text) per row, with next ids and texts by sort."""
    key = lambda i: (i is not None, i or 0)
    ids = sorted({r[0] for r in rows}, key=key)
    first = {i: min((t or "" for j, t in rows if j == i), key=lambda t: hashlib.sha256(t.encode()).hexdigest()) for i in ids}
    out = []
    for i, t in rows:
        t = t or ""
        after = first[ids[(ids.index(i) + 1) % len(ids)]]
        k = len(t) // 2
        e = t[:len(t) - k] + after[:k]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest()))
    return out


def test_documents_and_edges(spark):
    for df, rows in ((edge(spark), [(r[0], r[1]) for r in EDGE]), (documents(spark), None)):
        rows = rows or [(r.doc_id, r.text) for r in df.collect()]
        got = fingerprint.compare_edits(df).collect()
        assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == sorted(_edited(rows), key=str)
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
        assert len({(r.fingerprint == r.edited_fingerprint, r.near_edited == 1.0) for r in got if r.fingerprint == r.edited_fingerprint}) <= 1
    multisets = {}
    texts = {i: t for i, t in rows}
    for r in got:
        multisets.setdefault(tuple(sorted(texts[r.doc_id].split("\n"))), set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in multisets.values())
    assert len({next(iter(v)) for v in multisets.values()}) == len(multisets)
    halves = [r for r in got if r.n_chars > 200]
    assert sum(r.near_edited > r.near_next for r in halves) > 0.95 * len(halves)
    assert fingerprint.compare_edits(empty(spark)).count() == 0
    one = fingerprint.compare_edits(documents(spark).limit(1)).first()
    assert one.near_next == 1.0


def test_order_insertion_and_deletion(spark):
    rows = [(1, "a b c\nd e f\na b c"), (2, "a b c\na b c\nd e f"), (3, "a b c\na b c"), (4, "d e f"), (5, "a b c\nd e f")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    f = {r.doc_id: r.lanes for r in fingerprint.fingerprints(df).collect()}
    assert f[1] == f[2] != f[5]
    both = spark.createDataFrame([(f[3], f[4], f[1])], "a ARRAY<BIGINT>, b ARRAY<BIGINT>, c ARRAY<BIGINT>")
    r = both.select(fingerprint.combine(F.col("a"), F.col("b")).alias("sum"), fingerprint.combine(F.col("c"), F.col("b"), -1).alias("rest")).first()
    assert r["sum"] == f[1] and r.rest == f[3]


def test_lanes_by_hand(spark):
    import xxhash
    df = spark.createDataFrame([(1, "x y z\nw")], "doc_id BIGINT, text STRING")
    lanes = fingerprint.fingerprints(df).first().lanes
    digests = [hashlib.sha512(p).hexdigest() for p in (b"x y z", b"w")]
    assert lanes[:16] == [sum(int(d[8 * k:8 * k + 8], 16) for d in digests) % 2**32 for k in range(16)]

    def pair(a, b):
        seed = xxhash.xxh64_intdigest(a, 42)
        return xxhash.xxh64_intdigest(b, seed)

    hashes = [pair(b"x", b"y"), pair(b"y", b"z"), xxhash.xxh64_intdigest(b"w", 42)]
    assert lanes[16:80] == [sum(h >> k & 1 for h in hashes) for k in range(64)] and lanes[80] == 3
