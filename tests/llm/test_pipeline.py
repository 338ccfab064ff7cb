import hashlib

import numpy as np

import corpus_pipeline
from centrix.llm.catalog import tokenizer_path
from tests.llm.helpers import DIR1, EDGE, Groups, SCHEMA, doc_fingerprint, documents, empty
from tests.llm.test_line_dedup import _drops
from tests.llm.test_mixing import _mix


def _near(rows):
    """Ids that stay of each near class."""
    fps = {i: doc_fingerprint(t) for i, t in rows}
    g = Groups()
    for i in sorted(fps):
        g.root(i)
        for j in sorted(fps):
            if i < j and (fps[i] ^ fps[j]).bit_count() <= 4:
                g.tie(i, j)
    return {i for i in fps if g.root(i) == i}


def test_stages_against_plain_python(spark, tmp_path):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(tokenizer_path())
    docs, columns = documents(spark), documents(spark).columns
    done = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DIR1).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
        done.append(docs.collect())
    good, lined, near, mixed, encoded = done
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DIR1}/labels.parquet").collect()}
    kept = {r.doc_id for r in good}
    assert all((i in kept) == bool(q) for i, q in labels.items())
    drops = _drops([(r.doc_id, r.text) for r in good])
    want = {r.doc_id: "\n".join(x for at, x in enumerate(r.text.split("\n")) if (r.doc_id, at) not in drops) for r in good}
    assert {r.doc_id: r.text for r in lined} == want and all(r.n_chars == len(r.text) for r in lined)
    assert {r.doc_id for r in near} == _near([(r.doc_id, r.text) for r in lined])
    copies = {i: taken for i, _, _, taken in _mix([(r.doc_id, r.source, len(r.text.encode().split())) for r in near])[0]}
    got = {}
    for r in mixed:
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.encode().split())
    assert {i: n for i, n in got.items() if n} == {i: n for i, n in copies.items() if n}
    ids = [library.encode(r.text, add_special_tokens=False).ids for r in mixed]
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encoded) == sorted(
        (r.doc_id, len(x), hashlib.sha256(np.array(x, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()) for r, x in zip(mixed, ids, strict=True))
    assert sorted(map(str, corpus_pipeline.run(spark, DIR1).collect())) == sorted(map(str, encoded))


def test_stages_take_edges(spark, tmp_path):
    for name, rows in (("edge", EDGE), ("empty", [])):
        docs = spark.createDataFrame(rows, SCHEMA)
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, DIR1).write.parquet(str(tmp_path / f"{name}{k}"))
            docs = spark.read.parquet(str(tmp_path / f"{name}{k}"))
    assert len(corpus_pipeline.STAGES) == 5 and empty(spark).count() == 0


def test_one_row_of_each_near_class(spark):
    a, b, c = (" ".join(f"{x}word{k}" for k in range(60)) for x in "abc")
    rows = [(1, a, "en", "s", 1), (1, a, "en", "s", 1), (1, b, "en", "s", 1), (0, b, "en", "s", 1), (2, a, "en", "s", 1),
            *[(None, c, None, "s", k % 2) for k in range(6)], (None, a, "en", "s", 1), (None, None, None, None, None), (None, None, None, None, None)]
    got = corpus_pipeline.near_copies(spark, spark.createDataFrame(rows, SCHEMA), DIR1).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(1, a), (0, b), (None, c), (None, None)], key=str)
    assert all(tuple(r) in rows for r in got)
