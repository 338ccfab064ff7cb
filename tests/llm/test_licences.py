import re

from centrix.llm import licences
from tests.llm.helpers import DIR2, EDGE, documents, edge, empty

KNOWN = {"MIT License": "MIT", "Apache License": "Apache-2.0", "GNU General Public License": "GPL", "CC BY": "CC"}


def test_documents(spark):
    df = documents(spark, DIR2)
    want = {}
    for r in df.collect():
        found = {f for line in r.text.split("\n") for t, f in KNOWN.items() if re.search(r"(Licensed|licensed|Released) under", line) and t in line}
        want[r.doc_id] = ",".join(sorted(found))
    got = licences.scan(df).collect()
    assert {r.doc_id: r.families for r in got} == want and any(want.values())
    assert all(r.confirmed for r in got if r.family) and all(r.probability is None for r in got if not r.family)


def test_statements(spark):
    texts = ["Permission is hereby granted, free of charge, to any person obtaining a copy", "Licensed under the Mozilla Public License, version 2.0.", "LICENSED UNDER THE MIT LICENSE",
             "Released under the Nowhere Software License, version 9.", "She lost a driving licence.", "The general public is invited to the commons.", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    got = {r.doc_id: r.family for r in licences.scan(df).collect()}
    assert got == {0: "MIT", 1: "MPL", 2: "MIT", 3: "unknown", 4: None, 5: None, 6: None, 7: None}


def test_sql_scores_are_the_models(spark):
    lines = [p for ps in licences.TEMPLATES.values() for p in ps] + licences.UNKNOWN_STATEMENTS
    df = spark.createDataFrame([(1, "\n".join(lines))], "doc_id BIGINT, text STRING")
    m = licences.model()
    for r in licences.scan_paragraphs(df).collect():
        p = licences._score(m[:3], lines[r.at])
        best = max((x, c) for x, c in zip(p, m[0], strict=True) if c != licences.NONE)
        assert abs(best[0] - r.probability) < 1e-9
        assert r.family in (best[1], licences.UNKNOWN)


def test_edges_and_native_plan(spark):
    rows = licences.scan(edge(spark)).collect()
    assert len(rows) == len(EDGE) and all(r.family is None and r.n_statements == 0 for r in rows)
    assert licences.scan(empty(spark)).count() == 0
    twice = spark.createDataFrame([(1, "Released under the MIT License.")] * 2, "doc_id BIGINT, text STRING")
    assert [r.n_statements for r in licences.scan(twice).collect()] == [1, 1]
    plan = licences.scan(documents(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval|MapIn", plan)
