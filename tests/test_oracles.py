"""Every registered query against its DuckDB oracle (the driver's
correctness gate, run locally at sf0.001): same columns, same rows."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield c
    c.close()


def _norm(v):
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(sorted((k, _norm(x)) for k, x in v.asDict().items()))
    return v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = con.sql(ORACLES[name])
    ocols = rel.columns
    assert cols == sorted(ocols)
    want = sorted((tuple(_norm(r[ocols.index(c)]) for c in cols) for r in rel.fetchall()), key=repr)
    assert got == want


def test_rows_only_queries_run(spark):
    for name in sorted(set(E.queries()) - set(ORACLES)):
        assert E.queries()[name](spark, SF).count() > 0
