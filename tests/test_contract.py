"""Driver contract: entry, registry and oracles on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return None if v is None else str(v)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["brand", "year", "month", "month_name", "blended_cpa", "total_spend",
                          "total_conversions"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    from spendlens.plans import catalog

    q, o = catalog.queries(), catalog.oracles()
    assert set(o) == set(q) and len(q) >= 74
    assert set(q) <= set(E.queries()) and set(o) <= set(E.oracle_sql()) <= set(E.queries())


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == cols
    otypes = {d[0]: str(d[1]) for d in cur.description}
    for f in sdf.schema.fields:
        assert SPARK_TO_DUCK.get(f.dataType.simpleString()) == otypes[f.name], f.name
    idx = sorted(range(len(ocols)), key=lambda i: ocols[i])
    ref = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert got == ref
