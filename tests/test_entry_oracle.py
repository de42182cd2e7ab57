"""Driver contract: entry(), queries() and their DuckDB twins agree on sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["word", "count"]
    assert len(df.collect()) == 5


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(E.QUERIES)))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = [r.asDict() for r in sdf.collect()]
    rel = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    drows = [dict(zip(dcols, r)) for r in rel.fetchall()]
    assert cols == sorted(dcols)
    assert _rows(srows, cols) == _rows(drows, cols)
