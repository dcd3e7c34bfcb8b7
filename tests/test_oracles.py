"""Every registered query against its DuckDB oracle on the sf0.001 tables (the
driver's gate runs the same comparison at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_mod

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return str(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(entry_mod.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == rows_of(cols, res.fetchall())
