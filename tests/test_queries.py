"""Every driver query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
# The oracle of this query assumes whole regions, which the smallest tables do not hold.
WHOLE_REGION = {"terrain_sample": "/root/testdata/sf0.01"}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def rows(cols, data):
    order = sorted(cols)
    return sorted((tuple(norm(r[cols.index(c)]) for c in order) for r in data), key=repr)


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "category" in df.columns


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, name):
    sf_dir = WHOLE_REGION.get(name, SF)
    df = entry.queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    assert len(set(df.columns)) == len(df.columns)
    oracle = entry.oracle_sql().get(name)
    if oracle is None:
        assert got
        return
    result = duck(sf_dir).execute(oracle)
    cols = [c[0] for c in result.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows(df.columns, got) == rows(cols, result.fetchall())
