"""The registered queries on the smallest tables, with their SQL or their contract."""

import duckdb
import pytest

import __spark_entry__ as entry
from geoloom.llm import catalogue

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, name):
    df = entry.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    assert got
    sql = entry.oracle_sql().get(name)
    if sql:
        con = duckdb.connect()
        for t in ("documents", "conversations", "pages", "labels"):
            con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
        result = con.execute(sql)
        cols = [c[0] for c in result.description]
        assert sorted(cols) == sorted(df.columns)
        order = sorted(cols)
        pick = lambda names, rows: sorted((tuple(r[names.index(c)] for c in order) for r in rows), key=repr)
        assert pick(df.columns, got) == pick(cols, result.fetchall())


def test_all_queries_and_the_pipeline():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in catalogue.queries()} == {f"op{k}" for k in range(1, 14)} and "pipeline" in names
