"""Queries of this folder against their SQL on the smallest tables."""

import os

import duckdb
import pytest
from llm_support import SF

from gradeloom.llm.queries import QUERIES, SQL


def test_each_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for table in os.listdir(SF):
        con.execute(f"create view {table.split('.')[0]} as select * from '{SF}/{table}'")
    rows = QUERIES[name](spark, SF)
    want = con.execute(f"select {', '.join(rows.columns)} from ({SQL[name]})").fetchall()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in rows.collect()), key=key) == sorted(want, key=key)
