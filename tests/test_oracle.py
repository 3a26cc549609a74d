"""Every query that SQL can express, Spark against DuckDB on the smallest tables."""

import os
import sys

import duckdb
import pandas as pd
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import TABLES, rows

from fernglass.plans import all_queries, all_sql

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def test_names_match():
    assert SQL.keys() <= QUERIES.keys()
    assert len(QUERIES) > 340


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    got = pd.DataFrame([tuple(r) for r in frame.collect()], columns=frame.columns)
    out = duck.sql(SQL[name])
    want = pd.DataFrame(out.fetchall(), columns=out.columns)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - SQL.keys()))
def test_runs(spark, name):
    assert len(QUERIES[name](spark, FOLDER).collect()) > 0


#: Filters on the driver's tables that must neither keep nor drop everything.
SELECTIVE = {"flt_01_optional": "orders", "flt_06_any_regex": "part", "joi_08_semi": "orders", "joi_09_anti": "documents", "ded_03_passages": "documents", "cls_12_terms": "documents"}


@pytest.mark.parametrize("name", sorted(SELECTIVE))
def test_filters_filter(spark, name):
    n = QUERIES[name](spark, FOLDER).count()
    assert 0 < n < spark.read.parquet(f"{FOLDER}/{SELECTIVE[name]}.parquet").count()


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert QUERIES.keys() <= entry.queries().keys() and SQL.keys() <= entry.oracle_sql().keys()
