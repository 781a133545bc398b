"""Every registered query against its SQL on the smallest tables; the others run and keep their schema."""

import datetime
import decimal

import duckdb
import numpy as np
import pandas as pd
import pytest

from cytoplan.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def value(v):
    if isinstance(v, list | np.ndarray):
        return str([value(x) for x in v])
    if pd.isna(v):
        return "null"
    if isinstance(v, bool | np.bool_):
        return str(bool(v))
    if isinstance(v, int | np.integer):
        return str(int(v))
    if isinstance(v, float | np.floating | decimal.Decimal):
        return str(int(v)) if v == int(v) else repr(round(float(v), 9))
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str(v)


def rows(df):
    return sorted(tuple(value(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_against_sql(spark, con, name):
    got, want = catalogue.QUERIES[name](spark, SF).toPandas(), con.sql(catalogue.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_runs(spark, name):
    df = catalogue.QUERIES[name](spark, SF)
    first = df.schema
    assert df.count() > 0 and catalogue.QUERIES[name](spark, SF).schema == first


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
