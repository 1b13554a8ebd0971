"""Every query with SQL against DuckDB over the smallest data set."""

from __future__ import annotations

import datetime
import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__
from sitemill.plans import queries as Q

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, Decimal):
        x = float(x)
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 9) + 0.0
    return x.replace(tzinfo=None) if isinstance(x, datetime.datetime) else x


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query(spark, duck, name):
    df = Q.QUERIES[name](spark, DATA)
    c = duck.execute(Q.SQL[name])
    columns = [d[0] for d in c.description]
    assert sorted(columns) == sorted(df.columns)
    want = table(c.fetchall(), columns)
    assert want and table(df.collect(), df.columns) == want


def test_every_core_query_has_sql():
    assert set(Q.QUERIES) == set(Q.SQL)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
