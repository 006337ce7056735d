"""Every query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

from stockledger.catalog.oracle import all_sql
from stockledger.catalog.queries import all_queries

SMALL = "/root/testdata/sf0.001"
TABLES = ["nation", "customer", "supplier", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return ""
        return str(v) if isinstance(v, (str, bool)) else repr(float(v))

    return sorted(tuple(text(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_sql())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, duck, name):
    df = all_queries()[name](spark, SMALL)
    want = duck.sql(all_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert canonical(df.columns, df.collect()) == canonical(want.columns, want.fetchall())
