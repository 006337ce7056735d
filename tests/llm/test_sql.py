"""The SQL of the text operators on the smallest tables."""

import duckdb
import pytest

from stockledger.llm import queries

from llm_cases import SMALL


@pytest.mark.parametrize("name", sorted(queries.all_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want, got = con.sql(queries.all_sql()[name]), queries.all_queries()[name](spark, SMALL)
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(want.columns)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(want.select(*columns).fetchall())
