"""Queries that SQL can express, against the same in DuckDB."""

import duckdb
import pytest

from strandlake.llm.queries import oracle_sql, queries

DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    df, told = queries()[name](spark, DIR), con.sql(oracle_sql()[name])
    assert df.columns == told.columns
    assert sorted(map(tuple, df.collect())) == sorted(told.fetchall())


def test_registered(spark):
    import __spark_entry__ as e

    own = [n for n in e.queries() if n.startswith("op")]
    assert {n.split("_")[0] for n in own} >= {f"op{k}" for k in range(1, 14)} and "pipeline" in e.queries()
