"""Every registered barcode query against the same in DuckDB."""

import math
import os

import duckdb
import pytest

from strandlake.registry import ORACLES, QUERIES

DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("region", "nation", "lineitem", "events", "part"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def normal(v):
    return None if isinstance(v, float) and math.isnan(v) else round(float(v), 5) if isinstance(v, float) or type(v).__name__ == "Decimal" else v


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    told = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(told.columns)
    mine, theirs = rows(df.columns, df.collect()), rows(told.columns, told.fetchall())
    assert len(mine) == len(theirs) and mine == theirs
    assert mine
