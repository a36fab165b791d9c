"""Row numbers over large groups against Python's sort."""

import pytest
from pyspark.sql import functions as F

from strandlake.operators.ranks import numbered, prefix

ROWS = [(s, n % 3, None if n % 11 == 5 else f"{'ACGT'[n % 4]}{n * 7919 % 101:03d}é"[: n % 6]) for s in ("a", "b", None) for n in range(60)]
SCHEMA = "sample string, n long, code string"


def expected(rows):
    """Distinct rows of a sample, largest n first, then by code."""
    out = {}
    for s in {r[0] for r in rows}:
        own = sorted({r for r in rows if r[0] == s}, key=lambda r: (-r[1], r[2] is not None, (r[2] or "").encode()))
        out |= {r: (i + 1, len(own)) for i, r in enumerate(own)}
    return out


@pytest.mark.parametrize("size", [1, 3])
def test_numbered(spark, size):
    df = spark.createDataFrame(ROWS, SCHEMA).distinct()
    told = numbered(df, ["sample"], [-F.col("n"), prefix("code", size)], [F.col("code")], total=True)
    assert told.columns == ["sample", "n", "code", "place", "total"]
    assert {tuple(r)[:3]: tuple(r)[3:] for r in told.collect()} == expected(ROWS)


def test_without_groups(spark):
    df = spark.createDataFrame([(5,), (1,), (3,)], "n long")
    assert sorted(map(tuple, numbered(df, [], [F.col("n") % 2], [F.col("n")], total=True).collect())) == [(1, 1, 3), (3, 2, 3), (5, 3, 3)]


def test_empty(spark):
    assert numbered(spark.createDataFrame([], SCHEMA), ["sample"], [F.col("n")], [F.col("code")]).collect() == []
