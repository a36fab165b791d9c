"""Plans of the main path: no Python, no cartesian product, pruned scans; and the driver's entry."""

import contextlib
import io

import pytest

from strandlake.registry import ORACLES, QUERIES

DIR = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"sample_overlap", "overlap_ceiling"}))
def test_no_python_no_cross(spark, name):
    text = plan(QUERIES[name](spark, DIR))
    assert "Python" not in text and "MapInArrow" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scan_is_pruned(spark):
    text = plan(QUERIES["gbc_raw_counts"](spark, DIR))
    assert "l_comment" not in text and "l_extendedprice" not in text
    assert "l_orderkey" in text


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["sample", "clone", "GBC_set", "n_cells", "prevalence"]
    assert set(QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
