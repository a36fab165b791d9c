"""Quantiles over several tasks against Spark's own and numpy's."""

import random

import numpy as np
import pytest

from strandlake.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("reach", [5e-4, 0.2, 1.0])
def test_against_numpy(spark, reach):
    rng = random.Random(3)
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    groups = {("a", None): [rng.gauss(0, 1) for _ in range(3000)], ("a", 1): [rng.choice([1.0, 2.0, 5.0]) for _ in range(500)], (None, 2): [10.0 ** rng.uniform(-300, 300) for _ in range(777)], ("b", 3): [4.0], ("c", 4): [1.0, 2.0], ("d", 5): [7.0] * 40}
    rows = [(*k, v) for k, vs in groups.items() for v in vs] + [("a", 1, None), ("e", 6, None)]
    rng.shuffle(rows)
    got = exact_quantiles(spark.createDataFrame(rows, "s string, k int, value double").repartition(5), ["s", "k"], "value", shares, reach=reach).collect()
    assert {(r.s, r.k) for r in got} == set(groups)
    for r in got:
        assert r.n == len(groups[r.s, r.k]) and r.q == pytest.approx(np.quantile(groups[r.s, r.k], shares).tolist(), rel=1e-12)


def test_narrow_brackets_are_widened(spark):
    rows = [(float(i % 997),) for i in range(20_000)]
    got = exact_quantiles(spark.createDataFrame(rows, "v double"), [], "v", [0.5, 0.37], reach=1e-9).first()
    assert got.n == 20_000 and got.q == pytest.approx(np.quantile([r[0] for r in rows], [0.5, 0.37]).tolist())


def test_empty(spark):
    assert exact_quantiles(spark.createDataFrame([], "g string, v double"), ["g"], "v", [0.5]).count() == 0
