"""Barcodes by posterior, UMIs within genes, cells among droplets."""

import math
import random

import numpy as np
import pytest

from strandlake.operators import cells

A, B = "ACGTACGTACGTACGT", "ACTTACGTACGTACGT"
FIRST = "read_id string, seq string, qual string"


def reads(spark, rows):
    return spark.createDataFrame([(f"r{i}", cb + "TTTTGGGGCCCC", q) for i, (cb, q) in enumerate(rows)], FIRST)


def matched(spark, rows, listed, **more):
    found = cells.match_barcodes(reads(spark, rows), spark.createDataFrame([(x,) for x in listed], "CB string"), **more)
    return {r.read_id: (r.CB, round(r.posterior, 6)) for r in found.collect()}


def test_posterior(spark):
    high, low = "I" * 28, "II#" + "I" * 25
    between = "ACAT" + A[4:]
    # a place of A and B misread: the one with 99 reads outweighs the other with none 100 to 1
    got = matched(spark, [(A, high)] * 99 + [(between[:2] + "A" + A[3:], high)], [A, B])
    assert got["r99"] == (A, round(100 / 101, 6))
    # 9 reads to none aren't enough, at whatever quality
    got = matched(spark, [(A, high)] * 9 + [(A[:2] + "A" + A[3:], low)], [A, B])
    assert "r9" not in got and matched(spark, [(A, high)] * 9 + [(A[:2] + "A" + A[3:], low)], [A, B], min_posterior=0.9)["r9"][0] == A
    # equal candidates are a tie, one alone is certain
    assert matched(spark, [(A[:2] + "C" + A[3:], high)], [A, B]) == {}
    assert matched(spark, [(A[:2] + "C" + A[3:], high)], [A]) == {"r0": (A, 1.0)}


def test_qualities_weigh(spark):
    """Two candidates at different places: the badly read place is the wrong one."""
    other = A[:15] + "A"
    seen = A[:2] + "T" + A[3:15] + "A"
    one = A[:2] + "T" + A[3:]  # differs from seen at 16
    assert matched(spark, [(seen, "II" + "I" * 13 + "#" + "I" * 12)], [other, one])["r0"][0] == one
    assert matched(spark, [(seen, "II#" + "I" * 25)], [other, one])["r0"][0] == other


def test_unknown_bases(spark):
    q = "I" * 28
    assert matched(spark, [("N" + A[1:], q), ("NN" + A[2:], q), (A[:8], q)], [A, B]) == {"r0": (A, 1.0)}
    assert matched(spark, [(A[:2] + "N" + A[3:], q)], [A, B]) == {}
    # with an N elsewhere there is no room for a substitution
    assert matched(spark, [("N" + A[1:2] + "C" + A[3:], q)], [A, B]) == {}


def umis(spark, rows, **more):
    listed = [("s", c, g, u) for c, g, u, n in rows for _ in range(n)]
    found = cells.collapse_umis(spark.createDataFrame(listed, "sample string, CB string, gene string, UB string"), umi_length=4, **more)
    return {(r.CB, r.gene, r.UB): r.reads for r in found.collect()}


def test_collapse(spark):
    assert umis(spark, [("c", "g", "AACC", 5), ("c", "g", "AACG", 2), ("c", "g", "TTCC", 1), ("c", "h", "AACG", 1), ("d", "g", "AACG", 3)]) == {("c", "g", "AACC"): 7, ("c", "g", "TTCC"): 1, ("c", "h", "AACG"): 1, ("d", "g", "AACG"): 3}
    # equal counts: the smaller one stays
    assert umis(spark, [("c", "g", "AACC", 2), ("c", "g", "AACG", 2)]) == {("c", "g", "AACC"): 4}


def test_chains_are_followed_one_step(spark):
    assert umis(spark, [("c", "g", "AACC", 9), ("c", "g", "AACG", 5), ("c", "g", "AATG", 2), ("c", "g", "GATG", 1)]) == {("c", "g", "AACC"): 14, ("c", "g", "AACG"): 2, ("c", "g", "AATG"): 1}


def test_odd_umis(spark):
    assert umis(spark, [("c", "g", "AAAA", 5), ("c", "g", "NACG", 2), ("c", "g", "ACG", 1), ("c", "g", None, 1), ("c", "g", "ACGT", 1)]) == {("c", "g", "ACGT"): 1}


def test_one_gene(spark):
    rows = [("c", "g", "ACGT", 3), ("c", "h", "ACGT", 2), ("c", "g", "CCGT", 1), ("c", "i", "GGTT", 2), ("c", "j", "GGTT", 2), ("d", "j", "GGTT", 1)]
    assert umis(spark, rows, multi_gene=True) == {("c", "g", "ACGT"): 4, ("d", "j", "GGTT"): 1}


def brute_umis(rows):
    counts = {}
    for key in rows:
        counts[key] = counts.get(key, 0) + 1
    out = {}
    for (c, g, u), n in counts.items():
        near = [(m, v) for (c2, g2, v), m in counts.items() if (c, g) == (c2, g2) and sum(x != y for x, y in zip(u, v)) <= 1]
        best = max(m for m, _ in near)
        to = min(v for m, v in near if m == best)
        out[c, g, to] = out.get((c, g, to), 0) + n
    return out


def test_collapse_against_brute_force(spark):
    rng = random.Random(6)
    rows = [(f"c{rng.randint(0, 3)}", f"g{rng.randint(0, 1)}", "".join(rng.choices("ACGT", [6, 1, 1, 1], k=4))) for _ in range(900)]
    rows = [r for r in rows if len(set(r[2])) > 1]
    assert umis(spark, [(*r, 1) for r in rows]) == brute_umis(rows)


def test_log_factorial(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 2, 19, 20, 21, 22, 1000, 10**6)], "n long")
    for r in df.select("n", cells.log_factorial(cells.F.col("n")).alias("f")).collect():
        assert r.f == pytest.approx(math.lgamma(r.n + 1), abs=1e-6, rel=1e-12)


def test_good_turing(spark):
    """The frequencies of a published example: 'prosody', total 30,902, once 120 kinds."""
    freq = {1: 120, 2: 40, 3: 24, 4: 13, 5: 15, 6: 5, 7: 11, 8: 2, 9: 2, 10: 1, 12: 3, 14: 2, 15: 1, 16: 1, 17: 3, 19: 1, 20: 3, 21: 2, 23: 3, 24: 3, 25: 3, 26: 2, 27: 2, 28: 1, 31: 2, 32: 2, 33: 1, 34: 2, 36: 2, 41: 3, 43: 1, 45: 3, 46: 1, 47: 1, 50: 1, 71: 1, 84: 1, 101: 1, 105: 1, 121: 1, 124: 1, 146: 1, 162: 1, 193: 1, 199: 1, 224: 1, 226: 1, 254: 1, 257: 1, 339: 1, 421: 1, 456: 1, 481: 1, 483: 1, 1140: 1, 1256: 1, 1322: 1, 1530: 1, 2131: 1, 2395: 1, 6925: 1, 7846: 1}
    rows = [("s", f"g{r}_{k}", r) for r, n in freq.items() for k in range(n)] + [("s", f"u{k}", 0) for k in range(10)] + [("t", "a", 3), ("t", "b", 3)]
    got = cells.good_turing(spark.createDataFrame(rows, "sample string, gene string, n long"))
    p = {(r["sample"], r.gene): r.p for r in got.collect()}
    total = sum(r * n for r, n in freq.items())
    assert sum(v for (s, _), v in p.items() if s == "s") == pytest.approx(1)
    assert p["s", "u0"] == pytest.approx(120 / total / 10)
    assert p["s", "g1_0"] == pytest.approx(0.7628 / total, rel=2e-3) and p["s", "g7846_0"] == pytest.approx(7839 / total, rel=2e-3)
    assert p["t", "a"] == p["t", "b"] == pytest.approx(0.5)


def droplets(seed, n_ambient=400, n_small=25, n_large=12, genes=200):
    rng = np.random.default_rng(seed)
    ambient = rng.dirichlet(np.full(genes, 0.5))
    own = rng.dirichlet(np.full(genes, 0.2))
    rows, small, large = [], set(), set()
    for i in range(n_ambient + n_small + n_large):
        kind = "ambient" if i < n_ambient else "small" if i < n_ambient + n_small else "large"
        total = {"ambient": rng.integers(20, 60), "small": rng.integers(60, 120), "large": rng.integers(2000, 3000)}[kind]
        drawn = rng.multinomial(total, ambient if kind == "ambient" else own)
        rows += [("s", f"D{i:04d}", f"g{g:03d}", int(c)) for g, c in enumerate(drawn) if c]
        (small if kind == "small" else large if kind == "large" else set()).add(f"D{i:04d}")
    return rows, small, large


PARAMS = cells.CellParams(expected_cells=500, ambient_from=60, ambient_to=440, umi_min=20, simulations=2000)


def test_planted_cells_are_called(spark):
    rows, small, large = droplets(3)
    df = spark.createDataFrame(rows, "sample string, CB string, gene string, n long")
    got = {r.CB: r for r in cells.call_cells(df, PARAMS).collect()}
    assert {c for c, r in got.items() if r.reason == "size"} == large
    called = {c for c, r in got.items() if r.reason == "profile"}
    assert small <= called and len(called - small) <= 3
    again = {r.CB: r.p_value for r in cells.call_cells(df.repartition(7), PARAMS).collect()}
    assert again == {c: r.p_value for c, r in got.items()}


def test_ambient_droplets_alone_are_not_cells(spark):
    rows, _, _ = droplets(4, n_small=0)
    got = cells.call_cells(spark.createDataFrame(rows, "sample string, CB string, gene string, n long"), PARAMS).where("reason = 'profile'")
    assert got.count() <= 3


def test_too_few_droplets(spark):
    rows = [("s", f"D{i}", "g", 100 - i) for i in range(5)] + [("t", "D0", "g", 7)]
    got = cells.call_cells(spark.createDataFrame(rows, "sample string, CB string, gene string, n long"))
    assert {(r["sample"], r.CB, r.reason) for r in got.collect()} == {("s", f"D{i}", "size") for i in range(5)} | {("t", "D0", "size")}
    assert cells.call_cells(spark.createDataFrame([], "sample string, CB string, gene string, n long")).count() == 0


def test_reads_are_derived_once(spark):
    found = cells.match_barcodes(reads(spark, [(A, "I" * 28), (A[:2] + "A" + A[3:], "I" * 28)]), spark.createDataFrame([(A,), (B,)], "CB string"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "LocalRelation" not in plan and "parquet" in plan
