"""Hand-worked cases and properties of the single-cell flow."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlake.functions import axis
from strandlake.functions.seq import poisson_upper_tail
from strandlake.operators import consensus, sc
from strandlake.params import ScParams
from strandlake.plans import report
from strandlake.plans.single_cell import elements_from_reads, run_single_cell
from strandlake.sources.tables import clone_summary

G1, G2 = "ACGTACGTACGTACGTAC", "TTTTGGGGCCCCAAAATT"
CELLS = {("c1", "G1"): 9, ("c1", "G2"): 1, ("c2", "G1"): 6, ("c2", "G2"): 5, ("c3", "G2"): 8, ("c4", "G1"): 4, ("c5", "G1"): 7}
LOOSE = ScParams(umi_threshold=1, max_ratio_threshold=0.05, normalized_abundance_threshold=0.05)


@pytest.fixture(scope="module")
def umis(spark):
    return spark.createDataFrame([("s1", c, g, f"u{i}", 3) for (c, g), n in CELLS.items() for i in range(n)], "sample string, CBC string, GBC string, UMI string, count long")


@pytest.fixture(scope="module")
def scored(umis):
    return sc.poisson(sc.combos(umis)).cache()


def test_scores(scored):
    got = {(r.CBC, r.GBC): r for r in scored.collect()}
    assert got["c2", "G2"].max_ratio == pytest.approx(0.833333, abs=1e-6)
    assert got["c2", "G1"].normalized_abundance == pytest.approx(0.545455, abs=1e-6)
    for key, p in {("c1", "G1"): 0.208427, ("c1", "G2"): 0.993262, ("c2", "G1"): 0.630959, ("c2", "G2"): 0.559507, ("c3", "G2"): 0.133372, ("c4", "G1"): 0.888150, ("c5", "G1"): 0.473476}.items():
        assert got[key].p == pytest.approx(p, abs=1e-6)
    totals = scored.groupBy("CBC").agg(F.sum("normalized_abundance").alias("s")).collect()
    assert all(r.s == pytest.approx(1) for r in totals)


def test_strict(scored):
    cells = sc.cell_gbc(sc.support(scored))
    assert sorted((r.clone, r.GBC_set, r.n_cells, round(r.prevalence, 6)) for r in sc.clones(sc.unique_cells(cells)).collect()) == [("C0", "G1", 2, 0.666667), ("C1", "G2", 1, 0.333333)]
    assert sorted((r.cell_id, r.GBC) for r in sc.cell_table(cells).collect()) == [("c1_s1", "G1"), ("c3_s1", "G2"), ("c5_s1", "G1")]
    m = sc.moi_stats(cells).first()
    assert (m.median_moi, m.std_moi) == (1, 0)


def test_strict_poisson(scored):
    cells = sc.cell_gbc(sc.support(scored, ScParams(p_threshold=0.3)))
    assert sorted((r.clone, r.GBC_set, r.n_cells) for r in sc.clones(cells).collect()) == [("C0", "G1", 1), ("C1", "G2", 1)]


def test_loose(scored):
    cells = sc.cell_gbc(sc.support(scored, LOOSE))
    assert sorted((r.moi, r.n_cells) for r in sc.moi_distribution(cells).collect()) == [(1, 3), (2, 2)]
    m = sc.moi_stats(cells).first()
    assert (m.median_moi, round(m.std_moi, 6)) == (1, 0.547723)
    clones = sc.clones(cells)
    assert sorted((r.GBC_set, r.n_cells) for r in clones.collect()) == [("G1", 2), ("G1;G2", 2), ("G2", 1)]
    assert sc.set_stats(clones).first().redundancy == 0.5
    assert sorted((r.GBC_set, r.n_cells) for r in sc.clones(sc.unique_cells(cells)).collect()) == [("G1", 2), ("G2", 1)]


def test_sample_params(spark, scored):
    own = spark.createDataFrame([("s1", 1.0, 1.0, 0.05, 0.05), ("other", 99.0, 0.0, 1.0, 1.0)], "sample string, umi_treshold double, p_treshold double, max_ratio_treshold double, normalized_abundance_treshold double")
    assert sc.support(scored, ScParams(), own).where("status = 'supported'").count() == len(CELLS)


def test_nearest_and_missing(spark):
    near = "C" + G1[1:]
    far = "CATG" + G1[4:]
    elements = spark.createDataFrame([("s", "c", "u1", G1), ("s", "c", "u2", near), ("s", "c", "u3", far), ("s", "c", "u4", None)], "sample string, CBC string, UMI string, GBC string")
    bulk = spark.createDataFrame([("s", G1, 50), ("s", "G" + G1[1:], 70), ("s", G2, 9)], "sample string, gbc string, read_count long")
    mapped = {r.GBC: (r.correct_GBC, r.hamming) for r in sc.bulk_map(elements, bulk).collect()}
    assert mapped == {G1: (G1, 0), near: ("G" + G1[1:], 1)}
    assert sorted(r.UMI for r in sc.correct_with_bulk(elements, sc.bulk_map(elements, bulk)).collect()) == ["u1", "u2"]


def test_distance_bound(spark):
    three, four = "CATT" + G1[4:], "CATC" + G1[4:]
    dist = lambda x: sum(a != b for a, b in zip(x, G1))
    rows = [("s", "c", "u", x) for x in (three, four)]
    bulk = spark.createDataFrame([("s", G1, 5)], "sample string, gbc string, read_count long")
    got = {r.GBC for r in sc.bulk_map(spark.createDataFrame(rows, "sample string, CBC string, UMI string, GBC string"), bulk).collect()}
    assert got == {x for x in (three, four) if dist(x) <= 3}


def test_poisson_bounds(spark):
    df = spark.createDataFrame([(0, 2.0), (400, 1.0), (900, 900.0), (1, 0.5)], "o long, m double").select("o", poisson_upper_tail(F.col("o"), F.col("m")).alias("p"))
    got = {r.o: r.p for r in df.collect()}
    assert got[0] == 1 and got[400] == pytest.approx(0, abs=1e-9) and got[900] == pytest.approx(0.5, abs=0.02) and got[1] == pytest.approx(1 - 2.718281828**-0.5, abs=1e-6)


def test_whole_flow(spark):
    rev = lambda s: s[::-1].translate(str.maketrans("ACGTN", "TGCAN"))
    rows = [("s", f"c{i}", f"u{j}", rev(G1)) for i in range(12) for j in range(6)] + [("s", "c0", "u9", rev(G2))]
    elements = spark.createDataFrame(rows, "sample string, CBC string, UMI string, GBC string")
    result = run_single_cell(elements)
    assert [(r.GBC_set, r.n_cells) for r in result.clones.collect()] == [(G1, 12)]
    m = result.metrics.first().asDict()
    assert (m["starting_CBCs"], m["n_clones_10plus"], m["unsupported_combos"]) == (12, 1, 1)
    text = report.summary_text(m, "s")
    parsed = clone_summary(spark.createDataFrame([("s", line) for line in text.split("\n")], "sample string, value string")).first().asDict()
    assert all(parsed[k] == m[k] for k in ("unique_good_GBCs", "supported_combos", "starting_CBCs", "n_clones", "n_clones_10plus", "uniquely_barcoded_cells"))
    with pytest.raises(KeyError):
        run_single_cell(elements, bulk=spark.createDataFrame([("r", G1, 5)], "sample string, gbc string, read_count long"), sample_map=spark.createDataFrame([("other", "r")], "sample string, reference string"))
    page = report.report_page(report.run_document(result.metrics, {"umi": 5}, run_type="sc"))
    assert "unique_good_GBCs" in page and "<td>s</td>" in page and report.SORT in page


def test_empty_sample_metrics(spark):
    schema = "sample string, CBC string, UMI string, GBC string"
    assert run_single_cell(spark.createDataFrame([], schema)).metrics.count() == 0


def test_consensus(spark):
    anchor = "TAGCAAACTGGGGCACAAGCTTAATTAAGAATT"
    good, bad = anchor + G1 + "GG", anchor + "C" + G1[1:] + "GG"
    high, low = "I" * len(good), "#" * len(good)
    rows = [("s", f"r{i}", "lentiCassette", 5, 60, 0, good, high, "CB1", "U1") for i in range(3)] + [("s", "r3", "lentiCassette", 5, 60, 0, bad, high, "CB1", "U1"), ("s", "r4", "lentiCassette", 5, 60, 0, bad, low, "CB1", "U1")]
    rows += [("s", "x1", "chrM", 5, 60, 0, good, high, "CB1", "U1"), ("s", "x2", "lentiCassette", 5, 60, 4, good, high, "CB1", "U1"), ("s", "x3", "lentiCassette", 5, 60, 0, good, high, "-", "U1"), ("s", "x4", "lentiCassette", 5, 60, 0, good, high, "CB2", "U1")]
    reads = spark.createDataFrame(rows, "sample string, read_id string, contig string, pos long, mapq int, flag int, seq string, qual string, CB string, UB string")
    got = elements_from_reads(reads, spark.createDataFrame([("s", "CB1")], "sample string, CB string"), ScParams(min_reads=4)).collect()
    assert [tuple(r) for r in got] == [("s", "read_0", "CB1", "0", G1, "4")]
    grouped = consensus.molecules(consensus.tagged(reads, "lentiCassette"))
    assert consensus.consensus(grouped, min_reads=6).count() == 0


def test_axis():
    assert [axis.nice_step(x) for x in (0, 0.15, 0.22, 0.3, 1.5, 4, 10, 11)] == [0.1, 0.2, 0.25, 0.5, 2, 5, 10, 1]
    assert axis.log_ticks(3, 2000) == [3, 10, 50, 100, 500, 1000, 2000] and axis.log_ticks(1, 10) == [1, 10]
    assert axis.log_ticks(0, 5) == [0, 5] and axis.log_ticks(4, 4) == [4]
    assert axis.figure_size(3) == (12, 4) and axis.figure_size(40) == (28, 4)
    assert axis.dark(0, 0, 0) and not axis.dark(1, 1, 1)


def test_types(spark, scored):
    kinds = dict(scored.dtypes)
    assert kinds["umi"] == "bigint" and kinds["p"] == "double" and isinstance(scored.schema["CBC"].dataType, T.StringType)


def test_density_of_many_points(spark):
    """A narrow kernel: the same density as from all points at all places of the grid."""
    import math
    import random

    import numpy as np

    rng = random.Random(2)
    rows = [("s", rng.betavariate(2, 5), rng.betavariate(5, 2)) for _ in range(4000)] + [("flat", 0.5, 0.1 * k) for k in range(5)]
    got = {(r.x, r.y): r.density for r in sc.support_kde(spark.createDataFrame(rows, "sample string, max_ratio double, normalized_abundance double")).where("sample = 's'").collect()}
    x, y = (np.array([r[k] for r in rows if r[0] == "s"]) for k in (1, 2))
    f, cov = len(x) ** (-1 / 3), np.cov(x, y)
    inverse, norm = np.linalg.inv(cov * f), len(x) * 2 * math.pi * f * math.sqrt(np.linalg.det(cov))
    assert len(got) == 400
    for (a, b), density in got.items():
        d = np.array([a - x, b - y])
        assert density == pytest.approx(np.exp(-0.5 * np.einsum("ik,ij,jk->k", d, inverse, d)).sum() / norm, abs=1e-9)
