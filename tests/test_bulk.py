"""Hand-worked cases and properties of the bulk flow."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from strandlake.functions import seq
from strandlake.operators import bulk, bulk_summary, cluster, similarity
from strandlake.params import BulkParams
from strandlake.plans.bulk import run_bulk

ANCHOR = BulkParams().anchor
A, B, C, D, E = "ACGTACGTACGTACGTAC", "ACGTACGTACGTACGTAG", "ACGTACGTACGTACCATG", "TTTTGGGGCCCCAAAATT", "ATTTGGGGCCCCAAAATT"
LONE, SHORT = "CCGTACGTACGTACGTAC", "ACGTACGTACGTACGTA"
COUNTS = {A: 100, B: 40, C: 20, D: 30, E: 16, LONE: 1}


def values(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame([("s", g, n) for g, n in COUNTS.items()], "sample string, gbc string, read_counts long")


@pytest.fixture(scope="module")
def corrections(raw):
    return cluster.correction(cluster.labels(raw))


def test_correction(corrections):
    assert values(corrections, "correct", "degenerated", "n_reads_correct", "n_reads_degenerated") == sorted([(A, B, 100, 40), (A, C, 100, 20)])


@pytest.mark.parametrize("spikes, expected", [(None, {A: 160, D: 30}), ([B], {A: 160, D: 30}), ([A], {B: 40, D: 30}), ([B, C], {A: 100, D: 30})])
def test_spikeins(spark, raw, corrections, spikes, expected):
    table = None if spikes is None else spark.createDataFrame([(s,) for s in spikes], "gbc string")
    assert dict(values(cluster.final_pool(raw, corrections, min_n_reads=30, spikeins=table), "gbc", "read_count")) == expected


def test_no_cluster(spark):
    raw = spark.createDataFrame([("s", D, 30), ("s", E, 16)], "sample string, gbc string, read_counts long")
    found = cluster.correction(cluster.labels(raw))
    assert found.count() == 0
    assert values(cluster.final_pool(raw, found, min_n_reads=30), "gbc", "read_count") == [(D, 30)]


def test_empty(spark):
    raw = spark.createDataFrame([], "sample string, gbc string, read_counts long")
    assert cluster.labels(raw).count() == 0


def test_extraction(spark):
    reads = [f"TT{ANCHOR}T{A}CC", f"TT{ANCHOR[:-1]}TT{A}CC", f"TTGGGTTAAAACGGGCCCTCTATT{A}", f"{ANCHOR}TACG", ANCHOR, "AC", None]
    df = spark.createDataFrame([("s", r) for r in reads], "sample string, seq string")
    assert values(bulk.extract(df, anchor=ANCHOR), "gbc") == sorted([(A,), (A,), ("ACG",), ("",)])
    assert values(bulk.raw_counts(bulk.extract(df, anchor=ANCHOR)), "gbc", "read_counts") == [(A, 2)]


def test_whole_flow(spark):
    reads = [f"TT{ANCHOR}T{g}CC" for g, n in COUNTS.items() for _ in range(n)] + [f"{ANCHOR}T{SHORT}"] * 5
    result = run_bulk(spark.createDataFrame([("s", r) for r in reads], "sample string, seq string"), BulkParams(min_n_reads=30))
    assert dict(values(result.corrected, "gbc", "read_count")) == {A: 160, D: 30}
    m = result.metrics.first()
    assert (m.total_GBC_reads, m.n_unique_GBCs, m.n_filtered_GBCs, m.n_corrected_GBCs, m.n_degenerated_GBCs, m.median_n_reads_added) == (207, 6, 2, 1, 2, 30.0)
    assert values(result.common, "sample_x", "sample_y", "n_common") == [("s", "s", 2)]


def test_sequence_functions(spark):
    rng = random.Random(5)
    pairs = [("".join(rng.choices("ACGTN", k=18)), "".join(rng.choices("ACGTN", k=18))) for _ in range(60)]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", seq.packed_hamming(seq.packed(F.col("a")), seq.packed(F.col("b"))).alias("p"), seq.hamming(F.col("a"), F.col("b")).alias("h"), seq.reverse_complement(seq.reverse_complement(F.col("a"))).alias("rr")).collect():
        assert r.p == r.h == sum(x != y for x, y in zip(r.a, r.b))
        assert r.rr == r.a
    one = spark.createDataFrame([(A, "ACG", "")], "x string, y string, z string").select(seq.reverse_complement(F.col("x")).alias("rc"), seq.hamming(F.col("x"), F.col("y")).alias("h"), seq.hamming(F.col("x"), F.col("z")).alias("e")).first()
    assert (one.rc, one.h, one.e) == ("GTACGTACGTACGTACGT", 0, 0)
    with pytest.raises(Exception, match="DNA"):
        spark.createDataFrame([("AXG",)], "x string").select(seq.checked_reverse_complement(F.col("x"))).collect()


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_pairs_against_all(spark, threshold):
    rng = random.Random(threshold)
    base = ["".join(rng.choices("ACGT", k=12)) for _ in range(4)]
    mutant = lambda s: "".join(rng.choice("ACGT") if rng.random() < 0.15 else c for c in s)
    own = sorted({mutant(rng.choice(base)) for _ in range(60)})
    left, right = (spark.createDataFrame([("s", x) for x in own], f"sample string, {c} string") for c in ("a", "b"))
    got = values(similarity.similar_pairs(left, right, by=["sample"], left_col="a", right_col="b", threshold=threshold, length=12), "a", "b", "hamming")
    want = sorted((x, y, d) for x in own for y in own if (d := sum(p != q for p, q in zip(x, y))) <= threshold)
    assert got == want


def test_labels_against_search(spark):
    rng = random.Random(11)
    rows, want = [], {}
    for k in range(12):
        base = ["".join(rng.choices("ACGT", k=10)) for _ in range(2)]
        own = {}
        for _ in range(18):
            s = "".join(rng.choice("ACGT") if rng.random() < 0.12 else c for c in rng.choice(base))
            own[s] = rng.choice([2, 3, 4, 5, 8, 15, 40, 100])
        order, taken = sorted(own, key=lambda s: (-own[s], s)), {}
        for root in order:
            queue = [] if root in taken else [root]
            while queue:
                x = queue.pop()
                if x not in taken:
                    taken[x] = root
                    queue += [y for y in own if y not in taken and sum(p != q for p, q in zip(x, y)) <= 2 and own[x] >= 2 * own[y] - 1]
        rows += [(f"s{k}", s, n) for s, n in own.items()]
        want |= {(f"s{k}", s): r for s, r in taken.items()}
    df = spark.createDataFrame(rows, "sample string, gbc string, read_counts long")
    got = {(r.sample, r.gbc): r.correct for r in cluster.labels(df, threshold=2, length=10).collect()}
    assert got == want


def test_reads_are_kept(spark, raw, corrections):
    summed = cluster.final_pool(raw, corrections, min_n_reads=0).agg(F.sum("read_count")).first()[0]
    assert summed == sum(n for n in COUNTS.values() if n > 1)


def test_overlap_is_symmetric(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 1), ("b", "y", 1), ("c", "z", 1)], "sample string, gbc string, read_count long")
    got = {(r.sample_x, r.sample_y): r.n_common for r in bulk_summary.overlap(df).collect()}
    assert all(got[x, y] == got[y, x] for x, y in itertools.product("abc", repeat=2))
    assert (got["a", "a"], got["a", "b"], got["a", "c"]) == (2, 1, 0)


def test_segments():
    assert similarity.segments(18, 4) == [(1, 5), (6, 5), (11, 4), (15, 4)]
    for length, threshold in ((18, 1), (18, 2), (18, 3), (16, 2)):
        keys = similarity.choices(length, threshold)
        assert min(sum(n for _, n in k) for k in keys) >= 8 and len(keys) <= 20
    with pytest.raises(ValueError):
        similarity.segments(3, 4)
