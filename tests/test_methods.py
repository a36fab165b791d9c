"""Clustering methods and UMI adjacency against plain Python."""

import random

import pytest

from strandlake.operators import cluster, consensus
from strandlake.params import BulkParams
from strandlake.plans.bulk import run_bulk

SCHEMA = "sample string, gbc string, read_counts long"


def hamming(a, b):
    return sum(x != y for x, y in zip(a, b))


def by_hand(counts, method, t):
    """barcode -> first of its group, from {barcode: reads}."""
    nodes = {b: n for b, n in counts.items() if n > 1}
    order = sorted(nodes, key=lambda b: (-nodes[b], b))
    near = {b: [o for o in order if o != b and hamming(b, o) <= t] for b in order}
    seen, out = set(), {}
    for b in order:
        if b in seen:
            continue
        part, todo = [], [b]
        seen.add(b)
        while todo:
            x = todo.pop()
            part.append(x)
            for o in near[x]:
                if o not in seen:
                    seen.add(o)
                    todo.append(o)
        part.sort(key=lambda x: (-nodes[x], x))
        if method == "cluster":
            out |= {x: part[0] for x in part}
            continue
        k = next(k for k in range(1, len(part) + 1) if set(part) <= {o for x in part[:k] for o in [x, *near[x]]})
        for x in part:
            out[x] = x if x in part[:k] else next(lead for lead in part[:k] if lead in near[x])
    return out


def told(spark, samples, method, t, length):
    rows = [(s, b, n) for s, counts in samples.items() for b, n in counts.items()]
    found = cluster.grouped(spark.createDataFrame(rows, SCHEMA), method, threshold=t, length=length).collect()
    firsts = {(r["sample"], r.gbc): r.correct for r in found}
    assert all(r.n_correct == samples[r["sample"]][r.correct] and r.read_counts == samples[r["sample"]][r.gbc] for r in found)
    return firsts


def test_the_usual_example(spark):
    """Six UMIs of a known picture: one component, of which adjacency keeps more and direction splits otherwise."""
    counts = {"ACGT": 456, "TCGT": 2, "CCGT": 2, "ACAT": 72, "ACAG": 90, "AAAT": 1 + 1}
    groups = lambda m: {b for b in told(spark, {"s": counts}, m, 1, 4).values()}
    assert groups("cluster") == {"ACGT"} and groups("adjacency") == {"ACGT", "ACAG", "ACAT"}
    assert groups("directional") == {"ACGT", "ACAG"} and groups("unique") == set(counts)
    with pytest.raises(ValueError, match="unknown method"):
        groups("other")


@pytest.mark.parametrize("method", ["cluster", "adjacency"])
@pytest.mark.parametrize("t", [1, 2])
def test_against_python(spark, method, t):
    rng = random.Random(t)
    samples = {s: {"".join(rng.choices("ACGT", [5, 2, 1, 1], k=7)): rng.choice([1, 2, 2, 5, 9, 40]) for _ in range(70)} for s in ("a", "b")}
    want = {(s, b): f for s, counts in samples.items() for b, f in by_hand(counts, method, t).items()}
    assert told(spark, samples, method, t, 7) == want


def test_long_chains_and_nothing(spark):
    chain = {"A" * (12 - k) + "C" * k: 20 - k for k in range(13)}
    assert set(told(spark, {"s": chain}, "cluster", 1, 12).values()) == {"A" * 12}
    assert cluster.grouped(spark.createDataFrame([], SCHEMA), "adjacency", length=12).count() == 0


def test_percentile(spark):
    assert set(told(spark, {"s": {"AAAA": 10_000, "CCCC": 9_000, "GGGG": 90, "TTTT": 91}}, "percentile", 1, 4)) == {("s", b) for b in ("AAAA", "CCCC", "GGGG", "TTTT")}
    assert set(told(spark, {"s": {"AAAA": 10_000, "CCCC": 9_000, "TTTT": 3}}, "percentile", 1, 4)) == {("s", "AAAA"), ("s", "CCCC")}


def test_a_run_by_another_method(spark):
    anchor, good = BulkParams().anchor, "ACGTACGTACGTACGTAC"
    near = good[:-1] + "G"
    reads = [("s", "TT" + anchor + "T" + g + "CC") for g, n in ((good, 30), (near, 25)) for _ in range(n)]
    df = spark.createDataFrame(reads, "sample string, seq string")
    told_ = lambda m: sorted((r.gbc, r.read_count) for r in run_bulk(df, BulkParams(min_n_reads=10, method=m)).corrected.collect())
    assert told_("directional") == sorted([(good, 30), (near, 25)]) and told_("cluster") == [(good, 55)]


def test_adjacent_umis(spark):
    rows = [("s", "c", 5, u, i) for u, n in (("AAAACCCCGGGG", 9), ("AAAACCCCGGGT", 4), ("AAAACCCCGGTT", 2), ("TTTTCCCCGGGG", 3), ("AAAA", 1)) for i in range(n)] + [("s", "c", 6, "AAAACCCCGGGT", 0), ("s", "d", 5, "AAAACCCCGGGT", 0), ("s", "c", 5, None, 0)]
    df = spark.createDataFrame(rows, "sample string, CB string, pos long, UB string, other int")
    got = {}
    for r in consensus.adjacent_umis(df).collect():
        got[r.CB, r.pos, r.UB] = got.get((r.CB, r.pos, r.UB), 0) + 1
    assert got == {("c", 5, "AAAACCCCGGGG"): 15, ("c", 5, "TTTTCCCCGGGG"): 3, ("c", 5, "AAAA"): 1, ("c", 6, "AAAACCCCGGGT"): 1, ("d", 5, "AAAACCCCGGGT"): 1, ("c", 5, None): 1}
    assert consensus.adjacent_umis(df, edits=0).count() == len(rows)
