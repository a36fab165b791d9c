"""Reads on the cassette against the whole dynamic programme."""

import random

import pytest

from strandlake.operators import remap


def best(read, ref):
    """The best score of the read from end to end anywhere on the reference, with affine gaps; mismatches beyond its ends."""
    pad = len(read) + 20
    ref = "#" * pad + ref + "#" * pad
    h, ins = [0] * (len(ref) + 1), [-(10**6)] * (len(ref) + 1)
    for c in read:
        new, new_ins, gap = [-(10**6)] * (len(ref) + 1), [-(10**6)] * (len(ref) + 1), -(10**6)
        for j in range(len(ref) + 1):
            new_ins[j] = max(h[j] - 7, ins[j] - 1)
            new[j] = new_ins[j]
            if j:
                new[j] = max(new[j], h[j - 1] + (1 if ref[j - 1] == c else -4))
                gap = max(new[j - 1] - 7, gap - 1)
                new[j] = max(new[j], gap)
        h, ins = new, new_ins
    return max(h)


def mutated(rng, s):
    s = list(s)
    for _ in range(rng.randint(0, 3)):
        at = rng.randrange(5, len(s) - 5)
        kind = rng.choice("xid")
        if kind == "x":
            s[at] = rng.choice("ACGT")
        elif kind == "i":
            s[at:at] = rng.choices("ACGT", k=rng.randint(1, 3))
        else:
            del s[at : at + rng.randint(1, 3)]
    return "".join(s)


def spelled(read, ref, pos, cigar):
    """Points of an alignment, clipped bases as mismatches."""
    i, j, points, n = 0, pos - 1, 0, ""
    for c in cigar:
        if c.isdigit():
            n += c
            continue
        k, n = int(n), ""
        if c == "M":
            points += sum(1 if a == b else -4 for a, b in zip(read[i : i + k], ref[j : j + k], strict=True))
            i, j = i + k, j + k
        elif c in "IS":
            points -= 6 + k if c == "I" else 4 * k
            i += k
        else:
            points -= 6 + k
            j += k
    assert i == len(read)
    return points


@pytest.fixture(scope="module")
def cassette():
    return "".join(random.Random(1).choices("ACGT", k=400))


def test_against_the_whole_programme(spark, cassette):
    rng = random.Random(2)
    rows = []
    for i in range(120):
        a = rng.randrange(0, 330)
        s = mutated(rng, cassette[a : a + 70])
        rows.append((i, s if i % 2 else s[::-1].translate(str.maketrans("ACGT", "TGCA")), s))
    df = remap.remap(spark.createDataFrame(rows, "i int, seq string, as_on_ref string"), [("other", "T" * 50), ("cassette", cassette)])
    got = df.collect()
    assert len(got) == len(rows) and df.columns[:3] == ["i", "seq", "as_on_ref"]
    for r in got:
        assert (r.contig, r.flag) == ("cassette", 0 if r.i % 2 else 16)
        assert r.score == best(r.as_on_ref, cassette) == spelled(r.as_on_ref, cassette, r.pos, r.cigar)


def test_barcode_by_place(spark, cassette):
    """The bases on a place of the reference, whatever is missing or put in before it."""
    barcode = cassette[200:218]
    reads = [cassette[150:230], cassette[150:170] + cassette[172:230], cassette[150:160] + "A" + cassette[160:230], cassette[150:205] + "GG" + cassette[205:230], cassette[150:203] + cassette[204:230]]
    got = {r.i: r for r in remap.remap(spark.createDataFrame(list(enumerate(reads)), "i int, seq string"), [("c", cassette)], region=("c", 201, 18)).collect()}
    assert [got[i].bases for i in range(3)] == [barcode] * 3
    assert got[0].cigar == "80M" and got[1].cigar.count("D") == 1 and got[2].cigar.count("I") == 1
    assert sorted(got[3].bases) == sorted(barcode + "GG") and len(got[4].bases) == 17


def test_ends_and_nothing(spark, cassette):
    rows = [(0, "GATTACAGATTACA" + cassette[:60]), (1, cassette[-60:] + "ACACACAC"), (2, "A" * 40), (3, None), (4, "ACG"), (5, "")]
    got = {r.i: r for r in remap.remap(spark.createDataFrame([(i, s, "x") for i, s in rows], "i int, seq string, contig string"), [("c", cassette)]).collect()}
    assert (got[0].pos, got[0].cigar) == (1, "14S60M") and (got[1].pos, got[1].cigar) == (341, "60M8S")
    assert all((got[i].contig, got[i].flag) == (None, 4) for i in (2, 3, 4, 5))
    with pytest.raises(ValueError):
        remap.remap(spark.createDataFrame(rows, "i int, seq string"), [("c", "A" * (remap.MAX_REFERENCE + 1))])
