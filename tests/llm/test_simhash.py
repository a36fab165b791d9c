"""Fingerprints, links and components against brute force."""

import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from strandlake.llm import simhash
from strandlake.llm.components import components
from tests.llm.conftest import low

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_print(text, size=3):
    w = WORD.findall(low(text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, radius):
    n, parent = len(prints), list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(n), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return [root(i) for i in range(n)]


def test_query(docs, tricky, sample, empty):
    for df, rows in ((docs, tricky), (sample, [(r.doc_id, r.text) for r in sample.collect()])):
        prints = [brute_print(t) for _, t in rows]
        got = simhash.op5_simhash(df).collect()
        roots = brute_components(prints, 2)
        low_id = {}
        for (i, _), r in zip(rows, roots):
            low_id[r] = min(low_id.get(r, 1 << 63), (1 << 63) - 1 if i is None else i)
        want = sorted((-1 if i is None else i, f"{p:016x}", -1 if low_id[r] == (1 << 63) - 1 else low_id[r]) for (i, _), p, r in zip(rows, prints, roots))
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.fingerprint, -1 if r.component_id is None else r.component_id) for r in got) == want
    assert simhash.op5_simhash(empty).count() == 0


def planted(n, seed, flips):
    """Fingerprints in groups whose members differ from a base in some bits."""
    rng = random.Random(seed)
    out = set()
    for _ in range(n):
        base = rng.getrandbits(64)
        out |= {base} | {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, flips))) for _ in range(rng.choice([1, 2, 12]))}
    return sorted(out)


@pytest.mark.parametrize("radius, parts, bucket", [(2, 3, 64), (2, 3, 2), (2, 2, 64), (1, 2, 64), (1, 2, 2), (3, 3, 4096), (5, 4, 4), (9, 5, 4096), (9, 5, 8)])
def test_links(spark, radius, parts, bucket):
    own = planted(20, radius * 100 + bucket, radius + 3)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in own], "fp long")
    found = simhash.links(df, radius=radius, parts=parts, bucket=bucket)
    pairs = [(r.fa & (2**64 - 1), r.fb & (2**64 - 1)) for r in found.collect()]
    roots = dict(zip(own, brute_components(own, radius)))
    assert all((a ^ b).bit_count() <= radius for a, b in pairs)
    assert all(roots[a] == roots[b] for a, b in pairs)
    parent = {x: x for x in own}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[root(a)] = root(b)
    assert len({root(x) for x in own}) == len(set(roots.values()))


def test_dense_bucket():
    rng = random.Random(12)
    for n in (3, 40, 700):
        base = [rng.getrandbits(64) for _ in range(2)]
        own = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(n)})
        i, j = simhash.bucket_links(np.array(own, dtype=np.uint64), 5, [])
        assert len(i) <= 10 * len(own) + 10
        assert all((own[a] ^ own[b]).bit_count() <= 5 for a, b in zip(i.tolist(), j.tolist()))
        parent = list(range(len(own)))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in zip(i.tolist(), j.tolist()):
            parent[root(int(b))] = root(int(a))
        assert len({root(x) for x in range(len(own))}) == len(set(brute_components(own, 5)))


def test_allocation():
    rng = random.Random(3)
    for _ in range(50):
        parts, top, total = 4, 2, rng.randint(-4, 6)
        keys = [[rng.randint(1, 50) for _ in range(top + 1)] for _ in range(parts)]
        pairs = [[float(rng.randint(0, 10_000)) for _ in range(top + 1)] for _ in range(parts)]
        cost = lambda own: sum(0 if t < 0 else 100 * keys[i][t] + pairs[i][t] for i, t in enumerate(own))
        best = min(cost(own) for own in itertools.product(range(-1, top + 1), repeat=parts) if sum(own) == total)
        assert cost(simhash.allocate(100, keys, pairs, total)) == best
    with pytest.raises(ValueError):
        simhash.allocate(1, [[1]], [[1.0]], 5)


def test_partitions():
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2, (4000, 64)).astype(float)
    bits[:, 1::2] = bits[:, ::2]  # each odd bit repeats its neighbour
    found = simhash.partition_bits(len(bits), bits.T @ bits, 4)
    assert sorted(b for p in found for b in p) == list(range(64))
    assert all((b ^ 1) in p for p in found for b in p)


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(110)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, k) for k in range(5001, 5060)] + [(7, 7)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text, size=5):
    w = WORD.findall(low(text or ""))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def test_near_copies(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(3000)]
    rows, group = [], {}
    for g in range(25):
        base = rng.choices(words, k=200)
        for k in range(4):
            own = list(base)
            if k:
                for _ in range(2):
                    own[rng.randrange(len(own))] = rng.choice(words)
            i = len(rows)
            rows.append((i, " ".join(own)))
            group[i] = g
    for _ in range(30):  # half of a text and half of another: alike, but not by 0.8
        a, b = rng.sample(range(100), 2)
        rows.append((len(rows), " ".join(rows[a][1].split()[:100] + rng.choices(words, k=100))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in simhash.keep_first(df, shingle=5, similarity=0.8).collect()}
    assert {i for i in kept if i >= 100} == set(range(100, 130))
    assert len(kept & set(range(100))) <= 28 and {group[i] for i in kept if i < 100} == set(range(25))
    # whatever went is near to something that stayed or to a member of its chain
    sets = {i: shingles(t) for i, t in rows}
    for i in set(range(100)) - kept:
        assert max(len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for j in range(100) if j != i) > 0.7


def test_keep_first_passes_columns(docs, empty):
    out = simhash.keep_first(docs, shingle=5, similarity=0.8)
    assert out.columns == docs.columns and 0 < out.count() < docs.count()
    kept = out.collect()
    # rows without an id stay where their text is no one else's; texts without words are one group
    assert sum(r.doc_id is None for r in kept) == 1 and sum(not (r.text or "").split() for r in kept) == 1
    assert sum(r.doc_id == 10 for r in kept) == 1  # twice the same row
    assert simhash.keep_first(empty, shingle=5, similarity=0.8).count() == 0


def test_sketch():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2**63, 4000, dtype=np.int64).astype("<u8")
    for share in (0.5, 0.8, 0.95):
        n = int(2000 * (1 - share) / (1 + share))
        a, b = (np.frombuffer(simhash.sketch(x), "<u2") for x in (pool[:2000], pool[n : 2000 + n]))
        assert abs(((a == b) & (a != 0)).sum() / ((a | b) != 0).sum() - share) < 0.15
    assert not any(simhash.sketch(np.zeros(0, "<u8")))


def brute_kept(rows, least):
    """The smallest id of each group that links of that similarity connect."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        same = len(sets[i] & sets[j])
        if same >= least * (len(sets[i]) + len(sets[j]) - same) - 1e-9:
            a, b = sorted((root(i), root(j)))
            label[b] = a
    return {rows[i][0] for i in range(len(rows)) if root(i) == i}


@pytest.mark.parametrize("group", [512, 40])
def test_base_with_variants(spark, group):
    """Variants are like their base, but not like each other: each has to meet the base."""
    rng = random.Random(15)
    base = [f"w{k}" for k in range(400)]
    rows = [(300, " ".join(base))]
    for i in range(300):
        own = list(base)
        for k in rng.sample(range(5, 395), 7):
            own[k] = f"v{i}x{k}"
        rows.append((i, " ".join(own)))
    rng.shuffle(rows)
    want = brute_kept(sorted(rows), 0.8)
    found = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string"), shingle=5, similarity=0.8, group=group)
    assert {r.doc_id for r in found.collect()} == want and len(want) < 5


def test_recall_near_the_limit(spark):
    """Pairs just over 0.8 go, pairs just under it stay: nothing is estimated."""
    rng = random.Random(16)
    rows = []
    for g in range(300):
        base = [f"g{g}w{k}" for k in range(404)]
        cut = rng.randint(30, 58)  # of 400 shingles the last are others: (400 - cut) / (400 + cut)
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(base[:-cut] + [f"h{g}w{k}" for k in range(cut)]))]
    want = brute_kept(rows, 0.8)
    found = {r.doc_id for r in simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string"), shingle=5, similarity=0.8).collect()}
    assert want <= found and len(found - want) <= 1
    assert 300 < len(want) < 600
