"""Compact windows and repeated passages against brute force."""

import random
import re

import numpy as np
import pytest

from strandlake.llm import passages
from tests.llm.conftest import low

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall(low(text or ""))


def brute_repeats(rows, size=50):
    """For each row the words inside runs of that size which another text has."""
    runs = {}
    for _, t in rows:
        w = words(t)
        for k in range(len(w) - size + 1):
            runs.setdefault(tuple(w[k : k + size]), set()).add(t)
    count = {}
    for i, t in rows:
        count.setdefault(t, set()).add(i)
    out = {}
    for i, t in rows:
        w = words(t)
        hit = set(range(len(w))) if len(count[t]) > 1 and len(w) >= size else set()
        for k in range(len(w) - size + 1):
            if len(runs[tuple(w[k : k + size])]) > 1:
                hit |= set(range(k, k + size))
        if hit:
            out.setdefault(i, set()).update(hit)
    return out


def told(df):
    return {r.doc_id: {w for p in r.passages.split(",") for w in range(int(p.split(":")[0]), int(p.split(":")[1]))} for r in df.collect()}


def test_word_hashes(tricky):
    raw = [(t or "").encode() for _, t in tricky]
    h, text = passages.word_hashes(raw)
    want = [(k, w) for k, (_, t) in enumerate(tricky) for w in words(t)]
    assert text.tolist() == [k for k, _ in want]
    by_word = {}
    for (_, w), x in zip(want, h.tolist()):
        assert by_word.setdefault(w, x) == x
    assert len(set(by_word.values())) == len(by_word)
    assert len(passages.word_hashes([b"", b" "])[0]) == 0


def test_windows():
    """Every passage lies in exactly one window a function, at the place of its least value."""
    rng = np.random.default_rng(1)
    words_, text = rng.integers(0, 2**63, 90, dtype=np.int64).astype(np.uint64), np.repeat([0, 1, 3], [40, 12, 38])
    found = list(passages.compact_windows(words_, text, shingle=3, passage=10, hashes=2))
    h = passages.shingle_hashes(words_, 3)
    for f, (sig, own, first, c, last) in enumerate(found):
        v = passages.mix64(h, 100 + f)
        assert (sig == v[c]).all() and (own == text[c]).all()
        seen = {}
        for a, m, b in zip(first.tolist(), c.tolist(), last.tolist()):
            for i in range(a, m + 1):
                for j in range(m, b + 1):
                    assert (i, j) not in seen
                    seen[i, j] = m
        for lo, hi in ((0, 40), (40, 52), (52, 90)):
            for i in range(lo, hi):
                for j in range(i + 7, hi - 2):
                    assert seen[i, j] == i + int((v[i : j + 1] >> np.uint64(24)).argmin())


def test_query(sample, docs, tricky, empty):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    want, got = brute_repeats(rows), told(passages.op9_passages(sample))
    assert set(want) <= set(got) and all(want[i] <= got[i] for i in want)
    edges = told(passages.op9_passages(docs))
    assert set(brute_repeats([r for r in tricky if r[1]])) - {None} <= set(edges)
    assert passages.op9_passages(empty).count() == 0


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(9)
    vocabulary = ["".join(rng.choices("abcdefghijkl", k=6)) for _ in range(5000)]
    prose = lambda n: rng.choices(vocabulary, k=n)
    rows, group = [], {}
    for g in range(12):
        passage = prose(rng.randint(55, 120))
        for k in range(rng.choice([2, 3, 9])):
            own = list(passage)
            if g % 3 == 2 and k:
                own[len(own) // 2] = "changed"
            i = len(rows)
            rows.append((i, " ".join(prose(rng.randint(0, 200)) + own + prose(rng.randint(0, 200)))))
            group[i] = g
    short = prose(30)
    clean = range(len(rows), len(rows) + 40)
    rows += [(i, " ".join(prose(80) + short + prose(80))) for i in clean]
    return rows, group, set(clean)


@pytest.mark.parametrize("bucket", [64, 2])
def test_planted(spark, planted, bucket):
    rows, group, clean = planted
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), bucket=bucket).collect()
    classes = {}
    for r in found:
        classes.setdefault(r.doc, set()).add(r.class_id)
    assert not clean & set(classes)
    exact = {i for i, g in group.items() if g % 3 != 2}
    assert exact <= set(classes)
    if bucket == 64:
        # a change in the middle leaves over 50 words alike where the passage is long enough
        assert all(len({min(classes[i]) for i in group if group[i] == g}) == 1 for g in set(group.values()) if g % 3 != 2)


def test_without_filter(spark, planted):
    rows = planted[0][:30]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    a = {tuple(r) for r in passages.repeated_passages(df).collect()}
    assert a and a == {tuple(r) for r in passages.repeated_passages(df, filter_bytes=-1).collect()}


def edited(own, kind, rng, new):
    """A passage with words changed, put in or taken out."""
    own = list(own)
    at = rng.randrange(1, len(own) - 1)
    if kind == "changed":
        own[at] = next(new)
    elif kind == "inserted":
        own[at:at] = [next(new)]
    elif kind == "deleted":
        del own[at]
    elif kind == "block":
        own[at:at] = [next(new) for _ in range(3)]
    return own


def jaccard(a, b):
    a, b = ({tuple(x[k : k + 5]) for k in range(len(x) - 4)} for x in (a, b))
    return len(a & b) / len(a | b)


def test_common():
    """The stretch that is told is as similar as it has to be, and none that whole pairs have is missed."""
    rng = random.Random(2)
    told_, n = 0, 0
    for _ in range(400):
        a, fresh = list(range(rng.randint(55, 110))), iter(range(200, 256))
        b = edited(a, rng.choice(["same", "changed", "inserted", "deleted", "block"]), rng, fresh)
        shared = [k for k in range(len(a) - 4) if a[k : k + 5] in [b[m : m + 5] for m in range(len(b) - 4)]]
        c = rng.choice(shared)
        d = b.index(a[c])
        one, two = (bytes(a[:c][::-1]), bytes(a[c:])), (bytes(b[:d][::-1]), bytes(b[d:]))
        got = passages.common(one, two, 5, 50, 0.8)
        if got:
            x, y = a[c - got[0] : c + got[1]], b[d - got[2] : d + got[3]]
            assert min(len(x), len(y)) >= 50 and jaccard(x, y) >= 0.8 - 1e-9
        n += jaccard(a, b) >= 0.8
        told_ += jaccard(a, b) >= 0.8 and got is not None and got[0] + got[1] >= len(a) - 5 and got[2] + got[3] >= len(b) - 7  # a run of under five words holds no shingle
    assert told_ == n > 250


@pytest.mark.parametrize("bucket, block", [(64, 128), (2, 128), (1, 1)])
def test_recall(spark, bucket, block):
    """Pairs of planted passages with a similarity of 0.8 or more are found, however words differ."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghijkl", k=6)) for _ in range(20_000)]
    prose = lambda k: rng.choices(vocabulary, k=k)
    rows, pairs = [], {}
    new = (f"new{i}" for i in range(10_000))
    for kind in ("same", "changed", "inserted", "deleted", "block", "twice"):
        for _ in range(60):
            own = prose(90 if kind != "twice" else 120)
            other = edited(edited(own, "changed", rng, new), "inserted", rng, new) if kind == "twice" else edited(own, kind, rng, new)
            if jaccard(own, other) >= 0.8:
                pairs.setdefault(kind, []).append((len(rows), len(rows) + 1))
                rows += [(len(rows) + k, " ".join(prose(rng.randint(20, 150)) + x + prose(rng.randint(20, 150)))) for k, x in enumerate((own, other))]
    found = {}
    for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), bucket=bucket, block=block).collect():
        found.setdefault(r.class_id, set()).add(r.doc)
    joined = {frozenset(x) for x in found.values()}
    for kind, own in pairs.items():
        assert len(own) >= 40 and sum(frozenset(p) in joined for p in own) >= (1 if kind in ("same", "changed", "inserted", "deleted") else 0.97) * len(own), kind
    assert set().union(*joined) <= {i for own in pairs.values() for p in own for i in p}


@pytest.mark.parametrize("n, bucket, block", [(40, 64, 128), (100, 64, 128), (200, 64, 128), (200, 4, 8)])
def test_own_word_each(spark, n, bucket, block):
    """Copies of a passage, each with a word of its own in the middle: more copies lose none."""
    rng = random.Random(n)
    vocabulary = ["".join(rng.choices("abcdefghijkl", k=6)) for _ in range(5000)]
    prose = lambda k: rng.choices(vocabulary, k=k)
    passage = prose(98)
    rows = [(i, " ".join(prose(40) + passage[:49] + [f"own{i}"] + passage[49:] + prose(40))) for i in range(n)]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), bucket=bucket, block=block).collect()
    assert {r.doc for r in found} == set(range(n)) and {r.class_id for r in found} == {0}


def test_further_occurrences(spark):
    """A text that has a passage several times, once with a word changed, tells every occurrence."""
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefghijkl", k=6)) for _ in range(5000)]
    prose = lambda k: rng.choices(vocabulary, k=k)
    passage, alone = prose(90), prose(90)
    changed = passage[:45] + ["changed"] + passage[46:]
    rows = [(0, prose(30) + passage + prose(70) + passage + prose(60) + changed), (1, prose(50) + passage + prose(20)), (2, alone + prose(60) + alone)]
    found = passages.repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")).collect()
    got = {i: sorted((r.first, r.last) for r in found if r.doc == i) for i in range(3)}
    close = lambda a, b: len(a) == len(b) and all(abs(x - y) <= 2 for p, q in zip(a, b) for x, y in zip(p, q))
    assert close(got[0], [(30, 120), (190, 280), (340, 430)]) and close(got[1], [(50, 140)]) and not got[2]
    assert {r.class_id for r in found} == {0}


def test_fingerprints():
    """Similar passages have one in common."""
    rng = random.Random(4)
    run = passages.shortest_run(5, 50, 0.8)
    assert 20 <= run <= 25
    for _ in range(300):
        a = rng.sample(range(200), rng.randint(50, 100))
        b = edited(a, rng.choice(["changed", "inserted", "deleted", "block"]), rng, iter([250, 251, 252]))
        if min(len(a), len(b)) >= 50 and jaccard(a, b) >= 0.8:
            x, y = (passages.fingerprints(bytes(rng.choices(range(200), k=20)) + bytes(w), run, 2 * run // 3) for w in (a, b))
            assert set(x.tolist()) & set(y.tolist())


def variants(n, rng):
    """A passage in a base and in n texts, each with another one of its words 10 to 49 changed, in different surroundings."""
    vocabulary = ["".join(rng.choices("abcdefghijkl", k=6)) for _ in range(5000)]
    prose = lambda k: rng.choices(vocabulary, k=k)
    passage, rows = prose(60), []
    for i in range(n + 1):
        own = list(passage)
        if i:
            own[rng.randrange(10, 50)] = f"changed{i}"
        rows.append((i, " ".join(prose(40) + own + prose(40))))
    return rows


@pytest.mark.parametrize("n", [4, 12, 200])
def test_changed_elsewhere(spark, n):
    """Variants are like the base only, whatever comes first; a function whose c is at the changed word tells nothing."""
    rows = variants(n, random.Random(n))
    found = {r.doc for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), hashes=8).collect()}
    assert len(found) >= 0.95 * len(rows)


def test_group_links():
    """In a large group every window with a partner is linked, and classes are those of all pairs."""
    rng = random.Random(21)
    for n in (3, 12, 90):
        bases = [bytes(rng.randrange(100) for _ in range(110)) for _ in range(3)]
        rows = []
        for i in range(n):
            base = rng.choice(bases)
            own, lo, hi = bytearray(bases[0][:50] + base[50:] if n < 90 else base[:45] + bases[0][45:65] + base[65:]), rng.randint(0, 45), rng.randint(75, 110)
            for _ in range(rng.choice([0, 1, 1, 2])):
                own[rng.randrange(110)] = 100 + i
            if rng.random() < 0.3:
                at = rng.choice([20, 80])
                own[at:at] = bytes([250])
                lo += at == 20
            rows.append((rng.randrange(max(2, 2 * n // 3)), 1000 * i, 50 + (own[20] == 250) - lo, bytes(own[lo:hi])))

        def outcome(links):
            """Linked windows and their classes."""
            label = {}

            def root(k):
                while label.setdefault(k, k) != k:
                    k = label[k]
                return k

            for ta, fa, _, tb, fb, _ in links:
                u, v = (root((t, round((f + 50) / 1000))) for t, f in ((ta, fa), (tb, fb)))
                label[u] = v
            return {k: min(m for m in label if root(m) == root(k)) for k in list(label)}

        exact, quick = (passages.group_links(rows, 5, 50, 0.8, bucket) for bucket in (1000, 2))
        assert outcome(exact) == outcome(quick) and (n < 12 or exact)
