"""Repeated byte strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from strandlake.llm import suffixes


def brute(rows, size=200):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + size] for _, b in raw for k in range(len(b) - size + 1))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if seen[b[k : k + size]] > 1:
                gone[k : k + size] = b"\1" * size
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(b)))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def told(df):
    return sorted(map(tuple, df.collect()), key=str)


def shared(n, seed, length=600):
    """Documents around a passage that all share from different places on, and some copies of them."""
    rng = random.Random(seed)
    text = lambda k: "".join(rng.choices("abcdefgh ijklä", k=k))
    passage = text(length)
    rows = [(i, text(rng.randint(0, 300)) + passage[rng.randint(0, 250) : length - rng.randint(0, 250)] + text(rng.randint(0, 300))) for i in range(n)]
    return rows + [(n + i, rows[i][1][: rng.randint(150, 700)] + text(10)) for i in range(n // 2)]


def test_least():
    values = np.random.default_rng(1).integers(0, 1000, 500).astype(np.uint64)
    for width in (1, 2, 7, 64, 169):
        assert suffixes.least(values, width).tolist() == [values[k : k + width].min() for k in range(len(values) - width + 1)]


def test_anchors_of_equal_windows():
    rng = random.Random(2)
    text = "".join(rng.choices("abc", k=900))
    a, _ = suffixes.anchors(np.frombuffer(("xyz" + text).encode(), np.uint8), 200, 32)
    b, _ = suffixes.anchors(np.frombuffer(text.encode(), np.uint8), 200, 32)
    assert (a[3:] - 3).tolist() == b.tolist() and len(b) == 701


def test_sample(spark, sample):
    want = brute([(r.doc_id, r.text) for r in sample.collect()])
    assert told(suffixes.op13_suffixes(sample)) == want and sum(x[2] for x in want) > 1000


def test_tricky(spark, docs, tricky):
    assert told(suffixes.op13_suffixes(docs)) == brute(tricky)


def test_empty(spark, empty):
    df = suffixes.op13_suffixes(empty)
    assert df.count() == 0 and df.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


@pytest.mark.parametrize("bucket", [2, 16, 256])
def test_large_buckets_are_divided(spark, bucket):
    rows = shared(60, bucket)
    df = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), bucket=bucket)
    got = sorted(((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in df.collect()), key=str)
    assert got == brute(rows)


def test_edges_and_overlaps(spark):
    run, exact = "a" * 500, "".join(random.Random(5).choices("abcdef", k=200))
    rows = [(0, run), (1, exact), (2, "q" + exact), (3, exact[:199]), (4, exact[:100] + "z" + exact[101:]), (None, "w" * 199), (None, "w" * 199)]
    assert told(suffixes.op13_suffixes(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_parts_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 1000)
    rows = shared(20, 9, 3000)
    texts = [t.encode() for _, t in rows]
    seen = []
    for data, parts in suffixes._pieces(list(range(len(texts))), texts, 200):
        for key, at, lo, n in parts:
            assert data[at : at + n + 199] == texts[key][lo : lo + n + 199]
            seen += [(key, lo + k) for k in range(n)]
    assert sorted(seen) == [(k, i) for k, t in enumerate(texts) for i in range(len(t) - 199)]


def test_string_ids(spark):
    df = suffixes.op13_suffixes(spark.createDataFrame([("x", "m" * 300), ("y", "short")], "doc_id string, text string"))
    assert dict(df.dtypes)["doc_id"] == "string" and {r.doc_id: r.n_removed for r in df.collect()} == {"x": 300, "y": 0}
