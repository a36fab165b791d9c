"""Shares, bounds and pairs of the source audit against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandlake.llm import divergence
from tests.llm.conftest import low

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, lang string, source string, c long, item string, n long"


def brute(rows, least=10, top=10):
    """From (text, lang, source)."""
    rows = [(t or "", a or "", s or "") for t, a, s in rows]
    out = []
    for lang in {a for _, a, _ in rows}:
        docs = [(s, Counter(TERM.findall(low(t)))) for t, a, s in rows if a == lang]
        df = Counter(t for _, c in docs for t in c)
        kept = sorted(t for t in df if df[t] >= least)
        count = {None: Counter()}
        for s, c in docs:
            for key in (s, None):
                count.setdefault(key, Counter()).update({t: n for t, n in c.items() if df[t] >= least})
        share = {s: {t: 1 + 10**9 * (c[t] + 2) // (c.total() + 2 * len(kept)) for t in kept} for s, c in count.items()}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        sources = [s for s in count if s is not None]
        for s in sources:
            pairs = sorted((-sum(f(share[s][t], share[o][t]) for t in kept), o.encode(), o) for o in sources if o != s)
            terms = sorted((-f(share[s][t], share[None][t]), t.encode(), t) for t in kept if count[s][t] and share[s][t] > share[None][t])
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(pairs)]
            out += [(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(terms[:top])]
    return sorted(out)


def told(df):
    return sorted(map(tuple, df.collect()))


def rows_of(n, sources, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 4))) for _ in range(120)]
    out = []
    for _ in range(n):
        s = rng.choice(sources)
        r = random.Random(s)
        out.append((" ".join(rng.choices(words, [r.random() ** 4 for _ in words], k=rng.randint(0, 40))), rng.choice(["en", "de", None]), s))
    return out


@pytest.mark.parametrize("side", [2, 256])
def test_brute_force(spark, monkeypatch, side):
    monkeypatch.setattr(divergence, "SIDE", side)
    rows = rows_of(400, [f"s{k}" for k in range(7)] + [None, "é", "Z"], 1)
    assert told(divergence.divergence(spark.createDataFrame(rows, "text string, lang string, source string"))) == brute(rows)


def test_matrices_of_blocks(monkeypatch):
    """Lists over several blocks, with few matrices held at a time."""
    monkeypatch.setattr(divergence, "SIDE", 3)
    monkeypatch.setattr(divergence, "MATRICES", 2)
    rng = np.random.default_rng(3)
    lists = [[{"k": int(k), "p": int(p), "z": int(z)} for k, p, z in zip(np.sort(rng.choice(10, n, replace=False)), rng.integers(1, 10**9, n), rng.integers(1, 1000, n))] for n in (2, 5, 10, 10, 3)]
    kind = pa.list_(pa.struct([("k", pa.int32()), ("p", pa.int64()), ("z", pa.int64())]))
    batch = pa.record_batch({"lang": ["en"] * 5, "list": pa.array(lists, kind)})
    got = Counter()
    for b in divergence._paired(iter([batch.slice(0, 2), batch.slice(2)])):
        for r in b.to_pylist():
            if r["i"] < r["j"]:
                got[r["i"], r["j"]] += r["both"]
    f = lambda p, q: (p - q) ** 2 // (p + q)
    want = Counter()
    for x in lists:
        for a in x:
            for b in x:
                if a["k"] < b["k"]:
                    want[a["k"], b["k"]] += f(a["p"], b["p"]) - f(a["p"], b["z"]) - f(a["z"], b["p"]) + f(a["z"], b["z"])
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_shares_of_large_counts(spark):
    values = [(0, 1), (5, 7), (10**15, 9 * 10**15), (8 * 10**15, 9 * 10**15), (123456789012345, 8999999999999999), (0, 0)]
    df = spark.createDataFrame(values, "c long, whole long").select("c", "whole", F.expr(divergence.share("c", "whole")).alias("p"))
    assert [r.p for r in df.collect()] == [1 + 10**9 * (c + 2) // max(w, 1) for c, w in values]


def test_bounds_hold(spark):
    """A bucket's bound is no less than any value in it: equal results with one bucket and with many, whatever the tops."""
    rows = rows_of(300, ["a", "b", "c"], 5)
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    for top in (1, 3, 200):
        assert told(divergence.divergence(df, top=top, min_docs=3)) == brute(rows, 3, top)


def test_tricky(spark, tricky):
    rows = [(t, "en" if (i or 0) % 3 else None, f"s{(i or 0) % 4}" if i else None) for i, t in tricky] * 4
    df = spark.createDataFrame([(1, *r, 5, "x", 6) for r in rows], SCHEMA)
    assert told(divergence.op12_divergence(df)) == brute(rows)


def test_empty_and_nothing_kept(spark):
    assert divergence.op12_divergence(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, "en", "a"), ("word", "en", "b"), (None, None, None)]
    assert told(divergence.op12_divergence(spark.createDataFrame([(1, *r, 5, "x", 6) for r in rows], SCHEMA))) == brute(rows) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
