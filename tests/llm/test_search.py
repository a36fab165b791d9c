"""The tiered index and its ranking against brute force."""

import math
import random
import re
from collections import Counter

import pytest

from strandlake.llm import search
from tests.llm.conftest import low

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEMS = "item_id string, text string, doc long, block long, term string"


def brute(docs, items, top=20):
    counted = [(i, Counter(TERM.findall(low(t or "")))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counted:
            m = 75 + 25 * c.total() * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in TERM.findall(low(text or "")) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def told(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    weights = [1 / (k + 1) for k in range(300)]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 120)))) for i in range(n)], rng, words


@pytest.mark.parametrize("block", [5, 64, 1 << 16])
def test_brute_force(spark, block):
    rows, rng, words = corpus(400, block)
    items = [(f"q{k}", " ".join(rng.choices(words, k=rng.randint(1, 12)))) for k in range(30)] + [("rare", "w299 w298"), ("common", "w0"), ("none", "zzz"), (None, None)]
    index = search.build_index(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), block_docs=block)
    found = search.search(index, spark.createDataFrame(items, "item_id string, text string"))
    assert told(found) == brute(rows, items)


def test_lower_tiers_are_left_where_nothing_there_can_count(spark):
    """A rare term decides within its first tier; equal impacts of a common one go on in the next."""
    rows = [(i, ("often " if i % 2 else "") + f"filler{i} " * (i % 7 + 1) + ("rare " * 3 if i % 100 == 0 else "")) for i in range(4000)]
    items = [("r", "rare"), ("b", "rare often"), ("c", "often")]
    index = search.build_index(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), block_docs=500)
    found = search.search(index, spark.createDataFrame(items, "item_id string, text string"))
    assert told(found) == brute(rows, items)
    tiers = {r.item_id: r.tiers for r in found.select("item_id", "tiers").distinct().collect()}
    assert tiers["r"] == 1 and tiers["c"] > 1
    held = search.postings(spark, index).where("term = 'often'").groupBy("tier").sum("df").count()
    assert held == 3


def test_residual_bounds(spark):
    rows, _, _ = corpus(300, 8)
    index = search.build_index(spark.createDataFrame(rows, "doc_id long, text string").repartition(1))
    import numpy as np

    lists = search.postings(spark, index).where("term <> ''").collect()
    by = {(r.term, r.tier): r for r in lists}
    assert len(by) == len(lists) and any(t == 2 for _, t in by)
    for (term, tier), r in by.items():
        lower = [np.frombuffer(by[term, k].impacts, np.int32).max() for k in range(tier + 1, 3) if (term, k) in by]
        assert r.rest == max(lower, default=0) and np.frombuffer(r.impacts, np.int32).min() >= r.rest


@pytest.mark.parametrize("group", [1, 3, 1024])
def test_groups_of_items(spark, group):
    rows, rng, words = corpus(60, 4)
    items = [("same", "w1 w2 w2"), ("same", "w1 w2 w2"), ("same", "w3"), (None, "w4 W5")]
    index = search.build_index(spark.createDataFrame(rows, "doc_id long, text string"))
    assert told(search.search(index, spark.createDataFrame(items, "item_id string, text string"), group=group, top=7)) == brute(rows, items, 7)


def test_tricky(spark, docs, tricky):
    items = [("a", "one two word"), ("b", tricky[6][1]), ("c", "straße 123 日本語のテキスト"), ("d", ""), (None, tricky[15][1][:5000])]
    assert told(search.op11_search(docs, spark.createDataFrame([(*x, 1, 2, "t") for x in items], ITEMS))) == brute(tricky, items)


def test_empty(spark, docs, empty):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([("a", "one", 1, 2, "t")], ITEMS)
    for d, i in ((docs, none), (empty, some), (empty, none)):
        df = search.op11_search(d, i)
        assert df.columns == ["item_id", "rank", "doc_id", "score"] and df.count() == 0
