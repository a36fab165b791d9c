"""Line dedup, its filters and its index against brute force."""

import hashlib
import random

import numpy as np
import pytest

from strandlake.llm import cuckoo, line_dedup
from strandlake.llm.line_dedup import LineIndex, dedup_lines, op3_line_dedup
from tests.llm.conftest import low

WS = " \t\n\x0b\x0c\r"
LAST = 1 << 70


def expected(rows):
    """For each row (lines, dropped, kept) by (id, text)."""
    key = lambda line: low(line.strip(WS))
    held = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                held.setdefault(key(line), set()).add(LAST if i is None else i)
    out = []
    for i, t in rows:
        own, lines = LAST if i is None else i, (t or "").split("\n")
        stay = [x for x in lines if not (len(key(x)) >= 10 and len(held[key(x)]) > 1 and min(held[key(x)]) != own)]
        out.append((-1 if i is None else i, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out)


def told(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in df.collect())


def test_query(docs, tricky, sample, empty):
    assert told(op3_line_dedup(docs)) == expected(tricky)
    assert told(op3_line_dedup(sample)) == expected([(r.doc_id, r.text) for r in sample.collect()])
    assert op3_line_dedup(empty).count() == 0


def test_columns_pass(docs):
    out = dedup_lines(docs)
    assert [c for c in out.columns if c not in ("n_lines", "n_dropped", "kept_text", "kept_sha256")] == [c for c in docs.columns if c != "n_lines"]


def test_without_filters(docs, tricky):
    index = LineIndex(docs.sparkSession)
    index.insert(docs)
    a = {(r.doc, frozenset((k.h1, k.h2) for k in r["keys"])) for r in index.drops().collect()}
    b = {(r.doc, frozenset((k.h1, k.h2) for k in r["keys"])) for r in index.drops(filter_bytes=-1).collect()}
    assert a == b and a


def test_insert_and_delete(spark):
    rng = random.Random(4)
    pool = [f"a line with number {i} in it" for i in range(30)]
    rows = [(i, "\n".join(rng.choices(pool, k=5) + [f"own line of document {i}"])) for i in range(24)]
    table = lambda r: spark.createDataFrame(r, "doc_id long, text string")
    index = LineIndex(spark)
    index.insert(table(rows[:10]))
    assert told(index.apply(table(rows[:10]))) == expected(rows[:10])
    index.insert(table(rows[10:]))
    assert told(index.apply(table(rows))) == expected(rows)
    gone = {0, 3, 5, 11, 17}
    left = [r for r in rows if r[0] not in gone]
    index.delete(table([r for r in rows if r[0] in gone]).select("doc_id"))
    assert told(index.apply(table(left))) == expected(left)
    counts = {(r.h1, r.h2): r.refs for r in index.refs.collect()}
    assert sum(counts.values()) == sum(len({x for x in t.split("\n")}) for _, t in left)
    # reversed: what comes in again is as if it had never been out
    index.insert(table([r for r in rows if r[0] in gone]))
    assert told(index.apply(table(rows))) == expected(rows)
    index.delete(table(rows).select("doc_id"))
    assert index.refs.count() == 0


def test_opened_again(spark, monkeypatch):
    """An index goes on where its folder ends; its shards grow with the shared keys."""
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 2)
    pool = [f"a line with number {i} in it" for i in range(120)]
    rng = random.Random(6)
    rows = [(i, "\n".join(rng.choices(pool, k=12))) for i in range(40)]
    table = lambda r: spark.createDataFrame(r, "doc_id long, text string")
    first = LineIndex(spark)
    first.insert(table(rows[:5]))
    again = LineIndex(spark, first.folder)
    assert (again.version, again.shards) == (1, first.shards) and again.refs.count() > 0
    again.insert(table(rows[5:]))
    assert again.shards > first.shards
    third = LineIndex(spark, first.folder)
    assert (third.version, third.shards) == (2, again.shards)
    assert told(third.apply(table(rows))) == expected(rows)
    third.delete(table(rows[:7]).select("doc_id"))
    assert told(LineIndex(spark, first.folder).apply(table(rows[7:]))) == expected(rows[7:])
    (spark.range(1).write.parquet(f"{first.folder}/v4/postings"))  # a change that didn't end
    last = LineIndex(spark, first.folder)
    assert last.version == 3
    last.insert(table(rows[:7]))
    assert told(last.apply(table(rows))) == expected(rows)
    a, b = ({(r.doc, frozenset((k.h1, k.h2) for k in r["keys"])) for r in last.drops(n).collect()} for n in (1 << 30, -1))
    assert a == b and a


def test_references(spark):
    """Rows with one id are one document, and one reference."""
    rows = [(1, "the same line here"), (1, "the same line here\nanother line of it"), (2, "the same line here")]
    index = LineIndex(spark)
    index.insert(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.refs for r in index.refs.collect()) == [1, 2]


@pytest.mark.parametrize("n", [0, 1, 5, 1000, 40_000])
def test_cuckoo(n):
    rng = np.random.default_rng(n)
    own = np.unique(rng.integers(0, 2**63, n, dtype=np.int64)).view(np.uint64)
    found = cuckoo.build(own)
    assert found.probe(own).all()
    assert found.probe(rng.integers(0, 2**63, 20_000, dtype=np.int64).view(np.uint64)).mean() < 0.002
    again = cuckoo.CuckooFilter.loads(found.dumps())
    half = own[::2][:500]
    again.remove(half)
    assert again.probe(np.setdiff1d(own, half)).all()
    if len(half) > 10:
        assert again.probe(half).mean() < 0.05


def test_full_filter():
    small = cuckoo.CuckooFilter(4)
    assert not small.add(np.arange(200, dtype=np.uint64))
