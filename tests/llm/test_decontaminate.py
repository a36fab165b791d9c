"""Contamination against brute force, in one automaton and in several."""

import hashlib
import re

import pytest

from strandlake.llm.decontaminate import find_contamination, op6_decontaminate, remove_contaminated
from tests.llm.conftest import low

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def expected(rows, items, window=10):
    windows = {}
    for i, t in items:
        w = WORDS.findall(low(t or ""))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + window]), set()).add(str(i))
    sizes, out = {len(k) for k in windows}, []
    for i, t in rows:
        w = WORDS.findall(low(t or ""))
        hit, seen = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                own = windows.get(tuple(w[k : k + n]))
                if own:
                    hit |= set(range(k, k + n))
                    seen |= own
        out.append((-1 if i is None else i, len(w), len(hit), len(seen), hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def told(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


ITEMS = [
    (1, "one two"), (2, "Word, word; WORD"), (3, None), (4, ""), (5, "..."), (6, "ÄÖÜ ß straße doppelt tab istanbul"), (7, "a b c d e f g h i j k l"), (8, "c d e f g h i j k l m"), (9, "a b c d e f g h i j k l"), (10, "日本語のテキスト"), (11, "aa aa aa aa aa aa aa aa aa aa"),
]
TEXTS = [(50, "x a b c, d e F g h I j k. l m n"), (51, "c d e f g h i j k l m"), (52, "b c d e f g h i j"), (53, "a-b-c d e f g h i j k l a b c d e f g h i j"), (54, "İß one\ntwo word word word"), (55, " ".join(["aa"] * 40)), (56, "Ä ONE! TWO?")]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_query(spark, docs, tricky, items, empty, sample):
    rows = tricky + TEXTS
    table = docs.select("doc_id", "text", "words").unionByName(spark.createDataFrame([(i, t, "") for i, t in TEXTS], "doc_id long, text string, words string"))
    assert told(op6_decontaminate(table, items)) == expected(rows, ITEMS)
    assert told(op6_decontaminate(table, items.limit(0))) == expected(rows, [])
    assert op6_decontaminate(empty, items).count() == 0
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    assert told(op6_decontaminate(sample, bench)) == expected([(r.doc_id, r.text) for r in sample.collect()], [(r.item_id, r.text) for r in bench.collect()])


def test_blocks(spark, items):
    table = spark.createDataFrame(TEXTS + [(50, "one two")], "doc_id long, text string")
    one = find_contamination(table, items).collect()
    many = find_contamination(table, items, block_words=4).collect()
    words = lambda rows: sorted((r.doc_id, r.n_words, sorted({w for a, b in zip(r["first"], r["last"]) for w in range(a, b)}), r["items"]) for r in rows)
    assert words(one) == words(many)
    a = {tuple(r) for r in remove_contaminated(table, items).collect()}
    assert a == {tuple(r) for r in remove_contaminated(table, items, block_words=4).collect()} == {(52, "b c d e f g h i j")}


def test_offsets(spark, items):
    rows = [(1, "Ä ONE! TWO?"), (2, "日本語のテキスト und mehr"), (3, "x… one, two")]
    found = find_contamination(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    cut = {r.doc_id: [dict(rows)[r.doc_id][a:b] for a, b in zip(r["start"], r["end"])] for r in found}
    assert cut == {1: ["ONE! TWO"], 2: ["日本語のテキスト"], 3: []} or cut == {1: ["ONE! TWO"], 2: ["日本語のテキスト"], 3: ["one, two"]}


def test_items_without_id(spark):
    items = spark.createDataFrame([(None, "one two"), (None, "three four"), (5, "four five")], "item_id long, text string")
    table = spark.createDataFrame([(1, "zero one two"), (2, "three four five"), (3, "five four")], "doc_id long, text string")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert told(op6_decontaminate(table, items)) == [(1, 3, 2, 1, sha(""), True), (2, 3, 3, 2, sha("5"), True), (3, 2, 0, 0, sha(""), False)]
    for words in (400_000, 1):
        assert [r.doc_id for r in remove_contaminated(table, items, block_words=words).collect()] == [3]
    many = find_contamination(table, items, block_words=1).collect()
    assert {r.doc_id: r["items"] for r in many} == {1: [None], 2: ["5", None], 3: []}
