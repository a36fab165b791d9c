"""The corpus pipeline against a version that holds everything in memory."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from strandlake.storage import materialise
from tests.llm.test_decontaminate import expected as contamination
from tests.llm.test_lines import expected as deduped
from tests.llm.test_quality import judged
from tests.llm.test_simhash import shingles

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], DIR), f"test-{name}"))
    return out


def test_names():
    assert [n for n, _ in pipeline.STAGES] == ["quality", "lines", "near_duplicates", "decontaminate", "packing"]


def test_columns(stages):
    assert all(s.columns == stages[0].columns and dict(s.dtypes) == dict(stages[0].dtypes) for s in stages[:-1])


def test_quality(stages):
    before, after = ({r.doc_id: r for r in s.collect()} for s in stages[:2])
    want = judged([(r.doc_id, r.source, r.text) for r in before.values()], 5, 10, 80)
    assert {i: r.text for i, r in after.items()} == {i: t for (i, _), (t, ok) in want.items() if ok}
    assert all(r.n_chars == (before[i].n_chars if r.text == before[i].text else len(r.text)) for i, r in after.items())


def test_lines(stages):
    import hashlib

    before, after = stages[1].collect(), {r.doc_id: r for r in stages[2].collect()}
    want = {i: (n, d, s) for i, n, d, s in deduped([(r.doc_id, r.text) for r in before])}
    assert set(after) == set(want)
    for i, r in after.items():
        assert hashlib.sha256(r.text.encode()).hexdigest() == want[i][2]
        assert want[i][1] == 0 or r.n_chars == len(r.text)


def test_near_duplicates(stages):
    before, after = ({r.doc_id: r for r in s.collect()} for s in stages[2:4])
    assert set(after) <= set(before) and all(before[i] == r for i, r in after.items())
    sets = {i: shingles(r.text) for i, r in before.items()}
    alike = lambda a, b: len(sets[a] & sets[b]) >= 0.7 * max(1, len(sets[a] | sets[b])) or sets[a] == sets[b]
    assert all(any(alike(i, j) for j in before if j != i) for i in set(before) - set(after))
    assert not any(sets[i] == sets[j] for i in after for j in after if i < j)


def test_decontaminate(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    before, after = stages[3].collect(), stages[4].collect()
    dirty = {r[0] for r in contamination([(r.doc_id, r.text) for r in before], items) if r[-1]}
    assert sorted(after) == sorted(r for r in before if r.doc_id not in dirty)


def test_packing(stages):
    from strandlake.llm.queries import vocabulary

    plain = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    pieces = {}
    for r in stages[5].collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    for r in stages[4].collect():
        ids = plain.encode(r.text or "", add_special_tokens=False).ids + [1]
        want = [(a, len(ids[a : a + 2048]), zlib.crc32(np.array(ids[a : a + 2048], "<u4").tobytes()), len(ids)) for a in range(0, len(ids), 2048)]
        assert sorted(pieces.pop(r.doc_id)) == want
    assert not pieces


def test_run(spark, stages):
    drop = lambda df: sorted(tuple(r) for r in df.select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect())
    assert drop(pipeline.run(spark, DIR)) == drop(stages[5])


def test_tricky(spark, docs):
    table = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in pipeline.STAGES[:-1]:
        out = materialise(stage(spark, table, DIR), "tricky")
        assert out.columns == table.columns
        stage(spark, table.limit(0), DIR).count()
    assert pipeline.packing(spark, table, DIR).count() >= docs.count()


def test_near_duplicates_by_fingerprint(spark):
    """What op5 links goes, too, where sets of shingles, which know no repeats, are far apart."""
    from strandlake.llm.simhash import op5_simhash

    much = " ".join(["again and on"] * 100)
    tail = lambda k: " ".join(f"w{k}x{i}" for i in range(25))
    changed = [f"c{i}" for i in range(300)]
    rows = [(5, f"{much} {tail(5)}"), (3, f"{much} {tail(3)}"), (9, f"{tail(9)} {much}"), (4, tail(4)), (6, " ".join(changed)), (7, " ".join([*changed[:-30], "other"]))]
    assert len(shingles(rows[0][1]) & shingles(rows[1][1])) < 0.3 * len(shingles(rows[0][1]) | shingles(rows[1][1]))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    first = {r.doc_id: r.component_id for r in op5_simhash(table).collect()}
    assert first[5] == first[9] == 3 and len({first[i] for i in (3, 4, 6, 7)}) == 4
    assert sorted(r.doc_id for r in pipeline.near_duplicates(spark, table, DIR).collect()) == [3, 4, 6]


def test_near_duplicates_hold_op5(stages):
    from strandlake.llm.simhash import op5_simhash

    first = {r.doc_id: r.component_id for r in op5_simhash(stages[2]).collect()}
    kept = [first[r.doc_id] for r in stages[3].collect()]
    assert len(kept) == len(set(kept))
