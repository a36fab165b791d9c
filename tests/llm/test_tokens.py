"""Token pieces, packing and token files against the library itself."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from strandlake.llm import token_files
from strandlake.llm.packing import TournamentTree, _packed, first_fit_decreasing, op1_packing, pack
from strandlake.llm.token_files import from_planes, op2_token_ids, read_ids, to_planes, write_ids
from strandlake.llm.tokens import Encoder
from strandlake.storage import scratch_path

WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"
ODD = ["", " ", "\n", " a b", "a  b", "a\n\nb", "\na", "x\n", "a \nb", "a\n b", "a\tb c", "é ë ΑΣ Σ", "it's\n's we'll", "12 345\x0bz\x1cq", "日本 語\n テ", "a b   c", "A.B, c!", "é x", "İ I", "<|endoftext|> x", "a\x85b", "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y", "b <|startoftext|>", "<|startoftext|> A<|ENDOFTEXT|>", "a <| b |> <|endof text|>"]


@pytest.mark.parametrize("as_text", [False, True])
@pytest.mark.parametrize("name, space", [(WORD, False), (BYTE, True)])
def test_pieces(vocab, tricky, name, space, as_text):
    encoder, plain = Encoder(vocab(name), space, as_text), Tokenizer.from_file(vocab(name))
    if as_text:  # else as it is read from the file
        plain.encode_special_tokens = True
    texts = ODD + [t for _, t in tricky if t]
    for _ in range(2):  # from new, then from the memo
        for text, ids in zip(texts, encoder(texts)):
            assert np.frombuffer(ids, "<u2").tolist() == plain.encode(text, add_special_tokens=False).ids, text[:50]


def test_special_ids(vocab):
    ids = lambda name, space: np.frombuffer(Encoder(vocab(name), space)(["a <|endoftext|> b"])[0], "<u2").tolist()
    assert ids(WORD, False) == [320, 49407, 321] and ids(BYTE, True) == [64, 220, 50256, 275]


def test_tournament_tree():
    rng = random.Random(1)
    for n in (1, 2, 7, 64):
        tree, free = TournamentTree(n, 100), [100] * n
        for _ in range(3 * n):
            need = rng.randint(1, 60)
            want = next((i for i, f in enumerate(free) if f >= need), None)
            if want is None:
                if tree.size == n:
                    with pytest.raises(ValueError):
                        tree.first(need)
                continue
            assert tree.first(need) == want
            free[want] -= need


def test_first_fit_decreasing():
    rng = random.Random(2)
    for _ in range(30):
        lengths = [rng.choice([rng.randint(1, 100), 100]) for _ in range(rng.randint(0, 60))]
        bins, want = [], [0] * len(lengths)
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            b = next((k for k, used in enumerate(bins) if used + lengths[i] <= 100), len(bins))
            bins += [0] * (b == len(bins))
            want[i] = (b, bins[b])
            bins[b] += lengths[i]
        assert first_fit_decreasing(lengths, 100) == want


def check_packing(rows, docs, plain, capacity):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    for i, texts in docs.items():
        want = []
        for t in texts:
            ids = plain.encode(t or "", add_special_tokens=False).ids + [1]
            want += [(a, len(ids[a : a + capacity]), zlib.crc32(np.array(ids[a : a + capacity], "<u4").tobytes()), len(ids)) for a in range(0, len(ids), capacity)]
        assert sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in by_doc.pop(i)) == sorted(want)
    assert not by_doc


def test_packing(docs, tricky, vocab, sample, empty):
    plain = Tokenizer.from_file(vocab(WORD))
    by_id = {}
    for i, t in tricky:
        by_id.setdefault(i, []).append(t)
    check_packing(op1_packing(docs, vocab(WORD)).collect(), by_id, plain, 2048)
    rows = op1_packing(sample, vocab(WORD)).collect()
    check_packing(rows, {r.doc_id: [r.text] for r in sample.collect()}, plain, 2048)
    used = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) * 2048 < 1.05 * used
    assert op1_packing(empty, vocab(WORD)).count() == 0


def test_groups_and_blocks(sample, vocab):
    rows = pack(sample, vocab(WORD), capacity=256, group_docs=20).collect()
    seen = {}
    for r in rows:
        seen.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
    assert all(sum(n for _, n in p) <= 256 for p in seen.values())
    # blocks of a group keep sequences apart
    import pyarrow as pa

    n = 25
    batch = pa.RecordBatch.from_arrays([pa.array([3] * n), pa.array(range(n)), pa.array([0] * n), pa.array([5] * n), pa.array([b"\1\0" * 5] * n)], ["__group", "doc_id", "start", "doc_tokens", "ids16"])
    out = pa.Table.from_batches(list(_packed(iter([batch]), 16, 10))).to_pylist()
    places = {}
    for r in out:
        places.setdefault(r["sequence_id"], []).append(r["offset"])
    assert sum(map(len, places.values())) == n
    assert all(sorted(p) == [5 * i for i in range(len(p))] for p in places.values())


@pytest.mark.parametrize("bits", [False, True])
def test_planes(bits):
    rng = np.random.default_rng(0)
    for n in (0, 1, 7, 1000):
        ids = rng.integers(0, 1 << 17, n).astype("<u4")
        assert (from_planes(to_planes(ids, bits), n, bits) == ids).all()


@pytest.mark.parametrize("bits", [False, True])
def test_files(spark, sample, vocab, bits, monkeypatch):
    monkeypatch.setattr(token_files, "READ_DOCS", 16)
    folder = scratch_path(spark, "test-ids")
    shards = write_ids(sample, folder, vocab(BYTE), bits=bits)
    plain, start = Tokenizer.from_file(vocab(BYTE)), 0
    got = sorted(read_ids(spark, folder, shards, read_docs=16).collect())
    for r, d in zip(got, sample.orderBy("doc_id").collect(), strict=True):
        ids = plain.encode(d.text or "", add_special_tokens=False).ids + [0]
        assert (r.doc_id, r.start, r.n_tokens) == (d.doc_id, start, len(ids))
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        start += len(ids)
    with pytest.raises(Exception):
        token_files.ShardReader(folder, "missing.slbp")


def test_token_ids_query(docs, tricky, vocab, empty):
    plain = Tokenizer.from_file(vocab(BYTE))
    rows = op2_token_ids(docs, vocab(BYTE)).collect()
    lengths = sorted(len(plain.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in tricky)
    assert sorted(r.n_tokens for r in rows) == lengths
    rows.sort(key=lambda r: r.start)
    keys = [(-1 if r.doc_id is None else r.doc_id) for r in rows]
    assert keys == sorted(keys)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:])) and rows[0].start == 0
    assert op2_token_ids(empty, vocab(BYTE)).count() == 0
