"""Consensus reads placed on a cassette anew, with their tags.

A read's words of ``k`` bases vote for the diagonal of the reference that most of them lie on; around it the read is aligned in
a band, from end to end, with affine gaps. Alignments of a batch run side by side: each step of the recurrence is one for all
its reads. Bases beyond an end of the reference are clipped. Equal reads of a batch are aligned once.

The reference is a cassette of some thousand bases and goes to the workers with the code; one of over ``MAX_REFERENCE`` bases is refused.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Points of a match, and what a mismatch, a gap and each base of it cost.
MATCH, MISMATCH, OPEN, EXTEND = 1, 4, 6, 1
K, BAND = 11, 8
MAX_REFERENCE = 1 << 20
NEVER = -(1 << 20)
#: A place of the reference that may hold any base, such as those of a barcode: it costs a point.
UNKNOWN = ord("N")
COMPLEMENT = bytes.maketrans(b"ACGT", b"TGCA")


def words(reference: list[tuple[str, str]], k: int) -> dict[bytes, list[tuple[int, int]]]:
    """Where each word is: contig and place."""
    found: dict[bytes, list[tuple[int, int]]] = {}
    for c, (_, seq) in enumerate(reference):
        raw = seq.encode()
        for at in range(len(raw) - k + 1):
            found.setdefault(raw[at : at + k], []).append((c, at))
    return found


def diagonal(read: bytes, index: dict[bytes, list[tuple[int, int]]], k: int) -> tuple[int, int, int, int] | None:
    """Votes, strand (0 or 1), contig and diagonal; of equals the forward strand, then the first."""
    best = None
    for strand, seq in enumerate((read, read.translate(COMPLEMENT)[::-1])):
        votes = Counter((c, at - i) for i in range(len(seq) - k + 1) for c, at in index.get(seq[i : i + k], ()))
        for (c, d), n in votes.items():
            if best is None or (-n, strand, c, d) < (-best[0], *best[1:]):
                best = (n, strand, c, d)
    return best


def banded(reads: list[bytes], windows: list[bytes], band: int) -> list[tuple[int, int, str]]:
    """Of reads of one length, each against a window of the reference that begins ``band`` before its diagonal and is 2 * band longer:
    points, first place in the window and operations, one letter for each."""
    n, length, wide = len(reads), len(reads[0]), 2 * band + 1
    q = np.frombuffer(b"".join(reads), np.uint8).reshape(n, length).T
    w = np.frombuffer(b"".join(windows), np.uint8).reshape(n, length + 2 * band).T
    h, gap_in = np.zeros((wide, n), np.int32), np.full((wide, n), NEVER, np.int32)
    come = np.zeros((length + 1, wide, n), np.uint8)  # 0-1: match, insertion, deletion; 4: insertion extended; 8: deletion extended
    for i in range(length):
        diag = h + np.where(w[i : i + wide] == q[i], MATCH, np.where(w[i : i + wide] == UNKNOWN, -1, -MISMATCH))
        opened = np.concatenate((h[1:], np.full((1, n), NEVER, np.int32))) - OPEN - EXTEND
        longer = np.concatenate((gap_in[1:], np.full((1, n), NEVER, np.int32))) - EXTEND
        gap_in = np.maximum(opened, longer)
        best, way = np.maximum(diag, gap_in), (gap_in > diag).astype(np.uint8) | ((longer > opened).astype(np.uint8) << 2)
        gap = np.full(n, NEVER, np.int32)
        for b in range(1, wide):
            opened_, longer_ = best[b - 1] - OPEN - EXTEND, gap - EXTEND
            gap = np.maximum(opened_, longer_)
            way[b] |= (longer_ > opened_).astype(np.uint8) << 3
            over = gap > best[b]
            best[b] = np.where(over, gap, best[b])
            way[b] = np.where(over, (way[b] & 12) | 2, way[b])
        h, come[i + 1] = best, way
    last = np.argmax(h, 0)
    out = []
    for r in range(n):
        i, b, ops, state = length, int(last[r]), [], 0
        while i > 0:
            code = int(come[i, b, r])
            kind = state or code & 3
            if kind == 0:
                ops.append("M")
                i -= 1
            elif kind == 1:
                ops.append("I")
                state = 1 if code & 4 else 0
                i, b = i - 1, b + 1
            else:
                ops.append("D")
                state = 2 if code & 8 else 0
                b -= 1
        out.append((int(h[last[r], r]), b, "".join(reversed(ops))))
    return out


def cigar(ops: str) -> str:
    out, at = [], 0
    while at < len(ops):
        end = at
        while end < len(ops) and ops[end] == ops[at]:
            end += 1
        out.append(f"{end - at}{ops[at]}")
        at = end
    return "".join(out)


def align(reads: list[bytes], reference: list[tuple[str, str]], index: dict, *, k: int, band: int, region: tuple[str, int, int] | None) -> list[tuple]:
    """(contig, pos, flag, cigar, score, bases) of each read; without a contig, and with flag 4, if no word of it is known."""
    told: list[tuple] = [(None, None, 4, None, None, None)] * len(reads)
    by_length: dict[int, list[tuple[int, tuple]]] = {}
    for r, read in enumerate(reads):
        found = diagonal(read, index, k)
        if found:
            by_length.setdefault(len(read), []).append((r, found))
    for length, group in by_length.items():
        for lo in range(0, len(group), 2000):
            part = group[lo : lo + 2000]
            seqs = [reads[r].translate(COMPLEMENT)[::-1] if strand else reads[r] for r, (_, strand, _, _) in part]
            padded = {c: b"#" * (length + 2 * band) + reference[c][1].encode() + b"#" * (length + 2 * band) for c in {f[2] for _, f in part}}
            starts = [d - band for _, (_, _, _, d) in part]
            windows = [padded[c][s + length + 2 * band : s + 2 * length + 4 * band] for s, (_, (_, _, c, _)) in zip(starts, part)]
            for (r, (_, strand, c, _)), seq, s, (points, b, ops) in zip(part, seqs, starts, banded(seqs, windows, band)):
                at, size = s + b, len(reference[c][1])
                place, marked, bases = at, [], []
                for op in ops:
                    outside = op != "I" and not 0 <= place < size
                    marked.append("S" if outside and op == "M" else "" if outside else op)
                    place += op != "I"
                head = "".join(marked)
                # gaps at an end, or next to a clipped one, are clipped, too
                front = len(head) - len(head.lstrip("SID"))
                back = len(head) - len(head.rstrip("SID"))
                core = head[front : len(head) - back]
                clipped = "S" * sum(x != "D" for x in head[:front]) + core + "S" * sum(x != "D" for x in head[len(head) - back :])
                pos = max(at, 0) + sum(x == "D" for x in head[:front])
                if region and reference[c][0] == region[0]:
                    i, place = 0, pos
                    for op in clipped:
                        if op in "MI" and region[1] - 1 <= place < region[1] - 1 + region[2]:
                            bases.append(seq[i])
                        i += op != "D"
                        place += op in "MD"
                told[r] = (reference[c][0], pos + 1, 16 * strand, cigar(clipped), points, bytes(bases).decode() if region and reference[c][0] == region[0] else None)
    return told


def _remapped(batches: Iterator[pa.RecordBatch], *, reference: list[tuple[str, str]], seq: str, options: dict) -> Iterator[pa.RecordBatch]:
    index = words(reference, options["k"])
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.string()]
    for batch in batches:
        coded = batch.column(seq).dictionary_encode()
        found = align([x.encode() for x in coded.dictionary.to_pylist()], reference, index, **options)
        none = (None, None, 4, None, None, None)
        rows = [none if i is None else found[i] for i in coded.indices.to_pylist()]
        columns = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "contig", "pos", "flag", "cigar", "score", "bases"])


def remap(reads: DataFrame, reference: list[tuple[str, str]], *, seq: str = "seq", k: int = K, band: int = BAND, region: tuple[str, int, int] | None = None) -> DataFrame:
    """The reads with contig, pos (from 1), flag (16 on the other strand, 4 without a place), cigar, score and bases: those of the read on the ``region`` (contig, first
    place, length) of the reference, insertions with them. Columns of these names are replaced; a null sequence has no place."""
    if sum(len(s) for _, s in reference) > MAX_REFERENCE:
        raise ValueError(f"a reference of over {MAX_REFERENCE} bases")
    own = reads.drop("contig", "pos", "flag", "cigar", "score", "bases")
    schema = ", ".join([*(f"`{n}` {t}" for n, t in own.dtypes), "contig string, pos long, flag int, cigar string, score int, bases string"])
    options = {"k": k, "band": band, "region": region}
    return own.mapInArrow(partial(_remapped, reference=reference, seq=seq, options=options), schema)
