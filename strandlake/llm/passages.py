"""Substring dedup with compact windows: near-duplicate passages of many words.

A text is a sequence of word shingles, the first, second, ... of a kind in the text told apart; each
of ``HASHES`` functions gives every one a value. A passage's signature under a function is its least value. The Cartesian tree over a
text's values groups all its passages by the place of their minimum: the compact
window (first, c, last) holds exactly the passages between first and last that contain
c, the place of the least value between them. Only minima whose window has room for a passage of
``PASSAGE`` words are kept, about 2 / PASSAGE of all places; they are the minima of
sliding windows, and the tree over them alone gives the same windows.

1. Windows of all texts are grouped by function and signature; signatures in one text
   only are of no use. Copies of a text count as that text: windows carry a hash of it.
2. Interval join: windows with a signature are laid on each other at c; where what they
   have in common has room for a passage, it is verified: the words around c are aligned to
   both sides, run by run, across changed, inserted and deleted words, and the longest stretch whose
   sets of shingles have a Jaccard similarity of ``SIMILARITY`` or more is told, if it is a passage
   in both texts. In groups of up to ``BUCKET`` different windows every two are compared. In
   larger ones windows that verified links connect already aren't compared again, and two others are only if
   they share as many shingles as similar passages do at least: every window that is like any other is
   linked, and what all links would connect is connected. Groups of over ``BLOCK`` times ``BUCKET`` windows are
   divided by fingerprints of runs so long as similar passages have one in common at least, by the
   pigeonhole principle; what is as large still is cut into blocks, of which each two meet. Equal windows are linked to the first.
3. Verified stretches are united within a text, and united ones that links connect are
   a class. Where a text repeats what it has in common with others, the first occurrence meets
   theirs, the second the second; the further ones of a text are aligned to its first one, and are
   of its class if that is told.

Word codes have eight bits, so a stretch can reach a word too far at either end once in 256 times;
it cannot come about by chance.

Defined results: a null text or one of fewer words than a passage has no row; rows without
an id come last; rows with the same id but different texts are apart, yet each counts for
that id; a passage that only one text repeats in itself isn't told; a very long text is a batch of
its own and taken whole; an empty table gives no rows; other columns are ignored. The id has to be a number or a
text that is one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandlake.llm import cuckoo
from strandlake.llm.components import components
from strandlake.llm.runtime import NULL_ID, doc_key, materialise, mix64, ship_code

SHINGLE = 5
PASSAGE = 50
SIMILARITY = 0.8
HASHES = 3
BUCKET = 64
#: Words on each side of c that are verified.
SIDE = 64
#: Groups of so many times BUCKET windows are compared in one task; larger ones are divided.
BLOCK = 128
#: Words that are skipped at once in any pair.
SKIP = 20
#: Rows of a table that is broadcast, at most.
SENT = 1_000_000
#: Words that are worked on at a time; a longer text is a batch of its own.
BATCH_WORDS = 1 << 19
#: Bytes of the filter of shared signatures that is broadcast, at most.
FILTER_BYTES = 64 << 20

_fold = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 32 or 9 <= c <= 13 else c for c in range(256))
_powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(1023, 0x9E3779B97F4A7C15, dtype=np.uint64)]), dtype=np.uint64)


def word_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of all texts' words, in order: a 64-bit hash each and the number of its text."""
    joined = b" ".join(raw).translate(_fold) + b" "
    b = np.frombuffer(joined, np.uint8)
    inside = b != 32
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sizes = np.array([len(r) + 1 for r in raw], dtype=np.int64)
    text = np.searchsorted(np.cumsum(sizes), starts, side="right")
    at = np.arange(len(b)) - np.repeat(starts, np.diff(np.append(starts, len(b)))) if starts[0] == 0 else np.arange(len(b)) - np.concatenate([np.zeros(starts[0], np.int64), np.repeat(starts, np.diff(np.append(starts, len(b))))])
    value = np.where(inside, (b.astype(np.uint64) + np.uint64(1)) * _powers[at & 1023], np.uint64(0))
    return mix64(np.add.reduceat(value, starts) + (ends - starts).astype(np.uint64), 9), text


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words, across text borders too."""
    n = len(words) - size + 1
    h = words[:n].copy()
    for j in range(1, size):
        h = h * np.uint64(0xD6E8FEB86659FD93) + words[j : n + j]
    return h


def sliding_min(v: np.ndarray, t: int) -> np.ndarray:
    """The least of each t neighbours, by doubling."""
    n = 1
    while 2 * n <= t:
        v = np.minimum(v[: len(v) - n], v[n:])
        n *= 2
    return np.minimum(v[: len(v) - (t - n)], v[t - n :]) if n < t else v


def tree_extents(keys: list[int], places: list[int], texts: list[int], first: list[int], last: list[int]) -> tuple[list[int], list[int]]:
    """How far each kept minimum is the least: the Cartesian tree's stack, text by text.

    ``first`` and ``last`` are the borders of the minimum's text.
    """
    n = len(keys)
    low, high, stack = first[:], last[:], []
    for i in range(n):
        if stack and texts[stack[-1]] != texts[i]:
            stack.clear()
        k = keys[i]
        while stack and keys[stack[-1]] > k:
            high[stack.pop()] = places[i] - 1
        if stack:
            low[i] = places[stack[-1]] + 1
        stack.append(i)
    return low, high


def ranks(h: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each shingle how many of its kind come before it in its text, and places ordered by kind, then place."""
    key = h + mix64(text.astype(np.uint64), 13)
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], np.diff(key[order]) != 0])
    at = np.arange(len(h))
    rank = np.empty(len(h), np.int64)
    rank[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return rank, order


def compact_windows(words: np.ndarray, text: np.ndarray, *, shingle: int = SHINGLE, passage: int = PASSAGE, hashes: int = HASHES) -> Iterator[tuple[np.ndarray, ...]]:
    """For each function: signature, text, first, c and last (shingles, counted over all texts)."""
    t = passage - shingle + 1
    n = len(words) - shingle + 1
    if n < t:
        return
    h = shingle_hashes(words, shingle)
    h = h + ranks(h, text[:n])[0].astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    whole = np.flatnonzero(text[: len(words) - passage + 1] == text[passage - 1 :])  # windows within a text
    border = np.searchsorted(text, np.arange(int(text[-1]) + 2))
    at = np.arange(n, dtype=np.uint64)
    places = np.uint64((1 << max(24, n.bit_length())) - 1)
    for f in range(hashes):
        v = mix64(h, 100 + f)
        key = (v & ~places) | at
        low = sliding_min(key, t)[whole]
        if not len(low):
            continue
        c = np.unique((low & places).astype(np.int64))
        own = text[c]
        first, last = tree_extents(key[c].tolist(), c.tolist(), own.tolist(), border[own].tolist(), (border[own + 1] - shingle).tolist())
        yield v[c], own, np.array(first), c, np.array(last)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(text hashes, texts) of about BATCH_WORDS words; equal texts of a batch once."""
    for batch in batches:
        keys, raw, size, seen = [], [], 0, set()
        for key, x in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
            if key in seen or not x.is_valid:
                continue
            seen.add(key)
            x = x.as_py()
            if raw and size + len(x) > 4 * BATCH_WORDS:
                yield np.array(keys, dtype=np.int64), raw
                keys, raw, size = [], [], 0
            keys.append(key)
            raw.append(x)
            size += len(x)
        if raw:
            yield np.array(keys, dtype=np.int64), raw


def _signatures(batches: Iterator[pa.RecordBatch], options: dict) -> Iterator[pa.RecordBatch]:
    for keys, raw in _texts(batches):
        words, text = word_hashes(raw)
        for sig, own, *_ in compact_windows(words, text, **options) if len(words) else ():
            yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(keys[own])], ["sig", "text"])


def _again(h: np.ndarray, text: np.ndarray, codes: bytes, border: np.ndarray, size: int, passage: int, similarity: float):
    """A function from a place c and the words around it to its text's further occurrences that are like it there:
    (first word, words) of the first and of the other, all in one list."""
    rank, order = ranks(h, text[: len(h)])
    place = np.empty(len(h), np.int64)
    place[order] = np.arange(len(h))

    def found(c: int, lo: int, hi: int) -> list[int]:
        out: list[int] = []
        if rank[c]:
            return out
        one, start, end = (codes[lo:c][::-1], codes[c:hi]), int(border[text[c]]), int(border[text[c] + 1])
        for k in range(int(place[c]) + 1, len(order)):
            d = int(order[k])
            if not rank[d]:
                break
            if d + size <= end and (got := common(one, (codes[max(start, d - SIDE) : d][::-1], codes[d : min(end, d + SIDE + size)]), size, passage, similarity)):
                out += [c - got[0] - start, got[0] + got[1], d - got[2] - start, got[2] + got[3]]
        return out

    return found


def _windows(batches: Iterator[pa.RecordBatch], shared, options: dict, similarity: float) -> Iterator[pa.RecordBatch]:
    """Windows with a signature that may be shared, with the codes of the words around c and the text's further
    occurrences of what is there."""
    known = cuckoo.CuckooFilter.loads(shared.value) if shared is not None else None
    size, passage = options["shingle"], options["passage"]
    for keys, raw in _texts(batches):
        words, text = word_hashes(raw)
        if len(words) < passage:
            continue
        codes = (words >> np.uint64(56)).astype(np.uint8).tobytes()
        border = np.searchsorted(text, np.arange(len(raw) + 1))
        again = _again(shingle_hashes(words, size), text, codes, border, size, passage, similarity)
        for sig, own, first, c, last in compact_windows(words, text, **options):
            if known is not None:
                hit = known.probe(sig)
                sig, own, first, c, last = sig[hit], own[hit], first[hit], c[hit], last[hit]
            lo, hi = np.maximum(first, c - SIDE), np.minimum(last, c + SIDE) + size
            ends = list(zip(c.tolist(), lo.tolist(), hi.tolist()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(sig.view(np.int64)), pa.array(keys[own]), pa.array((c - border[own]).astype(np.int32)), pa.array((c - lo).astype(np.int32)),
                    pa.array([codes[a:b] for _, a, b in ends], pa.binary()), pa.array([again(*x) for x in ends], pa.list_(pa.int32())),
                ],
                ["sig", "text", "c", "before", "codes", "again"],
            )


def _run(a: bytes, x: int, b: bytes, y: int) -> int:
    """Equal words from place x of the one and y of the other on."""
    n = min(len(a) - x, len(b) - y)
    diff = int.from_bytes(a[x : x + n], "little") ^ int.from_bytes(b[y : y + n], "little")
    return ((diff & -diff).bit_length() - 1) // 8 if diff else n


def align(a: bytes, b: bytes, size: int) -> list[tuple[int, int, int]]:
    """Where the runs that two sides have in common end, and each run's length, from c outwards.

    After a difference the next run is the one that skips the fewest words; it has ``size`` words at least, as a
    shorter one holds no shingle.
    """
    x = _run(a, 0, b, 0)
    out, y = [(x, x, x)], x
    while x + size <= len(a) and y + size <= len(b):
        best = None
        for k in range(min(SKIP, len(b) - size - y) + 1):
            if best and best[0] <= k:
                break
            at = a.find(b[y + k : y + k + size], x, x + SKIP + size)
            if at >= 0 and (best is None or at - x + k < best[0]):
                best = (at - x + k, at, y + k)
        if best is None:
            break
        n = _run(a, best[1], b, best[2])
        x, y = best[1] + n, best[2] + n
        out.append((x, y, n))
    return out


def common(one: tuple[bytes, bytes], two: tuple[bytes, bytes], size: int, passage: int, similarity: float) -> tuple[int, int, int, int] | None:
    """Words before c and from c on of the longest similar stretch, in the one and in the other; None: no passage.

    Both are (words before c, backwards; words from c on).
    """
    if min(len(one[0]), len(two[0])) + min(len(one[1]), len(two[1])) + SKIP < passage or one[1][:size] != two[1][:size]:
        return None  # no room, or equal signatures of different shingles
    left, right = align(one[0], two[0], size), align(one[1], two[1], size)
    best, most = None, 2 * passage - 1
    more = 1 - size
    for i, (xa, xb, n) in enumerate(left):
        more += n - (size - 1 if i else 0)
        shared = more
        for j, (ya, yb, m) in enumerate(right):
            shared += m - (size - 1 if j else 0)
            la, lb = xa + ya, xb + yb
            if la >= passage and lb >= passage and la + lb > most and shared >= similarity * (la + lb - 2 * (size - 1) - shared) - 1e-9:
                best, most = (xa, ya, xb, yb), la + lb
    return best


def shortest_run(size: int, passage: int, similarity: float) -> int:
    """Words of the longest run that two similar passages have in common, at least.

    e separate edits spoil least when words are put in: (s - (size - 1) e) / (s + size e) >= similarity for s
    shingles, and the words that stay lie in e + 1 runs.
    """
    least = lambda e: max(passage, e * (size - 1 + similarity * size) / (1 - similarity) + size - 1)
    return int(min((least(e) - e) / (e + 1) for e in range(1, 2 * SIDE))) if similarity < 1 else passage


def fingerprints(codes: bytes, run: int, gram: int) -> np.ndarray:
    """The least hash of the grams in each run of that length: windows with such a run in common share one."""
    words = np.frombuffer(codes, np.uint8).astype(np.uint64)
    n = len(words) - gram + 1
    if len(words) < run:
        return np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for j in range(gram):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[j : n + j] + np.uint64(1)
    return np.unique(sliding_min(mix64(h, 12), run - gram + 1)).view(np.int64)


def _divided(batches: Iterator[pa.RecordBatch], run: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Windows, once for each fingerprint."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            part = batch.slice(lo, 1000)
            keys = [fingerprints(x, run, gram) for x in part.column(4).to_pylist()]
            rows = part.take(pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys])))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64))], [*part.schema.names, "part"])


class _Kinds:
    """The different windows of a group, with an index of their shingles (the r-th of a kind in a window apart)."""

    def __init__(self, codes: list[bytes], size: int, least: int):
        self.n, self.least = len(codes), least
        length = np.array([len(x) - size + 1 for x in codes])
        words = np.frombuffer(b"".join(codes), np.uint8).astype(np.uint64)
        gram = np.zeros(len(words) - size + 1, np.uint64)
        for j in range(size):
            gram = gram << np.uint64(8) | words[j : len(gram) + j]
        at = np.repeat(np.cumsum([0, *map(len, codes)])[:-1] - np.cumsum([0, *length])[:-1], length) + np.arange(length.sum())
        row, gram = np.repeat(np.arange(self.n), length), gram[at]
        order = np.lexsort((gram, row))
        row, gram = row[order], gram[order]
        new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (row[1:] != row[:-1])])
        rank = np.arange(len(row)) - np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))
        key = np.unique(gram << np.uint64(8) | rank.astype(np.uint64), return_inverse=True)[1]
        self.own, self.at = key, np.searchsorted(row, np.arange(self.n + 1))
        order = np.argsort(key, kind="stable")
        self.of_key, self.first = row[order], np.searchsorted(key[order], np.arange(int(key.max()) + 2)).tolist()

    def near(self, i: int) -> np.ndarray:
        """Later windows that share ``least`` shingles or more with window i, most first."""
        count = np.bincount(np.concatenate([self.of_key[self.first[k] : self.first[k + 1]] for k in self.own[self.at[i] : self.at[i + 1]].tolist()]), minlength=self.n)
        j = np.flatnonzero(count[i + 1 :] >= self.least) + i + 1
        return j[np.argsort(-count[j], kind="stable")]


def _similar(sides: list[tuple[bytes, bytes]], apart, size: int, passage: int, similarity: float, bucket: int) -> list[tuple[int, ...]]:
    """(i, j, words before c, from c on in i, the same in j) of different windows; ``apart``: in different texts."""
    n, out = len(sides), []
    if n <= bucket:
        for j in range(n):
            for i in range(j):
                if apart(i, j) and (got := common(sides[i], sides[j], size, passage, similarity)):
                    out.append((i, j, *got))
        return out
    # of passages with s shingles each, at least 2 s similarity / (1 + similarity) are shared
    kinds = _Kinds([a[::-1] + b for a, b in sides], size, math.ceil(2 * (passage - size + 1) * similarity / (1 + similarity) - 1e-9))
    label = np.arange(n)
    for i in range(n):
        others = kinds.near(i)
        others = others[label[others] != label[i]]
        while len(others):
            j, others = int(others[0]), others[1:]
            if apart(i, j) and (got := common(sides[i], sides[j], size, passage, similarity)):
                out.append((i, j, *got))
                label[label == label[j]] = label[i]
                others = others[label[others] != label[i]]
    return out


def _thin(found: list[tuple[int, ...]], n: int) -> list[tuple[int, ...]]:
    """Links that connect what all connect, and for each window those that reach furthest to either side.

    All stretches of a window contain c, so these unite to the same.
    """
    label, kept = list(range(n)), set()

    def root(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    best: dict[tuple[int, int], tuple[int, tuple[int, ...]]] = {}
    for link in found:
        i, j, *reach = link
        if root(i) != root(j):
            label[root(i)] = root(j)
            kept.add(link)
        for k, r in zip(((i, 0), (i, 1), (j, 0), (j, 1)), reach):
            if r > best.get(k, (0,))[0]:
                best[k] = (r, link)
    return sorted(kept | {link for _, link in best.values()})


def group_links(rows: list[tuple[int, int, int, bytes]], size: int, passage: int, similarity: float, bucket: int = BUCKET) -> list[tuple[int, int, int, int, int, int]]:
    """Links (text, first word, words) twice of windows (text, c, before, codes) of a signature."""
    alike: dict[tuple[int, bytes], list[tuple[int, int]]] = {}
    for text, c, before, codes in sorted(rows):
        if len(codes) >= passage:
            alike.setdefault((before, codes), []).append((text, c))
    kinds, members, out = list(alike), list(alike.values()), []
    other = [next((m for m in own if m[0] != own[0][0]), None) for own in members]  # of another text than the first
    for (before, codes), own, two in zip(kinds, members, other):
        if two:
            for text, c in own[1:]:
                t, k = own[0] if text != own[0][0] else two
                out.append((t, k - before, len(codes), text, c - before, len(codes)))
    if len(kinds) < 2:
        return out
    apart = lambda i, j: members[i][0][0] != members[j][0][0] or other[i] or other[j]
    found = _similar([(codes[:before][::-1], codes[before:]) for before, codes in kinds], apart, size, passage, similarity, bucket)
    for i, j, xa, ya, xb, yb in _thin(found, len(kinds)):
        u, v = members[i][0], members[j][0]
        if u[0] == v[0]:
            u, v = (other[i], v) if other[i] else (u, other[j])
        # a kind that one text has in several places isn't linked in itself
        pairs = {(u, v)} | ({(m, v) for m in members[i]} if not other[i] else set()) | ({(u, m) for m in members[j]} if not other[j] else set())
        out += [(t, c - xa, xa + ya, t2, c2 - xb, xb + yb) for (t, c), (t2, c2) in pairs]
    return out


def _compare(batches: Iterator[pa.RecordBatch], size: int, passage: int, similarity: float, bucket: int) -> Iterator[pa.RecordBatch]:
    """Links within each group (a bounded list of windows)."""
    for batch in batches:
        out = []
        for group in batch.column(0):
            out += group_links([(r["text"], r["c"], r["before"], r["codes"]) for r in group.as_py()], size, passage, similarity, bucket)
        kinds = (pa.int64(), pa.int32(), pa.int32()) * 2
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], ["ta", "fa", "na", "tb", "fb", "nb"])


def _few(df: DataFrame) -> DataFrame:
    """A table of a few columns, to be broadcast if its rows are counted to be few: else a join deals both sides out."""
    return F.broadcast(df) if df.count() <= SENT else df


def _links(windows: DataFrame, *, shingle: int, passage: int, similarity: float, bucket: int, block: int) -> DataFrame:
    """(ta, fa, na, tb, fb, nb): verified stretches of na and nb words in two texts, from windows (sig, text, c, before, codes)."""
    sizes = windows.groupBy("sig").agg(F.count(F.lit(1)).alias("size"))
    hot = _few(materialise(sizes.where(F.col("size") > bucket).select("sig"), "hot-signatures"))
    many = materialise(windows.join(hot, "sig", "left_semi").where(F.length("codes") >= passage).select("sig", "text", "c", "before", "codes"), "many")
    place = F.struct("text", "c")
    # the same words around c in several texts: linked to the first, or its text's to the last
    ends = materialise(many.groupBy("sig", "before", "codes").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low.text <> high.text"), "equal-windows")
    same = many.join(ends, ["sig", "before", "codes"])
    to = F.when(F.col("text") == F.col("low.text"), F.col("high")).otherwise(F.col("low"))
    n = F.length("codes")
    exact = same.withColumn("to", to).select(F.col("to.text").alias("ta"), (F.col("to.c") - F.col("before")).alias("fa"), n.alias("na"), F.col("text").alias("tb"), (F.col("c") - F.col("before")).alias("fb"), n.alias("nb"))
    two = ends.select("sig", "before", "codes", F.explode(F.array("low", "high")).alias("x")).select("sig", "x.text", "x.c", "before", "codes")
    firsts = materialise(many.join(ends, ["sig", "before", "codes"], "left_anti").select(two.columns).unionByName(two), "hot-windows")
    columns, group = ["sig", "part", "x", "text", "c", "before", "codes"], bucket * block
    whole = lambda df: df.withColumns({"part": F.lit(0).cast("long"), "x": F.expr("named_struct('a', 0, 'b', 0)")}).select(columns)
    large = materialise(firsts.groupBy("sig").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > group).select("sig"), "large-signatures")
    cold = windows.join(hot, "sig", "left_anti")
    parts = whole(cold).unionByName(whole(firsts.join(_few(large), "sig", "left_anti")))
    if large.count():
        # divided by what similar passages share, and what is still large into blocks of which each two meet
        run = shortest_run(shingle, passage, similarity)
        over = firsts.join(_few(large), "sig", "left_semi").select("sig", "text", "c", "before", "codes")
        divided = materialise(over.mapInArrow(partial(_divided, run=run, gram=max(1, 2 * run // 3)), "sig long, text long, c int, before int, codes binary, part long"), "divided-windows")
        sized = divided.groupBy("sig", "part").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        cut = divided.join(sized, ["sig", "part"]).withColumn("blocks", F.when(F.col("size") > group, F.ceil(2 * F.col("size") / group)).otherwise(1).cast("int")).withColumn("own", F.pmod(F.xxhash64("before", "codes"), F.col("blocks")).cast("int"))
        met = cut.withColumn("x", F.explode(F.expr("transform(filter(sequence(0, blocks - 1), x -> x <> own or blocks = 1), x -> struct(least(x, own) as a, greatest(x, own) as b))")))
        parts = parts.unionByName(met.select(columns))
    groups = parts.groupBy("sig", "part", "x").agg(F.collect_list(F.struct("text", "c", "before", "codes")).alias("rows")).where(F.size("rows") > 1)
    found = groups.select("rows").mapInArrow(partial(_compare, size=shingle, passage=passage, similarity=similarity, bucket=bucket), "ta long, fa int, na int, tb long, fb int, nb int")
    return found.unionByName(exact).where("ta <> tb").distinct()


def repeated_passages(docs: DataFrame, *, shingle: int = SHINGLE, passage: int = PASSAGE, similarity: float = SIMILARITY, hashes: int = HASHES, bucket: int = BUCKET, block: int = BLOCK, filter_bytes: int = FILTER_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, first, last, class_id): passages in words (last exclusive) that other documents
    repeat; class_id is the smallest id of a document with a passage of the class, null if none has an id."""
    spark = docs.sparkSession
    ship_code(spark)
    own = docs.select(doc_key(id_col).alias("doc"), F.xxhash64(text_col).alias("text"), F.col(text_col).alias("raw")).where("raw is not null")
    options = {"shingle": shingle, "passage": passage, "hashes": hashes}
    texts = own.select("text", "raw")
    sigs = texts.mapInArrow(partial(_signatures, options=options), "sig long, text long")
    shared = materialise(sigs.groupBy("sig").agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a < b").select("sig"), "shared-signatures")
    n, sent = shared.count(), None
    if n * 3 <= filter_bytes:
        held = shared.toArrow().column("sig").to_numpy().view(np.uint64)
        sent = spark.sparkContext.broadcast(cuckoo.build(held).dumps())
    drawn = texts.mapInArrow(partial(_windows, shared=sent, options=options, similarity=similarity), "sig long, text long, c int, before int, codes binary, again array<int>")
    if sent is None:
        drawn = drawn.join(shared, "sig", "left_semi")
    windows = materialise(drawn.dropDuplicates(["sig", "text", "c"]), "windows")
    links = materialise(_links(windows, shingle=shingle, passage=passage, similarity=similarity, bucket=bucket, block=block), "passage-links")
    # copies: the whole of a text that is long enough
    n_words = F.size(F.filter(F.split("raw", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    copies = own.groupBy("text").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.first("raw").alias("raw")).where("low < high").select("text", F.lit(0).alias("f"), n_words.alias("l")).where(F.col("l") >= passage)
    ends = links.select(F.col("ta").alias("text"), F.col("fa").alias("f"), (F.col("fa") + F.col("na")).alias("l")).unionByName(links.select(F.col("tb").alias("text"), F.col("fb").alias("f"), (F.col("fb") + F.col("nb")).alias("l")))
    # united stretches: a text's own rows only, at most so many as it has stretches
    in_text = Window.partitionBy("text").orderBy("f", "l")
    reach = F.max("l").over(in_text.rowsBetween(Window.unboundedPreceding, -1))
    marked = ends.unionByName(copies).distinct().withColumn("new", F.when(reach >= F.col("f"), 0).otherwise(1))
    numbered = marked.withColumn("span", F.sum("new").over(in_text.rowsBetween(Window.unboundedPreceding, 0)))
    numbered = materialise(numbered.select("text", "f", "l", F.xxhash64("text", "span").alias("node")), "stretches")
    side = lambda t, f, node: numbered.select(F.col("text").alias(t), F.col("f").alias(f), F.col("l").alias(f"l{t}"), F.col("node").alias(node))
    edges = links.withColumns({"lta": F.col("fa") + F.col("na"), "ltb": F.col("fb") + F.col("nb")}).join(side("ta", "fa", "a"), ["ta", "fa", "lta"]).join(side("tb", "fb", "b"), ["tb", "fb", "ltb"]).select("a", "b")
    reached = components(edges, "passage-classes")
    spans = numbered.groupBy("node").agg(F.min("text").alias("text"), F.min("f").alias("first"), F.max("l").alias("last"))
    classed = materialise(spans.join(reached, "node", "left").select("text", "first", "last", F.coalesce("component", "node").alias("component")), "passages")
    # further occurrences in the same text of what is told there
    quads = F.expr("transform(sequence(0, size(again) div 4 - 1), k -> struct(again[4 * k] as f0, again[4 * k + 1] as n0, again[4 * k + 2] as first, again[4 * k + 3] as n))")
    more = windows.where(F.size("again") > 0).select("text", F.explode(quads).alias("x")).select("text", "x.*").distinct()
    held = classed.select("text", F.col("first").alias("a"), F.col("last").alias("b"), "component")
    further = more.join(held, "text").where(F.least("b", F.col("f0") + F.col("n0")) - F.greatest("a", "f0") >= passage).select("text", "first", (F.col("first") + F.col("n")).alias("last"), "component")
    in_all = Window.partitionBy("text").orderBy("first", "last")
    before = F.max("last").over(in_all.rowsBetween(Window.unboundedPreceding, -1))
    parts = classed.unionByName(further.distinct()).withColumn("new", F.when(before >= F.col("first"), 0).otherwise(1)).withColumn("span", F.sum("new").over(in_all.rowsBetween(Window.unboundedPreceding, 0)))
    whole = parts.groupBy("text", "span").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.min("component").alias("component")).drop("span")
    placed = own.select("doc", "text").join(whole, "text")
    low = placed.groupBy("component").agg(F.min(F.when(F.col("doc") != F.lit(NULL_ID), F.col("doc"))).alias("class_id"))
    return placed.join(low, "component").select("doc", "first", "last", "class_id")


def op9_passages(docs: DataFrame) -> DataFrame:
    """A row for each document that repeats a passage of another: doc_id, n_passages, n_repeated
    (words), passages (first:last in words, comma-joined) and class_ids (smallest ids of their classes)."""
    found = repeated_passages(docs).distinct().groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("first", "last", "class_id"))).alias("p"))
    doc = F.when(F.col("doc") != F.lit(NULL_ID), F.col("doc"))
    return found.select(
        doc.alias("doc_id"), F.size("p").cast("long").alias("n_passages"), F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["last"] - x["first"]).alias("n_repeated"),
        F.array_join(F.transform("p", lambda x: F.concat_ws(":", x["first"].cast("string"), x["last"].cast("string"))), ",").alias("passages"),
        F.array_min(F.transform("p", lambda x: x["class_id"])).alias("class_id"), F.array_distinct(F.transform("p", lambda x: x["class_id"])).alias("class_ids"),
    )
