"""SimHash near-duplicates: generalised pigeonhole with unequal thresholds.

Each document's 64-bit fingerprint is the majority of its shingles' hashes, bit by bit.
Equal fingerprints are one class, so copies cost nothing further. Between classes, links
at ``radius`` or fewer differing bits are found like this:

1. Bits that vary together are put in the same of ``parts`` partitions, by the matrix of
   their correlations over all classes. What the partitions have in common is then
   small, and a partition of redundant bits isn't asked to tell much.
2. Thresholds T_i >= -1 with sum(T_i) = radius - parts + 1 are enough: a pair within the
   radius differs in at most T_i bits of some partition i. A dynamic programme takes
   those of least estimated cost; the numbers of candidates are estimated from second
   moments of sketches of all classes' partition values, with up to two bits masked.
3. Every class sends, for each partition with T_i >= 0, its value with each set of T_i
   bits masked; classes that share a key are candidates and are verified by their
   distance.

A key that more than ``BUCKET`` classes share isn't paired out. At a radius of two its classes take an
exact way without pairs: they send each fingerprint and all those at one differing bit
(65 keys); classes that share such a point are linked to its smallest one, and sharing a
point is the same as being within the radius, so no link is lost or invented. At larger radii the
bucket is cut into blocks, and each two blocks meet in one bounded group.

Defined results: no word: fingerprint zero, linked like any other; fewer words than a
shingle: the whole sequence is one; rows without an id take part as the last document;
rows with the same id are apart, each with its own text's class; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm.components import components
from strandlake.llm.runtime import NULL_ID, doc_key, materialise, mix64, ship_code, slices, utf8

#: What A-Z become and what separates words.
_fold = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 32 or 9 <= c <= 13 else c for c in range(256))
SEED = 42
BITS = 64
RADIUS = 2
PARTS = 3
#: Classes under one key that are compared with each other.
BUCKET = 64
SKETCH = 1 << 10
#: Minima in a document's sketch: a power of two, at most 2^16.
BINS = 256
#: Minima in a band and bands: at a similarity of 0.8 a pair shares a band but for 2 in 10,000, at 0.85 but for 6 in a million.
ROWS = 7
BANDS = 36
#: Candidates of which each two are compared in one task.
GROUP = 512
#: Columns of a membership matrix at a time.
COLUMNS = 4096
#: Candidates whose keys are broadcast, at most.
SENT = 1_000_000
#: At this radius, large buckets are linked through points.
POINTS_RADIUS = 2

_salts, _factors = (mix64(np.arange(BANDS * ROWS, dtype=np.uint64), salt) | np.uint64(1) for salt in (10, 11))


def shingle_hashes(raw: bytes, size: int) -> np.ndarray:
    """XXH64 of a text's word shingles, A-Z lower-cased, repeats included."""
    words = [w for w in raw.translate(_fold).split(b" ") if w]
    if not words:
        return np.zeros(0, "<u8")
    text = b" ".join(words)
    n = len(words) - size + 1
    if n < 2:
        return np.array([xxhash.xxh64_intdigest(text, SEED)], dtype="<u8")
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    view, digest = memoryview(text), xxhash.xxh64_intdigest
    return np.array([digest(view[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[size - 1 :].tolist())], dtype="<u8")


def fingerprint(h: np.ndarray) -> int:
    """Bit by bit what over half of the hashes have."""
    counts = np.zeros(BITS, dtype=np.int64)
    for lo in range(0, len(h), 8192):
        counts += np.unpackbits(h[lo : lo + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view("<u8")[0])


def sketch(h: np.ndarray) -> bytes:
    """One-permutation min-hash: 16 bits of the least hash in each of BINS equal ranges; 0: none there."""
    out = np.zeros(BINS, dtype="<u2")
    if len(h):
        v = np.sort(mix64(h, 5))
        bin_ = (v >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
        first = np.concatenate([[True], bin_[1:] != bin_[:-1]])
        out[bin_[first]] = (v[first] & np.uint64(0xFFFF)).astype(np.uint16) | np.uint16(1)
    return out.tobytes()


def _fingerprints(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        fps = [fingerprint(shingle_hashes(raw, size)) for raw in utf8(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, dtype=np.uint64).view(np.int64))], ["doc", "fp"])


def band_keys(h: np.ndarray) -> np.ndarray:
    """A key for each of BANDS groups of ROWS minima, of distinct shingle hashes; none for an empty set."""
    if not len(h):
        return np.zeros(0, np.int64)
    low = np.full(BANDS * ROWS, (1 << 64) - 1, dtype=np.uint64)
    for lo in range(0, len(h), 1024):
        low = np.minimum(low, ((h[None, lo : lo + 1024] ^ _salts[:, None]) * _factors[:, None]).min(1))
    weighed = (mix64(low, 7) * _factors).reshape(BANDS, ROWS).sum(1, dtype=np.uint64)
    return mix64(weighed + np.arange(BANDS, dtype=np.uint64), 8).view(np.int64)


def _banded(batches: Iterator[pa.RecordBatch], size: int, words: int) -> Iterator[pa.RecordBatch]:
    """(doc, copy, fp, cls, keys): the fingerprint over shingles of ``words``; cls is a hash of the whole shingle set."""
    for batch in slices(batches):
        fps, sets, keys = [], [], []
        for raw in utf8(batch.column(2)):
            fps.append(fingerprint(shingle_hashes(raw, words)))
            h = np.unique(shingle_hashes(raw, size))
            sets.append(xxhash.xxh3_64_intdigest(h.tobytes(), SEED))
            keys.append(band_keys(h))
        at = np.cumsum([0, *map(len, keys)], dtype=np.int32)
        lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)))
        signed = lambda x: pa.array(np.array(x, dtype=np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), signed(fps), signed(sets), lists], ["doc", "copy", "fp", "cls", "keys"])


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        sets = [np.unique(shingle_hashes(raw, size)).tobytes() for raw in utf8(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["cls", "shingles"])


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fp).astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of fingerprints and the sum of their bits' products."""
    n, total = 0, np.zeros((BITS, BITS))
    for batch in batches:
        x = _bits(batch.column(0).to_numpy()).astype(np.float32)
        total += x.T @ x
        n += len(x)
    yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.reshape(-1).tolist()], pa.list_(pa.float64()))], ["n", "m"])


def partition_bits(n: int, moments: np.ndarray, parts: int) -> list[list[int]]:
    """Bits by partition, of about equal numbers: each next bit goes where it correlates most."""
    mean = np.diag(moments) / max(n, 1)
    cov = moments / max(n, 1) - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    room = [len(x) for x in np.array_split(np.arange(BITS), parts)]
    left, out = set(range(BITS)), []
    for size in room:
        first = max(left, key=lambda b: (corr[b, list(left)].sum(), -b))
        own = [first]
        left.discard(first)
        while len(own) < size:
            b = max(left, key=lambda b: (corr[b, own].mean(), -b))
            own.append(b)
            left.discard(b)
        out.append(sorted(own))
    return out


def _masks(bits: list[int], t: int) -> list[int]:
    """For each choice of t of the bits, a mask of the others."""
    whole = sum(1 << b for b in bits)
    return [whole & ~sum(1 << b for b in gone) for gone in itertools.combinations(bits, t)]


def _sketches(batches: Iterator[pa.RecordBatch], masks: list[int]) -> Iterator[pa.RecordBatch]:
    """For each mask a count sketch of the masked fingerprints: its squares estimate the pairs that agree."""
    total = np.zeros((len(masks), SKETCH))
    for batch in batches:
        fp = batch.column(0).to_numpy().view(np.uint64)
        for k, m in enumerate(masks):
            h = mix64(fp & np.uint64(m), k + 1)
            total[k] += np.bincount((h >> np.uint64(40)).astype(np.int64) % SKETCH, weights=1.0 - 2.0 * (h & np.uint64(1)).astype(float), minlength=SKETCH)
    yield pa.RecordBatch.from_arrays([pa.array(range(len(masks)), pa.int64()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["k", "s"])


def allocate(n: int, keys: list[list[int]], pairs: list[list[float]], total: int) -> list[int]:
    """Thresholds by dynamic programming.

    ``keys[i][t]`` and ``pairs[i][t]``: the keys a class sends for partition i at threshold t
    and the pairs that they bring together; t = -1 costs nothing. The thresholds sum to ``total``.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for i in range(len(keys)):
        then: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, own) in best.items():
            for t in range(-1, len(keys[i])):
                c = cost + (0.0 if t < 0 else n * keys[i][t] + pairs[i][t])
                if spent + t not in then or c < then[spent + t][0]:
                    then[spent + t] = (c, [*own, t])
        best = then
    if total not in best:
        raise ValueError("more partitions are needed for that radius")
    return best[total][1]


def plan(classes: DataFrame, radius: int, parts: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition, from statistics over all classes (column fp)."""
    got = classes.select("fp").mapInArrow(_moments, "n long, m array<double>")
    n = got.agg(F.sum("n").alias("n")).first()["n"] or 0
    wide = got.select(F.posexplode("m").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
    moments = np.zeros(BITS * BITS)
    for r in wide:
        moments[r["i"]] = r["v"]
    bits = partition_bits(n, moments.reshape(BITS, BITS), parts)
    top = min(2, radius)
    masks: list[list[list[int]]] = [[_masks(b, t) if t < 2 else [] for t in range(top + 1)] for b in bits]
    flat = [m for part in masks for level in part for m in level]
    drawn = classes.select("fp").mapInArrow(partial(_sketches, masks=flat), "k long, s array<double>")
    summed = drawn.select("k", F.posexplode("s").alias("i", "v")).groupBy("k", "i").agg(F.sum("v").alias("v"))
    moment = {r["k"]: r["f"] for r in summed.groupBy("k").agg(F.sum(F.col("v") * F.col("v")).alias("f")).collect()}
    agree = {m: max(0.0, (moment.get(k, 0.0) - n) / 2) for k, m in enumerate(flat)}
    keys, pairs = [], []
    for b, levels in zip(bits, masks):
        own_pairs = [sum(agree[m] for m in level) for level in levels if level]
        own_keys = [len(level) for level in levels if level]
        if top == 2:  # beyond one masked bit: as each further one multiplies
            own_pairs.append(own_pairs[1] * max(1.0, own_pairs[1] / max(own_pairs[0], 1.0)) / 2)
            own_keys.append(len(b) * (len(b) - 1) // 2)
        keys.append(own_keys)
        pairs.append(own_pairs)
    return list(zip(bits, allocate(max(n, 1), keys, pairs, radius - parts + 1)))


def _probes(fp: Column, chosen: list[tuple[list[int], int]]) -> Column:
    """The keys (probe number, masked value) of a fingerprint."""
    out, k = [], 0
    for bits, t in chosen:
        for m in _masks(bits, t) if t >= 0 else []:
            signed = m - (1 << 64) if m >> 63 else m
            out.append(F.struct(F.lit(k).alias("probe"), fp.bitwiseAND(F.lit(signed)).alias("value")))
            k += 1
    return F.array(*out)


def _pairs(v: np.ndarray, lo: int, radius: int, before: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Places i < j of fingerprints within the radius, i from ``lo`` on, 256 at a time; without pairs that
    agree under one of the masks ``before``: another bucket tells those."""
    x = v[lo : lo + 256, None] ^ v[None, lo:]
    i, j = np.nonzero(np.triu(np.bitwise_count(x) <= radius, 1))
    x = x[i, j]
    for m in before:
        if not len(x):
            break
        keep = (x & np.uint64(m)) != 0
        i, j, x = i[keep], j[keep], x[keep]
    return i + lo, j + lo


def _dense(v: np.ndarray, radius: int, before: list[int]) -> list[tuple[int, int]]:
    """Links that connect what all pairs connect, about one or two a fingerprint: each to the firsts it is near,
    and what is still apart by one pair."""
    root = list(range(len(v)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out, free = [], np.ones(len(v), dtype=bool)
    for first in range(len(v)):
        if not free[first]:
            continue
        x = v[first + 1 :] ^ v[first]
        near = np.bitwise_count(x) <= radius
        for m in before:
            near &= (x & np.uint64(m)) != 0
        for j in (np.flatnonzero(near) + first + 1).tolist():
            free[j] = False
            out.append((first, j))
            root[find(j)] = find(first)
    for lo in range(0, len(v), 256):
        i, j = _pairs(v, lo, radius, before)
        label = np.array([find(k) for k in range(len(v))])
        _, at = np.unique(label[i] * len(v) + label[j], return_index=True)
        for a, b in zip(i[at].tolist(), j[at].tolist()):
            if find(a) != find(b):
                out.append((a, b))
                root[find(b)] = find(a)
    return out


def bucket_links(v: np.ndarray, radius: int, before: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Linked places in a bucket: all pairs while they are at most two a fingerprint, else enough to connect them."""
    left, right, total = [], [], 0
    for lo in range(0, len(v), 256):
        i, j = _pairs(v, lo, radius, before)
        total += len(i)
        if total > 2 * len(v):
            return tuple(np.array(_dense(v, radius, before), dtype=np.int64).reshape(-1, 2).T)
        left.append(i)
        right.append(j)
    return np.concatenate(left), np.concatenate(right)


def _verify(batches: Iterator[pa.RecordBatch], radius: int, masks: list[int]) -> Iterator[pa.RecordBatch]:
    """Links within each bucket (a probe and a bounded list of fingerprints)."""
    for batch in batches:
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        values, at = batch.column(1).values.to_numpy(), batch.column(1).offsets.to_numpy()
        for probe, lo, hi in zip(batch.column(0).to_pylist(), at[:-1].tolist(), at[1:].tolist()):
            v = np.sort(values[lo:hi])
            i, j = bucket_links(v.view(np.uint64), radius, masks[:probe])
            left.append(v[i])
            right.append(v[j])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], ["fa", "fb"])


def links(classes: DataFrame, *, radius: int = RADIUS, parts: int = PARTS, bucket: int = BUCKET) -> DataFrame:
    """Pairs (fa, fb) of fingerprints within the radius that connect all classes within it.

    ``classes`` has distinct fingerprints in column fp. A pair is told by the first probe that brings it
    together, and a bucket tells about one or two links a class, however dense it is.
    """
    chosen = plan(classes, radius, parts)
    masks = [m for bits, t in chosen if t >= 0 for m in _masks(bits, t)]
    sent = classes.select("fp", F.explode(_probes(F.col("fp"), chosen)).alias("key")).select("fp", "key.probe", "key.value")
    hot = materialise(sent.groupBy("probe", "value").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > bucket), "buckets")
    groups = sent.join(hot.select("probe", "value"), ["probe", "value"], "left_anti").groupBy("probe", "value").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    found = groups.select("probe", "fps").mapInArrow(partial(_verify, radius=radius, masks=masks), "fa long, fb long")
    if radius == POINTS_RADIUS:
        many = sent.join(hot.select("probe", "value"), ["probe", "value"], "left_semi").select("fp").distinct()
        rest = _by_points(many)
    else:
        rest = _by_blocks(sent.join(hot, ["probe", "value"]), radius, bucket, masks)
    return found.unionByName(rest).distinct()


def _by_points(classes: DataFrame) -> DataFrame:
    """Links at a radius of two through the points at one bit, without pairing any group out."""
    signed = [0, *(1 << b for b in range(BITS - 1)), -(1 << (BITS - 1))]
    points = classes.select("fp", F.explode(F.array(*(F.col("fp").bitwiseXOR(F.lit(s)) for s in signed))).alias("point"))
    low = points.groupBy("point").agg(F.min("fp").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return points.join(low.select("point", "low"), "point").where("fp <> low").select(F.col("low").alias("fa"), F.col("fp").alias("fb"))


def _by_blocks(sent: DataFrame, radius: int, bucket: int, masks: list[int]) -> DataFrame:
    """Large buckets cut into blocks by a hash; each two blocks meet in a bounded group."""
    blocks = F.ceil(2 * F.col("size") / bucket).cast("int")
    own = sent.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    met = own.select("fp", "probe", "value", F.explode(F.expr("transform(sequence(0, blocks - 1), x -> struct(least(x, own) as a, greatest(x, own) as b))")).alias("x"))
    groups = met.groupBy("probe", "value", "x").agg(F.collect_list("fp").alias("fps"))
    return groups.select("probe", "fps").mapInArrow(partial(_verify, radius=radius, masks=masks), "fa long, fb long")


def alike(sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Links that connect all sets whose Jaccard similarity is at least ``least``: every two are compared, by exact
    counts, and only then are the links thinned, to one fewer than the sets at most."""
    n, sizes = len(sets), np.array([len(x) for x in sets])
    values, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), sizes)
    shared = count[at] > 1
    column, row = (np.cumsum(count > 1) - 1)[at[shared]], row[shared]
    common = np.zeros((n, n), dtype=np.float64)
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    for lo in range(0, int((count > 1).sum()), COLUMNS):
        i, j = np.searchsorted(column, (lo, lo + COLUMNS))
        member = np.zeros((n, COLUMNS), dtype=np.float32)
        member[row[i:j], column[i:j] - lo] = 1
        common += member @ member.T
    near = common >= least * (sizes[:, None] + sizes[None, :] - common) - 1e-9
    out, free = [], np.ones(n, dtype=bool)
    for start in range(n):
        todo = [start] if free[start] else []
        free[start] = False
        while todo:
            k = todo.pop()
            for j in np.flatnonzero(near[k] & free).tolist():
                free[j] = False
                out.append((k, j))
                todo.append(j)
    return out


def _verified(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Links of each group; its rows (g, cls, shingles) come one after another."""

    def links_of(own: list[tuple[int, bytes]]) -> pa.RecordBatch:
        names = np.array([c for c, _ in own], dtype=np.int64)
        i, j = np.array(alike([np.frombuffer(x, "<u8") for _, x in own], least), dtype=np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(names[i]), pa.array(names[j])], ["a", "b"])

    now, own = None, []
    for batch in batches:
        for g, c, x in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if g != now and own:
                yield links_of(own)
                own = []
            now = g
            own.append((c, x))
    if own:
        yield links_of(own)


def fingerprints(docs: DataFrame, *, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, fp) of each row, written to the shared folder."""
    ship_code(docs.sparkSession)
    return materialise(docs.select(doc_key(id_col).alias("doc"), F.col(text_col).alias("text")).mapInArrow(partial(_fingerprints, size=shingle), "doc long, fp long"), "simhash")


def near_duplicates(docs: DataFrame, *, shingle: int = 3, radius: int = RADIUS, parts: int = PARTS, bucket: int = BUCKET, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, fp, component): component is the smallest id that links reach, the document's own included."""
    prints = fingerprints(docs, shingle=shingle, id_col=id_col, text_col=text_col)
    return prints.join(linked(prints, radius=radius, parts=parts, bucket=bucket).drop("root"), "fp")


def linked(prints: DataFrame, *, radius: int = RADIUS, parts: int = PARTS, bucket: int = BUCKET) -> DataFrame:
    """(fp, root, component) of the fingerprints of a table (doc, fp): what links within the radius reach."""
    classes = materialise(prints.groupBy("fp").agg(F.min("doc").alias("low")), "classes")
    return _labelled(classes, links(classes, radius=radius, parts=parts, bucket=bucket))


def _labelled(classes: DataFrame, edges: DataFrame) -> DataFrame:
    """(fp, root, component) of classes (fp, low): the smallest fp and the smallest low that edges reach."""
    reached = components(edges.toDF("a", "b"), "simhash-components").toDF("fp", "root")
    rooted = classes.join(reached, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    return rooted.join(rooted.groupBy("root").agg(F.min("low").alias("component")), "root").select("fp", "root", "component")


def similar_documents(
    docs: DataFrame, *, words: int = 3, radius: int = RADIUS, parts: int = PARTS, bucket: int = BUCKET,
    shingle: int = 5, similarity: float = 0.8, group: int = GROUP, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc, copy, root, component): groups of documents whose fingerprints link as in :func:`near_duplicates`, or whose sets of
    shingles have that Jaccard similarity, or that are connected by such links of either kind.

    The fingerprints are those of shingles of ``words``, repeats included. Few pairs near the similarity are within their
    radius, so the sets bring what fingerprints can't tell, and take none of their links away.
    """
    ship_code(docs.sparkSession)
    own = docs.select(doc_key(id_col).alias("doc"), F.xxhash64(text_col).alias("copy"), F.col(text_col).alias("text"))
    prints = materialise(own.mapInArrow(partial(_banded, size=shingle, words=words), "doc long, copy long, fp long, cls long, keys array<long>"), "bands")
    by_print = linked(prints, radius=radius, parts=parts, bucket=bucket).select("fp", F.col("root").alias("print"))
    by_set = _by_sets(own, prints, shingle, similarity, group).select("cls", F.col("root").alias("set"))
    rows = materialise(prints.select("doc", "copy", "fp", "cls").join(by_print, "fp").join(by_set, "cls").select("doc", "copy", "print", "set"), "both-labels")
    # groups of sets that fingerprints connect: each with the smallest that has the same label of prints
    met = rows.select("print", "set").distinct()
    low = materialise(met.groupBy("print").agg(F.min("set").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("print", "first"), "print-firsts")
    reached = components(met.join(low, "print").select(F.col("first").alias("a"), F.col("set").alias("b")), "both-components").toDF("set", "root")
    rooted = materialise(rows.join(reached, "set", "left").select("doc", "copy", F.coalesce("root", "set").alias("root")), "both-roots")
    return rooted.join(rooted.groupBy("root").agg(F.min("doc").alias("component")), "root").select("doc", "copy", "root", "component")


def _by_sets(own: DataFrame, prints: DataFrame, shingle: int, similarity: float, group: int) -> DataFrame:
    """(cls, root, component) of classes of texts (doc, copy, text) with the same shingle set, linked by the similarity of these.

    Classes that share a band of minima are candidates, and so is what they connect: every two of such a group are
    compared by their whole sets. A group of over ``group`` classes is cut into blocks by a hash, of which each two meet.
    """
    classes = materialise(prints.groupBy("cls").agg(F.min(F.struct("doc", "copy")).alias("x"), F.first("keys").alias("keys")).select("cls", F.col("x.doc").alias("low"), F.col("x.copy").alias("copy"), "keys"), "classes")
    sent = classes.select("cls", F.explode("keys").alias("key"))
    # written first: so the join deals both sides out by itself and can split a hot key
    low = materialise(sent.groupBy("key").agg(F.min("cls").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "first"), "band-firsts")
    star = sent.join(low, "key").where("cls <> first").select(F.col("first").alias("a"), F.col("cls").alias("b"))
    reached = components(star, "candidates")
    sizes = reached.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    cut = reached.join(sizes, "component").withColumn("blocks", F.when(F.col("size") > group, F.ceil(2 * F.col("size") / group)).otherwise(1).cast("int"))
    some = materialise(cut.withColumnRenamed("node", "cls").join(classes.select("cls", "low", "copy"), "cls"), "candidates")
    n = some.count()
    names = some.select("cls", F.col("low").alias("doc"), "copy")
    texts = own.join(F.broadcast(names) if n <= SENT else names, ["doc", "copy"]).select("cls", "text")
    sets = texts.mapInArrow(partial(_sets, size=shingle), "cls long, shingles binary").dropDuplicates(["cls"])
    sets = materialise(sets, "shingle-sets")
    block = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    met = some.withColumn("own", block).select("cls", F.explode(F.expr("transform(sequence(0, blocks - 1), x -> xxhash64(component, least(x, own), greatest(x, own)))")).alias("g"))
    groups = met.join(sets, "cls").select("g", "cls", "shingles").repartition("g").sortWithinPartitions("g")
    kept = groups.mapInArrow(partial(_verified, least=similarity), "a long, b long")
    return _labelled(classes.select(F.col("cls").alias("fp"), "low"), kept).toDF("cls", "root", "component")


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest id, all its columns; of rows with that
    id in the group one. Rows without an id come last, and each group of them keeps its own."""
    found = similar_documents(docs, id_col=id_col, text_col=text_col, **options)
    first = found.groupBy("root").agg(F.min(F.struct("doc", "copy")).alias("x")).select(F.col("x.doc").alias("__doc"), F.col("x.copy").alias("__copy")).distinct()
    own = docs.withColumns({"__doc": doc_key(id_col), "__copy": F.xxhash64(text_col)})
    return own.join(first, ["__doc", "__copy"], "left_semi").dropDuplicates(["__doc", "__copy"]).drop("__doc", "__copy")


def op5_simhash(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    known = lambda c: F.when(F.col(c) != F.lit(NULL_ID), F.col(c))
    return found.select(known("doc").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), known("component").alias("component_id"))
