"""Exact substring dedup by bucket-pointer refinement over sampled suffixes.

Bytes covered by a string of ``SIZE`` bytes that starts anywhere else too are told. Not every suffix is
sorted: a window of ``SIZE`` bytes is told by its anchor, the place of its least hash of ``GRAM`` bytes (the
leftmost of equals), and equal windows have equal anchors at equal offsets. About 2 / (SIZE - GRAM) of all places are anchors;
each speaks for the run of windows that it is the anchor of.

1. Initial buckets: anchors with equal grams. An anchor alone in its bucket has no repeated window.
2. Within a bucket, anchors whose whole run of windows is the same are settled: all their windows are repeated.
3. What is left of a bucket is refined: the range of offsets between window and anchor is quartered, and a quarter's bucket is named by
   its parent's bucket and the bytes at the later offsets that all windows of this quarter hold. An anchor alone in the new
   bucket has no repeated window there; equal runs are settled; the rest is refined in the same way, so each round uses the
   buckets of the one before, down to single offsets. One of each kind of settled runs stays, for others to meet.
   Buckets of up to ``BUCKET`` kinds of runs are finished in one go, by comparing their windows byte by byte.

Rounds of refinement are Spark aggregations and joins, with sums made before the shuffle, so that a bucket that a third of all
documents share is in no one task; there are at most four, for offsets are below ``SIZE``.

A row's key is a 64-bit hash of its id and text, with a seed for which no two different rows share one. Grams and runs are compared by 64-bit
hashes of both: two different runs count as one only if both agree.

Defined results: a null text is empty; a text shorter than ``SIZE`` bytes keeps all; rows with the same id are texts of
their own, also equal ones, which then repeat each other; rows without an id take part as others; a very long text is taken whole, in
parts that overlap; strings that overlap their own repetition count ("aaaa..."); an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm.runtime import materialise, mix64, ship_code

SIZE = 200
GRAM = 32
#: Kinds of runs in a bucket that are compared in one go.
BUCKET = 256
#: Bytes that are hashed at a time in a worker.
CHUNK = 1 << 19
STEP = np.uint64(0x9E3779B97F4A7C15)
PLACE = np.uint64(0xFFFFFF)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the bytes from each place; ``gram`` is a power of two."""
    h, n = mix64(data, 1), 1
    with np.errstate(over="ignore"):
        while n < gram:
            h = (h[:-n] * STEP) ^ (h[n:] + (h[:-n] >> np.uint64(31)))
            n *= 2
    return mix64(h, 2)


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` values."""
    found, done, now, n = None, 0, values, 1
    while done < width:
        if width & n:
            found = now if found is None else np.minimum(found[: len(now) - done], now[done:])
            done += n
        if done < width:
            now = np.minimum(now[:-n], now[n:])
            n *= 2
    return found


def anchors(data: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of the bytes its anchor's place, and the hash of each gram."""
    h = gram_hashes(data, gram)
    placed = (h & ~PLACE) | np.arange(len(h), dtype=np.uint64)
    return (least(placed, size - gram + 1) & PLACE).astype(np.int64), h


def _pieces(keys: list[int], texts: list[bytes], size: int) -> Iterator[tuple[bytes, list[tuple[int, int, int, int]]]]:
    """Some bytes, and for each text in them its key, place there, first byte and number of windows."""
    held, parts, n = [], [], 0
    for key, text in zip(keys, texts):
        for lo in range(0, len(text) - size + 1, CHUNK):
            piece = text[lo : lo + CHUNK + size - 1]
            held.append(piece)
            parts.append((key, n, lo, len(piece) - size + 1))
            n += len(piece)
            if n >= CHUNK:
                yield b"".join(held), parts
                held, parts, n = [], [], 0
    if parts:
        yield b"".join(held), parts


def _anchored(batches: Iterator[pa.RecordBatch], *, size: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            cut = batch.slice(lo, 200)
            texts = [x or b"" for x in cut.column("text").cast(pa.binary()).to_pylist()]
            for data, parts in _pieces(cut.column("r").to_pylist(), texts, size):
                own, h = anchors(np.frombuffer(data, np.uint8), size, gram)
                inside = np.zeros(len(own) + 1, np.int64)
                keys, at, shift, count = (np.array(x, np.int64) for x in zip(*parts))
                inside[at] += 1
                inside[at + count] -= 1
                windows = np.flatnonzero(np.cumsum(inside[:-1]))
                part = np.searchsorted(at, windows, "right") - 1
                new = np.flatnonzero(np.concatenate(([True], (np.diff(own[windows]) != 0) | (np.diff(part) != 0))))
                first, last = windows[new], windows[np.concatenate((new[1:] - 1, [len(windows) - 1]))]
                anchor, part = own[first], part[new]
                runs = np.array([xxhash.xxh3_64_intdigest(data[a : b + size]) for a, b in zip(first.tolist(), last.tolist())], np.uint64)
                place = ((anchor - at[part] + shift[part]) << 16) | ((anchor - first) << 8) | (anchor - last)
                yield pa.record_batch({"g": h[anchor].view(np.int64), "c": runs.view(np.int64), "r": keys[part], "place": place})


def anew(key: str) -> Column:
    """The key, as an expression that Spark doesn't take for the column it is partitioned by."""
    return F.col(key).bitwiseXOR(F.lit(0)).alias(key)


def _sized(keyed: DataFrame) -> DataFrame:
    """Rows (b, u, ...) with the rows of their (b, u), the kinds of runs in b and whether they stand for their kind.

    Counts are joined by keys made anew, so that Spark shuffles them once more: with an aggregate's own partitioning it couldn't
    split the rows of a hot bucket.
    """
    ref = F.struct("r", "a", "p1", "p2")
    kinds = keyed.groupBy("b", "u").agg(F.count(F.lit(1)).alias("same"), F.min(ref).alias("stands"))
    buckets = kinds.groupBy("b").agg(F.count(F.lit(1)).alias("kinds"), F.sum("same").alias("rows"))
    counts = kinds.join(buckets.where("rows > 1"), "b").select(anew("b"), anew("u"), "same", "stands", "kinds")
    return keyed.join(counts, ["b", "u"]).withColumn("stands", F.col("stands") == ref)


GOES_ON = "kinds > 1 and (same = 1 or stands)"


def _span(size: int) -> list[Column]:
    """The bytes that windows of a run cover."""
    return [F.col("r"), (F.col("a") - F.col("p2")).alias("start"), (F.col("a") - F.col("p1") + size).alias("end")]


def _cut(batches: Iterator[pa.RecordBatch], *, size: int) -> Iterator[pa.RecordBatch]:
    """The bytes of each listed run."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            cut = batch.slice(lo, 200)
            lists = cut.column("runs")
            flat, counts = lists.flatten(), np.diff(lists.offsets.to_numpy())
            texts = cut.column("text").cast(pa.binary()).to_pylist()
            cols = {n: flat.field(n) for n in ("b", "a", "p1", "p2", "kinds")}
            row = np.repeat(np.arange(cut.num_rows), counts)
            ends = zip(row.tolist(), (cols["a"].to_numpy() - cols["p2"].to_numpy()).tolist(), (cols["a"].to_numpy() - cols["p1"].to_numpy() + size).tolist())
            ctx = pa.array([texts[k][a:b] for k, a, b in ends], pa.binary())
            yield pa.record_batch({"b": cols["b"], "r": cut.column("r").take(pa.array(row)), "a": cols["a"], "p1": cols["p1"], "p2": cols["p2"], "kinds": cols["kinds"], "ctx": ctx})


def _finished(batches: Iterator[pa.RecordBatch], *, size: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by b: the bytes of windows that another run of the bucket has at the same offset."""

    def told(group: list[tuple]) -> list[tuple]:
        seen: dict[tuple[int, bytes], int] = {}
        for _, _, p1, p2, ctx in group:
            for k in range(p2 - p1 + 1):
                w = (p2 - k, ctx[k : k + size])
                seen[w] = seen.get(w, 0) + 1
        out = []
        for r, a, p1, p2, ctx in group:
            began = -1
            for k in range(p2 - p1 + 2):
                again = k <= p2 - p1 and seen[p2 - k, ctx[k : k + size]] > 1
                if again and began < 0:
                    began = k
                elif not again and began >= 0:
                    out.append((r, a - p2 + began, a - p2 + k - 1 + size))
                    began = -1
        return out

    now, group, out = None, [], []
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("b", "r", "a", "p1", "p2", "ctx")))
        for b, *row in rows:
            if b != now:
                out += told(group) if len(group) > 1 else []
                now, group = b, []
            group.append(row)
        if len(out) > 10_000:
            yield _spans(out)
            out = []
    out += told(group) if len(group) > 1 else []
    if out:
        yield _spans(out)


def _spans(out: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(x, pa.int64()) for x in zip(*out)], ["r", "start", "end"])


def _divided(rows: DataFrame, size: int) -> DataFrame:
    """Runs (b, o1, o2, r, a, p1, p2, ctx) in the quarters of their range of offsets, with b and u anew."""
    width = F.col("o2") - F.col("o1") + 1
    cut = [(F.col("o1") + F.floor(width * k / 4)).cast("int") for k in range(5)]
    quarters = F.array(*(F.struct(a.alias("q1"), (b - 1).alias("q2")) for a, b in zip(cut, cut[1:])))
    both = rows.withColumn("part", F.explode(quarters)).select("*", F.greatest("part.q1", "p1").alias("n1"), F.least("part.q2", "p2").alias("n2")).where("n1 <= n2 and part.q1 <= part.q2")
    held = both.withColumn("cut", F.substring("ctx", F.col("p2") - F.col("n2") + 1, F.lit(size) + F.col("n2") - F.col("n1")))
    core = F.substring("cut", F.col("n2") - F.col("part.q1") + 1, F.lit(size) - F.col("part.q2") + F.col("part.q1"))
    return held.select(
        F.xxhash64("b", "part.q1", core).alias("b"), F.xxhash64("n1", "n2", "cut").alias("u"), F.col("part.q1").alias("o1"), F.col("part.q2").alias("o2"), "r", "a", F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("cut").alias("ctx")
    )


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(r, doc_id, text): r is the same for equal rows only."""
    for seed in range(16):
        rows = docs.select(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("r"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        other = F.xxhash64(F.col("text"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(seed))
        if rows.groupBy("r").agg(F.min(other).alias("x"), F.max(other).alias("y")).where("x <> y").isEmpty():
            return rows
    raise RuntimeError("no seed gives all rows keys of their own")


def repeated_spans(rows: DataFrame, *, size: int = SIZE, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """(r, start, end) in bytes from rows (r, text): what repeated strings cover, in pieces that may overlap."""
    placed = rows.select("r", "text").mapInArrow(partial(_anchored, size=size, gram=gram), "g long, c long, r long, place long")
    multi = placed.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("x"), F.max("c").alias("y")).where("n > 1").select(anew("g"), (F.col("x") == F.col("y")).alias("settled"))
    at, low, high = F.shiftright("place", 16), F.col("place").bitwiseAND(255), F.shiftright("place", 8).bitwiseAND(255)
    live = placed.join(multi, "g").select(F.col("g").alias("b"), F.col("c").alias("u"), "r", at.alias("a"), low.cast("int").alias("p1"), high.cast("int").alias("p2"), "settled")
    live = materialise(live, "anchors")
    sized = materialise(_sized(live.where("not settled").drop("settled")), "buckets")
    spans = live.where("settled").select(_span(size)).unionByName(sized.where("same > 1").select(_span(size)))
    lists = sized.where(GOES_ON).groupBy("r").agg(F.collect_list(F.struct("b", "a", "p1", "p2", F.col("kinds").cast("int").alias("kinds"))).alias("runs"))
    texts = rows.select("r", "text").join(lists, "r")
    runs = materialise(texts.mapInArrow(partial(_cut, size=size), "b long, r long, a long, p1 int, p2 int, kinds int, ctx binary"), "runs")
    fine = ["b", "r", "a", "p1", "p2", "ctx"]
    small = [runs.where(F.col("kinds") <= bucket).select(fine)]
    large = runs.where(F.col("kinds") > bucket).select(*fine, F.lit(0).alias("o1"), F.lit(size - gram).alias("o2"))
    for _ in range(size.bit_length()):
        if large.isEmpty():
            break
        now = materialise(_sized(_divided(large, size)), "parts")
        spans = spans.unionByName(now.where("same > 1").select(_span(size)))
        small.append(now.where(GOES_ON).where(F.col("kinds") <= bucket).select(fine))
        large = now.where(GOES_ON).where(F.col("kinds") > bucket).select(*fine, "o1", "o2")
    for part in small:
        spans = spans.unionByName(part.repartition("b").sortWithinPartitions("b").mapInArrow(partial(_finished, size=size), "r long, start long, end long"))
    return spans


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            cut = batch.slice(lo, 200)
            kept, united = [], []
            for text, spans in zip(cut.column("text").cast(pa.binary()).to_pylist(), cut.column("spans").to_pylist()):
                text, told, parts, at = text or b"", [], [], 0
                for s in sorted((s["start"], s["end"]) for s in spans or ()):
                    if told and s[0] <= told[-1][1]:
                        told[-1] = (told[-1][0], max(told[-1][1], s[1]))
                    else:
                        told.append(s)
                for a, b in told:
                    parts.append(text[at:a])
                    at = b
                kept.append(b"".join([*parts, text[at:]]))
                united.append([{"start": a, "end": b} for a, b in told])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch({"doc_id": cut.column("doc_id"), "n_bytes": cut.column("n_bytes"), "spans": pa.array(united, kind), "kept": pa.array(kept, pa.binary())})


def remove_repeats(docs: DataFrame, *, size: int = SIZE, gram: int = GRAM, bucket: int = BUCKET, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of each row: the text's bytes, the maximal runs (start, end) that
    strings of ``size`` bytes found elsewhere too cover, and the other bytes in one piece, which may cut a letter."""
    ship_code(docs.sparkSession)
    rows = _keyed(docs, id_col, text_col)
    spans = repeated_spans(rows, size=size, gram=gram, bucket=bucket).distinct()
    found = spans.groupBy("r").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = rows.join(found, "r", "left").select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "spans")
    id_type = joined.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(_kept, f"doc_id {id_type}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def op13_suffixes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256): a row for each document."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return remove_repeats(docs).select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
