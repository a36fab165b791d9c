"""Packing token sequences: first-fit decreasing in randomised groups of documents.

Every document becomes its token ids and an end id. Runs longer than a sequence
are cut into whole sequences and a remainder. Documents are dealt by a hash of
their id (their text, where they have none) to groups of some thousands; each group is packed on its own: pieces in
decreasing length, each into the first bin with room, which a tournament tree over
the bins' free capacities finds in logarithmic time. A group streams through one
task in blocks of bounded size, so no group, however large, is held at once.

Defined results: a null or empty text is the end id alone; rows with the same id
are packed apart, each with its own ``start``; a very long text is many whole sequences and a remainder; an empty table gives no rows; columns
other than the id and the text are ignored, whatever their names; ties in length go
by id, then by start.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.runtime import ship_code
from strandlake.llm.tokens import encoder

#: Documents in a group, on average, and pieces in a block, at most.
GROUP_DOCS = 4096
BLOCK_PIECES = 1 << 16


class TournamentTree:
    """The bins' free capacities in the leaves; each inner node holds the larger child."""

    def __init__(self, bins: int, capacity: int):
        self.size = 1
        while self.size < max(bins, 1):
            self.size *= 2
        self.tree = [capacity] * (2 * self.size)

    def first(self, need: int) -> int:
        """The first bin with room; its capacity shrinks."""
        tree, i = self.tree, 1
        if tree[1] < need:
            raise ValueError("no bin has room")
        while i < self.size:
            i *= 2
            if tree[i] < need:
                i += 1
        bin_ = i - self.size
        tree[i] -= need
        while i > 1:
            i //= 2
            a, b = tree[2 * i], tree[2 * i + 1]
            top = a if a > b else b
            if tree[i] == top:
                break
            tree[i] = top
        return bin_


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """For each length the bin and the offset there. Bins are numbered as they are opened."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    out: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    whole = 0
    while whole < len(order) and lengths[order[whole]] == capacity:
        out[order[whole]] = (whole, 0)  # a whole bin: what the tree would find too
        whole += 1
    tree = TournamentTree(len(order) - whole, capacity)
    used: dict[int, int] = {}
    for i in order[whole:]:
        b = tree.first(lengths[i])
        at = used.get(b, 0)
        out[i] = (whole + b, at)
        used[b] = at + lengths[i]
    return out


def _pieces(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    encode = encoder(path, leading_space=False)
    end = array("H", [end_id]).tobytes()
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            part = batch.slice(lo, 512)
            ids = [x + end for x in encode([t or "" for t in part.column(2).to_pylist()])]
            row, start, data = [], [], []
            for i, x in enumerate(ids):
                for at in range(0, len(x) // 2, capacity):
                    row.append(i)
                    start.append(at)
                    data.append(x[2 * at : 2 * (at + capacity)])
            take = pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(take), part.column(1).take(take), pa.array(start, pa.int64()),
                    pa.array([len(ids[i]) // 2 for i in row], pa.int64()), pa.array(data, pa.binary()),
                ],
                ["__group", "doc_id", "start", "doc_tokens", "ids16"],
            )


def _packed(batches: Iterator[pa.RecordBatch], capacity: int, block: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; a block ends where the group ends or is full."""
    held: list[pa.RecordBatch] = []
    count, group, base = 0, None, 0

    def packed() -> Iterator[pa.RecordBatch]:
        nonlocal base
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        data = rows.column(4)
        lengths = [len(x) // 2 for x in data.to_pylist()]
        placed = first_fit_decreasing(lengths, capacity)
        bins = np.array([b for b, _ in placed], dtype=np.int64)
        sequence = (np.int64(group) << np.int64(36)) + base + bins
        base += int(bins.max()) + 1
        at = pa.array([o for _, o in placed], pa.int64())
        for lo in range(0, rows.num_rows, 1024):
            part = rows.slice(lo, 1024)
            wide = [np.frombuffer(x, "<u2").astype("<u4").tobytes() for x in part.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(1), part.column(2), pa.array(lengths[lo : lo + 1024], pa.int64()), part.column(3), pa.array(sequence[lo : lo + 1024]), at.slice(lo, 1024), pa.array(wide, pa.binary())],
                ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )
        held.clear()

    for batch in batches:
        groups = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi == lo:
                continue
            if groups[lo] != group:
                if held:
                    yield from packed()
                count, group, base = 0, int(groups[lo]), 0
            while lo < hi:
                n = min(hi - lo, block - count)
                held.append(batch.slice(lo, n))
                count, lo = count + n, lo + n
                if count == block:
                    yield from packed()
                    count = 0
    if held:
        yield from packed()


def pack(docs: DataFrame, tokenizer: str, *, end_id: int = 1, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", group_docs: int = GROUP_DOCS, seed: int = 7) -> DataFrame:
    """Pieces of documents and their places: doc_id, start, length, doc_tokens, sequence_id,
    offset and ``ids`` (little-endian unsigned 32-bit, the piece's own tokens).

    The pieces of a sequence lie one behind another from 0; what follows the last
    one up to ``capacity`` is padding.
    """
    spark = docs.sparkSession
    ship_code(spark)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    groups = max(1, -(-own.count() // group_docs))
    dealt = own.select(F.pmod(F.xxhash64("doc_id", F.lit(seed), F.when(F.col("doc_id").isNull(), F.xxhash64("text"))), F.lit(groups)).alias("__group"), "doc_id", "text")
    pieces = dealt.mapInArrow(partial(_pieces, path=tokenizer, end_id=end_id, capacity=capacity), "__group long, doc_id long, start long, doc_tokens long, ids16 binary")
    sorted_ = pieces.repartition("__group").sortWithinPartitions("__group", "doc_id", "start", "ids16")
    return sorted_.mapInArrow(partial(_packed, capacity=capacity, block=BLOCK_PIECES), "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def op1_packing(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The registered query's columns, from the pieces themselves."""
    return pack(docs, tokenizer).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
