"""Hamming similarity joins by the pigeonhole principle.

Two sequences of one length within t substitutions agree on at least m - t of m disjoint segments.
Each side sends a key for each choice of m - t segments, equal keys meet in a hash join, and the packed
distance decides. No pair within t is missed, and no side is crossed with the other. More segments
make longer keys, which bring fewer chance pairs together, and more of them.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.functions.seq import MAX_PACKED, hamming, packed, packed_hamming


#: Bases of a key, at least where the length allows it, and keys a sequence, at most.
KEY_BASES = 8
KEYS = 20


def segments(length: int, parts: int) -> list[tuple[int, int]]:
    """(start, length) of so many segments, counted from 1, as equal as can be."""
    if parts > length:
        raise ValueError(f"{length} bases can't be cut into {parts} segments")
    short, more = divmod(length, parts)
    out, at = [], 1
    for i in range(parts):
        size = short + (i < more)
        out.append((at, size))
        at += size
    return out


def choices(length: int, threshold: int) -> list[tuple[tuple[int, int], ...]]:
    """The segments of each key: of the fewest that make keys of KEY_BASES, or of the longest keys there are."""
    best = None
    for parts in range(threshold + 1, length + 1):
        if math.comb(parts, threshold) > KEYS:
            break
        cut = segments(length, parts)
        keys = list(itertools.combinations(cut, parts - threshold))
        bases = min(sum(size for _, size in k) for k in keys)
        if best is None or bases > best[0]:
            best = bases, keys
        if bases >= KEY_BASES:
            break
    if best is None:
        raise ValueError(f"{length} bases and {threshold} substitutions need over {KEYS} keys")
    return best[1]


def _bases(seq: str | Column, key: tuple[tuple[int, int], ...]) -> Column:
    return F.concat(*(F.substring(seq, at, size) for at, size in key))


def segment_keys(seq: Column, length: int, threshold: int) -> Column:
    """One string for each key: its number and its bases."""
    return F.array(*(F.concat(F.lit(f"{i}:"), _bases(seq, key)) for i, key in enumerate(choices(length, threshold))))


def distance(a: Column, b: Column, length: int) -> Column:
    return packed_hamming(packed(a), packed(b)) if length <= MAX_PACKED else hamming(a, b)


def similar_pairs(left: DataFrame, right: DataFrame, *, by: list[str], left_col: str, right_col: str, threshold: int, length: int, condition: Column | None = None) -> DataFrame:
    """All pairs of rows with the same ``by`` columns whose sequences are within the threshold, each once.

    Only sequences of ``length`` bases take part. Columns besides ``by`` must have different names
    on the two sides. ``condition`` on both sides' columns is checked before the distance.
    The result has the columns of both and ``hamming``.
    """
    short = length <= MAX_PACKED
    keys = choices(length, threshold)

    def sent(df: DataFrame, col: str, side: str) -> DataFrame:
        own = df.where(F.length(col) == length)
        if short:
            own = own.withColumn(f"__{side}", packed(F.col(col)))
        return own.withColumn("__key", F.explode(segment_keys(F.col(col), length, threshold)))

    met = sent(left, left_col, "l").join(sent(right, right_col, "r"), [*by, "__key"])
    if condition is not None:
        met = met.where(condition)
    ham = packed_hamming(F.col("__l"), F.col("__r")) if short else hamming(F.col(left_col), F.col(right_col))
    near = met.withColumn("hamming", ham.cast("int")).where(F.col("hamming") <= threshold)
    # a pair that agrees on several keys is told by the first of them, without a second shuffle
    first = F.coalesce(*(F.when(_bases(left_col, key) == _bases(right_col, key), F.lit(f"{i}:")) for i, key in enumerate(keys)))
    return near.where(F.col("__key").startswith(first)).drop("__key", "__l", "__r")


def nearest(queries: DataFrame, reference: DataFrame, *, by: list[str], query_col: str, ref_col: str, threshold: int, length: int, order: list[Column]) -> DataFrame:
    """For each query its nearest reference sequence within the threshold: columns of ``queries``, ``ref_col`` and ``hamming``.

    Ties go by ``order``, expressions over the reference's columns that sort ascending.
    """
    pairs = similar_pairs(queries, reference, by=by, left_col=query_col, right_col=ref_col, threshold=threshold, length=length)
    rank = F.struct("hamming", *(o.alias(f"o{i}") for i, o in enumerate(order)))
    best = pairs.groupBy(*queries.columns).agg(F.min_by(F.struct(ref_col, "hamming"), rank).alias("best"))
    return best.select(*queries.columns, F.col("best")[ref_col].alias(ref_col), F.col("best.hamming").alias("hamming"))
