"""Column functions on DNA strings and on counts; all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits a base takes in a packed sequence, and the longest sequence that a long holds.
BASE_BITS = 3
MAX_PACKED = 21


def search_patterns(anchor: str) -> list[str]:
    """The anchor with each base in turn free, each running on to the end of the read."""
    return [f"{anchor[:i]}.{anchor[i + 1:]}.*" for i in range(len(anchor))]


def anchor_regex(anchor: str) -> str:
    """One regular expression for all search patterns.

    One base is free, so one half of the anchor stands as it is: places without either half are passed
    by at once.
    """
    half = len(anchor) // 2
    return f"(?:{'|'.join(p.removesuffix('.*') for p in search_patterns(anchor))}).*" if half < 4 else f"(?={anchor[:half]}|.{{{half}}}{anchor[half:]})(?:{'|'.join(p.removesuffix('.*') for p in search_patterns(anchor))}).*"


def anchored(read: Column, anchor: str) -> Column:
    """From the leftmost place where the anchor fits but for one base to the read's end; null if none."""
    return F.nullif(F.regexp_extract(read, anchor_regex(anchor), 0), F.lit(""))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTN", "TGCAN"))


def checked_reverse_complement(seq: Column) -> Column:
    """Other letters than A, C, G, T and N are an error."""
    return F.when(F.assert_true(seq.rlike("^[ACGTN]*$") | seq.isNull(), F.lit("not a DNA sequence")).isNull(), reverse_complement(seq))


def packed(seq: Column) -> Column:
    """Three bits a base (A, T, C, G, N: 1 to 5, other 0), the first base highest; up to 21 bases."""
    codes = F.transform(F.split(F.translate(seq, "ATCGN", "12345"), ""), lambda c: F.coalesce(c.try_cast("long"), F.lit(0).cast("long")))
    return F.aggregate(codes, F.lit(0).cast("long"), lambda acc, c: F.shiftleft(acc, BASE_BITS).bitwiseOR(c))


def packed_hamming(a: Column, b: Column) -> Column:
    """Positions in which two packed sequences of one length differ."""
    d = a.bitwiseXOR(b)
    low = sum(1 << (BASE_BITS * i) for i in range(MAX_PACKED))
    return F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseOR(F.shiftrightunsigned(d, 2)).bitwiseAND(F.lit(low)))


def hamming(a: Column, b: Column) -> Column:
    """Positions that differ, up to the shorter one's end; any length."""
    n = F.least(F.length(a), F.length(b))
    same = F.zip_with(F.split(F.left(a, n), ""), F.split(F.left(b, n), ""), lambda x, y: (x != y).cast("int"))
    return F.when(n == 0, F.lit(0)).otherwise(F.aggregate(same, F.lit(0), lambda s, v: s + v))


def poisson_upper_tail(observed: Column, mean: Column) -> Column:
    """P(X >= observed) for a Poisson variable, as 1 less the sum of the terms below, at least 0.

    The terms are summed by their logarithms' recurrence, so that a large mean doesn't underflow at once.
    """
    below = F.aggregate(
        F.when(observed >= 1, F.sequence(F.lit(1).cast("long"), observed.cast("long"))).otherwise(F.expr("cast(array() as array<bigint>)")),
        F.struct(F.lit(0.0).alias("sum"), (-mean).alias("log_term")),
        lambda acc, k: F.struct((acc["sum"] + F.exp(acc["log_term"])).alias("sum"), (acc["log_term"] + F.log(mean) - F.log(k.cast("double"))).alias("log_term")),
        lambda acc: acc["sum"],
    )
    return F.greatest(F.lit(0.0), 1 - below)


def minus_log10(p: Column) -> Column:
    """-log10(p); infinite at 0, where the logarithm itself would be null."""
    return F.when(p <= 0, F.lit(float("inf"))).otherwise(-F.log10(p))
