"""Row numbers over groups that are too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: First characters of a barcode that split rows of equal counts.
PREFIX = 5


def prefix(column: str, size: int = PREFIX) -> Column:
    """The first characters: sorts as the column does, null first."""
    return F.coalesce(F.substring(column, 1, size), F.lit(""))


def _offsets(keyed: DataFrame, by: list[str], names: list[str]) -> tuple[DataFrame, list[str]]:
    """For each step the rows before it (__before), and those of all (__total), with its keys under new names.

    Steps within ``by`` are summed up in one task a group. Without groups that would be one task for all, so that there only the
    values of the first step are; the others are summed up within each of these.
    """
    keys = [*by, *names]
    sizes = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    own = [f"__by{i}" for i in range(len(keys))]
    named = sizes.select(*(F.col(c).alias(o) for c, o in zip(keys, own)), "__n")
    if by or len(names) < 2:
        group = Window.partitionBy(*own[: len(by)])
        return named.select(*own, (F.sum("__n").over(group.orderBy(*own[len(by) :])) - F.col("__n")).alias("__before"), F.sum("__n").over(group).alias("__total")), own
    first = named.groupBy(own[0]).agg(F.sum("__n").alias("__n"))
    steps = first.select(F.col(own[0]).alias("__first"), (F.sum("__n").over(Window.orderBy(own[0])) - F.col("__n")).alias("__ahead"), F.sum("__n").over(Window.partitionBy()).alias("__total"))
    within = named.withColumn("__in", F.sum("__n").over(Window.partitionBy(own[0]).orderBy(*own[1:])) - F.col("__n"))
    return within.join(steps, F.col(own[0]).eqNullSafe(F.col("__first"))).select(*own, (F.col("__ahead") + F.col("__in")).alias("__before"), "__total"), own


def numbered(df: DataFrame, by: list[str], steps: list[Column], order: list[Column], *, total: bool = False) -> DataFrame:
    """The rows with ``place``: from 1 within ``by``, sorted by ``steps`` and then by ``order``; and ``total``, the rows within ``by``.

    Rows with equal steps are sorted in one task; of each step only its number of rows goes on to the
    window over ``by``. Steps sort ascending and are never null; ``order`` must settle all ties.
    """
    names = [f"__step{i}" for i in range(len(steps))]
    keyed = df.withColumns(dict(zip(names, steps)))
    before, own = _offsets(keyed, by, names)
    within = keyed.withColumn("__k", F.row_number().over(Window.partitionBy(*by, *names).orderBy(*order)))
    met = [F.col(c).eqNullSafe(F.col(o)) for c, o in zip([*by, *names], own)]
    return within.join(before, met).select(*df.columns, (F.col("__before") + F.col("__k")).alias("place"), *([F.col("__total").alias("total")] if total else []))
