"""Exact quantiles of groups that are too large for one task.

A sketch brackets each quantile: values between slightly smaller and slightly larger shares. What lies below a bracket is only
counted; the values inside, some thousandths of the group, are counted by value and sorted. If a quantile should lie
outside its bracket, brackets are widened and the count is made again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandlake.storage import materialise

#: How far a bracket reaches to both sides of a share at first, and the sketch's accuracy, which is finer.
REACH, ACCURACY = 5e-4, 10_000


def exact_quantiles(df: DataFrame, by: list[str], column: str, shares: list[float], *, reach: float = REACH) -> DataFrame:
    """(by, n, q): rows with a value, and the quantiles, interpolated between neighbours, in the order of ``shares``."""
    keys = [f"__by{i}" for i in range(len(by))]
    rows = df.where(F.col(column).isNotNull()).select(*(F.col(c).alias(k) for c, k in zip(by, keys)), F.col(column).cast("double").alias("__v"))
    while True:
        around = [x for s in shares for x in (max(0.0, s - reach), min(1.0, s + reach))]
        sketch = F.percentile_approx("__v", F.array(*map(F.lit, around)), ACCURACY)
        least = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), sketch.alias("s"), F.min("__v").alias("min"), F.max("__v").alias("max"))
        # at the ends of a group the bracket is open
        ends = [F.struct(F.lit(k).alias("k"), F.floor(s * (F.col("n") - 1)).alias("rank"), (F.col("min") if around[2 * k] == 0 else F.col("s")[2 * k]).alias("lo"), (F.col("max") if around[2 * k + 1] == 1 else F.col("s")[2 * k + 1]).alias("hi")) for k, s in enumerate(shares)]
        brackets = materialise(least.select(*keys, "n", F.array(*ends).alias("e")), "brackets")
        each = brackets.select(*(F.col(k).alias(f"{k}b") for k in keys), "e")
        met = [F.col(k).eqNullSafe(F.col(f"{k}b")) for k in keys]
        placed = rows.join(each, met) if keys else rows.crossJoin(F.broadcast(each))
        sides = placed.select(*keys, "__v", F.explode(F.filter("e", lambda e: F.col("__v") <= e["hi"])).alias("e"))
        # values below a bracket are one entry, those inside one each
        counted = sides.groupBy(*keys, "e.k", F.when(F.col("__v") >= F.col("e.lo"), F.col("__v")).alias("v")).agg(F.count(F.lit(1)).alias("c"))
        upto = counted.withColumn("upto", F.sum("c").over(Window.partitionBy(*keys, "k").orderBy(F.asc_nulls_first("v"))))
        ranks = brackets.select(*(F.col(k).alias(f"{k}b") for k in keys), F.explode("e").alias("e")).select(*(f"{k}b" for k in keys), F.col("e.k").alias("kb"), "e.rank", F.array("e.rank", F.col("e.rank") + 1).alias("two"))
        found = upto.join(ranks, [*met, F.col("k") == F.col("kb")])
        at = lambda i: F.max(F.when((F.col("upto") > F.col("two")[i]) & (F.col("upto") - F.col("c") <= F.col("two")[i]), F.coalesce("v", F.lit(float("-inf")))))
        picked = found.groupBy(*keys, "k").agg(at(0).alias("low"), at(1).alias("high"))
        told = materialise(brackets.select(*(F.col(k).alias(f"{k}b") for k in keys), "n", F.explode("e").alias("e")).select("*", F.col("e.k").alias("kb")).join(picked, [*met, F.col("k") == F.col("kb")], "left"), "quantiles")
        last = F.col("e.rank") + 1 >= F.col("n")
        missed = told.where(F.col("low").isNull() | (F.col("low") == float("-inf")) | (~last & (F.col("high").isNull() | (F.col("high") == float("-inf")))))
        if reach >= 1 or missed.isEmpty():
            break
        reach *= 8
    share = F.element_at(F.array(*map(F.lit, map(float, shares))), F.col("kb") + 1)
    over = share * (F.col("n") - 1) - F.col("e.rank")
    value = F.when(last | (over == 0), F.col("low")).otherwise((1 - over) * F.col("low") + over * F.col("high"))
    out = told.select(*(F.col(f"{k}b").alias(k) for k in keys), "n", "kb", value.alias("value")).groupBy(*keys, "n").agg(F.sort_array(F.collect_list(F.struct("kb", "value"))).alias("q"))
    return out.select(*(F.col(k).alias(c) for c, k in zip(by, keys)), "n", F.transform("q", lambda x: x["value"]).alias("q"))
