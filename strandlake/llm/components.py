"""Connected components of an edge table, by alternating star contraction.

Each round links every node's larger neighbours to its smallest one (large star) and
its smaller ones to the smallest (small star), until nothing changes. Each round's edges are
written to the shared folder, so the lineage stays short and survives lost executors.
Hot nodes don't gather in one task: minima are pre-aggregated, and neighbours are joined
with their minimum, not collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.runtime import drop, materialise

ROUNDS = 60
#: Edges of a file between rounds: few edges aren't written in as many files as there are partitions.
FILE_EDGES = 200_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (a, b), any direction and distinct; the star around each node's minimum."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if large else both.where("b < a")
    low = near.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    if large:
        moved = near.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        moved = near.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(low.select("a", F.col("low").alias("b")))
    return moved.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component): for each node with an edge the smallest node it can reach.

    ``edges`` has two long columns, a and b; loops and repeats are allowed.
    """
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)

    def state(e: DataFrame):
        r = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        return r["n"], r["x"]

    was = state(now)
    if not was[0]:
        return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for _ in range(ROUNDS):
        # a round's edges are no more than those before it, which are counted
        parts = max(1, was[0] // FILE_EDGES)
        star = _star(_star(now, True), False)
        old, now = now, materialise(star.coalesce(parts) if parts < star.sparkSession.sparkContext.defaultParallelism else star, label)
        drop(old)
        is_ = state(now)
        if is_ == was:
            break
        was = is_
    else:
        raise RuntimeError("components didn't settle")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
