"""Directional clustering of barcodes and the corrected counts that follow from it.

An edge leads from a to b if they are within the Hamming threshold and
n_a >= 2 n_b - 1. All counts are over one, so counts fall along edges, the graph has no cycle,
and n - 1 halves at least at every step: paths are short. A barcode's label is its best ancestor
(most reads, then the smaller sequence), itself included. Labels spread along the edges until
nothing changes, in at most log2(largest count) + 2 rounds; each round is written to shared storage.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandlake.operators.similarity import similar_pairs
from strandlake.storage import materialise


def directional_edges(counts: DataFrame, *, threshold: int = 3, length: int = 18) -> DataFrame:
    """(sample, src, dst, n_src, n_dst, hamming) from (sample, gbc, read_counts), counts over one."""
    nodes = counts.where("read_counts > 1")
    a = nodes.select("sample", F.col("gbc").alias("src"), F.col("read_counts").alias("n_src"))
    b = nodes.select("sample", F.col("gbc").alias("dst"), F.col("read_counts").alias("n_dst"))
    rule = (F.col("src") != F.col("dst")) & (F.col("n_src") >= 2 * F.col("n_dst") - 1)
    return similar_pairs(a, b, by=["sample"], left_col="src", right_col="dst", threshold=threshold, length=length, condition=rule).select("sample", "src", "dst", "n_src", "n_dst", "hamming")


def labels(counts: DataFrame, *, threshold: int = 3, length: int = 18) -> DataFrame:
    """(sample, gbc, read_counts, correct, n_correct): each barcode over one read and its cluster's first."""
    nodes = counts.where("read_counts > 1")
    edges = materialise(directional_edges(counts, threshold=threshold, length=length).select("sample", "src", "dst"), "edges")
    # the rank sorts as (reads descending, sequence ascending); only nodes with an edge have to move
    rank = F.struct((-F.col("read_counts")).alias("minus"), F.col("gbc").alias("gbc"))
    now = materialise(nodes.select("sample", "gbc", "read_counts", rank.alias("best")), "labels")
    top = now.agg(F.max("read_counts")).first()[0] or 1
    for _ in range(int(math.log2(top)) + 2):
        sent = edges.join(now.select("sample", F.col("gbc").alias("src"), F.col("best").alias("sent")), ["sample", "src"])
        got = sent.groupBy("sample", F.col("dst").alias("gbc")).agg(F.min("sent").alias("sent"))
        then = now.join(got, ["sample", "gbc"], "left").select("sample", "gbc", "read_counts", F.least("best", "sent").alias("best"), F.coalesce(F.col("sent") < F.col("best"), F.lit(False)).alias("moved"))
        then = materialise(then, "labels")
        now = then.drop("moved")
        if not then.where("moved").limit(1).count():
            break
    return now.select("sample", "gbc", "read_counts", F.col("best.gbc").alias("correct"), (-F.col("best.minus")).alias("n_correct"))


def near_edges(counts: DataFrame, *, threshold: int = 3, length: int = 18) -> DataFrame:
    """(sample, src, dst) both ways for every two barcodes, over one read each, within the threshold."""
    nodes = counts.where("read_counts > 1")
    a, b = (nodes.select("sample", F.col("gbc").alias(c)) for c in ("src", "dst"))
    return similar_pairs(a, b, by=["sample"], left_col="src", right_col="dst", threshold=threshold, length=length, condition=F.col("src") != F.col("dst")).select("sample", "src", "dst")


def _components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(sample, gbc, read_counts, best): each barcode's best one that edges reach.

    A round takes the best of the neighbours' labels, and then that label's own one, so that long chains shrink by doubling.
    """
    rank = F.struct((-F.col("read_counts")).alias("minus"), F.col("gbc").alias("gbc"))
    now = materialise(nodes.select("sample", "gbc", "read_counts", rank.alias("best")), "components")
    while True:
        sent = edges.join(now.select("sample", F.col("gbc").alias("src"), F.col("best").alias("sent")), ["sample", "src"])
        got = sent.groupBy("sample", F.col("dst").alias("gbc")).agg(F.min("sent").alias("sent"))
        near = now.join(got, ["sample", "gbc"], "left").select("sample", "gbc", "read_counts", F.least("best", "sent").alias("near"), F.col("best").alias("old"))
        own = near.select("sample", F.col("gbc").alias("at"), F.col("near").alias("far"))
        jumped = near.withColumn("at", F.col("near.gbc")).join(own, ["sample", "at"], "left").select("sample", "gbc", "read_counts", F.least("near", "far").alias("best"), "old")
        then = materialise(jumped.select("sample", "gbc", "read_counts", "best", (F.col("best") < F.col("old")).alias("moved")), "components")
        now = then.drop("moved")
        if then.where("moved").isEmpty():
            return now


METHODS = ("directional", "unique", "percentile", "cluster", "adjacency")


def grouped(counts: DataFrame, method: str = "directional", *, threshold: int = 3, length: int = 18) -> DataFrame:
    """(sample, gbc, read_counts, correct, n_correct) as :func:`labels`, by one of the usual methods.

    'unique' and 'percentile' leave each barcode as it is, the latter only those with over a hundredth of the median of reads. 'cluster' gives all
    barcodes that are connected to the best of them. 'adjacency' takes of these the fewest, best first, from which all others are one edge away;
    each other one goes to the first of its neighbours among them.
    """
    nodes = counts.where("read_counts > 1").select("sample", "gbc", "read_counts")
    alone = nodes.withColumns({"correct": F.col("gbc"), "n_correct": F.col("read_counts")})
    match method:
        case "directional":
            return labels(counts, threshold=threshold, length=length)
        case "unique":
            return alone
        case "percentile":
            sizes = nodes.groupBy("sample", "read_counts").agg(F.count(F.lit(1)).alias("n"))
            least = sizes.groupBy("sample").agg((F.percentile("read_counts", F.lit(0.5), F.col("n")) / 100).alias("least"))
            return alone.join(least, "sample").where("read_counts > least").drop("least")
        case "cluster" | "adjacency":
            edges = materialise(near_edges(counts, threshold=threshold, length=length), "edges")
            reached = _components(nodes, edges)
        case _:
            raise ValueError(f"unknown method {method!r}: {', '.join(METHODS)}")
    if method == "cluster":
        return reached.select("sample", "gbc", "read_counts", F.col("best.gbc").alias("correct"), (-F.col("best.minus")).alias("n_correct"))
    ranked = reached.select("sample", "gbc", "read_counts", F.col("best.gbc").alias("of"), F.row_number().over(Window.partitionBy("sample", "best.gbc").orderBy(F.desc("read_counts"), "gbc")).alias("place"))
    ranked = materialise(ranked, "ranked")
    first = edges.join(ranked.select("sample", F.col("gbc").alias("src"), F.struct("place", F.col("gbc").alias("gbc"), F.col("read_counts").alias("n")).alias("near")), ["sample", "src"])
    nearest = ranked.join(first.groupBy("sample", F.col("dst").alias("gbc")).agg(F.min("near").alias("near")), ["sample", "gbc"], "left")
    covered = nearest.withColumn("cover", F.least("place", "near.place"))
    leads = covered.withColumn("leads", F.max("cover").over(Window.partitionBy("sample", "of")))
    own = F.col("place") <= F.col("leads")
    return leads.select("sample", "gbc", "read_counts", F.when(own, F.col("gbc")).otherwise(F.col("near.gbc")).alias("correct"), F.when(own, F.col("read_counts")).otherwise(F.col("near.n")).alias("n_correct"))


def correction(labelled: DataFrame) -> DataFrame:
    """(sample, correct, degenerated, n_reads_correct, n_reads_degenerated): the members of clusters of two or more."""
    return labelled.where("gbc <> correct").select("sample", "correct", F.col("gbc").alias("degenerated"), F.col("n_correct").alias("n_reads_correct"), F.col("read_counts").alias("n_reads_degenerated"))


def corrected_counts(corrections: DataFrame) -> DataFrame:
    """(sample, gbc, read_count): reads of each cluster's first with those of its members."""
    return corrections.groupBy("sample", F.col("correct").alias("gbc")).agg((F.first("n_reads_correct") + F.sum("n_reads_degenerated")).alias("read_count"))


def final_pool(counts: DataFrame, corrections: DataFrame, *, min_n_reads: int, spikeins: DataFrame | None = None) -> DataFrame:
    """(sample, gbc, read_count): the whitelist.

    Clusters are summed before spike-ins leave, so a spike's reads stay with the barcode they were
    corrected to; a cluster whose first is a spike, or whose members all are, falls back to raw counts.
    """
    summed = corrected_counts(corrections)
    nodes = counts.where("read_counts > 1").select("sample", "gbc", F.col("read_counts").alias("read_count"))
    left = corrections
    if spikeins is not None:
        spikes = spikeins.select("gbc").distinct()
        nodes = nodes.join(spikes, "gbc", "left_anti").select("sample", "gbc", "read_count")
        left = left.join(spikes.withColumnRenamed("gbc", "correct"), "correct", "left_anti").join(spikes.withColumnRenamed("gbc", "degenerated"), "degenerated", "left_anti")
    firsts = left.select("sample", F.col("correct").alias("gbc")).distinct()
    clustered = firsts.unionByName(left.select("sample", F.col("degenerated").alias("gbc")))
    alone = nodes.join(clustered, ["sample", "gbc"], "left_anti")
    pool = summed.join(firsts, ["sample", "gbc"], "left_semi").unionByName(alone)
    return pool.where(F.col("read_count") >= min_n_reads)
