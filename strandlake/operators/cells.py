"""From droplet reads to cells: barcodes matched to a list by posterior, UMIs collapsed, cells told from ambient droplets.

Barcodes one substitution apart meet by a key for each place left free, in a hash join; two of them share exactly one such key. Nothing
is compared all with all, and what is counted is counted before the shuffle.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandlake.operators.ranks import numbered, prefix
from strandlake.storage import materialise


def free_places(seq: str, length: int) -> Column:
    """The sequence with each place in turn left free: (at, key)."""
    return F.transform(F.sequence(F.lit(1), F.lit(length)), lambda i: F.struct(i.alias("at"), F.overlay(seq, F.lit("."), i).alias("key")))


def match_barcodes(r1: DataFrame, whitelist: DataFrame, *, by: tuple[str, ...] = (), min_posterior: float = 0.975, cell_length: int = 16, umi_length: int = 12) -> DataFrame:
    """(by, read_id, CB, UB, posterior) of first reads (by, read_id, seq, qual): cell bases, then UMI bases.

    A listed barcode is its own match. Another one, with at most one N, has as candidates the listed ones a single
    place away. A candidate weighs its exact reads of the group plus one, times the chance that its place was misread; the
    heaviest is the match if its share of all weights is ``min_posterior`` or more. Reads that are too short have none.
    """
    by = list(by)
    cut = r1.select(*by, "read_id", F.substring("seq", 1, cell_length).alias("CR"), F.substring("qual", 1, cell_length).alias("CQ"), F.substring("seq", cell_length + 1, umi_length).alias("UB")).where(F.length("CR") == cell_length)
    cut = materialise(cut, "first-reads")  # read for the counts, the exact matches and the others
    listed = materialise(whitelist.select("CB").distinct(), "listed-barcodes")
    seen = materialise(cut.groupBy(*by, "CR").agg(F.count(F.lit(1)).alias("n")), "seen-barcodes")
    exact = seen.join(listed, F.col("CR") == F.col("CB")).select(*by, "CB", "n")
    unknown = F.length("CR") - F.length(F.replace("CR", F.lit("N"), F.lit("")))
    rest = seen.where(unknown <= 1).join(exact.select(*by, F.col("CB").alias("CR")), [*by, "CR"], "left_anti")
    own = F.filter(free_places("CR", cell_length), lambda x: (unknown == 0) | (x["at"] == F.instr("CR", "N")))
    keys = listed.select("CB", F.explode(free_places("CB", cell_length)).alias("x")).select("CB", F.col("x.key").alias("key"))
    near = rest.select(*by, "CR", F.explode(own).alias("x")).select(*by, "CR", "x.at", "x.key").join(keys, "key").join(exact.withColumnRenamed("n", "reads"), [*by, "CB"], "left")
    candidates = near.groupBy(*by, "CR").agg(F.sort_array(F.collect_list(F.struct("CB", "at", F.coalesce("reads", F.lit(0)).alias("reads")))).alias("candidates"))
    misread = lambda at: F.pow(F.lit(10.0), -(F.ascii(F.substring("CQ", at, F.lit(1))) - 33) / 10)
    # a generator keeps the weights from being computed again for each use
    weights = F.transform("candidates", lambda c: (c["reads"] + 1) * misread(c["at"]))
    weighed = cut.join(candidates, [*by, "CR"]).select(*by, "read_id", "UB", "candidates", F.explode(F.array(weights)).alias("weights"))
    best = F.array_max("weights")
    told = weighed.select(
        *by, "read_id", F.element_at("candidates", F.array_position("weights", best).cast("int"))["CB"].alias("CB"), "UB", (best / F.aggregate("weights", F.lit(0.0), lambda n, x: n + x)).alias("posterior")
    ).where(F.col("posterior") >= min_posterior)
    same = cut.join(exact.select(*by, F.col("CB").alias("CR")), [*by, "CR"]).select(*by, "read_id", F.col("CR").alias("CB"), "UB", F.lit(1.0).alias("posterior"))
    return same.unionByName(told)


def collapse_umis(reads: DataFrame, *, group: tuple[str, ...] = ("sample", "CB", "gene"), multi_gene: bool = False, umi_length: int = 12) -> DataFrame:
    """(group, UB, reads): molecules after correction of UMIs within a cell and gene.

    A UMI becomes the one with most reads of those at most one substitution away, itself included (ties: the smaller one). It is
    corrected once, by the counts before any correction: its reads don't follow where that one goes. UMIs of other letters or of
    one letter only don't count. With ``multi_gene`` a UMI that a cell has in several genes stays in the one with most reads, and in none if
    two have as many; the gene is the last of ``group``.
    """
    group = list(group)
    good = reads.where(F.col("UB").rlike("^[ACGT]+$") & ~F.col("UB").rlike("^(A+|C+|G+|T+)$") & (F.length("UB") == umi_length))
    counts = good.groupBy(*group, "UB").agg(F.count(F.lit(1)).alias("n"))
    # the complement of a UMI sorts the other way round
    ranked = counts.withColumn("rank", F.struct("n", F.translate("UB", "ACGT", "TGCA").alias("turned")))
    keyed = ranked.withColumn("x", F.explode(free_places("UB", umi_length))).select(*group, "UB", "n", "rank", "x.key")
    best = keyed.withColumn("best", F.max("rank").over(Window.partitionBy(*group, "key")))
    to = best.groupBy(*group, "UB", "n").agg(F.max("best").alias("best")).select(*group, F.translate("best.turned", "TGCA", "ACGT").alias("UB"), "n")
    molecules = to.groupBy(*group, "UB").agg(F.sum("n").alias("reads"))
    if not multi_gene:
        return molecules
    cell = Window.partitionBy(*group[:-1], "UB")
    judged = molecules.withColumn("most", F.max("reads").over(cell)).where("reads = most").withColumn("ties", F.count(F.lit(1)).over(cell))
    return judged.where("ties = 1").select(*group, "UB", "reads")


def gene_counts(molecules: DataFrame) -> DataFrame:
    """(sample, CB, gene, n): UMIs."""
    return molecules.groupBy("sample", "CB", "gene").agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class CellParams:
    """Cell calling: what makes a cell by its size, which droplets are ambient, which are tested."""

    expected_cells: int = 3000
    max_percentile: float = 0.99
    max_min_ratio: float = 10
    ambient_from: int = 45_000
    ambient_to: int = 90_000
    umi_min: int = 500
    umi_min_share_of_median: float = 0.01
    max_candidates: int = 20_000
    fdr: float = 0.01
    simulations: int = 10_000
    seed: int = 1


def droplet_totals(counts: DataFrame) -> DataFrame:
    """(sample, CB, total)."""
    return counts.groupBy("sample", "CB").agg(F.sum("n").alias("total"))


def knee(totals: DataFrame, params: CellParams = CellParams()) -> DataFrame:
    """(sample, threshold): a share of the total of the droplet that stands for the largest cells."""
    rank = round(params.expected_cells * (1 - params.max_percentile)) + 1
    largest = totals.withColumn("k", F.row_number().over(Window.partitionBy("sample").orderBy(F.desc("total"), "CB"))).where(F.col("k") <= rank)
    return largest.groupBy("sample").agg(F.greatest(F.lit(1), F.floor(F.min("total") / params.max_min_ratio + 0.5)).cast("long").alias("threshold"))


def ambient_counts(counts: DataFrame, totals: DataFrame, params: CellParams = CellParams()) -> DataFrame:
    """(sample, gene, n) over the droplets of ranks that hold ambient RNA only; genes that only others have with 0."""
    placed = numbered(totals, ["sample"], [-F.col("total"), prefix("CB")], [F.col("CB")])
    ambient = placed.where((F.col("place") > params.ambient_from) & (F.col("place") <= params.ambient_to)).select("sample", "CB", F.lit(1).alias("ambient"))
    return counts.join(ambient, ["sample", "CB"], "left").groupBy("sample", "gene").agg(F.sum(F.col("n") * F.coalesce("ambient", F.lit(0))).alias("n"))


def good_turing(profile: DataFrame) -> DataFrame:
    """(sample, gene, p) from counts (sample, gene, n): shares by Good and Turing's estimate, smoothed on a log-log line.

    Genes without a count share the mass of those counted once. Counts are adjusted by neighbouring frequencies as long as these differ
    from the line by more than chance, by the line from there on. A sample without any count has no rows.
    """
    of = Window.partitionBy("sample").orderBy("r")
    freq = profile.where("n > 0").groupBy("sample", F.col("n").alias("r")).agg(F.count(F.lit(1)).alias("genes"))
    before = F.coalesce(F.lag("r").over(of), F.lit(0))
    around = freq.withColumns({"width": (F.coalesce(F.lead("r").over(of), 2 * F.col("r") - before) - before) / 2, "next": F.when(F.lead("r").over(of) == F.col("r") + 1, F.lead("genes").over(of))})
    x, y = F.log("r"), F.log(F.col("genes") / F.col("width"))
    line = around.groupBy("sample").agg(F.regr_slope(y, x).alias("slope"), F.sum(F.col("r") * F.col("genes")).alias("whole"), F.sum(F.when(F.col("r") == 1, F.col("genes")).otherwise(0)).alias("once"))
    smooth = F.col("r") * F.pow(1 + 1 / F.col("r"), F.coalesce("slope", F.lit(-1.0)) + 1)
    turing = (F.col("r") + 1) * F.col("next") / F.col("genes")
    chance = 1.96 * (F.col("r") + 1) / F.col("genes") * F.sqrt(F.col("next") * (1 + F.col("next") / F.col("genes")))
    both = around.join(line, "sample").withColumns({"smooth": smooth, "turing": turing}).withColumn("apart", F.coalesce(F.abs(F.col("turing") - F.col("smooth")) > chance, F.lit(False)))
    adjusted = both.withColumn("r_star", F.when(F.min(F.col("apart").cast("int")).over(of) == 1, F.col("turing")).otherwise(F.col("smooth")))
    held = adjusted.withColumn("sum", F.sum(F.col("genes") * F.col("r_star")).over(Window.partitionBy("sample")))
    unseen = profile.groupBy("sample").agg(F.count_if(F.col("n") == 0).alias("unseen"))
    mass = F.when(F.col("unseen") > 0, F.col("once") / F.col("whole")).otherwise(0.0)
    seen = held.join(unseen, "sample").select("sample", F.col("r").alias("n"), ((1 - mass) * F.col("r_star") / F.col("sum")).alias("p"))
    rest = line.join(unseen.where("unseen > 0"), "sample").select("sample", F.lit(0).cast("long").alias("n"), (F.greatest(F.col("once"), F.lit(1)) / F.col("whole") / F.col("unseen")).alias("p"))
    return profile.join(seen.unionByName(rest), ["sample", "n"]).select("sample", "gene", "p")


def log_factorial(n: Column) -> Column:
    """ln n!, from a table up to 20 and by Stirling's series beyond."""
    table = F.array(*(F.lit(math.lgamma(k + 1)) for k in range(21)))
    x = n.cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x * x * x)
    return F.when(n <= 20, F.element_at(table, F.least(n, F.lit(20)).cast("int") + 1)).otherwise(series)


def log_likelihoods(counts: DataFrame, shares: DataFrame) -> DataFrame:
    """(sample, CB, total, loglik): of each droplet's counts under the shares, up to a term that depends on its total only."""
    return counts.join(shares, ["sample", "gene"]).groupBy("sample", "CB").agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.log("p") - log_factorial(F.col("n"))).alias("loglik"))


def _simulated(frames: Iterator[pd.DataFrame], *, size: int, seed: int) -> Iterator[pd.DataFrame]:
    """How many of a block's simulated droplets are as unlikely as each candidate of the same total."""
    for frame in frames:
        for sample, block, p, totals, logliks in zip(frame["sample"], frame["block"], frame["p"], frame["totals"], frame["logliks"]):
            rng = np.random.default_rng([seed, zlib.crc32(sample.encode()), block])
            p, totals, logliks = np.asarray(p), np.asarray(totals), np.asarray(logliks)
            edges, logs, below = np.cumsum(p) / np.sum(p), np.log(p), np.zeros(len(totals), np.int64)
            for _ in range(size):
                drawn = np.minimum(np.searchsorted(edges, rng.random(totals.max()), "right"), len(p) - 1)
                order = np.argsort(drawn, kind="stable")
                first = np.concatenate(([0], np.flatnonzero(np.diff(drawn[order])) + 1))
                again = np.empty(len(drawn), np.int64)
                again[order] = np.arange(len(drawn)) - np.repeat(first, np.diff(np.concatenate((first, [len(drawn)])))) + 1
                curve = np.cumsum(logs[drawn] - np.log(again))
                below += curve[totals - 1] <= logliks + 1e-9
            yield pd.DataFrame({"sample": sample, "at": np.arange(len(totals)), "below": below})


def ambient_test(candidates: DataFrame, shares: DataFrame, params: CellParams = CellParams(), *, block: int = 250) -> DataFrame:
    """(sample, CB, total, p_value, fdr) of candidates (sample, CB, total, loglik): the share of droplets simulated from the shares
    that are as unlikely, and the false-discovery rate within the sample.

    Simulations are dealt out in blocks, each with a seed of its own, so the result doesn't depend on where
    they run. A task holds the shares of all genes and the totals of all candidates of a sample; both are bounded.
    """
    numbered_ = candidates.withColumn("at", F.row_number().over(Window.partitionBy("sample").orderBy("total", "CB")) - 1)
    lists = numbered_.groupBy("sample").agg(F.sort_array(F.collect_list(F.struct("at", "total", "loglik"))).alias("c"))
    model = shares.groupBy("sample").agg(F.transform(F.sort_array(F.collect_list(F.struct("gene", "p"))), lambda x: x["p"]).alias("p"))
    blocks = -(-params.simulations // block)
    work = lists.join(model, "sample").select("sample", "p", F.transform("c", lambda x: x["total"]).alias("totals"), F.transform("c", lambda x: x["loglik"]).alias("logliks"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    told = work.repartition(blocks, "sample", "block").mapInPandas(partial(_simulated, size=block, seed=params.seed), "sample string, at int, below long")
    below = told.groupBy("sample", "at").agg(F.sum("below").alias("below"))
    tested = numbered_.join(below, ["sample", "at"]).select("sample", "CB", "total", ((F.col("below") + 1) / (blocks * block + 1)).alias("p_value"))
    by_p = Window.partitionBy("sample").orderBy("p_value", "CB")
    raw = tested.withColumns({"k": F.row_number().over(by_p), "m": F.count(F.lit(1)).over(Window.partitionBy("sample"))}).withColumn("raw", F.col("p_value") * F.col("m") / F.col("k"))
    return raw.select("sample", "CB", "total", "p_value", F.least(F.lit(1.0), F.min("raw").over(Window.partitionBy("sample").orderBy(F.desc("k")))).alias("fdr"))


def call_cells(counts: DataFrame, params: CellParams = CellParams()) -> DataFrame:
    """(sample, CB, total, p_value, fdr, reason) of cells from counts (sample, CB, gene, n).

    A droplet over the knee is a cell by its size ('size'). Smaller ones with enough UMIs, at most ``max_candidates`` a sample, largest first, are cells
    if their genes aren't those of ambient droplets ('profile'). A sample without droplets of ambient ranks has cells by size only.
    """
    counts = materialise(counts.select("sample", "CB", "gene", F.col("n").cast("long").alias("n")).where("n > 0"), "droplet-genes")
    totals = materialise(droplet_totals(counts), "droplets")
    limits = knee(totals, params)
    sized = totals.join(limits, "sample")
    large = sized.where("total >= threshold").select("sample", "CB", "total")
    least = large.groupBy("sample").agg(F.greatest(F.lit(float(params.umi_min)), F.median("total") * params.umi_min_share_of_median).alias("least"))
    smaller = sized.where("total < threshold").join(least, "sample").where("total >= least")
    tested = smaller.withColumn("k", F.row_number().over(Window.partitionBy("sample").orderBy(F.desc("total"), "CB"))).where(F.col("k") <= params.max_candidates).select("sample", "CB")
    shares = materialise(good_turing(ambient_counts(counts, totals, params)), "ambient-shares")
    candidates = materialise(log_likelihoods(counts.join(tested, ["sample", "CB"], "left_semi"), shares), "cell-candidates")
    by_profile = ambient_test(candidates, shares, params).where(F.col("fdr") <= params.fdr).withColumn("reason", F.lit("profile"))
    none = F.lit(None).cast("double")
    return large.select("sample", "CB", "total", none.alias("p_value"), none.alias("fdr"), F.lit("size").alias("reason")).unionByName(by_profile)
