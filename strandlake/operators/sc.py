"""Single-cell flow: UMI counts, cell-barcode combinations, their support, clones and cells.

Each table holds all samples; ``sample`` is part of every key.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandlake.functions.seq import checked_reverse_complement, minus_log10, poisson_upper_tail
from strandlake.operators.quantiles import exact_quantiles
from strandlake.operators.ranks import numbered, prefix
from strandlake.operators.similarity import nearest
from strandlake.params import ScParams
from strandlake.storage import materialise

THRESHOLDS = ("umi", "p", "max_ratio", "normalized_abundance")


def read_elements(elements: DataFrame) -> DataFrame:
    """Elements with the barcode as in the bulk library: reverse complement."""
    return elements.withColumn("GBC", checked_reverse_complement(F.col("GBC")))


def bulk_map(elements: DataFrame, bulk: DataFrame, *, threshold: int = 3, length: int = 18) -> DataFrame:
    """(sample, GBC, correct_GBC, hamming): each distinct barcode's nearest one in its sample's reference.

    ``bulk``: (sample, gbc, read_count). Ties go to the barcode with more reads, then to the smaller one.
    """
    seen = elements.where("GBC is not null").select("sample", "GBC").distinct()
    ref = bulk.select("sample", F.col("gbc").alias("correct_GBC"), F.col("read_count").alias("ref_reads"))
    return nearest(seen, ref, by=["sample"], query_col="GBC", ref_col="correct_GBC", threshold=threshold, length=length, order=[-F.col("ref_reads"), F.col("correct_GBC")])


def correct_with_bulk(elements: DataFrame, mapped: DataFrame) -> DataFrame:
    """Elements with their corrected barcode; those without one go."""
    told = mapped.select("sample", "GBC", "correct_GBC")
    return elements.join(told, ["sample", "GBC"]).withColumn("GBC", F.col("correct_GBC")).select(elements.columns)


def sample_reference(bulk: DataFrame, sample_map: DataFrame) -> DataFrame:
    """The bulk reference of each single-cell sample: (sample, gbc, read_count)."""
    own = sample_map.select("sample", F.col("reference").alias("__ref"))
    return bulk.withColumnRenamed("sample", "__ref").join(own, "__ref").select("sample", "gbc", "read_count")


def unmapped_samples(elements: DataFrame, sample_map: DataFrame) -> DataFrame:
    """Samples that the map lacks; there should be none."""
    return elements.select("sample").distinct().join(sample_map.select("sample"), "sample", "left_anti")


def umi_counts(elements: DataFrame) -> DataFrame:
    """(sample, CBC, GBC, UMI, count, log): reads of each UMI; rows with a missing key are no group."""
    kept = elements.where("CBC is not null and GBC is not null and UMI is not null")
    return kept.groupBy("sample", "CBC", "GBC", "UMI").agg(F.count(F.lit(1)).alias("count")).withColumn("log", F.log10("count"))


def combos(umis: DataFrame) -> DataFrame:
    """(sample, CBC, GBC, umi, max_ratio, normalized_abundance) from :func:`umi_counts`."""
    per = umis.groupBy("sample", "CBC", "GBC").agg(F.count(F.lit(1)).alias("umi"))
    cell = Window.partitionBy("sample", "CBC")
    return per.withColumns({"max_ratio": F.col("umi") / F.max("umi").over(cell), "normalized_abundance": F.col("umi") / F.sum("umi").over(cell)})


def poisson(combos_: DataFrame) -> DataFrame:
    """Combos with p, logp and logumi: the chance of as many UMIs for a Poisson variable around the barcode's median.

    The median is joined on the barcode; the sum of terms is made once for each distinct (umi, median).
    """
    mean = combos_.groupBy("sample", "GBC").agg(F.median("umi").alias("mean"))
    with_mean = combos_.join(mean, ["sample", "GBC"])
    tail = with_mean.select("umi", "mean").distinct().withColumn("p", poisson_upper_tail(F.col("umi"), F.col("mean")))
    joined = with_mean.join(tail, ["umi", "mean"]).drop("mean")
    return joined.withColumns({"logp": minus_log10(F.col("p")), "logumi": F.log10("umi")}).select(*combos_.columns, "p", "logp", "logumi")


def supported(umi: Column | int, p: Column | float, max_ratio: Column | float, normalized_abundance: Column | float) -> Column:
    return (F.col("umi") >= umi) & (F.col("p") <= p) & (F.col("max_ratio") >= max_ratio) & (F.col("normalized_abundance") >= normalized_abundance)


def support(scored: DataFrame, params: ScParams = ScParams(), sample_params: DataFrame | None = None) -> DataFrame:
    """Scored combos with status; a sample's own thresholds, where given, replace the common ones."""
    common = {k: F.lit(getattr(params, f"{k}_threshold")) for k in THRESHOLDS}
    if sample_params is None:
        test, joined = supported(**common), scored
    else:
        own = sample_params.select("sample", *(F.col(f"{k}_treshold").alias(f"__{k}") for k in THRESHOLDS))
        joined = scored.join(own, "sample", "left")
        test = supported(**{k: F.coalesce(F.col(f"__{k}"), common[k]) for k in THRESHOLDS})
    return joined.withColumn("status", F.when(test, "supported").otherwise("unsupported")).select(*scored.columns, "status")


def cell_gbc(status: DataFrame) -> DataFrame:
    """(sample, CBC, GBC, umi): supported combinations, the long form of the cell matrix."""
    return status.where("status = 'supported'").select("sample", "CBC", "GBC", "umi")


def cell_matrix(cells: DataFrame, gbcs: list[str]) -> DataFrame:
    """sample and CBC with one column a barcode: mean UMIs, 0 where there is none."""
    return cells.groupBy("sample", "CBC").pivot("GBC", gbcs).agg(F.avg("umi")).fillna(0, gbcs)


def moi(cells: DataFrame) -> DataFrame:
    """(sample, CBC, moi): barcodes of each cell."""
    return cells.where("umi > 0").groupBy("sample", "CBC").agg(F.count(F.lit(1)).alias("moi"))


def moi_distribution(cells: DataFrame) -> DataFrame:
    """(sample, moi, n_cells)."""
    return moi(cells).groupBy("sample", "moi").agg(F.count(F.lit(1)).alias("n_cells"))


def moi_stats(cells: DataFrame) -> DataFrame:
    """(sample, median_moi, std_moi); the deviation of a single cell is null."""
    return moi(cells).groupBy("sample").agg(F.median("moi").alias("median_moi"), F.stddev_samp("moi").alias("std_moi"))


def clones(cells: DataFrame) -> DataFrame:
    """(sample, clone, GBC_set, n_cells, prevalence): cells by their set of barcodes, largest first, then by set.

    Sizes are written once, as numbering them reads them several times.
    """
    sets = cells.where("umi > 0").groupBy("sample", "CBC").agg(F.array_join(F.array_sort(F.collect_set("GBC")), ";").alias("GBC_set"))
    sizes = materialise(sets.groupBy("sample", "GBC_set").agg(F.count(F.lit(1)).alias("n_cells")), "clone-sizes")
    whole = sizes.groupBy("sample").agg(F.sum("n_cells").alias("cells"))
    ranked = numbered(sizes, ["sample"], [-F.col("n_cells"), prefix("GBC_set")], [F.col("GBC_set")]).join(whole, "sample")
    return ranked.select("sample", F.concat(F.lit("C"), (F.col("place") - 1).cast("string")).alias("clone"), "GBC_set", "n_cells", (F.col("n_cells") / F.col("cells")).alias("prevalence"))


def unique_cells(cells: DataFrame) -> DataFrame:
    """Combinations of cells with exactly one barcode."""
    one = moi(cells).where("moi = 1").select("sample", "CBC")
    return cells.join(one, ["sample", "CBC"], "left_semi")


def cell_table(cells: DataFrame) -> DataFrame:
    """(sample, cell_id, GBC) of cells with exactly one barcode; the id is CBC_sample."""
    one = cells.where("umi > 0").groupBy("sample", "CBC").agg(F.count(F.lit(1)).alias("moi"), F.min("GBC").alias("GBC")).where("moi = 1")
    return one.select("sample", F.concat_ws("_", "CBC", "sample").alias("cell_id"), "GBC")


def set_stats(clones_: DataFrame) -> DataFrame:
    """(sample, n_sets, n_gbcs, redundancy, median_occurrence, std_occurrence) of barcodes across sets."""
    each = clones_.select("sample", "GBC_set", F.explode(F.split("GBC_set", ";")).alias("GBC"))
    per = each.groupBy("sample", "GBC").agg(F.count(F.lit(1)).alias("k"))
    sets = clones_.groupBy("sample").agg(F.count(F.lit(1)).alias("n_sets"))
    found = per.groupBy("sample").agg(F.count(F.lit(1)).alias("n_gbcs"), (1 - F.count(F.lit(1)) / F.sum("k")).alias("redundancy"), F.median("k").alias("median_occurrence"), F.stddev_samp("k").alias("std_occurrence"))
    return sets.join(found, "sample")


def gbc_occurrences(clones_: DataFrame) -> DataFrame:
    """(sample, GBC, n_sets), to be told most frequent first."""
    return clones_.select("sample", F.explode(F.split("GBC_set", ";")).alias("GBC")).groupBy("sample", "GBC").agg(F.count(F.lit(1)).alias("n_sets"))


def run_metrics(status: DataFrame) -> DataFrame:
    """One row a sample: combos, good barcodes, starting cells, MOI, clones and cells.

    The table is read twice, by barcode and by cell; what follows are sums over these: cells by their number of barcodes and, where it is
    one, by that barcode, which is a clone.
    """
    good = F.col("status") == "supported"
    by_gbc = status.groupBy("sample", "GBC").agg(F.count_if(good).alias("good"), F.count(F.lit(1)).alias("n"))
    combos_ = by_gbc.groupBy("sample").agg(F.count(F.lit(1)).alias("unique_good_GBCs"), F.sum(F.col("n") - F.col("good")).alias("unsupported_combos"), F.sum("good").alias("supported_combos"))
    held = good & (F.col("umi") > 0)
    by_cell = status.groupBy("sample", "CBC").agg(F.count_if(held).alias("moi"), F.min(F.when(held, F.col("GBC"))).alias("GBC"))
    kinds = by_cell.groupBy("sample", "moi", F.when(F.col("moi") == 1, F.col("GBC")).alias("clone")).agg(F.count(F.lit(1)).alias("cells"))
    some, one = F.col("moi") > 0, F.col("moi") == 1
    n, first, second = (F.sum(F.when(some, F.col("cells") * f).otherwise(0)) for f in (F.lit(1), F.col("moi"), F.col("moi") * F.col("moi")))
    cells = kinds.groupBy("sample").agg(
        F.sum("cells").alias("starting_CBCs"), F.percentile(F.when(some, F.col("moi")), F.lit(0.5), F.when(some, F.col("cells")).otherwise(0)).alias("observed_moi_median"),
        F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), (second - first * first / n) / (n - 1)))).alias("observed_moi_std"), F.sum(F.when(one, F.col("cells")).otherwise(0)).alias("uniquely_barcoded_cells"),
        F.count_if(one).alias("n_clones"), F.count_if(one & (F.col("cells") >= 10)).alias("n_clones_10plus"),
    )
    columns = ["unique_good_GBCs", "unsupported_combos", "supported_combos", "starting_CBCs", "observed_moi_median", "observed_moi_std", "uniquely_barcoded_cells", "n_clones", "n_clones_10plus"]
    return combos_.join(cells, "sample").select("sample", *columns)


def combo_medians(scored: DataFrame) -> DataFrame:
    """(sample, and the medians of umi, max_ratio, normalized_abundance and p).

    These are nearly as many values as rows, so that a sample's don't go into one task. They are written once, as they are read twice.
    """
    values = F.explode(F.array(*(F.struct(F.lit(c).alias("what"), F.col(c).cast("double").alias("value")) for c in THRESHOLDS)))
    written = materialise(scored.select("sample", values.alias("x")).select("sample", "x.*"), "combo-values")
    medians = exact_quantiles(written, ["sample", "what"], "value", [0.5])
    return medians.groupBy("sample").agg(*(F.max(F.when(F.col("what") == c, F.col("q")[0])).alias(f"median_{c}") for c in THRESHOLDS))


def bulk_check(status: DataFrame, bulk: DataFrame) -> DataFrame:
    """(sample, n_bulk, n_sc, n_common, bulk_found, abundance_corr): single-cell against bulk barcodes.

    The correlation is between shares of supported UMIs and shares of bulk reads of common barcodes;
    ``bulk_found`` is the share of bulk barcodes with any combo.
    """
    pseudo = cell_gbc(status).groupBy("sample", F.col("GBC").alias("gbc")).agg(F.sum("umi").alias("umi"))
    ref = bulk.select("sample", "gbc", F.col("read_count").alias("reads"))
    seen = status.select("sample", F.col("GBC").alias("gbc")).distinct().withColumn("seen", F.lit(1))
    a = ref.join(seen, ["sample", "gbc"], "left").groupBy("sample").agg(F.count(F.lit(1)).alias("n_bulk"), F.avg(F.coalesce("seen", F.lit(0))).alias("bulk_found"))
    b = seen.groupBy("sample").agg(F.count(F.lit(1)).alias("n_sc"))
    c = pseudo.join(ref, ["sample", "gbc"]).groupBy("sample").agg(F.count(F.lit(1)).alias("n_common"), F.corr(F.col("umi").cast("double"), F.col("reads").cast("double")).alias("abundance_corr"))
    whole = a.join(b, "sample").join(c, "sample", "left")
    return whole.select("sample", "n_bulk", "n_sc", F.coalesce("n_common", F.lit(0)).alias("n_common"), "bulk_found", F.when(~F.isnan("abundance_corr"), F.col("abundance_corr")).alias("abundance_corr"))


def umi_rank_curve(combos_: DataFrame) -> DataFrame:
    """(sample, rank, umi): UMI counts descending, from a point at (0, 0)."""
    points = numbered(combos_.select("sample", "umi", "CBC", "GBC"), ["sample"], [-F.col("umi"), prefix("CBC")], [F.col("CBC"), F.col("GBC")]).select("sample", F.col("place").alias("rank"), "umi")
    zero = combos_.select("sample").distinct().select("sample", F.lit(0).cast("long").alias("rank"), F.lit(0).cast("long").alias("umi"))
    return points.unionByName(zero)


def clone_size_curve(clones_: DataFrame) -> DataFrame:
    """(sample, clone, n_cells, n_larger): how many clones are at least as far up, 1 for the largest: a clone's own number."""
    return clones_.select("sample", "clone", "n_cells", (F.substring("clone", 2, 19).cast("long") + 1).alias("n_larger"))


def box_stats(values: DataFrame, column: str = "umi") -> DataFrame:
    """(sample, n, q1, median, q3, low, high, n_outliers): whiskers end at the last values within 1.5 box heights."""
    q = values.groupBy("sample").agg(F.percentile(F.col(column), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"), F.count(F.lit(1)).alias("n"))
    told = q.select("sample", "n", *(F.col("q")[i].alias(c) for i, c in enumerate(("q1", "median", "q3"))))
    iqr = 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col(column) >= F.col("q1") - iqr) & (F.col(column) <= F.col("q3") + iqr)
    both = values.select("sample", column).join(told, "sample")
    return both.groupBy("sample", "n", "q1", "median", "q3").agg(F.min(F.when(inside, F.col(column))).alias("low"), F.max(F.when(inside, F.col(column))).alias("high"), F.count_if(~inside).alias("n_outliers"))


def support_density(scored: DataFrame, bins: int = 20) -> DataFrame:
    """(sample, ratio_bin, abundance_bin, n): a two-dimensional histogram of max_ratio and normalized_abundance."""
    cut = lambda c: F.least(F.floor(F.col(c) * bins), F.lit(bins - 1)).cast("long")
    return scored.groupBy("sample", cut("max_ratio").alias("ratio_bin"), cut("normalized_abundance").alias("abundance_bin")).agg(F.count(F.lit(1)).alias("n"))


#: Standard deviations of the kernel beyond which a point adds nothing that a double would show.
REACH = 8


def support_kde(scored: DataFrame, points: int = 20) -> DataFrame:
    """(sample, x, y, density): a Gaussian kernel density of max_ratio and normalized_abundance on a grid over the unit square.

    The kernel has the sample's covariance, scaled by Scott's rule. Equal points are counted first, and each goes to the places of the
    grid within :data:`REACH` only: the more points there are the narrower is the kernel, so that a large sample's points go to a few
    places each, where they are summed before the shuffle. A sample without an area has no rows.
    """
    both = scored.select("sample", F.col("max_ratio").alias("x"), F.col("normalized_abundance").alias("y"))
    weights = both.groupBy("sample", "x", "y").agg(F.count(F.lit(1)).alias("w"))
    shape = both.groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.var_samp("x").alias("vx"), F.var_samp("y").alias("vy"), F.covar_samp("x", "y").alias("c"))
    kernel = shape.withColumns({"f": F.pow(F.col("n").cast("double"), F.lit(-1 / 3)), "det": F.col("vx") * F.col("vy") - F.col("c") * F.col("c")}).where("det > 1e-12")

    def near(at: str, variance: str) -> Column:
        reach = REACH * F.sqrt(F.col("f") * F.col(variance))
        first = F.greatest(F.lit(0), F.ceil((F.col(at) - reach) * points - 0.5).cast("int"))
        last = F.least(F.lit(points - 1), F.floor((F.col(at) + reach) * points - 0.5).cast("int"))
        return F.when(first <= last, F.sequence(first, last))

    spread = weights.join(kernel, "sample").withColumn("i", F.explode(near("x", "vx"))).withColumn("j", F.explode(near("y", "vy")))
    dx, dy = (F.col("i") + 0.5) / points - F.col("x"), (F.col("j") + 0.5) / points - F.col("y")
    form = (F.col("vy") * dx * dx - 2 * F.col("c") * dx * dy + F.col("vx") * dy * dy) / (F.col("det") * F.col("f"))
    summed = spread.groupBy("sample", "i", "j").agg(F.sum(F.col("w") * F.exp(-form / 2)).alias("s"))
    places = F.sequence(F.lit(0), F.lit(points - 1))
    grid = kernel.select("sample", "n", "f", "det", F.explode(places).alias("i")).withColumn("j", F.explode(places)).join(summed, ["sample", "i", "j"], "left")
    return grid.select("sample", ((F.col("i") + 0.5) / points).alias("x"), ((F.col("j") + 0.5) / points).alias("y"), (F.coalesce("s", F.lit(0.0)) / (F.col("n") * 2 * math.pi * F.col("f") * F.sqrt("det"))).alias("density"))


def retained_share(status: DataFrame) -> DataFrame:
    """(sample, n_combos, retained_percent)."""
    return status.groupBy("sample").agg(F.count(F.lit(1)).alias("n_combos"), (100 * F.count_if(F.col("status") == "supported") / F.count(F.lit(1))).alias("retained_percent"))


def unique_gbcs(elements: DataFrame) -> DataFrame:
    """(sample, unique_gbc_sc): barcodes as read, before any correction."""
    return elements.groupBy("sample").agg(F.count_distinct("GBC").alias("unique_gbc_sc"))
