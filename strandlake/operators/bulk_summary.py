"""Tables across bulk samples, and the data behind their plots."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.operators.ranks import numbered, prefix


def reference(corrected: DataFrame) -> DataFrame:
    """(gbc, read_count, sample): all samples' whitelists, one table."""
    return corrected.select("gbc", "read_count", "sample")


def raw_with_corrected(raw: DataFrame, corrected: DataFrame) -> DataFrame:
    """(sample, gbc, raw_counts, corrected_counts): full outer join, 0 where one is missing."""
    a = raw.select("sample", "gbc", F.col("read_counts").alias("raw_counts"))
    b = corrected.select("sample", "gbc", F.col("read_count").alias("corrected_counts"))
    return a.join(b, ["sample", "gbc"], "full").fillna(0, ["raw_counts", "corrected_counts"])


def overlap(corrected: DataFrame) -> DataFrame:
    """(sample_x, sample_y, n_common) for all pairs of samples, the diagonal included; 0 if nothing is common.

    Barcodes are joined with themselves one way; the matrix is mirrored. The grid of sample names is
    as large as the result.
    """
    own = corrected.select("sample", "gbc").distinct()
    x, y = own.toDF("sample_x", "gbc"), own.toDF("sample_y", "gbc")
    half = x.join(y, "gbc").where("sample_x <= sample_y").groupBy("sample_x", "sample_y").agg(F.count(F.lit(1)).alias("n"))
    other = half.where("sample_x < sample_y").select(F.col("sample_y").alias("sample_x"), F.col("sample_x").alias("sample_y"), "n")
    names = own.select("sample").distinct()
    grid = names.toDF("sample_x").crossJoin(names.toDF("sample_y"))
    return grid.join(half.unionByName(other), ["sample_x", "sample_y"], "left").select("sample_x", "sample_y", F.coalesce("n", F.lit(0)).alias("n_common"))


def overlap_ceiling(common: DataFrame, share: float = 0.99) -> DataFrame:
    """(ceiling): that quantile of the overlap matrix, where the heat map's scale ends."""
    return common.agg(F.percentile(F.col("n_common").cast("double"), F.lit(share)).alias("ceiling"))


def sample_matrix(joined: DataFrame, samples: list[str]) -> DataFrame:
    """gbc with one column of corrected counts for each sample, 0 where it is missing."""
    return joined.groupBy("gbc").pivot("sample", samples).agg(F.sum("corrected_counts")).fillna(0, samples)


def prevalence(joined: DataFrame) -> DataFrame:
    """(n_samples, n_gbcs): barcodes by the number of samples they have corrected reads in; 1 up to all samples."""
    found = joined.groupBy("gbc").agg(F.count_if(F.col("corrected_counts") > 0).alias("n_samples")).groupBy("n_samples").agg(F.count(F.lit(1)).alias("n"))
    bins = joined.agg(F.count_distinct("sample").alias("most")).select(F.explode(F.when(F.col("most") > 0, F.sequence(F.lit(1).cast("long"), "most"))).alias("n_samples"))
    return bins.join(found, "n_samples", "left").select("n_samples", F.coalesce("n", F.lit(0)).alias("n_gbcs"))


def cumulative(corrected: DataFrame) -> DataFrame:
    """(sample, gbc, read_count, cdf): row number over number of rows, counts ascending, all samples together."""
    told = numbered(corrected.select("sample", "gbc", "read_count"), [], [F.col("read_count"), F.col("sample"), prefix("gbc", 4)], [F.col("gbc")], total=True)
    return told.select("sample", "gbc", "read_count", (F.col("place") / F.col("total")).alias("cdf"))


def before_after(raw: DataFrame, corrected: DataFrame) -> DataFrame:
    """(sample, gbc, x, y): log10(count + 1) before and after the correction, of corrected barcodes."""
    a = raw.select("sample", "gbc", F.col("read_counts").alias("before"))
    return corrected.join(a, ["sample", "gbc"]).select("sample", "gbc", F.log10(F.col("before") + F.lit(1.0)).alias("x"), F.log10(F.col("read_count") + F.lit(1.0)).alias("y"))


def fit(points: DataFrame) -> DataFrame:
    """(sample, n, slope, intercept): least squares, where a sample has more than one point."""
    fitted = points.groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"))
    return fitted.select("sample", "n", *(F.when(F.col("n") > 1, F.col(c)).alias(c) for c in ("slope", "intercept")))


def density(values: DataFrame, *, points: int = 200) -> DataFrame:
    """(sample, x, density) of (sample, value): Gaussian kernels on a grid from the least to the largest value.

    The bandwidth is Scott's: the standard deviation times n^(-1/5). Equal values are counted
    first, so the work grows with distinct values times the grid.
    """
    per = values.groupBy("sample", "value").agg(F.count(F.lit(1)).alias("w"))
    shape = values.groupBy("sample").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.stddev_samp("value").alias("sd"), F.count(F.lit(1)).alias("n")).where("sd > 0")
    step = (F.col("hi") - F.col("lo")) / (points - 1)
    grid = shape.select("sample", "n", (F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("h"), F.explode(F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.col("lo") + i * step)).alias("x"))
    u = (F.col("x") - F.col("value")) / F.col("h")
    summed = grid.join(per, "sample").groupBy("sample", "x", "n", "h").agg(F.sum(F.col("w") * F.exp(-u * u / 2)).alias("s"))
    return summed.select("sample", "x", (F.col("s") / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))).alias("density"))


def count_medians(raw: DataFrame) -> DataFrame:
    """(sample, median_log10): of log10(count + 1). Equal counts are counted first, so that a task holds different counts only."""
    per = raw.groupBy("sample", "read_counts").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("sample").agg(F.percentile(F.log10(F.col("read_counts") + F.lit(1.0)), F.lit(0.5), F.col("n")).alias("median_log10"))


def count_ranges(raw: DataFrame) -> DataFrame:
    """(sample, least, most): what the axes of a plot need."""
    return raw.groupBy("sample").agg(F.min("read_counts").alias("least"), F.max("read_counts").alias("most"))
