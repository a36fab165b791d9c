"""Bulk flow: barcodes from reads, their counts and a sample's metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.functions.seq import anchored


def extract(reads: DataFrame, *, anchor: str, start: int = 23, length: int = 18) -> DataFrame:
    """(sample, gbc): what follows the anchor and a spacer, for each read with the anchor.

    Too short ends give short barcodes or empty ones; counting drops them.
    """
    # a generator keeps filters on the result from repeating the pattern
    tail = reads.select("sample", F.explode(F.array(anchored(F.col("seq"), anchor))).alias("tail"))
    return tail.where("tail is not null").select("sample", F.substring("tail", start, length).alias("gbc"))


def raw_counts(barcodes: DataFrame, *, length: int = 18) -> DataFrame:
    """(sample, gbc, read_counts) of barcodes of the full length; partial sums before the shuffle."""
    return barcodes.where(F.length("gbc") == length).groupBy("sample", "gbc").agg(F.count(F.lit(1)).alias("read_counts"))


def metrics(raw: DataFrame, corrected: DataFrame, corrections: DataFrame) -> DataFrame:
    """The six metrics of each sample; a sample without corrections has 0 and null there."""
    a = raw.groupBy("sample").agg(F.sum("read_counts").alias("total_GBC_reads"), F.count(F.lit(1)).alias("n_unique_GBCs"))
    b = corrected.groupBy("sample").agg(F.count(F.lit(1)).alias("n_filtered_GBCs"))
    c = corrections.groupBy("sample").agg(F.count_distinct("correct").alias("n_corrected_GBCs"), F.count_distinct("degenerated").alias("n_degenerated_GBCs"), F.median("n_reads_degenerated").alias("median_n_reads_added"))
    return a.join(b, "sample", "left").join(c, "sample", "left").fillna(0, ["n_filtered_GBCs", "n_corrected_GBCs", "n_degenerated_GBCs"])
