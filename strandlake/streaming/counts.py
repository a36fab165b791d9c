"""Barcode counts over a stream of reads: the same extraction, as files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandlake.operators.bulk import extract, raw_counts
from strandlake.params import BulkParams


def streamed_counts(reads: DataFrame, params: BulkParams = BulkParams()) -> DataFrame:
    """Running (sample, gbc, read_counts) of a streaming table (sample, seq)."""
    return raw_counts(extract(reads, anchor=params.anchor, start=params.gbc_start, length=params.gbc_length), length=params.gbc_length)


def count_available(spark: SparkSession, folder: str, checkpoint: str, name: str, params: BulkParams = BulkParams()) -> DataFrame:
    """Counts all Parquet files (sample, seq) in a folder as a stream that ends; the state is kept in ``checkpoint``.

    The result is the in-memory table of that name: a report over distinct barcodes, for small streams.
    """
    reads = spark.readStream.schema("sample string, seq string").parquet(folder)
    query = streamed_counts(reads, params).writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table(name)


def counts_to_table(reads: DataFrame, path: str, checkpoint: str, params: BulkParams = BulkParams()):
    """Starts a query that writes each batch's counts to a folder of its own; their sum is the count so far.

    Writing a batch again after a failure replaces it, so every read counts once.
    """

    def write(batch: DataFrame, number: int) -> None:
        streamed_counts(batch, params).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return reads.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
