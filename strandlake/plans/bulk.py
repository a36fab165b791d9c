"""The bulk flow as one plan over all samples."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from strandlake.operators import bulk, bulk_summary, cluster
from strandlake.params import BulkParams
from strandlake.storage import materialise


@dataclass
class BulkResult:
    raw: DataFrame
    correction: DataFrame
    corrected: DataFrame
    metrics: DataFrame
    reference: DataFrame
    common: DataFrame


def run_bulk(reads: DataFrame, params: BulkParams = BulkParams(), spikeins: DataFrame | None = None) -> BulkResult:
    """From (sample, seq) to counts, corrections, whitelist, metrics, reference and overlap.

    Raw counts and labels are written once to shared storage, as several results need them.
    """
    raw = materialise(bulk.raw_counts(bulk.extract(reads, anchor=params.anchor, start=params.gbc_start, length=params.gbc_length), length=params.gbc_length), "raw-counts")
    corrections = cluster.correction(cluster.grouped(raw, params.method, threshold=params.hamming_threshold, length=params.gbc_length))
    corrected = cluster.final_pool(raw, corrections, min_n_reads=params.min_n_reads, spikeins=spikeins)
    return BulkResult(raw, corrections, corrected, bulk.metrics(raw, corrected, corrections), bulk_summary.reference(corrected), bulk_summary.overlap(corrected))
