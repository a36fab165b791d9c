"""The single-cell flow as one plan over all samples."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.operators import consensus, sc
from strandlake.params import ScParams
from strandlake.storage import materialise


@dataclass
class ScResult:
    combos: DataFrame
    cells_by_gbc: DataFrame
    clones: DataFrame
    cells: DataFrame
    metrics: DataFrame


def elements_from_reads(reads: DataFrame, barcodes: DataFrame, params: ScParams = ScParams()) -> DataFrame:
    """From tagged reads and cell barcodes to elements, by one consensus a molecule."""
    kept = consensus.in_cells(consensus.tagged(reads, params.contig), barcodes)
    limits = {"min_reads": params.min_reads, "min_base_quality": params.min_base_quality}
    if params.error_model:
        kept = consensus.filter_posterior(consensus.posterior_consensus(kept, **limits), **limits, max_base_error_rate=params.max_base_error_rate)
    else:
        kept = consensus.keep_consensus(consensus.consensus(kept, **limits), min_reads=params.min_reads, max_error_rate=params.max_base_error_rate)
    return consensus.elements(kept, start=params.gbc_start, length=params.gbc_length)


def run_single_cell(elements: DataFrame, params: ScParams = ScParams(), *, bulk: DataFrame | None = None, sample_map: DataFrame | None = None, sample_params: DataFrame | None = None) -> ScResult:
    """From elements to combos with their status, clones, cells and metrics; with a bulk reference and a
    sample map, barcodes are corrected first. A sample that the map lacks is an error.

    The combos are written to the shared folder once; all other tables are read from there."""
    own = sc.read_elements(elements)
    if bulk is not None and sample_map is not None:
        missing = [r["sample"] for r in sc.unmapped_samples(own, sample_map).limit(5).collect()]
        if missing:
            raise KeyError(f"the sample map lacks {', '.join(missing)}")
        reference = sc.sample_reference(bulk, sample_map)
        own = sc.correct_with_bulk(own, sc.bulk_map(own, reference, threshold=params.bulk_correction_threshold, length=params.gbc_length))
    status = materialise(sc.support(sc.poisson(sc.combos(sc.umi_counts(own))), params, sample_params), "combos")
    cells = sc.cell_gbc(status)
    return ScResult(status, cells, sc.clones(sc.unique_cells(cells)), sc.cell_table(cells), sc.run_metrics(status))


def run_summary(
    metrics: DataFrame, *, bulk: DataFrame | None = None, elements: DataFrame | None = None, reads: DataFrame | None = None,
    alignments: DataFrame | None = None, barcodes: DataFrame | None = None, features: DataFrame | None = None,
) -> DataFrame:
    """The metrics of clone calling with what other sources tell of each sample; null where there is no source.

    ``bulk`` and ``barcodes`` and ``features`` have a row for each entry, ``reads`` (sample, total_reads) and ``alignments``
    (sample, mapped_reads, unmapped_reads) are counted already, by the kind of input there is.
    """
    lines = lambda df, name: None if df is None else df.groupBy("sample").agg(F.count(F.lit(1)).alias(name))
    parts = {
        "unique_gbc_bulk_ref": lines(bulk, "unique_gbc_bulk_ref"), "unique_gbc_sc": None if elements is None else sc.unique_gbcs(elements),
        "total_reads": reads, "mapped_reads": alignments, "unmapped_reads": alignments,
        "n_putative_cells": lines(barcodes, "n_putative_cells"), "total_n_transcripts": lines(features, "total_n_transcripts"),
    }
    out = metrics
    for name, part in parts.items():
        out = out.withColumn(name, F.lit(None).cast("long")) if part is None else out.join(part.select("sample", F.col(name).cast("long")), "sample", "left")
    return out
