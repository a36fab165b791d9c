"""Parameters of the two flows, with the defaults the command lines have."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class BulkParams:
    """Bulk flow: extraction, clustering, whitelist."""

    anchor: str = "GGGTTTAAACGGGCCCTCTAG"
    gbc_start: int = 23
    gbc_length: int = 18
    hamming_threshold: int = 3
    min_n_reads: int = 1000
    method: str = "directional"


@dataclass(frozen=True)
class ScParams:
    """Single-cell flow: consensus, support filter, bulk correction."""

    gbc_start: int = 34
    gbc_length: int = 18
    chunk_size: int = 3000
    min_reads: int = 10
    min_base_quality: int = 30
    max_base_error_rate: float = 0.2
    bulk_correction_threshold: int = 3
    umi_threshold: int = 5
    p_threshold: float = 1.0
    max_ratio_threshold: float = 0.75
    normalized_abundance_threshold: float = 0.75
    contig: str = "lentiCassette"
    #: Consensus by posterior with its filters, or by vote.
    error_model: bool = False
