"""Schemas of the tables that files bring in."""

from __future__ import annotations

BULK_SHEET = "ID_we_want string, path_bulk string, folder_name_bulk string"
SC_SHEETS = {
    "fastq": "sample string, fastq_folder string, library string",
    "fastq,GBC": "sample string, fastq_folder string, cell_barcodes string",
    "bam": "sample string, bam string, cell_barcodes string",
}
SC_ELEMENTS = "read_ID string, CBC string, UMI string, GBC string, n_consensus_read string"
ALIGNED_READS = "sample string, read_id string, contig string, pos long, mapq int, flag int, seq string, qual string, CB string, UB string"
BULK_REFERENCE = "gbc string, read_count long, sample string"
COUNTS = "gbc string, read_count long"
CORRECTION = "correct string, degenerated string, n_reads_correct long, n_reads_degenerated long"
SAMPLE_MAP = "sample string, reference string"
SAMPLE_PARAMS = "sample string, umi_treshold double, p_treshold double, max_ratio_treshold double, normalized_abundance_treshold double"
COMBOS = "CBC string, GBC string, umi string, max_ratio double, normalized_abundance double, p double, logp double, logumi double, status string"
CLONES = "sample string, clone string, GBC_set string, `n cells` long, prevalence double"
CELLS = "sample string, cell_id string, GBC string"
