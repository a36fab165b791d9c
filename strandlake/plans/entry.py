"""From a sample sheet to results: the whole runs, by kind of input, and gathering of what runs have written."""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.functions.seq import reverse_complement
from strandlake.operators import cells, channels, remap, sc
from strandlake.params import BulkParams, ScParams
from strandlake.plans import report
from strandlake.plans.bulk import BulkResult, run_bulk
from strandlake.plans.single_cell import ScResult, elements_from_reads, run_single_cell
from strandlake.sources import bam, sequences, sinks, tables
from strandlake.storage import materialise, scratch_path


def absolute(path: str) -> str:
    """A path without a scheme as one from the root, as Arrow's file systems want it."""
    return path if "://" in path else os.path.abspath(path)


def run_bulk_sheet(spark: SparkSession, sheet: str, params: BulkParams = BulkParams(), spikeins: str | None = None) -> BulkResult:
    """The bulk flow over all samples of a sheet; a sheet has few rows, and each names a folder of FASTQ files."""
    rows = tables.bulk_sheet(spark, sheet).collect()
    if not rows:
        raise ValueError(f"{sheet} names no sample")
    reads = reduce(DataFrame.unionByName, (sequences.bulk_reads(spark, r["folder"], r["sample"]) for r in rows))
    return run_bulk(reads, params, tables.spikeins(spark, spikeins))


def tagged_reads(spark: SparkSession, folder: str, sample: str, whitelist: DataFrame, cassette: list[tuple[str, str]], params: ScParams = ScParams()) -> DataFrame:
    """Reads of a barcode library as an aligner's file would have them: cell and UMI from the first mate, by posterior, and the
    second mate placed on the cassette, turned to its strand. Reads without a place or a cell are left out."""
    first, second = (sequences.merged_mate(spark, folder, mate, sample) for mate in ("R1", "R2"))
    tags = cells.match_barcodes(first, whitelist, by=("sample",)).select("sample", "read_id", "CB", "UB")
    placed = remap.remap(second.select("sample", "read_id", "seq", "qual"), cassette).where((F.col("contig") == params.contig))
    turned = F.col("flag").bitwiseAND(16) != 0
    own = placed.withColumns({"seq": F.when(turned, reverse_complement(F.col("seq"))).otherwise(F.col("seq")), "qual": F.when(turned, F.reverse("qual")).otherwise(F.col("qual"))})
    return own.join(tags, ["sample", "read_id"]).select("sample", "read_id", "contig", "pos", F.lit(60).alias("mapq"), "flag", "seq", "qual", "CB", "UB")


def cells_by_size(spark: SparkSession, folder: str, sample: str, whitelist: DataFrame, params: cells.CellParams = cells.CellParams()) -> DataFrame:
    """(sample, CB) of a transcript library's cells, by their number of UMIs: without an alignment there are no genes to test droplets by."""
    tags = cells.match_barcodes(sequences.merged_mate(spark, folder, "R1", sample), whitelist, by=("sample",))
    molecules = cells.collapse_umis(tags.withColumn("gene", F.lit("any")))
    totals = materialise(cells.droplet_totals(cells.gene_counts(molecules)), "droplets")
    return totals.join(cells.knee(totals, params), "sample").where("total >= threshold").select("sample", "CB")


def run_sheet(
    spark: SparkSession, sheet: str, input_type: str, params: ScParams = ScParams(), *, whitelist: DataFrame | None = None, cassette: list[tuple[str, str]] | None = None,
    cell_params: cells.CellParams = cells.CellParams(), bulk: DataFrame | None = None, sample_map: DataFrame | None = None, sample_params: DataFrame | None = None,
) -> ScResult:
    """The single-cell flow over all samples of a sheet.

    'bam': files of aligned reads with cell tags, and lists of cells. 'fastq,GBC': folders of a barcode library, and lists of
    cells. 'fastq': folders of transcript (TENX) and barcode (GBC) libraries; cells are told from the former. FASTQ input needs
    the list of possible barcodes and the cassette. A sheet has few rows, which the driver goes through.
    """
    rows = tables.sc_sheet(spark, sheet, input_type).collect()
    if not rows:
        raise ValueError(f"{sheet} names no sample")
    if input_type != "bam" and (whitelist is None or cassette is None):
        raise ValueError("FASTQ input needs a whitelist and a cassette")
    listed = lambda path, sample: tables.barcode_list(spark, path).select(F.lit(sample).alias("sample"), "CB")
    if input_type == "bam":
        reads = [bam.read_bam(spark, r["bam"], region=params.contig).withColumn("sample", F.lit(r["sample"])) for r in rows]
        barcodes = [listed(r["cell_barcodes"], r["sample"]) for r in rows]
    elif input_type == "fastq,GBC":
        reads = [tagged_reads(spark, r["fastq_folder"], r["sample"], whitelist, cassette, params) for r in rows]
        barcodes = [listed(r["cell_barcodes"], r["sample"]) for r in rows]
    else:
        reads = [tagged_reads(spark, r["fastq_folder"], r["sample"], whitelist, cassette, params) for r in rows if r["library"] == "GBC"]
        barcodes = [cells_by_size(spark, r["fastq_folder"], r["sample"], whitelist, cell_params) for r in rows if r["library"] == "TENX"]
        if not reads or not barcodes:
            raise ValueError(f"{sheet} has not both kinds of library")
    union = lambda parts: reduce(DataFrame.unionByName, parts)
    called = elements_from_reads(union(reads), union(barcodes), params)
    return run_single_cell(called, params, bulk=bulk, sample_map=sample_map, sample_params=sample_params)


# -- folders of results


def write_run(result: ScResult, documents: DataFrame, folder: str) -> None:
    """A folder for each sample with its combos and its document, under the names that later steps look for.

    ``documents``: (sample, document). Files are written by Spark and renamed; samples are few.
    """
    spark = documents.sparkSession
    combos, summaries = scratch_path(spark, "combos-files"), scratch_path(spark, "document-files")
    sinks.write_combos(result.combos.repartition("sample"), combos)
    documents.select("sample", F.col("document").alias("value")).repartition("sample").write.partitionBy("sample").text(summaries)
    sinks.publish(spark, combos, folder, "CBC_GBC_combos.tsv.gz")
    sinks.publish(spark, summaries, folder, "run_summary.json")


@dataclass
class Gathered:
    samples: DataFrame
    umis: DataFrame
    quality: DataFrame


#: Of a sample's document: its samples, each with an id and its metrics.
DOCUMENT = "run_type string, run_info map<string,string>, parameters map<string,string>, metrics_info map<string,string>, samples array<struct<id:string,metrics:map<string,double>,raw_data_input_type:string>>"


def gather(spark: SparkSession, folder: str) -> Gathered:
    """All samples below a folder that have both their document and their combos, at any depth.

    ``samples``: (sample, metrics, run_info, parameters, metrics_info); ``umis``: (sample, umi) of combos with UMIs; ``quality``: (sample,
    reads, moi, and the box of its UMIs). A document that can't be read leaves its sample out; a folder without any
    sample is an error.
    """
    complete = tables.complete_directories(spark, folder)
    if complete.isEmpty():
        raise ValueError(f"no results of samples in {folder}")
    # files are named as parts of an address, folders as they are
    of = lambda c: F.url_decode(F.replace(F.regexp_extract(c, "^(.*)/[^/]+$", 1), F.lit("+"), F.lit("%2B")))
    documents = _documents(spark, folder).withColumn("folder", of("file")).join(complete, "folder")
    own = documents.withColumn("sample", channels.sample_id(F.col("samples"), F.element_at(F.split("folder", "/"), -1)))
    told = own.select("folder", "sample", channels.sample_metrics(F.col("samples"), F.col("sample")).alias("metrics"), "run_info", "parameters", "metrics_info")
    told = materialise(told, "gathered-samples")
    if told.isEmpty():
        raise ValueError(f"no readable document of a sample in {folder}")
    lines = spark.read.option("pathGlobFilter", "CBC_GBC_combos.tsv.gz").option("recursiveFileLookup", "true").text(folder)
    cells_ = lines.select(of(F.col("_metadata.file_path")).alias("folder"), F.split("value", "\t").alias("cells"))
    # each file's own header tells which column has the UMIs
    heads = cells_.where(F.array_contains("cells", "umi")).select("folder", F.array_position("cells", "umi").cast("int").alias("at"))
    umis = channels.positive_umis(cells_.join(heads, "folder").select("folder", F.try_element_at("cells", F.col("at")).try_cast("double").alias("umi")))
    umis = materialise(umis.join(told.select("folder", "sample"), "folder").select("sample", F.col("umi").cast("long").alias("umi")), "gathered-umis")
    first = lambda *names: F.coalesce(*(F.try_element_at("metrics", F.lit(n)) for n in names))
    quality = told.select("sample", first("total_reads", "mapped_reads").alias("reads"), first("median_moi", "observed_moi_median").alias("moi")).join(sc.box_stats(umis), "sample", "left")
    return Gathered(told.drop("folder"), umis, quality)


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    """(file, and the document's fields) of every run_summary.json below a folder that is a document."""
    lines = spark.read.option("pathGlobFilter", "run_summary.json").option("recursiveFileLookup", "true").text(folder, wholetext=True)
    parsed = lines.select(F.col("_metadata.file_path").alias("file"), F.from_json("value", DOCUMENT).alias("d"))
    return parsed.where("d.samples is not null").select("file", "d.*")



def run_report(found: Gathered, title: str = "Barcode run", **page) -> str:
    """The page of a gathered run: its samples' metrics, charts over all samples and a card for each. Samples are few."""
    rows = found.samples.orderBy("sample").collect()
    first = lambda c: next((r[c] for r in rows if r[c]), {})
    document = {"run_info": first("run_info"), "parameters": first("parameters"), "metrics_info": first("metrics_info"), "samples": [{"id": r["sample"], "metrics": r["metrics"] or {}} for r in rows]}
    return report.report_page(document, title, figures=report.run_charts(found.quality), **page)
