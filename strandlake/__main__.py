"""Command line: whole runs from a sheet to folders of results, and the report of a run.

    python -m strandlake bulk SHEET OUT [--params FILE] [--spikeins FILE] [--bulk-option value ...]
    python -m strandlake cells SHEET OUT --type bam [--params FILE] [--whitelist FILE --cassette FASTA] ...
    python -m strandlake report FOLDER PAGE

Each parameter of the flows is an option, with the flows' defaults; a JSON file of parameters sets several at once.
"""

from __future__ import annotations

import argparse
import json
from dataclasses import asdict, fields

from pyspark.sql import SparkSession

from strandlake.operators.cells import CellParams
from strandlake.params import BulkParams, ScParams
from strandlake.plans import entry, report
from strandlake.plans.bulk import BulkResult
from strandlake.session import session
from strandlake.sources import bam, sequences, sinks, tables


def _flag(text: str) -> bool:
    return text.lower() in ("1", "true", "yes")


def _options(parser: argparse.ArgumentParser, kind: type) -> None:
    for f in fields(kind):
        own = type(f.default)
        parser.add_argument("--" + f.name.replace("_", "-"), type=_flag if own is bool else own, default=None, help=f"default: {f.default}")


def _params(args: argparse.Namespace, kind: type):
    """The defaults, then a file's values, then options; a file's other values are ignored, as it may be for several steps."""
    names = [f.name for f in fields(kind)]
    held = {}
    if args.params:
        with bam.open_file(args.params if "://" in args.params else entry.absolute(args.params)) as f:
            held = {k: v for k, v in json.loads(f.read()).items() if k in names and v not in (None, "None")}
    return kind(**(held | {k: getattr(args, k) for k in names if getattr(args, k) is not None}))


def write_bulk(spark: SparkSession, result: BulkResult, params: BulkParams, out: str) -> None:
    sinks.write_raw_counts(result.raw, f"{out}/raw_counts")
    sinks.write_correction(result.correction, f"{out}/correction")
    sinks.write_counts(result.corrected, f"{out}/counts_corrected")
    sinks.write_reference(result.reference, f"{out}/reference")
    sinks.write_overlap(result.common, f"{out}/common")
    sinks.write_metrics_csv(result.metrics, f"{out}/metrics")
    sinks.write_patterns(spark, params.anchor, f"{out}/search_patterns")
    documents = report.sample_documents(result.metrics, asdict(params), run_type="bulk_gbc")
    documents.select("sample", "document").write.mode("overwrite").partitionBy("sample").text(f"{out}/documents")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="strandlake", description=__doc__.splitlines()[0])
    steps = top.add_subparsers(dest="step", required=True)
    for name, kinds in (("bulk", (BulkParams,)), ("cells", (ScParams, CellParams))):
        own = steps.add_parser(name)
        own.add_argument("sheet")
        own.add_argument("out")
        own.add_argument("--params", help="a JSON file of parameters")
        for kind in kinds:
            _options(own, kind)
    steps.choices["bulk"].add_argument("--spikeins")
    cells = steps.choices["cells"]
    cells.add_argument("--type", required=True, choices=["fastq", "fastq,GBC", "bam"])
    cells.add_argument("--whitelist", help="a file of possible barcodes, for FASTQ input")
    cells.add_argument("--cassette", help="a FASTA file with the contig, for FASTQ input")
    cells.add_argument("--bulk-reference")
    cells.add_argument("--sample-map")
    cells.add_argument("--sample-params")
    page = steps.add_parser("report")
    page.add_argument("folder")
    page.add_argument("page")
    page.add_argument("--title", default="Barcode run")
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = spark or session()
    if args.step == "bulk":
        params = _params(args, BulkParams)
        write_bulk(spark, entry.run_bulk_sheet(spark, args.sheet, params, args.spikeins), params, args.out)
    elif args.step == "cells":
        params = _params(args, ScParams)
        read = lambda path, reader: reader(spark, path) if path else None
        cassette = args.cassette and [(r["name"], r["seq"]) for r in sequences.fasta_extract(spark, args.cassette, params.contig).collect()]
        result = entry.run_sheet(
            spark, args.sheet, args.type, params, whitelist=read(args.whitelist, tables.barcode_list), cassette=cassette, cell_params=_params(args, CellParams),
            bulk=read(args.bulk_reference, tables.bulk_reference), sample_map=read(args.sample_map, tables.sample_map), sample_params=read(args.sample_params, tables.sample_params),
        )
        documents = report.sample_documents(result.metrics, asdict(params), run_type="sc_gbc", input_type=args.type)
        entry.write_run(result, documents, f"{args.out}/samples")
        sinks.write_clones(result.clones, f"{args.out}/clones")
        sinks.write_cells(result.cells, f"{args.out}/cells")
    else:
        page = entry.run_report(entry.gather(spark, args.folder), args.title)
        with bam.open_file(entry.absolute(args.page), "w") as f:
            f.write(page.encode())


if __name__ == "__main__":
    main()
