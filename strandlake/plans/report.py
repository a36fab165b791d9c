"""Run-level documents: JSON of all samples and a page that shows it."""

from __future__ import annotations

import html
import json
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.plans import charts

#: A click on a column's head sorts the table by it, a second one the other way: by number if all its cells are numbers.
SORT = """for (const head of document.querySelectorAll("th")) head.onclick = () => {
  const body = document.querySelector("tbody"), rows = [...body.rows], text = r => r.cells[head.cellIndex].textContent.trim();
  const numeric = rows.every(r => text(r) !== "" && !isNaN(text(r))), sign = head.dataset.sign = head.dataset.sign === "1" ? -1 : 1;
  rows.sort((a, b) => sign * (numeric ? text(a) - text(b) : text(a).localeCompare(text(b))));
  body.append(...rows);
};"""

PAGE = """<!doctype html><html><head><meta charset="utf-8"><title>{title}</title>
<style>body{{font:15px sans-serif;margin:2em}}table{{border-collapse:collapse}}td,th{{border:1px solid #999;padding:.3em .6em;text-align:right}}td:first-child{{text-align:left}}</style>
</head><body><h1>{title}</h1><p>{date}</p><h2>Parameters</h2><ul>{params}</ul><h2>Samples</h2>
<input placeholder="search" oninput="for(const r of document.querySelectorAll('tbody tr'))r.hidden=!r.textContent.toLowerCase().includes(this.value.toLowerCase())">
<table><thead><tr>{head}</tr></thead><tbody>{rows}</tbody></table>{quality}{cards}
<script type="application/json" id="data">{data}</script><script>{sort}</script></body></html>"""


#: What the metrics of a run are, for its documents.
METRICS = {
    "total_reads": "Reads of the sample", "mapped_reads": "Reads that are mapped", "unmapped_reads": "Reads that aren't mapped",
    "unique_gbc_bulk_ref": "Barcodes in the bulk reference", "unique_gbc_sc": "Barcodes seen in single cells", "unique_good_GBCs": "Barcodes left after filtering",
    "unsupported_combos": "Pairs of cell and barcode without support", "supported_combos": "Pairs of cell and barcode with support",
    "observed_moi_median": "Median of barcodes a cell", "observed_moi_std": "Standard deviation of barcodes a cell", "starting_CBCs": "Cells with any barcode",
    "uniquely_barcoded_cells": "Cells with one barcode", "n_clones": "Clones", "n_clones_10plus": "Clones of ten cells or more",
    "n_putative_cells": "Cells that were called", "total_n_transcripts": "Transcripts that were seen",
    "total_GBC_reads": "Reads with a barcode", "n_unique_GBCs": "Barcodes as read", "n_filtered_GBCs": "Barcodes in the whitelist",
    "n_corrected_GBCs": "Barcodes that others were corrected to", "n_degenerated_GBCs": "Barcodes that were corrected", "median_n_reads_added": "Median of reads that a correction adds",
}


def sample_documents(metrics: DataFrame, parameters: dict, *, run_type: str = "bulk_gbc", input_type: str | None = None, images: DataFrame | None = None, day: date | None = None, user: str | None = None, folder: str | None = None) -> DataFrame:
    """(sample, document): one JSON document a sample with the run, its parameters, what the metrics mean, and the sample's own.

    ``images``: (sample, title, image), images as base64.
    """
    values = [c for c in metrics.columns if c != "sample"]
    own = metrics
    if images is None:
        own = own.withColumn("qc_images", F.expr("cast(array() as array<struct<title:string,image:string>>)"))
    else:
        own = own.join(images.groupBy("sample").agg(F.array_sort(F.collect_list(F.struct("title", "image"))).alias("qc_images")), "sample", "left")
    run = F.struct(F.lit(str(day or date.today())).alias("date"), F.lit(user).alias("user"), F.lit(folder).alias("working_directory"))
    settings = F.struct(*(F.lit(None if v is None else str(v)).alias(k) for k, v in sorted(parameters.items()))) if parameters else F.struct(F.lit(None).cast("string").alias("none"))
    told = F.struct(*(F.lit(METRICS[c]).alias(c) for c in values if c in METRICS))
    sample = F.struct(F.col("sample").alias("id"), F.struct(*values).alias("metrics"), "qc_images", F.lit(input_type).alias("raw_data_input_type"))
    body = F.struct(F.lit(run_type).alias("run_type"), run.alias("run_info"), settings.alias("parameters"), told.alias("metrics_info"), F.array(sample).alias("samples"))
    return own.select("sample", F.to_json(body).alias("document"))


def run_document(metrics: DataFrame, parameters: dict, *, run_type: str, day: date | None = None) -> dict:
    """All samples' metrics with the run's parameters; a row for each sample reaches the driver."""
    rows = [r.asDict(recursive=True) for r in metrics.orderBy("sample").collect()]
    samples = [{"id": r.pop("sample"), "metrics": r} for r in rows]
    return {"run_type": run_type, "run_info": {"date": str(day or date.today())}, "parameters": parameters, "samples": samples}


def run_charts(quality: DataFrame) -> dict[str, str]:
    """Charts of a run from (sample, reads, moi, n, q1, median, q3, low, high), by title; a row for each sample reaches the driver."""
    rows = quality.orderBy("sample").collect()
    known = lambda c: [(r["sample"], float(r[c])) for r in rows if r[c] is not None]
    out = {title: charts.bars(title, known(c)) for title, c in (("Total reads", "reads"), ("Median MOI", "moi")) if known(c)}
    umis = [(r["sample"], *(float(r[c]) for c in ("low", "q1", "median", "q3", "high"))) for r in rows if r["n"]]
    return out | ({"UMIs of a combination": charts.boxes("UMIs of a combination", umis)} if umis else {})


def _card(sample: dict) -> str:
    """A sample's own metrics and images, folded until it is asked for."""
    shown = lambda v: "NA" if v is None else charts.number(v) if isinstance(v, (int, float)) else html.escape(str(v))
    lines = "".join(f"<li title=\"{html.escape(METRICS.get(k, ''))}\">{html.escape(k)}: {shown(v)}</li>" for k, v in sample["metrics"].items() if v is not None)
    images = "".join(f'<figure><img src="data:image/png;base64,{i["image"]}"><figcaption>{html.escape(str(i["title"]))}</figcaption></figure>' for i in sample.get("qc_images") or [])
    return f'<details id="sample-{html.escape(str(sample["id"]))}"><summary>{html.escape(str(sample["id"]))}</summary><ul>{lines}</ul>{images}</details>'


def report_page(document: dict, title: str = "Barcode run", *, figures: dict[str, str] | None = None, template: str | None = None, token: str = "{{DATA}}") -> str:
    """A page of its own with the run's table, its charts and a card for each sample; columns without any value are left out.

    With a template of one's own only its token is replaced, by the document as JSON.
    """
    data = json.dumps(document | ({"run_level_qc": [{"title": t, "image": charts.as_image(svg)} for t, svg in figures.items()]} if figures else {}), default=str).replace("</", "<\\/")
    if template is not None:
        if token not in template:
            raise ValueError(f"the template has no {token}")
        return template.replace(token, data)
    names = list(dict.fromkeys(k for s in document["samples"] for k, v in s["metrics"].items() if v is not None))
    cell = lambda v: "NA" if v is None else f"{v:.4g}" if isinstance(v, float) else html.escape(str(v))
    rows = "".join(f"<tr><td>{html.escape(str(s['id']))}</td>" + "".join(f"<td>{cell(s['metrics'].get(n))}</td>" for n in names) + "</tr>" for s in document["samples"])
    params = "".join(f"<li>{html.escape(str(k))}: {html.escape(str(v))}</li>" for k, v in document["parameters"].items())
    head = "".join(f"<th>{html.escape(n)}</th>" for n in ["sample", *names])
    quality = "".join(["<h2>Quality</h2>", *figures.values()]) if figures else ""
    cards = "<h2>Each sample</h2>" + "".join(map(_card, document["samples"]))
    return PAGE.format(title=html.escape(title), date=html.escape(str((document.get("run_info") or {}).get("date", ""))), params=params, head=head, rows=rows, quality=quality, cards=cards, sort=SORT, data=data)


def summary_text(metrics: dict, sample: str) -> str:
    """The clone-calling summary of a sample as lines that :func:`strandlake.sources.tables.clone_summary` reads."""
    m, shown = metrics, lambda x: "nan" if x is None else f"{x:.2f}"
    return "\n".join([
        f"# Clone calling, sample {sample}",
        f"- Unique, \"good\" GBCs: {m['unique_good_GBCs']}",
        f"- n unsupported CBC-GBC combos: {m['unsupported_combos']}",
        f"- n supported CBC-GBC combos: {m['supported_combos']}",
        f"- Observed MOI: {shown(m['observed_moi_median'])} median, (+-{shown(m['observed_moi_std'])})",
        f"- n starting CBC: {m['starting_CBCs']}",
        f"- n uniquely barcoded cells: {m['uniquely_barcoded_cells']}",
        f"- n clones: {m['n_clones']}",
        f"- n clones>=10 cells: {m['n_clones_10plus']}",
    ])
