"""Whole runs from sheets, and results gathered from folders."""

import gzip
import json
import random

import pytest

from strandlake.operators.cells import CellParams
from strandlake.params import ScParams
from strandlake.plans import entry, report
from strandlake.plans.single_cell import run_single_cell
from strandlake.sources import bam

ANCHOR = "TAGCAAACTGGGGCACAAGCTTAATTAAGAATT"
CASSETTE = [("lentiCassette", ANCHOR + "N" * 18 + "GGATCCACTAGTTCTAGAGC")]
PARAMS = ScParams(min_reads=3, umi_threshold=2)
RNG = random.Random(7)
BASES = lambda n: "".join(RNG.choices("ACGT", k=n))
CELLS = [BASES(16) for _ in range(8)]
AMBIENT = [BASES(16) for _ in range(40)]
GBCS = [BASES(18), BASES(18)]
OF = {c: GBCS[i % 4 == 0] for i, c in enumerate(CELLS)}
REVERSED = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def library():
    """(read_id, CB, UB, cassette read) of four molecules a cell, five reads each, some on the other strand."""
    out = []
    for c in CELLS:
        for m in range(4):
            umi = BASES(12)
            for r in range(5):
                out.append((f"r{len(out)}", c, umi, ANCHOR + REVERSED(OF[c]) + "GGATCC"))
    return out


READS = library()


def fastq(path, reads):
    with gzip.open(path, "wt") as f:
        for name, seq in reads:
            f.write(f"@{name} x\n{seq}\n+\n{'I' * len(seq)}\n")


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    top = tmp_path_factory.mktemp("runs")
    gbc, tenx = top / "gbc", top / "tenx"
    gbc.mkdir()
    tenx.mkdir()
    misread = lambda c, i: c if i % 9 else c[:5] + ("A" if c[5] != "A" else "C") + c[6:]
    fastq(gbc / "a_R1_001.fastq.gz", [(n, misread(c, i) + u) for i, (n, c, u, _) in enumerate(READS)] + [("stray", BASES(28))])
    fastq(gbc / "a_R2_001.fastq.gz", [(n, s if i % 3 else REVERSED(s)) for i, (n, _, _, s) in enumerate(READS)] + [("stray", BASES(57))])
    fastq(tenx / "b_R1_001.fastq.gz", [(f"t{i}", c + BASES(12)) for i, c in enumerate([c for c in CELLS for _ in range(60)] + [c for c in AMBIENT for _ in range(2)])])
    fastq(tenx / "b_R2_001.fastq.gz", [])
    (top / "cells.tsv").write_text("\n".join(CELLS) + "\n")
    return top


def clones(result):
    return {(r["sample"], r.clone, r.GBC_set, r.n_cells) for r in result.clones.collect()}


WANT = {("s", "C0", GBCS[0], 6), ("s", "C1", GBCS[1], 2)}


def run(spark, folders, kind, head, rows, **more):
    sheet = folders / f"{kind.replace(',', '_')}.csv"
    sheet.write_text(head + "\n" + "\n".join(rows) + "\n")
    return entry.run_sheet(spark, str(sheet), kind, PARAMS, **more)


def whitelist(spark):
    return spark.createDataFrame([(c,) for c in CELLS + AMBIENT], "CB string")


def test_barcode_library_and_cells(spark, folders):
    result = run(spark, folders, "fastq,GBC", "sample,fastq_folder,cell_barcodes", [f"s,{folders}/gbc,{folders}/cells.tsv"], whitelist=whitelist(spark), cassette=CASSETTE)
    assert clones(result) == WANT
    m = result.metrics.first()
    assert (m.starting_CBCs, m.uniquely_barcoded_cells, m.n_clones) == (8, 8, 2)


def test_both_libraries(spark, folders):
    rows = [f"s,{folders}/tenx,TENX", f"s,{folders}/gbc,GBC"]
    result = run(spark, folders, "fastq", "sample,fastq_folder,library", rows, whitelist=whitelist(spark), cassette=CASSETTE, cell_params=CellParams(expected_cells=100))
    assert clones(result) == WANT
    with pytest.raises(ValueError, match="both kinds"):
        run(spark, folders, "fastq", "sample,fastq_folder,library", rows[:1], whitelist=whitelist(spark), cassette=CASSETTE)


def test_aligned_reads(spark, folders):
    rows = [(n, 0, "lentiCassette", 1, 60, "57M", s, "I" * len(s), c, u) for n, c, u, s in READS] + [("m", 0, "chrM", 1, 60, "4M", "ACGT", "IIII", CELLS[0], "A" * 12)]
    bam.write_sorted(spark.createDataFrame(rows, bam.SCHEMA), f"{folders}/sorted", [("chrM", 1000), ("lentiCassette", 1000)], files=2)
    result = run(spark, folders, "bam", "sample,bam,cell_barcodes", [f"s,{folders}/sorted/*.bam,{folders}/cells.tsv"])
    assert clones(result) == WANT


def test_what_is_refused(spark, folders):
    with pytest.raises(ValueError, match="unknown input type"):
        run(spark, folders, "cram", "sample,bam,cell_barcodes", ["s,x,y"])
    with pytest.raises(ValueError, match="whitelist"):
        run(spark, folders, "fastq", "sample,fastq_folder,library", ["s,x,TENX"])
    with pytest.raises(ValueError, match="no sample"):
        run(spark, folders, "bam", "sample,bam,cell_barcodes", [])


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("results") / "out")
    rows = [(s, f"c{i}", f"u{j}", GBCS[0]) for s, n in (("a b", 3), ("c=d", 5)) for i in range(n) for j in range(6)]
    result = run_single_cell(spark.createDataFrame(rows, "sample string, CBC string, UMI string, GBC string"))
    entry.write_run(result, report.sample_documents(result.metrics, {"umi": 5}, run_type="sc_gbc", input_type="bam"), folder)
    return folder


def test_gathered(spark, results):
    found = entry.gather(spark, results)
    got = {r["sample"]: r for r in found.quality.collect()}
    assert set(got) == {"a b", "c=d"} and (got["a b"].n, got["c=d"].n, got["c=d"].median, got["a b"].moi) == (3, 5, 6, 1)
    assert {r["sample"]: r.metrics["starting_CBCs"] for r in found.samples.collect()} == {"a b": 3, "c=d": 5}
    assert found.umis.count() == 8


def test_incomplete_folders_are_left_out(spark, results, tmp_path):
    import shutil

    top = tmp_path / "more"
    shutil.copytree(results, top / "deep")
    for name, files in (("half", {"run_summary.json": "{}"}), ("broken", {"run_summary.json": "{no", "CBC_GBC_combos.tsv.gz": None}), ("named", {"run_summary.json": json.dumps({"samples": [{"id": None, "metrics": {"mapped_reads": 7, "median_moi": 2.5}}]}), "CBC_GBC_combos.tsv.gz": "\tCBC\tumi\n0\tc\t4\n1\td\t0\n2\te\tx\n"})):
        (top / name).mkdir()
        for f, text in files.items():
            if f.endswith("gz"):
                with gzip.open(top / name / f, "wt") as out:
                    out.write(text or "\tCBC\tumi\n")
            else:
                (top / name / f).write_text(text)
    found = entry.gather(spark, str(top))
    got = {r["sample"]: r for r in found.quality.collect()}
    assert set(got) == {"a b", "c=d", "named"} and (got["named"].reads, got["named"].moi, got["named"].n) == (7, 2.5, 1)
    with pytest.raises(ValueError, match="no results"):
        entry.gather(spark, str(top / "half"))


def test_combos_are_numbered_without_gaps(spark, results):
    rows = spark.read.csv(f"{results}/*/CBC_GBC_combos.tsv.gz", sep="\t", header=True).collect()
    assert sorted(int(r["_c0"]) for r in rows) == sorted([*range(3), *range(5)])


def test_report(spark, results):
    found = entry.gather(spark, results)
    page = entry.run_report(found, "A run")
    assert page.count("<svg") == 2 and page.count("<details") == 2 and "starting_CBCs" in page and "<h1>A run</h1>" in page
    own = entry.run_report(found, template="<script>const d = {{DATA}};</script>")
    data = json.loads(own.removeprefix("<script>const d = ").removesuffix(";</script>"))
    assert {s["id"] for s in data["samples"]} == {"a b", "c=d"} and len(data["run_level_qc"]) == 2
    with pytest.raises(ValueError, match="no"):
        entry.run_report(found, template="<html></html>")


def test_charts():
    import xml.etree.ElementTree as ET

    from strandlake.plans import charts

    for svg in (charts.bars("t <1>", [("a", 3.0), ("b&c", 1250000.0)]), charts.bars("none", []), charts.boxes("b", [("a", 1, 2, 3, 4, 2000), ("b", 5, 5, 5, 5, 5)]), charts.boxes("one", [("a", 2, 2, 2, 2, 2)])):
        assert ET.fromstring(svg).tag.endswith("svg")
    assert charts.number(1250000.0) == "1,250,000" and charts.number(2.5) == "2.5" and charts.as_image("<svg/>").startswith("data:image/svg+xml;base64,")


def test_command_line(spark, folders, tmp_path):
    from strandlake.__main__ import main

    (tmp_path / "sheet.csv").write_text(f"sample,fastq_folder,cell_barcodes\ns,{folders}/gbc,{folders}/cells.tsv\n")
    (tmp_path / "list.txt").write_text("\n".join(CELLS) + "\n")
    (tmp_path / "cassette.fa").write_text(f">lentiCassette of a test\n{CASSETTE[0][1]}\n")
    (tmp_path / "p.json").write_text(json.dumps({"min_reads": 3, "umi_threshold": 9, "sheet": "None", "other": 1}))
    out = str(tmp_path / "out")
    main(["cells", str(tmp_path / "sheet.csv"), out, "--type", "fastq,GBC", "--params", str(tmp_path / "p.json"), "--umi-threshold", "2", "--whitelist", str(tmp_path / "list.txt"), "--cassette", str(tmp_path / "cassette.fa"), "--error-model", "true"], spark)
    assert {(r["GBC_set"], int(r["n cells"])) for r in spark.read.csv(f"{out}/clones", header=True).collect()} == {(GBCS[0], 6), (GBCS[1], 2)}
    main(["report", f"{out}/samples", str(tmp_path / "page.html"), "--title", "T"], spark)
    assert "<h1>T</h1>" in (tmp_path / "page.html").read_text()
    reads = tmp_path / "bulk" / "run"
    reads.mkdir(parents=True)
    anchor = "GGGTTTAAACGGGCCCTCTAG"
    fastq(reads / "x_R1_1.fastq.gz", [(f"b{i}", "TT" + anchor + "A" + GBCS[0] + "CC") for i in range(20)])
    fastq(reads / "x_R2_1.fastq.gz", [("c", "ACGT")])
    (tmp_path / "bulk.csv").write_text(f"ID_we_want,path_bulk,folder_name_bulk\ns,{tmp_path}/bulk,run\n")
    main(["bulk", str(tmp_path / "bulk.csv"), f"{out}/bulk", "--min-n-reads", "5", "--method", "cluster"], spark)
    assert [(r["gbc"], r["read_count"]) for r in spark.read.csv(f"{out}/bulk/reference", header=True).collect()] == [(GBCS[0], "20")]
    assert spark.read.text(f"{out}/bulk/search_patterns").count() == 21
