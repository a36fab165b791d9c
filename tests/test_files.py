"""Sources and sinks on files, and the stream."""

import gzip

import pytest

from strandlake.operators import channels
from strandlake.params import BulkParams
from strandlake.sources import sequences, sinks, tables
from strandlake.streaming.counts import count_available, counts_to_table


def fastq(path, reads):
    with gzip.open(path, "wt") as f:
        for name, seq in reads:
            f.write(f"@{name} extra\n{seq}\n+\n{'I' * len(seq)}\n")


def test_fastq(spark, tmp_path):
    for k in range(5):
        fastq(tmp_path / f"x_L{k}_R1_001.fastq.gz", [(f"a{k}_{i}", "ACGT" * (i + 1)) for i in range(7 + k)])
    fastq(tmp_path / "x_L0_R2_001.fastq.gz", [("b", "TTTT")])
    assert sequences.fastq_read_count(spark, str(tmp_path)) == sum(7 + k for k in range(5))
    reads = sequences.merged_mate(spark, str(tmp_path), "R1", "s").collect()
    assert len(reads) == 45 and all(len(r.seq) == len(r.qual) for r in reads)
    assert {r.read_id for r in reads} == {f"a{k}_{i}" for k in range(5) for i in range(7 + k)}
    assert sorted(r.seq for r in sequences.bulk_reads(spark, str(tmp_path), "s").collect()) == sorted([r.seq for r in reads] + ["TTTT"])


def test_records_are_found_in_any_split(spark, tmp_path):
    """Plain files over many splits, with quality lines that begin as name lines do, read as in one piece."""
    import random

    rng = random.Random(4)
    reads = [(f"r{i}", "".join(rng.choices("ACGT", k=n)), "".join(rng.choices("@@+IA", k=n))) for i, n in enumerate(rng.randint(0 if i % 50 == 0 else 1, 60) for i in range(2000))]
    for k in range(3):
        (tmp_path / f"p{k}.fastq").write_text("".join(f"@{a} x\n{b}\n+{a if k else ''}\n{c}\n" for a, b, c in reads[k::3]) + "\n" * (k == 2))
    kept = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in (700, 5000, 1 << 27):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", 1)
            df = sequences.fastq(spark, str(tmp_path / "*.fastq"))
            assert sorted((r.read_id, r.seq, r.qual) for r in df.collect()) == sorted(reads)
            assert sorted(r.seq for r in sequences.fastq_sequences(spark, str(tmp_path / "*.fastq"), "s").collect()) == sorted(b for _, b, _ in reads)
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)


def test_a_broken_file_is_told_and_moves_no_other(spark, tmp_path):
    for k in range(6):
        fastq(tmp_path / f"x{k}.fastq.gz", [(f"a{k}_{i}", "ACGTACGT") for i in range(200)])
    with gzip.open(tmp_path / "x0.fastq.gz", "rt") as f:
        lines = f.readlines()
    for broken in (lines[:-1], lines[:401] + lines[402:], lines[:402] + lines[403:], lines[:400] + ["ACGTACGT\n"] + lines[400:]):
        with gzip.open(tmp_path / "x0.fastq.gz", "wt") as f:
            f.writelines(broken)
        with pytest.raises(Exception, match="not a FASTQ record"):
            sequences.fastq(spark, str(tmp_path / "*.fastq.gz")).collect()
    with gzip.open(tmp_path / "x0.fastq.gz", "wt") as f:
        f.writelines(lines[:-4])
    assert [r.seq for r in sequences.fastq_sequences(spark, str(tmp_path / "*.fastq.gz"), "s").collect()] == ["ACGTACGT"] * 1199


def test_fasta(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">chr1 x\nACGT\nAC\n>lentiCassette_v2\nGGG\nTT\n")
    assert [tuple(r) for r in sequences.fasta_extract(spark, str(tmp_path / "g.fa"), "lenti").collect()] == [("lenti", "GGGTT")]


def test_sheets(spark, tmp_path):
    (tmp_path / "b.csv").write_text("ID_we_want,path_bulk,folder_name_bulk\ns1,/data,run1\n")
    assert tables.bulk_sheet(spark, str(tmp_path / "b.csv")).first() == ("s1", "/data/run1")
    (tmp_path / "f.csv").write_text("sample,fastq_folder,library\ns1,/a,TENX\ns1,/b,GBC\n")
    tenx, gbc = channels.split_libraries(tables.sc_sheet(spark, str(tmp_path / "f.csv"), "fastq"))
    assert (tenx.first().fastq_folder, gbc.first().fastq_folder) == ("/a", "/b")
    (tmp_path / "m.csv").write_text("sample,bam,cell_barcodes\ns1,/x.bam,/cb\n")
    sheet = tables.sc_sheet(spark, str(tmp_path / "m.csv"), "bam")
    assert tables.bam_path(sheet, "s1") == "/x.bam" and tables.bam_path(sheet, "s2") is None
    with pytest.raises(ValueError, match="unknown input type"):
        tables.sc_sheet(spark, str(tmp_path / "m.csv"), "cram")


def test_small_tables(spark, tmp_path):
    (tmp_path / "cb.tsv").write_text("AAA\nCCC\n")
    assert [r.CB for r in tables.barcode_list(spark, str(tmp_path / "cb.tsv")).collect()] == ["AAA", "CCC"]
    assert tables.line_count(spark, str(tmp_path / "cb.tsv")) == 2
    (tmp_path / "g.tsv").write_text("ACG\n\nNA\n")
    assert [r.gbc for r in tables.gbc_list(spark, str(tmp_path / "g.tsv")).collect()] == ["ACG", "NA"]
    (tmp_path / "s.csv").write_text("gbc,other\nACG,1\n")
    assert tables.spikeins(spark, str(tmp_path / "s.csv")).first().gbc == "ACG"
    assert tables.spikeins(spark, None) is None and tables.spikeins(spark, "None") is None and tables.spikeins(spark, str(tmp_path / "no.csv")) is None
    (tmp_path / "c.csv").write_text(",read_counts\nACG,5\n")
    assert tuple(tables.count_table(spark, str(tmp_path / "c.csv")).first()) == ("ACG", 5)
    (tmp_path / "r.csv").write_text(",gbc,read_count,sample\n0,ACG,5,a\n1,TTT,6,b\n")
    assert [r.gbc for r in tables.bulk_reference(spark, str(tmp_path / "r.csv"), "b").collect()] == ["TTT"]
    (tmp_path / "map.csv").write_text("sample,reference\ns,r\n")
    assert tuple(tables.sample_map(spark, str(tmp_path / "map.csv")).first()) == ("s", "r")
    (tmp_path / "p.csv").write_text("sample,umi_treshold,p_treshold,max_ratio_treshold,normalized_abundance_treshold\ns,5,1,.75,.5\n")
    assert tuple(tables.sample_params(spark, str(tmp_path / "p.csv")).first()) == ("s", 5, 1, 0.75, 0.5)


def test_tolerant_reads(spark, tmp_path):
    (tmp_path / "a/x").mkdir(parents=True)
    (tmp_path / "b").mkdir()
    (tmp_path / "a/x/run_summary.json").write_text('{"sample": "s1",\n "n": 3}')
    (tmp_path / "b/run_summary.json").write_text('{"sample": ')
    assert [(r.sample, r.n) for r in tables.json_documents(spark, str(tmp_path), "sample string, n long").collect()] == [("s1", 3)]
    with pytest.raises(Exception):
        tables.json_documents(spark, str(tmp_path), "sample string, n long", strict=True).collect()
    with gzip.open(tmp_path / "a/x/CBC_GBC_combos.tsv.gz", "wt") as f:
        f.write("\tCBC\tGBC\tumi\tmax_ratio\tnormalized_abundance\tp\tlogp\tlogumi\tstatus\n0\tc\tg\t5\t1\t1\t.5\t.3\t.7\tsupported\n1\tc\th\tx\t1\t1\t.5\t.3\t.7\tsupported\n2\tc\ti\t0\t1\t1\t.5\t.3\t.7\tsupported\n")
    assert [r.folder.rsplit("/", 1)[1] for r in tables.complete_directories(spark, str(tmp_path)).collect()] == ["x"]
    assert [(r.GBC, r.umi) for r in tables.combos(spark, str(tmp_path / "a/x/CBC_GBC_combos.tsv.gz")).collect()] == [("g", 5.0)]


def test_sinks(spark, tmp_path):
    raw = spark.createDataFrame([("a", "ACG", 5), ("b", "TTT", 6)], "sample string, gbc string, read_counts long")
    sinks.write_raw_counts(raw, f"{tmp_path}/raw")
    back = spark.read.csv(f"{tmp_path}/raw", header=True, inferSchema=True)
    assert sorted((r.sample, r.gbc, r.read_counts) for r in back.collect()) == [("a", "ACG", 5), ("b", "TTT", 6)]
    sinks.write_parquet(raw, f"{tmp_path}/pq")
    assert spark.read.parquet(f"{tmp_path}/pq").where("sample = 'b'").count() == 1
    sinks.write_metrics_csv(spark.createDataFrame([("a", None)], "sample string, n long"), f"{tmp_path}/m")
    assert any('"NA"' in p.read_text() or ",NA" in p.read_text() for p in (tmp_path / "m").glob("part-*"))
    sinks.write_json(raw, f"{tmp_path}/j")
    assert spark.read.json(f"{tmp_path}/j").count() == 2


def test_stream(spark, tmp_path):
    anchor = BulkParams().anchor
    gbc = "ACGTACGTACGTACGTAC"
    rows = spark.createDataFrame([("s", f"{anchor}T{gbc}")] * 4 + [("s", "AC")], "sample string, seq string")
    rows.repartition(2).write.parquet(f"{tmp_path}/in")
    assert [(r.sample, r.gbc, r.read_counts) for r in count_available(spark, f"{tmp_path}/in", f"{tmp_path}/cp", "streamed").collect()] == [("s", gbc, 4)]
    query = counts_to_table(spark.readStream.schema("sample string, seq string").parquet(f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/cp2")
    query.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").groupBy("gbc").sum("read_counts").first()[1] == 4


def test_counts_order(spark, tmp_path):
    """Files in the order of their names hold a sample's barcodes by count, ties by barcode."""
    rows = [(s, f"G{n:03d}", n * 37 % 11) for s in ("a", "b") for n in range(50)]
    sinks.write_counts(spark.createDataFrame(rows, "sample string, gbc string, read_count long").repartition(5), f"{tmp_path}/counts")
    for s in ("a", "b"):
        lines = [x for f in sorted((tmp_path / "counts" / f"sample={s}").glob("part-*")) for x in f.read_text().splitlines() if x != "gbc,read_count"]
        assert [tuple(x.split(",")) for x in lines] == [(g, str(n)) for _, g, n in sorted((r for r in rows if r[0] == s), key=lambda r: (-r[2], r[1]))]


def test_fastq_scans(spark, tmp_path):
    """Records whose quality line is cut are told from two readings of the files, each splitting a piece once."""
    text = "".join(f"@r{k} of{chr(9)}x\nACGT\n+\n{'@III' if k % 3 == 0 else 'IIII'}\n" for k in range(30))
    (tmp_path / "x_R1_001.fastq").write_text(text)
    found = sequences.fastq(spark, str(tmp_path / "*_R1_*.fastq"))
    assert sorted((r.read_id, r.seq, r.qual) for r in found.collect()) == sorted((f"r{k}", "ACGT", "@III" if k % 3 == 0 else "IIII") for k in range(30))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("] text") == 1 and plan.count("split(") == 1
