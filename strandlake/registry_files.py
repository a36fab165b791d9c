"""Queries that go through files: what a sink writes, a source reads again, against SQL on the tables themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake import fixtures as fx
from strandlake.operators import bulk, bulk_summary, consensus, sc
from strandlake.params import BulkParams, ScParams
from strandlake.plans import entry, report, single_cell
from strandlake.registry import BULK, CELLS, COMBOS, CONSENSUS, ELEMENTS, LABELS, LOOSE, ONE, ORACLES, OVERLAP, POOL, RAW, SCORED, STRICT, STRICT_CELLS, UMIS, _cells, _corrections, _pool, _raw, _scored, _umis, clones_sql, query, rounded, status_sql
from strandlake.sources import bam, sequences, sinks, tables
from strandlake.storage import materialise, scratch_path


def _sheet(spark, sf_dir, *columns) -> str:
    """A sheet from the nations, its columns in this order."""
    path = scratch_path(spark, "sheet")
    sinks.write_csv(spark.read.parquet(f"{sf_dir}/nation.parquet").select(*columns), path)
    return path


def _name(prefix: str, column: str = "n_nationkey"):
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


# -- sheets and lists


@query("SELECT 's' || n_nationkey AS sample, '/data/' || n_regionkey || '/run' || n_nationkey AS folder FROM nation")
def file_bulk_sheet(spark, sf_dir):
    return tables.bulk_sheet(spark, _sheet(spark, sf_dir, _name("run").alias("folder_name_bulk"), F.col("n_name").alias("note"), _name("s").alias("ID_we_want"), _name("/data/", "n_regionkey").alias("path_bulk")))


@query("SELECT 's' || n_nationkey AS sample, '/fq/' || n_regionkey AS fastq_folder, CASE WHEN n_nationkey % 2 = 0 THEN 'TENX' ELSE 'GBC' END AS library FROM nation")
def file_sc_sheet_fastq(spark, sf_dir):
    library = F.when(F.col("n_nationkey") % 2 == 0, "TENX").otherwise("GBC")
    return tables.sc_sheet(spark, _sheet(spark, sf_dir, library.alias("library"), _name("s").alias("sample"), _name("/fq/", "n_regionkey").alias("fastq_folder")), "fastq")


@query("SELECT 's' || n_nationkey AS sample, '/fq/' || n_regionkey AS fastq_folder, '/cb/' || n_nationkey AS cell_barcodes FROM nation")
def file_sc_sheet_barcodes(spark, sf_dir):
    return tables.sc_sheet(spark, _sheet(spark, sf_dir, _name("/cb/").alias("cell_barcodes"), _name("/fq/", "n_regionkey").alias("fastq_folder"), _name("s").alias("sample")), "fastq,GBC")


@query("SELECT 's' || n_nationkey AS sample, '/x' || n_nationkey || '.bam' AS bam, '/cb/' || n_nationkey AS cell_barcodes FROM nation")
def file_sc_sheet_bam(spark, sf_dir):
    return tables.sc_sheet(spark, _sheet(spark, sf_dir, F.concat(_name("/x"), F.lit(".bam")).alias("bam"), _name("/cb/").alias("cell_barcodes"), _name("s").alias("sample")), "bam")


@query("SELECT 's' || n_nationkey AS sample, 'r' || n_regionkey AS reference FROM nation")
def file_sample_map(spark, sf_dir):
    return tables.sample_map(spark, _sheet(spark, sf_dir, _name("r", "n_regionkey").alias("reference"), _name("s").alias("sample")))


@query(f"SELECT * FROM ({fx.SAMPLE_PARAMS}) p")
def file_sample_params(spark, sf_dir):
    path, own = scratch_path(spark, "params"), fx.sample_params(spark, sf_dir)
    sinks.write_csv(own.select(*reversed(own.columns)), path)
    return tables.sample_params(spark, path)


@query(f"WITH {RAW} SELECT DISTINCT gbc FROM raw")
def file_gbc_list(spark, sf_dir):
    path = scratch_path(spark, "gbcs")
    _raw(spark, sf_dir).select("gbc").distinct().write.text(path)
    return tables.gbc_list(spark, path)


@query(f"WITH {ELEMENTS} SELECT DISTINCT CBC AS CB FROM el")
def file_barcode_list(spark, sf_dir):
    path = scratch_path(spark, "barcodes")
    sc.read_elements(fx.sc_elements(spark, sf_dir)).select("CBC").distinct().write.option("compression", "gzip").text(path)
    return tables.barcode_list(spark, path)


@query(f"SELECT gbc FROM ({fx.SPIKEINS}) s")
def file_spikeins(spark, sf_dir):
    path = scratch_path(spark, "spikes")
    sinks.write_csv(fx.spikeins(spark, sf_dir), path)
    return tables.spikeins(spark, path)


@query(f"WITH {ELEMENTS} SELECT count(DISTINCT CBC)::bigint AS lines FROM el")
def file_line_count(spark, sf_dir):
    path = scratch_path(spark, "lines")
    sc.read_elements(fx.sc_elements(spark, sf_dir)).select("CBC").distinct().write.option("compression", "gzip").text(path)
    return spark.range(1).select(F.lit(tables.line_count(spark, path)).cast("long").alias("lines"))


# -- reads


def _fastq(spark, sf_dir) -> str:
    """The bulk reads as compressed FASTQ files of two mates."""
    path = scratch_path(spark, "fastq")
    reads = fx.bulk_reads(spark, sf_dir).select(F.concat_ws("_", "sample", "o", "ln").alias("read_id"), "seq", F.repeat(F.lit("I"), F.length("seq")).alias("qual"), "o")
    sinks.write_fastq(reads.where("o % 2 = 0"), path, "R1")
    sinks.write_fastq(reads.where("o % 2 = 1"), path, "R2")
    return path


@query(f"WITH {RAW} SELECT gbc, sum(read_counts)::bigint AS read_counts FROM raw GROUP BY gbc")
def file_bulk_fastq(spark, sf_dir):
    reads = sequences.bulk_reads(spark, _fastq(spark, sf_dir), "all")
    return bulk.raw_counts(bulk.extract(reads, anchor=BULK.anchor)).select("gbc", "read_counts")


@query(f"WITH reads AS ({fx.BULK_READS}) SELECT concat_ws('_', sample, o, ln) AS read_id, seq, length(seq)::bigint AS n_qual FROM reads WHERE o % 2 = 0")
def file_merged_mate(spark, sf_dir):
    return sequences.merged_mate(spark, _fastq(spark, sf_dir), "R1", "all").select("read_id", "seq", F.length("qual").cast("long").alias("n_qual"))


@query(f"WITH reads AS ({fx.BULK_READS}) SELECT count(*)::bigint AS reads FROM reads WHERE o % 2 = 0")
def file_read_count(spark, sf_dir):
    return spark.range(1).select(F.lit(sequences.fastq_read_count(spark, _fastq(spark, sf_dir))).cast("long").alias("reads"))


@query(f"WITH {RAW} SELECT sample || '_' || gbc AS name, gbc AS seq FROM raw")
def file_fasta(spark, sf_dir):
    path = scratch_path(spark, "fasta")
    half = F.concat(F.substring("gbc", 1, 9), F.lit("\n"), F.substring("gbc", 10, 9))
    _raw(spark, sf_dir).select(F.concat(F.lit(">"), F.concat_ws("_", "sample", "gbc"), F.lit(" of a pool\n"), half)).write.text(path)
    return sequences.fasta_records(spark, path)


# -- bulk results


@query(f"WITH {RAW} SELECT * FROM raw")
def file_raw_counts(spark, sf_dir):
    path = scratch_path(spark, "raw")
    sinks.write_raw_counts(_raw(spark, sf_dir), path)
    return tables.sample_counts(spark, path, "read_counts")


@query(f"WITH RECURSIVE {LABELS} SELECT * FROM correction")
def file_correction(spark, sf_dir):
    path = scratch_path(spark, "correction")
    sinks.write_correction(_corrections(spark, sf_dir)[1], path)
    return tables.correction(spark, path)


@query(f"{POOL} SELECT * FROM corrected")
def file_corrected_counts(spark, sf_dir):
    path = scratch_path(spark, "counts")
    sinks.write_counts(_pool(spark, sf_dir)[2], path)
    return tables.sample_counts(spark, path)


@query(f"{POOL} SELECT gbc, read_count, sample FROM corrected")
def file_bulk_reference(spark, sf_dir):
    path = scratch_path(spark, "reference")
    sinks.write_reference(bulk_summary.reference(_pool(spark, sf_dir)[2]), path)
    return tables.bulk_reference(spark, path)


@query(f"{POOL}, {OVERLAP} SELECT * FROM common")
def file_overlap(spark, sf_dir):
    path = scratch_path(spark, "common")
    sinks.write_overlap(bulk_summary.overlap(_pool(spark, sf_dir)[2]), path)
    return tables.overlap_matrix(spark, path)


@query(f"WITH {RAW} SELECT sample, gbc AS barcode, read_counts AS n FROM raw")
def file_barcodes(spark, sf_dir):
    path = scratch_path(spark, "not-corrected")
    reads = bulk.extract(fx.bulk_reads(spark, sf_dir), anchor=BULK.anchor).where(F.length("gbc") == BULK.gbc_length)
    sinks.write_barcodes(reads, path)
    read = spark.read.schema("value string, sample string").text(path)
    return read.groupBy("sample", F.col("value").alias("barcode")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT i::bigint AS place, substring(a, 1, i) || '.' || substring(a, i + 2) || '.*' AS pattern FROM (SELECT 'GGGTTTAAACGGGCCCTCTAG' AS a) t CROSS JOIN range(21) r(i)")
def file_patterns(spark, sf_dir):
    path = scratch_path(spark, "patterns")
    sinks.write_patterns(spark, BULK.anchor, path)
    return spark.read.text(path).select((F.instr("value", ".") - 1).cast("long").alias("place"), F.col("value").alias("pattern"))


# -- single-cell results


@query(f"WITH {ELEMENTS} SELECT 'r' || event_id AS \"read_ID\", CBC, UMI, GBC FROM el")
def file_elements(spark, sf_dir):
    path = scratch_path(spark, "elements")
    own = sc.read_elements(fx.sc_elements(spark, sf_dir)).select("sample", F.lit("3").alias("n_consensus_read"), "GBC", "UMI", _name("r", "event_id").alias("read_ID"), "CBC")
    sinks.write_elements(own, path)
    return tables.sc_elements(spark, path).select("read_ID", "CBC", "UMI", "GBC")


@query(f"WITH {SCORED}, {status_sql()} SELECT sample, CBC, GBC, umi, round(max_ratio, 6) AS max_ratio, round(normalized_abundance, 6) AS normalized_abundance, status FROM status")
def file_combos(spark, sf_dir):
    path = scratch_path(spark, "combos")
    sinks.write_combos(sc.support(_scored(spark, sf_dir), LOOSE), path)
    read = tables.combos(spark, path)
    return rounded(read.select("sample", "CBC", "GBC", F.col("umi").cast("long").alias("umi"), "max_ratio", "normalized_abundance", "status"))


@query(f"WITH {CELLS}, {clones_sql('cells', 'clones')} SELECT sample, clone, GBC_set, n_cells, round(prevalence, 6) AS prevalence FROM clones")
def file_clones(spark, sf_dir):
    path = scratch_path(spark, "clones")
    sinks.write_clones(sc.clones(_cells(spark, sf_dir)), path)
    return rounded(tables.clone_table(spark, path))


@query(f"WITH {STRICT_CELLS}, {ONE} SELECT sample, CBC || '_' || sample AS cell_id, GBC FROM one")
def file_cells(spark, sf_dir):
    path = scratch_path(spark, "cells")
    sinks.write_cells(sc.cell_table(sc.cell_gbc(sc.support(_scored(spark, sf_dir), STRICT))), path)
    return tables.cell_table(spark, path)


@query(f"WITH {COMBOS} SELECT sample, count(*)::bigint AS n, sum(umi)::bigint AS umis FROM combos GROUP BY 1")
def file_metrics(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    sinks.write_metrics_csv(sc.combos(_umis(spark, sf_dir)).groupBy("sample").agg(F.sum("umi").alias("umis"), F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("none")), path)
    return tables.named(spark, path, "sample string, n long, umis long")


@query(f"WITH {ELEMENTS}, b AS (SELECT sample, CBC, (row_number() OVER (PARTITION BY sample ORDER BY CBC) - 1) // 10 AS chunk FROM (SELECT DISTINCT sample, CBC FROM el) d) SELECT sample, chunk::bigint AS chunk, count(*)::bigint AS n, min(CBC) AS first FROM b GROUP BY ALL")
def file_chunks(spark, sf_dir):
    path = scratch_path(spark, "chunks")
    barcodes = sc.read_elements(fx.sc_elements(spark, sf_dir)).select("sample", F.col("CBC").alias("CB")).distinct()
    sinks.write_chunks(consensus.chunks(barcodes, 10), path)
    read = spark.read.schema("value string, sample string, chunk long").text(path)
    return read.groupBy("sample", "chunk").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("first"))


# -- the run's summary

SUMMARY = f"""SELECT m.*, (SELECT count(*) FROM ({fx.BULK_FOR_SC}) b WHERE b.sample = m.sample)::bigint AS unique_gbc_bulk_ref, (SELECT count(DISTINCT GBC) FROM ({fx.SC_ELEMENTS}) e WHERE e.sample = m.sample)::bigint AS unique_gbc_sc,
NULL::bigint AS total_reads, (SELECT count(*) FROM ({fx.ALIGNED_READS}) a WHERE a.sample = m.sample AND a.flag & 4 = 0)::bigint AS mapped_reads, (SELECT count(*) FROM ({fx.ALIGNED_READS}) a WHERE a.sample = m.sample AND a.flag & 4 <> 0)::bigint AS unmapped_reads,
(SELECT count(DISTINCT CBC) FROM ({fx.SC_ELEMENTS}) e WHERE e.sample = m.sample)::bigint AS n_putative_cells, (SELECT count(DISTINCT UMI) FROM ({fx.SC_ELEMENTS}) e WHERE e.sample = m.sample)::bigint AS total_n_transcripts FROM ({ORACLES['sc_metrics']}) m"""


def _summary(spark, sf_dir):
    elements = sc.read_elements(fx.sc_elements(spark, sf_dir))
    # lists with a line for each cell and each transcript
    cells, features = (elements.select("sample", c).distinct() for c in ("CBC", "UMI"))
    return single_cell.run_summary(
        sc.run_metrics(sc.support(_scored(spark, sf_dir), LOOSE)), bulk=fx.bulk_for_sc(spark, sf_dir), elements=elements,
        alignments=sequences.alignment_counts(fx.aligned_reads(spark, sf_dir)), barcodes=cells, features=features,
    )


@query(SUMMARY)
def sc_run_summary(spark, sf_dir):
    return rounded(_summary(spark, sf_dir))


@query(f"SELECT 'sc_gbc' AS run_type, sample, n_clones, mapped_reads, unique_gbc_sc, 'bam' AS raw_data_input_type, 0::bigint AS images FROM ({SUMMARY}) s")
def file_sample_documents(spark, sf_dir):
    path = scratch_path(spark, "documents")
    report.sample_documents(_summary(spark, sf_dir), {"raw_data_input": "reads"}, run_type="sc_gbc", input_type="bam").select(F.col("document").alias("value")).write.text(path)
    schema = "run_type string, samples array<struct<id:string,metrics:struct<n_clones:bigint,mapped_reads:bigint,unique_gbc_sc:bigint>,qc_images:array<struct<title:string>>,raw_data_input_type:string>>"
    read = spark.read.schema(schema).json(path)
    each = read.select("run_type", F.explode("samples").alias("s"))
    return each.select("run_type", F.col("s.id").alias("sample"), "s.metrics.*", F.col("s.raw_data_input_type").alias("raw_data_input_type"), F.size("s.qc_images").cast("long").alias("images"))


@query(f"""WITH {SCORED}, pts AS (SELECT sample, max_ratio AS x, normalized_abundance AS y, count(*) AS w FROM scored GROUP BY ALL),
s AS (SELECT sample, count(*) AS n, var_samp(max_ratio) AS vx, var_samp(normalized_abundance) AS vy, covar_samp(max_ratio, normalized_abundance) AS c FROM scored GROUP BY 1),
k AS (SELECT *, pow(n, -1.0 / 3) AS f, vx * vy - c * c AS det FROM s), g AS (SELECT k.*, (i + 0.5) / 20 AS gx, (j + 0.5) / 20 AS gy FROM k CROSS JOIN range(20) a(i) CROSS JOIN range(20) b(j) WHERE det > 1e-12)
SELECT g.sample, round(gx, 6) AS x, round(gy, 6) AS y, round(sum(w * exp(-0.5 * (vy * pow(gx - p.x, 2) - 2 * c * (gx - p.x) * (gy - p.y) + vx * pow(gy - p.y, 2)) / (det * f))) / (any_value(n) * 2 * pi() * any_value(f) * sqrt(any_value(det))), 6) AS density
FROM g JOIN pts p ON p.sample = g.sample GROUP BY g.sample, gx, gy""")
def support_kde(spark, sf_dir):
    return rounded(sc.support_kde(_scored(spark, sf_dir)))


# -- BAM files, read into a table of Spark's own before anything else is done with them

CONTIGS = [("chrM", 20_000), ("lentiCassette", 5000)]
PLACED = f"SELECT read_id, contig, cast(100 + event_id % 4000 AS bigint) AS pos, flag, CB, UB, seq, qual, sample FROM (SELECT *, cast(substring(read_id, 2, 20) AS bigint) AS event_id FROM ({fx.ALIGNED_READS}) r) p"
BAM_COLUMNS = ["read_id", "contig", "pos", "flag", "seq", "qual", "CB", "UB"]


def _placed(spark, sf_dir):
    reads = fx.table(spark, sf_dir, PLACED)
    return reads.withColumns({"mapq": F.lit(60), "cigar": F.lit("53M")})


def _sorted_bam(spark, sf_dir) -> str:
    path = scratch_path(spark, "bam")
    bam.write_sorted(_placed(spark, sf_dir), path, CONTIGS)
    return path


@query(f"SELECT read_id, contig, pos, flag::bigint AS flag, seq, qual, CB, UB FROM ({PLACED}) x")
def file_bam(spark, sf_dir):
    return rounded(materialise(bam.read_bam(spark, _sorted_bam(spark, sf_dir), split=50_000).select(BAM_COLUMNS), "bam-reads"))


@query(f"SELECT read_id, pos, CB, UB FROM ({PLACED}) x WHERE contig = 'lentiCassette' AND pos <= 600 AND pos + 52 >= 500")
def file_bam_region(spark, sf_dir):
    return materialise(bam.read_region(spark, _sorted_bam(spark, sf_dir), CONTIGS, ("lentiCassette", 500, 600)).select("read_id", "pos", "CB", "UB"), "bam-region")


@query(f"""WITH placed AS ({PLACED}), cb AS (SELECT DISTINCT CB FROM placed WHERE sample = 'S0' AND CB <> '-'), chunks AS (SELECT CB, (row_number() OVER (ORDER BY CB) - 1) // 2 AS chunk FROM cb)
SELECT p.read_id, p.CB, p.contig, p.seq FROM placed p JOIN chunks c ON p.CB = c.CB WHERE p.sample = 'S0' AND c.chunk = 1""")
def file_bam_chunk(spark, sf_dir):
    """Reads of a chunk's cells, from the file that was written for it."""
    reads, path = _placed(spark, sf_dir).where("sample = 'S0' and CB <> '-'"), scratch_path(spark, "bam-chunks")
    bam.write_bam(reads.join(consensus.chunks(reads.select('sample', 'CB').distinct(), 2), ["sample", "CB"]), path, CONTIGS, by="chunk")
    return materialise(bam.read_bam(spark, f"{path}/1/*.bam").select("read_id", "CB", "contig", "seq"), "bam-chunk")


@query(f"WITH placed AS ({PLACED}) SELECT count(*) FILTER (flag & 4 = 0)::bigint AS mapped_reads, count(*) FILTER (flag & 4 <> 0)::bigint AS unmapped_reads FROM placed")
def file_bam_counters(spark, sf_dir):
    reads = materialise(bam.read_bam(spark, _sorted_bam(spark, sf_dir)).select("flag"), "bam-flags")
    return sequences.alignment_counts(reads.withColumn("sample", F.lit("s"))).drop("sample")


# -- whole runs, from their sheets


def _calls(where: str) -> str:
    return f"{CONSENSUS}, el AS (SELECT sample, CB AS CBC, MI AS UMI, reverse(translate(substring(seq, 34, 18), 'ACGTN', 'TGCAN')) AS GBC FROM called WHERE cD >= 3 AND error_rate <= 0.2), {where}"


RUN = ScParams(min_reads=3, umi_threshold=1, max_ratio_threshold=0.05, normalized_abundance_threshold=0.05)
RUN_CLONES = _calls(UMIS.removeprefix(ELEMENTS + ", ") + COMBOS.removeprefix(UMIS) + SCORED.removeprefix(COMBOS) + f", {status_sql('1')}, cells AS (SELECT sample, CBC, GBC, umi FROM status WHERE status = 'supported'), moi AS (SELECT sample, CBC, count(*) AS moi FROM cells GROUP BY ALL), {ONE}, {clones_sql('one', 'clones')}")


@query(f"WITH {RUN_CLONES} SELECT sample, clone, GBC_set, n_cells, round(prevalence, 6) AS prevalence FROM clones")
def run_bam_sheet(spark, sf_dir):
    """From a sheet of BAM files and lists of cells to clones."""
    reads = fx.aligned_reads(spark, sf_dir).withColumns({"mapq": F.lit(60), "cigar": F.lit("53M")})
    folder = scratch_path(spark, "run")
    bam.write_bam(reads, folder, CONTIGS, by="sample")
    barcodes = reads.where("CB <> '-' and substring(CB, 1, 1) <> 'A'").select("sample", "CB").distinct()
    barcodes.write.partitionBy("sample").text(f"{folder}-cells")
    samples = reads.select("sample").distinct()
    own = lambda tail: F.concat(F.lit(folder + tail), "sample")
    sinks.write_csv(samples.select("sample", F.concat(own("/"), F.lit("/*.bam")).alias("bam"), own("-cells/sample=").alias("cell_barcodes")), f"{folder}-sheet")
    return rounded(entry.run_sheet(spark, f"{folder}-sheet", "bam", RUN).clones)


@query(f"WITH {RAW} SELECT gbc, sum(read_counts)::bigint AS read_counts FROM raw GROUP BY gbc")
def run_bulk_sheet(spark, sf_dir):
    """From a sheet of folders of FASTQ files to counts."""
    folder = _fastq(spark, sf_dir)
    base, _, name = folder.rpartition("/")
    path = scratch_path(spark, "sheet")
    sinks.write_csv(spark.createDataFrame([("all", base, name)], "ID_we_want string, path_bulk string, folder_name_bulk string"), path)
    return entry.run_bulk_sheet(spark, path, BulkParams(min_n_reads=100)).raw.select("gbc", "read_counts")


GATHERED = f"""{SCORED}, boxes AS (SELECT sample, count(*)::bigint AS n, quantile_cont(umi, 0.25) AS q1, quantile_cont(umi, 0.5) AS median, quantile_cont(umi, 0.75) AS q3 FROM scored WHERE umi > 0 GROUP BY 1)"""


@query(f"WITH {GATHERED} SELECT m.sample, b.n, b.q1::double AS q1, b.median::double AS median, b.q3::double AS q3, m.observed_moi_median::double AS moi, m.n_clones::double AS n_clones FROM ({ORACLES['sc_metrics']}) m JOIN boxes b USING (sample)")
def run_gathered(spark, sf_dir):
    """Results written in a folder a sample, and gathered again from these folders."""
    status = materialise(sc.support(_scored(spark, sf_dir), LOOSE), "combos")
    metrics = sc.run_metrics(status)
    path = scratch_path(spark, "results")
    result = single_cell.ScResult(status, None, None, None, metrics)
    entry.write_run(result, report.sample_documents(metrics, {"umi": 2}, run_type="sc_gbc", input_type="bam"), path)
    found = entry.gather(spark, path)
    clones = found.samples.select("sample", F.element_at("metrics", "n_clones").alias("n_clones"))
    return rounded(found.quality.select("sample", "n", "q1", "median", "q3", "moi").join(clones, "sample"))


# -- parameters, lists and documents, from the given tables


@query(f"SELECT DISTINCT pattern FROM (SELECT unnest(list_transform(range(1, 22), lambda i: concat(substring(a, 1, i - 1), '.', substring(a, i + 1, 21), '.*'))) AS pattern FROM (SELECT DISTINCT substring(translate(md5(n_name), {fx.DNA}), 1, 21) AS a FROM nation) x) y")
def file_anchor_patterns(spark, sf_dir):
    """The search patterns of many anchors, one file an anchor."""
    path = scratch_path(spark, "patterns")
    anchors = spark.sql(f"SELECT DISTINCT substring(translate(md5(n_name), {fx.DNA}), 1, 21) AS a FROM {{nation}}", nation=spark.read.parquet(f"{sf_dir}/nation.parquet")).collect()
    for k, row in enumerate(anchors):
        sinks.write_patterns(spark, row["a"], f"{path}/{k}")
    return spark.read.text(f"{path}/*").select(F.col("value").alias("pattern")).distinct()


@query(f"SELECT DISTINCT substring(translate(md5(concat('GBC', cast(p_size AS string))), {fx.DNA}), 1, 18) AS gbc FROM part")
def file_spikein_list(spark, sf_dir):
    path = scratch_path(spark, "spikein-list")
    own = spark.sql(f"SELECT DISTINCT substring(translate(md5(concat('GBC', cast(p_size AS string))), {fx.DNA}), 1, 18) AS gbc, 'x' AS note FROM {{part}}", part=spark.read.parquet(f"{sf_dir}/part.parquet"))
    sinks.write_csv(own, path)
    return tables.spikeins(spark, path)


@query("SELECT 'S' || n_nationkey AS sample, (n_nationkey % 7)::double AS umi_treshold, 0.5 + n_regionkey / 10.0 AS p_treshold, 0.05::double AS max_ratio_treshold, CASE WHEN n_regionkey = 0 THEN NULL ELSE 0.3::double END AS normalized_abundance_treshold FROM nation")
def file_threshold_table(spark, sf_dir):
    path, k, r = scratch_path(spark, "thresholds"), F.col("n_nationkey"), F.col("n_regionkey")
    own = spark.read.parquet(f"{sf_dir}/nation.parquet").select((k % 7).alias("umi_treshold"), _name("S").alias("sample"), F.when(r != 0, 0.3).alias("normalized_abundance_treshold"), F.lit(0.05).alias("max_ratio_treshold"), (0.5 + r / 10).alias("p_treshold"))
    sinks.write_csv(own, path)
    return rounded(tables.sample_params(spark, path))


@query(f"WITH {RAW} SELECT gbc, read_counts AS read_count FROM raw WHERE sample = 'S1'")
def file_count_table(spark, sf_dir):
    path = scratch_path(spark, "counts")
    sinks.write_csv(_raw(spark, sf_dir).where("sample = 'S1'").select("gbc", "read_counts"), path)
    return tables.count_table(spark, path)


@query("SELECT '/x' || n_nationkey || '.bam' AS bam FROM nation WHERE n_nationkey = 7")
def file_bam_path(spark, sf_dir):
    sheet = tables.sc_sheet(spark, _sheet(spark, sf_dir, F.concat(_name("/x"), F.lit(".bam")).alias("bam"), _name("/cb/").alias("cell_barcodes"), _name("s").alias("sample")), "bam")
    return spark.range(1).select(F.lit(tables.bam_path(sheet, "s7")).alias("bam"))


@query(f"SELECT sample, total_GBC_reads, n_filtered_GBCs, 'bulk_gbc' AS run_type FROM ({ORACLES['bulk_metrics']}) m")
def file_bulk_documents(spark, sf_dir):
    path = scratch_path(spark, "bulk-documents")
    raw, corrections, corrected = _pool(spark, sf_dir)
    report.sample_documents(bulk.metrics(raw, corrected, corrections), {"min_n_reads": 100}).select("sample", F.col("document").alias("value")).write.partitionBy("sample").text(path)
    read = tables.json_documents(spark, path, "run_type string, samples array<struct<id:string,metrics:struct<total_GBC_reads:bigint,n_filtered_GBCs:bigint>>>")
    return read.select("run_type", F.explode("samples").alias("s")).select(F.col("s.id").alias("sample"), "s.metrics.*", "run_type")


@query(f"""SELECT sample, "unique_good_GBCs", unsupported_combos, supported_combos, observed_moi_median, round(observed_moi_std, 2) AS observed_moi_std, "starting_CBCs", uniquely_barcoded_cells, n_clones, n_clones_10plus FROM ({ORACLES['sc_metrics']}) m""")
def file_clone_summaries(spark, sf_dir):
    """The summaries of clone calling as text, and read again."""
    path = scratch_path(spark, "summaries")
    metrics = sc.run_metrics(sc.support(_scored(spark, sf_dir), LOOSE)).collect()
    lines = [(r["sample"], line) for r in metrics for line in report.summary_text(r.asDict(), r["sample"]).split("\n")]
    spark.createDataFrame(lines, "sample string, value string").write.partitionBy("sample").text(path)
    return rounded(tables.clone_summary(spark.read.schema("value string, sample string").text(path)))


@query(f"SELECT sample, n_clones, observed_moi_median AS moi FROM ({ORACLES['sc_metrics']}) m")
def file_run_document(spark, sf_dir):
    """All samples' metrics in one document, and read again."""
    import json

    path = scratch_path(spark, "run-document")
    document = report.run_document(sc.run_metrics(sc.support(_scored(spark, sf_dir), LOOSE)), {"umi": 2}, run_type="sc_gbc")
    spark.createDataFrame([(json.dumps(document, default=str),)], "value string").write.text(path)
    read = tables.json_documents(spark, path, "samples array<struct<id:string,metrics:struct<n_clones:bigint,observed_moi_median:double>>>", strict=True)
    return rounded(read.select(F.explode("samples").alias("s")).select(F.col("s.id").alias("sample"), "s.metrics.n_clones", F.col("s.metrics.observed_moi_median").alias("moi")))


@query("SELECT n_name AS sample, CASE WHEN n_nationkey % 3 = 0 THEN 'raw,corrected,before' ELSE 'before,raw' END AS titles FROM nation")
def image_order(spark, sf_dir):
    from strandlake.operators import channels

    titles = F.when(F.col("n_nationkey") % 3 == 0, F.array(F.lit("before and after"), F.lit("Corrected counts"), F.lit("Raw counts"))).otherwise(F.array(F.lit("before"), F.lit("raw")))
    images = F.transform(titles, lambda t: F.struct(t.alias("title"), F.lit("").alias("image")))
    ordered = F.transform(channels.order_images(images), lambda x: F.lower(F.regexp_extract(x["title"], "^([A-Za-z]+)", 1)))
    return spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_name").alias("sample"), F.array_join(ordered, ",").alias("titles"))


@query("SELECT a.n_name AS a, b.n_name AS b, list_sum(list_transform(range(1, least(length(a.n_name), length(b.n_name)) + 1), lambda i: CASE WHEN substring(a.n_name, i, 1) <> substring(b.n_name, i, 1) THEN 1 ELSE 0 END))::bigint AS hamming FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey")
def hamming_any_length(spark, sf_dir):
    from strandlake.functions.seq import hamming

    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    a, b = (nation.select(F.col("n_name").alias(c), "n_regionkey") for c in ("a", "b"))
    return rounded(a.join(b, "n_regionkey").select("a", "b", hamming(F.col("a"), F.col("b")).alias("hamming")))


@query(f"WITH ref AS ({fx.BULK_FOR_SC}) SELECT 'x' || r_regionkey AS sample, gbc, read_count FROM ref JOIN region ON ref.sample = 'S' || (r_regionkey % 3)")
def sample_references(spark, sf_dir):
    """Several samples with one reference, by the map."""
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    pairs = region.select(_name("x", "r_regionkey").alias("sample"), F.concat(F.lit("S"), (F.col("r_regionkey") % 3).cast("string")).alias("reference"))
    return sc.sample_reference(fx.bulk_for_sc(spark, sf_dir), pairs)


@query(f"WITH reads AS ({fx.BULK_READS}) SELECT concat_ws('_', sample, o, ln) AS read_id, seq, length(seq)::bigint AS n_qual FROM reads WHERE o % 2 = 1")
def file_second_mate(spark, sf_dir):
    return sequences.merged_mate(spark, _fastq(spark, sf_dir), "R2", "all").select("read_id", "seq", F.length("qual").cast("long").alias("n_qual"))


@query(f"WITH {RAW} SELECT 'S1' AS name, gbc AS seq FROM raw WHERE sample = 'S1'")
def file_fasta_records(spark, sf_dir):
    """The records whose name begins with a sample's, under that name."""
    path = scratch_path(spark, "fasta")
    _raw(spark, sf_dir).select(F.concat(F.lit(">"), F.concat_ws("_", "sample", "gbc"), F.lit("\n"), "gbc")).write.text(path)
    return sequences.fasta_extract(spark, path, "S1")
