"""Sheets, counts and result tables from CSV, TSV, JSON and text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlake import schemas
from strandlake.operators.channels import positive_umis


def named(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """The columns of a schema by their names in the files' header, whatever their order and whatever others there are.

    Values that can't be read as their type are null; a column that isn't there is an error. Columns
    in folder names (sample=...) count too, as they stand there.
    """
    there = spark.read.csv(path, header=True, sep=sep).columns
    wanted = T.StructType.fromDDL(schema).fields
    missing = [f.name for f in wanted if f.name not in there]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    strings = T.StructType([T.StructField(c, T.StringType()) for c in there])
    # a header without a name (an index) can't be held against a schema
    rows = spark.read.schema(strings).csv(path, header=True, sep=sep, enforceSchema="_c0" in there)
    return rows.select(*(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in wanted))


def bulk_sheet(spark: SparkSession, path: str) -> DataFrame:
    """(sample, folder) of the bulk sample sheet."""
    rows = named(spark, path, schemas.BULK_SHEET)
    return rows.select(F.col("ID_we_want").alias("sample"), F.concat_ws("/", "path_bulk", "folder_name_bulk").alias("folder"))


def sc_sheet(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The single-cell sheet of an input type: 'fastq', 'fastq,GBC' or 'bam'; others are an error."""
    match kind:
        case "fastq" | "fastq,GBC" | "bam":
            return named(spark, path, schemas.SC_SHEETS[kind])
        case _:
            raise ValueError(f"unknown input type {kind!r}: 'fastq', 'fastq,GBC' or 'bam'")


def barcode_list(spark: SparkSession, path: str) -> DataFrame:
    """(CB): the first column of a file without a header."""
    return spark.read.csv(path, sep="\t").select(F.col("_c0").alias("CB")).where("CB is not null")


def gbc_list(spark: SparkSession, path: str) -> DataFrame:
    """(gbc): one barcode a line; blank lines are no barcodes."""
    return spark.read.text(path).select(F.col("value").alias("gbc")).where(F.length("gbc") > 0)


def spikeins(spark: SparkSession, path: str | None) -> DataFrame | None:
    """(gbc): the first column; no path, 'None' or a path that isn't there mean no spike-ins."""
    if path is None or path == "None":
        return None
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return None
    rows = spark.read.csv(path, header=True)
    return rows.select(F.col(f"`{rows.columns[0]}`").alias("gbc"))


def sc_elements(spark: SparkSession, path: str) -> DataFrame:
    """Elements with all columns as strings; several files are one table, each with its header."""
    return named(spark, path, schemas.SC_ELEMENTS, "\t")


def bulk_reference(spark: SparkSession, path: str, sample: str | None = None) -> DataFrame:
    """(gbc, read_count, sample); of one sample if named."""
    rows = named(spark, path, schemas.BULK_REFERENCE)
    return rows if sample is None else rows.where(F.col("sample") == sample)


def sample_map(spark: SparkSession, path: str) -> DataFrame:
    return named(spark, path, schemas.SAMPLE_MAP)


def sample_params(spark: SparkSession, path: str) -> DataFrame:
    return named(spark, path, schemas.SAMPLE_PARAMS)


def count_table(spark: SparkSession, path: str) -> DataFrame:
    """(gbc, read_count), whichever of the usual names the count has."""
    rows = spark.read.csv(path, header=True)
    named = rows.withColumnsRenamed({rows.columns[0]: "gbc", "read_counts": "read_count", "count_reads": "read_count", "count_read": "read_count"})
    return named.select("gbc", F.col("read_count").cast("long").alias("read_count"))


def combos(spark: SparkSession, path: str) -> DataFrame:
    """The combos table, read tolerantly: only rows with a positive number of UMIs; with their sample, where folders name it."""
    own = "sample string, " if "sample" in spark.read.csv(path, sep="\t", header=True).columns else ""
    return positive_umis(named(spark, path, own + schemas.COMBOS, "\t"))


def correction(spark: SparkSession, path: str) -> DataFrame:
    """Correction tables of all samples, by folder."""
    return named(spark, path, "sample string, " + schemas.CORRECTION)


def clone_table(spark: SparkSession, path: str) -> DataFrame:
    """Clone tables of all samples, by folder."""
    return named(spark, path, schemas.CLONES).withColumnRenamed("n cells", "n_cells")


def cell_table(spark: SparkSession, path: str) -> DataFrame:
    """Cell tables of all samples, by folder."""
    return named(spark, path, schemas.CELLS)


def sample_counts(spark: SparkSession, path: str, count: str = "read_count") -> DataFrame:
    """(sample, gbc and the count) of all samples, by folder."""
    return named(spark, path, f"sample string, gbc string, {count} long")


def overlap_matrix(spark: SparkSession, path: str) -> DataFrame:
    """(sample_x, sample_y, n_common) from a matrix with a column for each sample."""
    samples = [c for c in spark.read.csv(path, header=True).columns if c != "_c0"]
    rows = spark.read.csv(path, header=True)
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("sample_y"), F.col(f"`{c}`").try_cast("long").alias("n_common")) for c in samples))).alias("x")
    return rows.select(F.col("_c0").alias("sample_x"), each).select("sample_x", "x.*")


def json_documents(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """One row a document with its file; broken documents are left out unless ``strict``, then they are an error."""
    if strict:
        rows = spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST", recursiveFileLookup=True)
        return rows.withColumn("file", F.col("_metadata.file_path"))
    rows = spark.read.schema(f"{schema}, _corrupt_record string").json(path, multiLine=True, mode="PERMISSIVE", recursiveFileLookup=True)
    return rows.withColumn("file", F.col("_metadata.file_path")).where("_corrupt_record is null").drop("_corrupt_record")


def complete_directories(spark: SparkSession, path: str, names: tuple[str, ...] = ("run_summary.json", "CBC_GBC_combos.tsv.gz")) -> DataFrame:
    """(folder): folders at any depth that hold all the named files; only names are listed, nothing is read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    parts = listed.select(F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("folder"), F.regexp_extract("path", "([^/]+)$", 1).alias("name"))
    return parts.where(F.col("name").isin(*names)).groupBy("folder").agg(F.count_distinct("name").alias("n")).where(F.col("n") == len(names)).select("folder")


def line_count(spark: SparkSession, path: str) -> int:
    """Lines of a file, compressed or not."""
    return spark.read.text(path).count()


def bam_path(sheet: DataFrame, sample: str) -> str | None:
    """The path of a sample's BAM file, if the sheet has one."""
    row = sheet.where(F.col("sample") == sample).select("bam").first()
    return row and row["bam"]


def clone_summary(lines: DataFrame) -> DataFrame:
    """(sample, and nine metrics) from the lines (sample, value) of clone-calling summaries."""
    value = F.trim("value")

    def number(prefix: str, kind: str = "long") -> Column:
        return F.max(F.when(value.startswith(prefix), F.regexp_extract(value, r"(\d+)", 1).try_cast(kind)))

    moi = r"([\d.]+) median, \(?\+-([\d.]+)\)?"
    told = F.when(value.startswith("- Observed MOI") & value.rlike(moi), value)
    return lines.groupBy("sample").agg(
        number('- Unique, "good" GBCs:').alias("unique_good_GBCs"),
        number("- n unsupported CBC-GBC combos").alias("unsupported_combos"),
        number("- n supported CBC-GBC combos").alias("supported_combos"),
        F.max(F.regexp_extract(told, moi, 1).try_cast("double")).alias("observed_moi_median"),
        F.max(F.regexp_extract(told, moi, 2).try_cast("double")).alias("observed_moi_std"),
        number("- n starting CBC").alias("starting_CBCs"),
        number("- n uniquely barcoded cells").alias("uniquely_barcoded_cells"),
        number("- n clones:").alias("n_clones"),
        F.max(F.when(value.startswith("- n clones>=10 cells"), F.regexp_extract(value, r"(\d+)\D*$", 1).try_cast("long"))).alias("n_clones_10plus"),
    )
