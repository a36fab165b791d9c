"""Result tables as files, in the formats that downstream steps read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.functions.seq import search_patterns
from strandlake.operators.ranks import numbered, prefix


def write_csv(table: DataFrame, path: str, *, sep: str = ",", gzip: bool = False, by_sample: bool = False) -> None:
    """CSV or TSV with a header; one folder for each sample if wanted."""
    writer = table.write.mode("overwrite").option("header", True).option("sep", sep)
    writer = writer.option("compression", "gzip") if gzip else writer
    (writer.partitionBy("sample") if by_sample else writer).csv(path)


def most_first(table: DataFrame, count: str) -> DataFrame:
    """Sorted for files: by sample, largest counts first, then by barcode."""
    return table.orderBy("sample", F.desc(count), "gbc")


def write_raw_counts(raw: DataFrame, path: str) -> None:
    write_csv(most_first(raw.select("sample", "gbc", "read_counts"), "read_counts"), path, gzip=True, by_sample=True)


def write_correction(corrections: DataFrame, path: str) -> None:
    """Before spike-ins are removed."""
    write_csv(corrections.select("sample", "correct", "degenerated", "n_reads_correct", "n_reads_degenerated"), path, by_sample=True)


def write_counts(corrected: DataFrame, path: str) -> None:
    write_csv(most_first(corrected.select("sample", "gbc", "read_count"), "read_count"), path, by_sample=True)


def indexed(table: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """With a first column without a name that numbers the rows from 0, within ``by``, in the order of some columns that are strings."""
    placed = numbered(table, by, [prefix(order[0])], [F.col(c) for c in order])
    return placed.select((F.col("place") - 1).alias(""), *table.columns)


def write_combos(status: DataFrame, path: str) -> None:
    write_csv(indexed(status, ["sample"], ["CBC", "GBC"]), path, sep="\t", gzip=True, by_sample=True)


def write_reference(reference: DataFrame, path: str) -> None:
    """The whitelist of all samples in one table."""
    write_csv(indexed(reference.select("gbc", "read_count", "sample"), [], ["gbc", "sample"]), path)


def write_overlap(common: DataFrame, path: str) -> None:
    """Barcodes that two samples have in common, as a matrix; samples are few."""
    wide = common.groupBy("sample_x").pivot("sample_y").agg(F.first("n_common"))
    write_csv(wide.withColumnRenamed("sample_x", ""), path)


def write_cells(cells: DataFrame, path: str) -> None:
    write_csv(cells.select("sample", "cell_id", "GBC"), path, by_sample=True)


def write_patterns(spark: SparkSession, anchor: str, path: str) -> None:
    """The search patterns of an anchor, one a line."""
    spark.createDataFrame([(p,) for p in search_patterns(anchor)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_barcodes(barcodes: DataFrame, path: str) -> None:
    """Barcodes as read, uncorrected, one a line, a folder for each sample."""
    barcodes.select("sample", "gbc").write.mode("overwrite").partitionBy("sample").text(path)


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Cell barcodes by chunk, one a line, a folder for each sample and chunk."""
    chunks.select("sample", "chunk", "CB").write.mode("overwrite").partitionBy("sample", "chunk").text(path)


def write_clones(clones: DataFrame, path: str) -> None:
    write_csv(clones.withColumnRenamed("n_cells", "n cells"), path, by_sample=True)


def write_elements(elements: DataFrame, path: str) -> None:
    write_csv(elements, path, sep="\t", gzip=True, by_sample=True)


def write_metrics_csv(metrics: DataFrame, path: str) -> None:
    """All values quoted, NA where one is missing."""
    metrics.write.mode("overwrite").option("header", True).option("quoteAll", True).option("nullValue", "NA").csv(path)


def write_parquet(table: DataFrame, path: str) -> None:
    """The engine's own format, one folder a sample, so that a sample is read without the others."""
    table.write.mode("overwrite").partitionBy("sample").parquet(path)


def write_json(documents: DataFrame, path: str) -> None:
    """One JSON document a row."""
    documents.select(F.to_json(F.struct(*documents.columns)).alias("value")).write.mode("overwrite").text(path)


def write_fastq(reads: DataFrame, folder: str, mate: str) -> None:
    """Reads (read_id, seq, qual) as compressed FASTQ files of a mate, added to a folder; records stay whole."""
    spark = reads.sparkSession
    own = f"{folder}/_{mate}"
    reads.select(F.concat(F.lit("@"), "read_id", F.lit("\n"), "seq", F.lit("\n+\n"), "qual")).write.mode("overwrite").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(own)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(own)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(f.getPath().getName() for f in store.listStatus(where) if f.getPath().getName().startswith("part-"))
    for k, name in enumerate(names):
        store.rename(jvm.org.apache.hadoop.fs.Path(own, name), jvm.org.apache.hadoop.fs.Path(folder, f"x_L{k:05d}_{mate}_001.fastq.gz"))
    store.delete(where, True)


def publish(spark: SparkSession, written: str, folder: str, name: str) -> None:
    """Move what :func:`write_csv` and others wrote by sample to a file of that name in each sample's own folder.

    A sample with several parts keeps them, numbered before the name.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    store = path(written).getFileSystem(conf)
    for status in store.listStatus(path(written)):
        inner = status.getPath()
        if not inner.getName().startswith("sample="):
            continue
        own = path(folder, jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(inner.getName().removeprefix("sample=")))
        store.mkdirs(own)
        parts = sorted(f.getPath().getName() for f in store.listStatus(inner) if f.getPath().getName().startswith("part-"))
        for k, part in enumerate(parts):
            store.rename(path(inner, part), path(own, name if len(parts) == 1 else f"{k}-{name}"))
    store.delete(path(written), True)
