"""FASTQ and FASTA files as tables, and read counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.storage import materialise

#: What stands between two records: a line break and the first sign of a name line.
BETWEEN = "\n@"


def _pieces(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, id, name, seq, plus, qual, n) of the pieces that files fall into at :data:`BETWEEN`, n their lines.

    A piece is a record, or, where a quality line begins with the sign of a name line, three lines of one and then the rest of
    that line by itself. So the reader finds records wherever a split of a file begins, and a broken record doesn't move the
    ones after it. Anything else is an error.
    """
    read = spark.read.option("lineSep", BETWEEN).text(paths)
    text = F.rtrim(F.replace("value", F.lit("\r"), F.lit("")), F.lit("\n"))
    file = F.col("_metadata.file_path")
    lines = read.select(file.alias("file"), F.col("_metadata.file_block_start").alias("start"), (F.col("_metadata.file_block_start") + F.col("_metadata.file_block_length")).alias("end"), F.monotonically_increasing_id().alias("id"), text.alias("text"))
    # a generator keeps filters and columns from splitting a piece again
    lines = lines.select("file", "start", "end", "id", F.explode(F.array(F.split("text", "\n"))).alias("l"))
    n = F.size("l")
    line = lambda k: F.get("l", F.lit(k))
    good = (n == 1) | (F.coalesce(line(2), F.lit("")).startswith("+") & ((n == 3) | ((n == 4) & (F.length(line(1)) == F.length(line(3))))))
    broken = F.raise_error(F.concat(F.lit("not a FASTQ record in "), F.col("file"), F.lit(": @"), F.left(F.array_join("l", " | "), F.lit(200))))
    empty = (n == 3) & (line(1) == "")
    kind = F.when(empty & good, 4).when(good, n).otherwise(broken.cast("int"))
    name = F.when((n == 1) | ~line(0).startswith("@"), line(0)).otherwise(F.expr("substring(get(l, 0), 2)"))
    return lines.select("file", "start", "end", "id", name.alias("name"), line(1).alias("seq"), F.when(empty, "").otherwise(line(3)).alias("qual"), kind.alias("n"))


def _read_id(name: Column) -> Column:
    """What stands before a name line's first white space."""
    return F.substring_index(F.translate(name, "\t\n\x0b\f\r", "     "), " ", 1)


def fastq(spark: SparkSession, paths: str | list[str], sample: str | None = None) -> DataFrame:
    """(file, read, read_id, seq, qual) from FASTQ files, compressed or not; ``read`` sorts the reads of a part of a file.

    Records in one piece need no shuffle. Those whose quality line begins with the sign of a name line, about one in forty,
    are joined with the rest of that line, the next piece; the last of a split with the first of the next split. They are
    written to the shared folder first, so that files are read twice and not once for each side of a join.
    """
    pieces = _pieces(spark, paths)
    one = pieces.where("n = 4").select("file", F.col("id").alias("read"), _read_id(F.col("name")).alias("read_id"), "seq", "qual")
    parts = materialise(pieces.where("n <> 4"), "fastq-parts")
    heads = parts.where("n = 3")
    rests = parts.where("n = 1").select(F.col("file").alias("rest_file"), F.col("start").alias("from"), (F.col("id") - 1).alias("before"), F.col("name").alias("rest"))
    next_ = (F.col("file") == F.col("rest_file")) & (F.col("start") == F.col("from")) & (F.col("id") == F.col("before"))
    near = heads.join(rests, next_, "left").drop("rest_file", "from", "before")
    first = rests.join(heads.select("file", "start", "id"), next_, "left_anti").withColumnsRenamed({"rest": "next"}).drop("before")
    across = near.join(first, (F.col("file") == F.col("rest_file")) & (F.col("end") == F.col("from")) & F.col("rest").isNull(), "left")
    qual = F.concat(F.lit("@"), F.coalesce("rest", "next"))
    held = F.when(F.length(qual) == F.length("seq"), qual).otherwise(F.raise_error(F.concat(F.lit("not a FASTQ record in "), F.col("file"), F.lit(": @"), F.col("name"))))
    both = one.unionByName(across.select("file", F.col("id").alias("read"), _read_id(F.col("name")).alias("read_id"), "seq", held.alias("qual")))
    return both if sample is None else both.withColumn("sample", F.lit(sample))


def fastq_sequences(spark: SparkSession, paths: str | list[str], sample: str) -> DataFrame:
    """(sample, seq): the sequence lines only, without a shuffle."""
    return _pieces(spark, paths).where("n > 1").select(F.lit(sample).alias("sample"), "seq")


def bulk_reads(spark: SparkSession, folder: str, sample: str) -> DataFrame:
    """Both mates of a bulk sample, each read for itself."""
    return fastq_sequences(spark, [f"{folder}/*_R1_*.fastq.gz", f"{folder}/*_R2_*.fastq.gz"], sample)


def merged_mate(spark: SparkSession, folder: str, mate: str, sample: str) -> DataFrame:
    """All files of a mate ('R1' or 'R2') of a single-cell sample as one table."""
    return fastq(spark, f"{folder}/*{mate}*.fastq.gz", sample)


def fastq_read_count(spark: SparkSession, folder: str) -> int:
    """Reads of the first mate: whole records of each file, summed."""
    lines = spark.read.text(f"{folder}/*R1*.fastq.gz").select(F.col("_metadata.file_path").alias("file"))
    per = lines.groupBy("file").agg(F.floor(F.count(F.lit(1)) / 4).alias("reads"))
    return per.agg(F.sum("reads")).first()[0] or 0


def alignment_counts(reads: DataFrame) -> DataFrame:
    """(sample, mapped_reads, unmapped_reads)."""
    unmapped = F.col("flag").bitwiseAND(4) != 0
    return reads.groupBy("sample").agg(F.count_if(~unmapped).alias("mapped_reads"), F.count_if(unmapped).alias("unmapped_reads"))


def fasta_records(spark: SparkSession, path: str) -> DataFrame:
    """(name, seq): records of a FASTA file, line breaks removed."""
    records = spark.read.text(path, lineSep=">").where(F.length("value") > 0)
    return records.select(F.regexp_extract("value", r"^(\S+)", 1).alias("name"), F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s", "").alias("seq"))


def fasta_extract(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """The records whose name starts so, under that name."""
    return fasta_records(spark, path).where(F.col("name").startswith(prefix)).withColumn("name", F.lit(prefix))
