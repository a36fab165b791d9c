"""The dataflow between steps: keyed joins, splits, flattening, and resolving values per sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def combine(left: DataFrame, right: DataFrame, key: str = "sample") -> DataFrame:
    """Each left row with each right row of the same key."""
    return left.join(right, key)


def join(left: DataFrame, right: DataFrame, key: str = "sample") -> DataFrame:
    """One row a key from each side; keys on one side only are dropped."""
    return left.dropDuplicates([key]).join(right.dropDuplicates([key]), key)


def split_libraries(sheet: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The transcriptome and the barcode libraries of a FASTQ sheet."""
    return sheet.where("library = 'TENX'").select("sample", "fastq_folder"), sheet.where("library = 'GBC'").select("sample", "fastq_folder")


def flatten(rows: DataFrame, column: str) -> DataFrame:
    """One row for each element of a list; a null list gives none."""
    return rows.withColumn(column, F.explode(column))


def cell_name(path: Column) -> Column:
    """The last part of a path up to its first dot."""
    return F.split_part(F.regexp_extract(path, "([^/]+)$", 1), F.lit("."), F.lit(1))


def or_else(*values: Column) -> Column:
    """The first value that is neither null nor 0, else the last one."""
    return F.coalesce(*(F.nullif(v, F.lit(0)) for v in values[:-1]), values[-1])


def first_known(rows: DataFrame, columns: list[str], order: str = "sample") -> DataFrame:
    """One row: each column's value from the first sample, by name, that has one."""
    return rows.agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns))


def sample_id(samples: Column, folder: Column) -> Column:
    """The only sample's id, else the first with an id, else the folder's name. ``samples``: array of structs with id."""
    return F.coalesce(F.get(F.filter(samples, lambda s: s["id"].isNotNull()), 0)["id"], folder)


def sample_metrics(samples: Column, wanted: Column) -> Column:
    """The metrics of the sample with that id, else the first that aren't empty, else an empty map."""
    full = F.filter(samples, lambda s: F.size(s["metrics"]) > 0)
    own = F.filter(full, lambda s: s["id"] == wanted)
    return F.coalesce(F.get(own, 0)["metrics"], F.get(full, 0)["metrics"], F.expr("cast(map() as map<string,double>)"))


def order_images(images: Column) -> Column:
    """Images as raw, corrected, before, if each of the three is there; else as they came. Array of structs with title."""
    named = lambda word: F.filter(images, lambda x: F.contains(F.lower(x["title"]), F.lit(word)))
    found = [named(word) for word in ("raw", "corrected", "before")]
    picked = F.array(*(F.get(f, 0) for f in found))
    return F.when(F.forall(picked, lambda x: x.isNotNull()), picked).otherwise(images)


def positive_umis(combos: DataFrame) -> DataFrame:
    """Combos whose umi reads as a number over 0."""
    return combos.withColumn("umi", F.col("umi").try_cast("double")).where("umi > 0")
