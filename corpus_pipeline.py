"""The corpus pipeline: quality rules, line dedup, near-duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the
columns of documents. A stage's table is written as Parquet and read again as the next
one's input. No sampling, limits or id subsets: every stage works on all rows it gets.

Texts that lose lines get the length of what is left as n_chars. Near-duplicates are
documents whose SimHash fingerprints link as in op5 (three-word shingles, two bits, generalised pigeonhole),
and, as most pairs near it are further apart, also those whose sets of five-word shingles have a similarity of 0.8 or
more: of these, documents that share a band of minima are candidates, and the whole sets decide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm.decontaminate import remove_contaminated
from strandlake.llm.line_dedup import dedup_lines
from strandlake.llm.packing import op1_packing
from strandlake.llm.quality import keep_good
from strandlake.llm.queries import vocabulary
from strandlake.llm.runtime import materialise
from strandlake.llm.simhash import keep_first


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without their hosts' boilerplate lines.

    A null or empty text fails the rules; equal rows are judged alike, each for itself; a null source is a host of its own;
    very long texts are judged whole; an empty table stays empty.
    """
    before = "__before__"
    kept = keep_good(docs.withColumn(before, F.xxhash64("text")))
    return kept.withColumn("n_chars", F.when(F.xxhash64("text") == F.col(before), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document has.

    No document goes, even if it loses all lines. A null text stays null; of equal lines the smallest id keeps its own, and documents with
    that same id keep theirs, too; rows without an id come last; lines of fewer than ten characters always stay; an empty table stays empty.
    """
    kept = dedup_lines(docs)
    changed = F.col("n_dropped") > 0
    new = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("text")), "n_chars": F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))}
    return kept.withColumns(new).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Documents that op5 links are one group, whatever their sets are like. Texts without five words have one shingle of all of them; null texts count as empty; of equal rows one stays; rows without an id come last; very
    long texts are compared by all their shingles; an empty table stays empty.
    """
    return keep_first(docs, shingle=5, similarity=0.8).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    A null text, or one without words, has none and stays; equal rows go or stay together; very long texts are searched whole; an
    empty table, or an empty benchmark, takes nothing away.
    """
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of the documents' pieces in sequences of 2048 tokens.

    A null text is empty and has its end token only; rows with the same id, or without one, are packed each for itself; very long texts
    are cut over several sequences; an empty table gives no rows.
    """
    return op1_packing(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("packing", packing)]

#: SQL can't express fingerprints and packing; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
