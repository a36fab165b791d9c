"""Barcode tables derived from the star-schema test tables, by SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: md5's digits and the bases they stand for.
DNA = "'0123456789abcdef', 'ACGTACGTACGTACGT'"

#: Bulk reads: skewed barcodes, one-base mutants, short ones, anchors with 0, 1 and 2 substitutions.
BULK_READS = f"""
SELECT concat('S', cast(s AS string)) AS sample,
       concat('TT', CASE WHEN ln = 3 THEN 'GGGTTTAAACGGGCCCTCTAT' WHEN ln = 7 THEN 'GGGTTTAAACGGGCCCTCTTT' ELSE 'GGGTTTAAACGGGCCCTCTAG' END,
              'T', gbc, CASE WHEN length(gbc) = 18 THEN 'CC' ELSE '' END) AS seq, gbc, o, ln
FROM (SELECT *, CASE WHEN o % 97 = 0 THEN substring(root, 1, 17)
                     WHEN o % 11 = 0 THEN concat(substring(root, 1, p - 1), translate(substring(root, p, 1), 'ACGT', 'TGCA'), substring(root, p + 1, 18))
                     ELSE root END AS gbc
      FROM (SELECT *, substring(translate(md5(concat('GBC', cast(r AS string))), {DNA}), 1, 18) AS root, cast(1 + pk % 18 AS int) AS p
            FROM (SELECT l_orderkey AS o, l_linenumber AS ln, l_partkey AS pk, l_suppkey % 4 AS s, l_partkey % (1 + l_partkey % 40) AS r FROM lineitem) a) b) c
"""

#: Single-cell elements, barcodes as the instrument reads them (reverse complement).
SC_ELEMENTS = f"""
SELECT concat('S', cast(user_id % 3 AS string)) AS sample, event_id,
       substring(translate(md5(concat('C', cast(user_id AS string))), {DNA}), 1, 16) AS CBC,
       substring(translate(md5(concat('U', cast(event_id % 40 AS string))), {DNA}), 1, 12) AS UMI,
       reverse(translate(substring(translate(md5(concat('GBC', cast(CASE WHEN event_id % 10 < 8 THEN user_id % 30 ELSE event_id % 30 END AS string))), {DNA}), 1, 18), 'ACGT', 'TGCA')) AS GBC
FROM events
"""

#: Tagged reads: 33 bases of anchor, the barcode with a substitution in some reads, and qualities.
ALIGNED_READS = f"""
SELECT sample, concat('r', cast(event_id AS string)) AS read_id, CASE WHEN event_id % 29 = 0 THEN 'chrM' ELSE 'lentiCassette' END AS contig, cast(100 + event_id % 2 AS bigint) AS pos,
       CASE WHEN event_id % 33 = 0 THEN 4 ELSE 0 END AS flag, CASE WHEN event_id % 50 = 0 THEN '-' ELSE CBC END AS CB, UMI AS UB,
       concat('TAGCAAACTGGGGCACAAGCTTAATTAAGAATT', CASE WHEN event_id % 7 = 0 THEN concat('T', substring(g, 2, 17)) ELSE g END, 'GG') AS seq,
       translate(substring(concat(h, h), 1, 53), '0123456789abcdef', 'IIIIIIIIII5HGFED') AS qual
FROM (SELECT concat('S', cast(user_id % 3 AS string)) AS sample, event_id, md5(cast(event_id AS string)) AS h,
             substring(translate(md5(concat('C', cast(user_id % 12 AS string))), {DNA}), 1, 16) AS CBC,
             substring(translate(md5(concat('U', cast(event_id % 3 AS string))), {DNA}), 1, 12) AS UMI,
             substring(translate(md5(concat('GBC', cast(user_id % 4 AS string))), {DNA}), 1, 18) AS g
      FROM events) a
"""

#: First reads of droplets: cell and UMI bases, some cells with a substitution or an N, and qualities.
FIRST_READS = f"""
SELECT sample, concat('r', cast(event_id AS string)) AS read_id,
       concat(CASE WHEN event_id % 13 = 2 THEN concat(substring(CBC, 1, 2), translate(substring(CBC, 3, 1), 'ACGT', 'CATG'), substring(CBC, 4, 13))
                   WHEN event_id % 13 = 5 THEN concat(substring(CBC, 1, 2), 'N', substring(CBC, 4, 13))
                   WHEN event_id % 11 = 4 THEN concat(substring(CBC, 1, p - 1), translate(substring(CBC, p, 1), 'ACGT', 'TGCA'), substring(CBC, p + 1, 16))
                   WHEN event_id % 17 = 6 THEN concat(substring(CBC, 1, p - 1), 'N', substring(CBC, p + 1, 16)) ELSE CBC END, UMI, 'TTTT') AS seq,
       translate(substring(md5(concat('Q', cast(event_id AS string))), 1, 32), '0123456789abcdef', 'IIII#5:?HGFED+I5') AS qual
FROM (SELECT concat('S', cast(user_id % 3 AS string)) AS sample, event_id, cast(1 + event_id % 16 AS int) AS p,
             substring(translate(md5(concat('C', cast(user_id AS string))), {DNA}), 1, 16) AS CBC,
             substring(translate(md5(concat('U', cast(event_id % 40 AS string))), {DNA}), 1, 12) AS UMI FROM events) a
"""

#: Listed barcodes: those of the cells, and for some a second one that differs in the third base.
WHITELIST = f"""
SELECT DISTINCT CASE WHEN k = 1 THEN concat(substring(CBC, 1, 2), translate(substring(CBC, 3, 1), 'ACGT', 'TGCA'), substring(CBC, 4, 13)) ELSE CBC END AS CB
FROM (SELECT DISTINCT user_id, event_id % 2 AS k, substring(translate(md5(concat('C', cast(user_id AS string))), {DNA}), 1, 16) AS CBC FROM events) a WHERE k = 0 OR user_id % 4 = 1
"""

#: Reads of genes in cells: UMIs with one or two substitutions, of one letter, or with an N.
GENE_UMIS = f"""
SELECT sample, CB, gene, CASE WHEN event_id % 61 = 7 THEN 'AAAAAAAAAAAA' WHEN event_id % 59 = 8 THEN concat('N', substring(UMI, 2, 11))
                              WHEN event_id % 9 = 4 THEN concat(substring(UMI, 1, p - 1), translate(substring(UMI, p, 1), 'ACGT', 'TGCA'), substring(UMI, p + 1, 12))
                              WHEN event_id % 9 = 5 THEN concat(translate(substring(UMI, 1, 1), 'ACGT', 'TGCA'), translate(substring(UMI, 2, 1), 'ACGT', 'CATG'), substring(UMI, 3, 10)) ELSE UMI END AS UB
FROM (SELECT concat('S', cast(user_id % 2 AS string)) AS sample, event_id, cast(1 + event_id % 3 AS int) AS p, concat('g', cast(event_id % 5 AS string)) AS gene,
             substring(translate(md5(concat('C', cast(user_id % 24 AS string))), {DNA}), 1, 16) AS CB,
             substring(translate(md5(concat('U', cast(event_id % 7 AS string))), {DNA}), 1, 12) AS UMI FROM events) a
"""

#: UMIs of genes in droplets: a few large cells, some small ones with genes of their own, and ambient droplets.
DROPLET_GENES = """
SELECT sample, concat('D', cast(d AS string)) AS CB, concat('g', cast(CASE WHEN d < 8 THEN k % 40 WHEN d < 24 THEN 300 + k % 20 ELSE k % 311 END AS string)) AS gene,
       cast(sum(CASE WHEN d < 8 THEN q WHEN d < 24 THEN 2 ELSE 1 END) AS bigint) AS n
FROM (SELECT concat('S', cast(l_suppkey % 2 AS string)) AS sample, l_orderkey % 400 AS d, l_partkey AS k, cast(l_quantity AS bigint) AS q FROM lineitem) a GROUP BY 1, 2, 3
"""

#: Spike-ins: the two most frequent roots.
SPIKEINS = f"SELECT substring(translate(md5(concat('GBC', cast(r AS string))), {DNA}), 1, 18) AS gbc FROM (SELECT 0 AS r UNION ALL SELECT 7 AS r) a"

#: A bulk reference for the single-cell samples: their barcodes, some with a substitution, and some others.
BULK_FOR_SC = f"""
SELECT concat('S', cast(s AS string)) AS sample, CASE WHEN k % 4 = 1 THEN concat(substring(g, 1, 8), translate(substring(g, 9, 1), 'ACGT', 'TGCA'), substring(g, 10, 9)) ELSE g END AS gbc, cast(1000 + 7 * k + s AS bigint) AS read_count
FROM (SELECT n_nationkey AS k, n_regionkey % 3 AS s, substring(translate(md5(concat('GBC', cast(n_nationkey AS string))), {DNA}), 1, 18) AS g FROM nation) a
"""

#: Thresholds of each sample.
SAMPLE_PARAMS = """
SELECT 'S0' AS sample, 2e0 AS umi_treshold, 1e0 AS p_treshold, 5e-2 AS max_ratio_treshold, 5e-2 AS normalized_abundance_treshold
UNION ALL SELECT 'S1', 5e0, 5e-1, 7.5e-1, 3e-1
"""


def table(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The derived table from the Parquet tables of a folder."""
    views = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "events", "nation") if f"FROM {t}" in sql}
    for name in views:
        sql = sql.replace(f"FROM {name}", "FROM {" + name + "}")
    return spark.sql(sql, **views)


def bulk_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, BULK_READS)


def sc_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, SC_ELEMENTS)


def aligned_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, ALIGNED_READS)


def spikeins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, SPIKEINS)


def bulk_for_sc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, BULK_FOR_SC)


def sample_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, SAMPLE_PARAMS)


def sample_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.range(3).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("sample"), F.concat(F.lit("S"), F.col("id").cast("string")).alias("reference"))


def first_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, FIRST_READS)


def whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, WHITELIST)


def gene_umis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, GENE_UMIS)


def droplet_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, DROPLET_GENES)
