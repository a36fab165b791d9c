"""Every query of the barcode operators, each with the same in DuckDB's SQL.

Doubles are rounded to six digits on both sides; counts are 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake import fixtures as fx
from strandlake.functions.seq import reverse_complement, search_patterns
from strandlake.operators import bulk, bulk_summary, channels, cluster, consensus, sc
from strandlake.params import BulkParams, ScParams
from strandlake.sources import sequences, tables
from strandlake.storage import materialise

BULK = BulkParams(min_n_reads=100)
#: Several barcodes a cell pass these.
LOOSE = ScParams(umi_threshold=2, max_ratio_threshold=0.05, normalized_abundance_threshold=0.05)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Queries that SQL can't express.
UNTOLD: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(sql: str):
    """Registers a query under its function's name, with its oracle."""

    def put(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return put


def untold(f):
    """Registers a query without an oracle."""
    UNTOLD[f.__name__] = f
    return f


def rounded(df: DataFrame) -> DataFrame:
    """Counts as long, doubles to six digits."""
    kinds = dict(df.dtypes)
    return df.select(*(F.round(F.col(f"`{c}`"), 6).alias(c) if kinds[c] == "double" else F.col(f"`{c}`").cast("long").alias(c) if kinds[c] in ("int", "bigint") else F.col(f"`{c}`") for c in df.columns))


# -- what several oracles share

ANCHOR = "(?:" + "|".join(p.removesuffix(".*") for p in search_patterns(BULK.anchor)) + ").*"
READS = f"reads AS ({fx.BULK_READS})"
GBC = f"{READS}, barcodes AS (SELECT sample, substring(regexp_extract(seq, '{ANCHOR}', 0), 23, 18) AS gbc FROM reads WHERE regexp_matches(seq, '{ANCHOR}'))"
RAW = f"{GBC}, raw AS (SELECT sample, gbc, count(*)::bigint AS read_counts FROM barcodes WHERE length(gbc) = 18 GROUP BY ALL)"
EDGES = f"""{RAW}, nodes AS (SELECT * FROM raw WHERE read_counts > 1),
edges AS (SELECT a.sample, a.gbc AS src, b.gbc AS dst, a.read_counts AS n_src, b.read_counts AS n_dst, hamming(a.gbc, b.gbc)::bigint AS hamming
          FROM nodes a JOIN nodes b ON a.sample = b.sample AND a.gbc <> b.gbc AND hamming(a.gbc, b.gbc) <= 3 AND a.read_counts >= 2 * b.read_counts - 1)"""
LABELS = f"""{EDGES}, reach AS (SELECT sample, gbc AS root, gbc AS node FROM nodes UNION SELECT r.sample, r.root, e.dst FROM reach r JOIN edges e ON r.sample = e.sample AND r.node = e.src),
labels AS (SELECT r.sample, r.node AS gbc, r.root AS correct, n.read_counts AS n_correct FROM reach r JOIN nodes n ON r.sample = n.sample AND r.root = n.gbc
           QUALIFY row_number() OVER (PARTITION BY r.sample, r.node ORDER BY n.read_counts DESC, r.root) = 1),
correction AS (SELECT l.sample, l.correct, l.gbc AS degenerated, l.n_correct AS n_reads_correct, n.read_counts AS n_reads_degenerated
               FROM labels l JOIN nodes n ON l.sample = n.sample AND l.gbc = n.gbc WHERE l.gbc <> l.correct)"""


def pool_sql(spikes: str) -> str:
    return f"""summed AS (SELECT sample, correct AS gbc, any_value(n_reads_correct) + sum(n_reads_degenerated) AS read_count FROM correction GROUP BY ALL),
spikes AS ({spikes}), kept AS (SELECT * FROM correction WHERE correct NOT IN (SELECT gbc FROM spikes) AND degenerated NOT IN (SELECT gbc FROM spikes)),
corrected AS (SELECT * FROM (
  SELECT s.sample, s.gbc, s.read_count::bigint AS read_count FROM summed s WHERE EXISTS (SELECT 1 FROM kept k WHERE k.sample = s.sample AND k.correct = s.gbc)
  UNION ALL SELECT n.sample, n.gbc, n.read_counts FROM nodes n WHERE n.gbc NOT IN (SELECT gbc FROM spikes) AND NOT EXISTS (SELECT 1 FROM kept k WHERE k.sample = n.sample AND n.gbc IN (k.correct, k.degenerated))) u
  WHERE read_count >= {BULK.min_n_reads})"""


NO_SPIKES = "SELECT '' AS gbc WHERE false"
POOL = f"WITH RECURSIVE {LABELS}, {pool_sql(NO_SPIKES)}"
JOINED = f"{POOL}, joined AS (SELECT coalesce(r.sample, c.sample) AS sample, coalesce(r.gbc, c.gbc) AS gbc, coalesce(r.read_counts, 0) AS raw_counts, coalesce(c.read_count, 0) AS corrected_counts FROM raw r FULL JOIN corrected c ON r.sample = c.sample AND r.gbc = c.gbc)"


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bulk.raw_counts(bulk.extract(fx.bulk_reads(spark, sf_dir), anchor=BULK.anchor))


def _corrections(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    raw = materialise(_raw(spark, sf_dir), "raw-counts")
    return raw, cluster.correction(cluster.labels(raw))


def _pool(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    raw, corrections = _corrections(spark, sf_dir)
    return raw, corrections, cluster.final_pool(raw, corrections, min_n_reads=BULK.min_n_reads)


# -- bulk


@query(f"WITH {GBC} SELECT sample, gbc, count(*)::bigint AS n FROM barcodes GROUP BY ALL")
def extract_gbc(spark, sf_dir):
    found = bulk.extract(fx.bulk_reads(spark, sf_dir), anchor=BULK.anchor)
    return found.groupBy("sample", "gbc").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {RAW} SELECT * FROM raw")
def gbc_raw_counts(spark, sf_dir):
    return _raw(spark, sf_dir)


@query(f"WITH {EDGES} SELECT * FROM edges")
def hamming_edges(spark, sf_dir):
    return rounded(cluster.directional_edges(_raw(spark, sf_dir)))


@query(f"WITH RECURSIVE {LABELS} SELECT * FROM correction")
def gbc_correction(spark, sf_dir):
    return _corrections(spark, sf_dir)[1]


COMPONENTS = f"""{RAW}, nodes AS (SELECT * FROM raw WHERE read_counts > 1), near AS (SELECT a.sample, a.gbc AS src, b.gbc AS dst FROM nodes a JOIN nodes b ON a.sample = b.sample AND a.gbc <> b.gbc AND hamming(a.gbc, b.gbc) <= 3),
reach AS (SELECT sample, gbc AS root, gbc AS node FROM nodes UNION SELECT r.sample, r.root, e.dst FROM reach r JOIN near e ON r.sample = e.sample AND r.node = e.src),
parts AS (SELECT r.sample, r.node AS gbc, n.gbc AS best, n.read_counts AS n_best FROM reach r JOIN nodes n ON r.sample = n.sample AND r.root = n.gbc QUALIFY row_number() OVER (PARTITION BY r.sample, r.node ORDER BY n.read_counts DESC, n.gbc) = 1)"""


@query(f"WITH RECURSIVE {COMPONENTS} SELECT p.sample, p.best AS correct, p.gbc AS degenerated, p.n_best AS n_reads_correct, n.read_counts AS n_reads_degenerated FROM parts p JOIN nodes n ON p.sample = n.sample AND p.gbc = n.gbc WHERE p.gbc <> p.best")
def gbc_correction_cluster(spark, sf_dir):
    return cluster.correction(cluster.grouped(materialise(_raw(spark, sf_dir), "raw-counts"), "cluster"))


@query(f"""WITH RECURSIVE {COMPONENTS}, ranked AS (SELECT p.sample, p.gbc, p.best, n.read_counts, row_number() OVER (PARTITION BY p.sample, p.best ORDER BY n.read_counts DESC, p.gbc) AS place FROM parts p JOIN nodes n ON p.sample = n.sample AND p.gbc = n.gbc),
firsts AS (SELECT e.sample, e.dst AS gbc, min(r.place) AS place FROM near e JOIN ranked r ON e.sample = r.sample AND e.src = r.gbc GROUP BY ALL),
covers AS (SELECT r.*, f.place AS near_place, least(r.place, f.place) AS cover FROM ranked r LEFT JOIN firsts f ON r.sample = f.sample AND r.gbc = f.gbc), leads AS (SELECT *, max(cover) OVER (PARTITION BY sample, best) AS leads FROM covers)
SELECT l.sample, r.gbc AS correct, l.gbc AS degenerated, r.read_counts AS n_reads_correct, l.read_counts AS n_reads_degenerated FROM leads l JOIN ranked r ON r.sample = l.sample AND r.best = l.best AND r.place = l.near_place WHERE l.place > l.leads""")
def gbc_correction_adjacency(spark, sf_dir):
    return cluster.correction(cluster.grouped(materialise(_raw(spark, sf_dir), "raw-counts"), "adjacency"))


@query(f"{POOL} SELECT * FROM corrected")
def gbc_counts_corrected(spark, sf_dir):
    return _pool(spark, sf_dir)[2]


@query(f"WITH RECURSIVE {LABELS}, {pool_sql(fx.SPIKEINS)} SELECT * FROM corrected")
def gbc_spikein_removed(spark, sf_dir):
    raw, corrections = _corrections(spark, sf_dir)
    return cluster.final_pool(raw, corrections, min_n_reads=BULK.min_n_reads, spikeins=fx.spikeins(spark, sf_dir))


@query(f"""{POOL} SELECT r.sample, r.total_GBC_reads, r.n_unique_GBCs, coalesce(c.n, 0)::bigint AS n_filtered_GBCs, coalesce(k.a, 0)::bigint AS n_corrected_GBCs, coalesce(k.b, 0)::bigint AS n_degenerated_GBCs, round(k.m, 6) AS median_n_reads_added
FROM (SELECT sample, sum(read_counts)::bigint AS total_GBC_reads, count(*)::bigint AS n_unique_GBCs FROM raw GROUP BY 1) r LEFT JOIN (SELECT sample, count(*) AS n FROM corrected GROUP BY 1) c USING (sample)
LEFT JOIN (SELECT sample, count(DISTINCT correct) AS a, count(DISTINCT degenerated) AS b, median(n_reads_degenerated) AS m FROM correction GROUP BY 1) k USING (sample)""")
def bulk_metrics(spark, sf_dir):
    raw, corrections, corrected = _pool(spark, sf_dir)
    return rounded(bulk.metrics(raw, corrected, corrections))


@query(f"{POOL} SELECT gbc, read_count, sample FROM corrected")
def bulk_reference(spark, sf_dir):
    return bulk_summary.reference(_pool(spark, sf_dir)[2])


@query(f"{JOINED} SELECT * FROM joined")
def raw_corrected_outer(spark, sf_dir):
    raw, _, corrected = _pool(spark, sf_dir)
    return bulk_summary.raw_with_corrected(raw, corrected)


OVERLAP = """common AS (SELECT x.sample AS sample_x, y.sample AS sample_y, (SELECT count(*) FROM corrected a JOIN corrected b ON a.gbc = b.gbc WHERE a.sample = x.sample AND b.sample = y.sample)::bigint AS n_common
FROM (SELECT DISTINCT sample FROM corrected) x CROSS JOIN (SELECT DISTINCT sample FROM corrected) y)"""


@query(f"{POOL}, {OVERLAP} SELECT * FROM common")
def sample_overlap(spark, sf_dir):
    return rounded(bulk_summary.overlap(_pool(spark, sf_dir)[2]))


@query(f"{POOL}, {OVERLAP} SELECT round(quantile_cont(n_common::double, 0.99), 6) AS ceiling FROM common")
def overlap_ceiling(spark, sf_dir):
    return rounded(bulk_summary.overlap_ceiling(bulk_summary.overlap(_pool(spark, sf_dir)[2])))


@query(f"{JOINED} SELECT gbc, " + ", ".join(f"coalesce(sum(corrected_counts) FILTER (sample = '{s}'), 0)::bigint AS \"{s}\"" for s in ("S0", "S1", "S2", "S3")) + " FROM joined GROUP BY gbc")
def gbc_sample_matrix(spark, sf_dir):
    raw, _, corrected = _pool(spark, sf_dir)
    return bulk_summary.sample_matrix(bulk_summary.raw_with_corrected(raw, corrected), ["S0", "S1", "S2", "S3"])


@query(f"""{JOINED}, per AS (SELECT gbc, count(*) FILTER (corrected_counts > 0) AS n FROM joined GROUP BY gbc)
SELECT b.n_samples::bigint AS n_samples, (SELECT count(*) FROM per WHERE per.n = b.n_samples)::bigint AS n_gbcs FROM (SELECT unnest(range(1, (SELECT count(DISTINCT sample) + 1 FROM joined))) AS n_samples) b""")
def gbc_prevalence_hist(spark, sf_dir):
    raw, _, corrected = _pool(spark, sf_dir)
    return rounded(bulk_summary.prevalence(bulk_summary.raw_with_corrected(raw, corrected)))


@query(f"{POOL} SELECT sample, gbc, read_count, round(row_number() OVER (ORDER BY read_count, sample, gbc) / count(*) OVER (), 6) AS cdf FROM corrected")
def corrected_cdf(spark, sf_dir):
    return rounded(bulk_summary.cumulative(_pool(spark, sf_dir)[2]))


POINTS = "points AS (SELECT c.sample, c.gbc, log10(r.read_counts + 1) AS x, log10(c.read_count + 1) AS y FROM corrected c JOIN raw r ON c.sample = r.sample AND c.gbc = r.gbc)"


@query(f"{POOL}, {POINTS} SELECT sample, count(*)::bigint AS n, CASE WHEN count(*) > 1 THEN round(regr_slope(y, x), 6) END AS slope, CASE WHEN count(*) > 1 THEN round(regr_intercept(y, x), 6) END AS intercept FROM points GROUP BY sample")
def before_after_fit(spark, sf_dir):
    raw, _, corrected = _pool(spark, sf_dir)
    return rounded(bulk_summary.fit(bulk_summary.before_after(raw, corrected)))


@query(f"""WITH {RAW}, v AS (SELECT sample, log10(read_counts + 1) AS value FROM raw),
s AS (SELECT sample, min(value) AS lo, max(value) AS hi, stddev_samp(value) AS sd, count(*) AS n FROM v GROUP BY 1),
g AS (SELECT sample, n, sd * pow(n, -0.2) AS h, lo + i * (hi - lo) / 199 AS x, i FROM s CROSS JOIN range(200) t(i) WHERE sd > 0)
SELECT g.sample, round(g.x, 6) AS x, round(sum(exp(-0.5 * pow((g.x - v.value) / g.h, 2))) / (any_value(g.n) * any_value(g.h) * sqrt(2 * pi())), 6) AS density FROM g JOIN v ON g.sample = v.sample GROUP BY g.sample, g.i, g.x""")
def raw_count_kde(spark, sf_dir):
    values = _raw(spark, sf_dir).select("sample", F.log10(F.col("read_counts") + F.lit(1.0)).alias("value"))
    return rounded(bulk_summary.density(values, points=200))


@query(f"WITH {RAW} SELECT sample, round(median(log10(read_counts + 1)), 6) AS median_log10 FROM raw GROUP BY 1")
def raw_count_medians(spark, sf_dir):
    return rounded(bulk_summary.count_medians(_raw(spark, sf_dir)))


@query(f"WITH {RAW} SELECT sample, min(read_counts) AS least, max(read_counts) AS most FROM raw GROUP BY 1")
def raw_count_ranges(spark, sf_dir):
    return bulk_summary.count_ranges(_raw(spark, sf_dir))


# -- single cell

ELEMENTS = f"el AS (SELECT sample, event_id, CBC, UMI, reverse(translate(GBC, 'ACGTN', 'TGCAN')) AS GBC FROM ({fx.SC_ELEMENTS}) a)"
UMIS = f"{ELEMENTS}, umis AS (SELECT sample, CBC, GBC, UMI, count(*)::bigint AS count FROM el GROUP BY ALL)"
COMBOS = f"""{UMIS}, combos AS (SELECT *, umi / max(umi) OVER w AS max_ratio, umi / sum(umi) OVER w AS normalized_abundance FROM (SELECT sample, CBC, GBC, count(*)::bigint AS umi FROM umis GROUP BY ALL) c
WINDOW w AS (PARTITION BY sample, CBC))"""
SCORED = f"""{COMBOS}, means AS (SELECT sample, GBC, median(umi) AS m FROM combos GROUP BY ALL),
tails AS (SELECT umi, m, greatest(0, 1 - list_sum(list_transform(range(umi), lambda k: exp(-m + k * ln(m) - lgamma(k + 1))))) AS p FROM (SELECT DISTINCT c.umi, s.m FROM combos c JOIN means s USING (sample, GBC)) d),
scored AS (SELECT c.*, t.p FROM combos c JOIN means s USING (sample, GBC) JOIN tails t ON t.umi = c.umi AND t.m = s.m)"""


def status_sql(umi="2", p="1", ratio="0.05", share="0.05") -> str:
    return f"status AS (SELECT scored.*, CASE WHEN umi >= {umi} AND p <= {p} AND max_ratio >= {ratio} AND normalized_abundance >= {share} THEN 'supported' ELSE 'unsupported' END AS status FROM scored)"


CELLS = f"{SCORED}, {status_sql()}, cells AS (SELECT sample, CBC, GBC, umi FROM status WHERE status = 'supported'), moi AS (SELECT sample, CBC, count(*)::bigint AS moi FROM cells GROUP BY ALL)"


def clones_sql(cells: str, name: str) -> str:
    return f"""{name} AS (SELECT sample, 'C' || (row_number() OVER (PARTITION BY sample ORDER BY n_cells DESC, GBC_set) - 1) AS clone, GBC_set, n_cells, n_cells / sum(n_cells) OVER (PARTITION BY sample) AS prevalence
FROM (SELECT sample, GBC_set, count(*)::bigint AS n_cells FROM (SELECT sample, CBC, string_agg(GBC, ';' ORDER BY GBC) AS GBC_set FROM {cells} GROUP BY ALL) s GROUP BY ALL) t)"""


ONE = "one AS (SELECT c.* FROM cells c JOIN moi m ON c.sample = m.sample AND c.CBC = m.CBC WHERE m.moi = 1)"


def _umis(spark, sf_dir) -> DataFrame:
    return sc.umi_counts(sc.read_elements(fx.sc_elements(spark, sf_dir)))


def _scored(spark, sf_dir) -> DataFrame:
    return sc.poisson(sc.combos(_umis(spark, sf_dir)))


def _cells(spark, sf_dir) -> DataFrame:
    return sc.cell_gbc(sc.support(_scored(spark, sf_dir), LOOSE))


@query(f"WITH {ELEMENTS} SELECT sample, event_id, GBC FROM el")
def sc_revcomp(spark, sf_dir):
    return sc.read_elements(fx.sc_elements(spark, sf_dir)).select("sample", "event_id", "GBC")


NEAREST = f"""{ELEMENTS}, ref AS ({fx.BULK_FOR_SC}),
mapped AS (SELECT s.sample, s.GBC, r.gbc AS correct_GBC, hamming(s.GBC, r.gbc)::bigint AS hamming FROM (SELECT DISTINCT sample, GBC FROM el) s JOIN ref r ON r.sample = s.sample AND hamming(s.GBC, r.gbc) <= 3
QUALIFY row_number() OVER (PARTITION BY s.sample, s.GBC ORDER BY hamming(s.GBC, r.gbc), r.read_count DESC, r.gbc) = 1)"""


def _mapped(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    elements = sc.read_elements(fx.sc_elements(spark, sf_dir))
    bulk_ = sc.sample_reference(fx.bulk_for_sc(spark, sf_dir), fx.sample_map(spark, sf_dir))
    return elements, bulk_, sc.bulk_map(elements, bulk_)


@query(f"WITH {NEAREST} SELECT * FROM mapped")
def sc_nearest_bulk(spark, sf_dir):
    return rounded(_mapped(spark, sf_dir)[2])


@query(f"WITH {NEAREST} SELECT e.sample, e.CBC, m.correct_GBC AS GBC, e.UMI, count(*)::bigint AS count FROM el e JOIN mapped m ON e.sample = m.sample AND e.GBC = m.GBC GROUP BY ALL")
def sc_corrected_umis(spark, sf_dir):
    elements, _, mapped = _mapped(spark, sf_dir)
    return sc.umi_counts(sc.correct_with_bulk(elements, mapped)).drop("log")


@query(f"WITH {UMIS} SELECT *, round(log10(count), 6) AS log FROM umis")
def umi_counts(spark, sf_dir):
    return rounded(_umis(spark, sf_dir))


@query(f"WITH {COMBOS} SELECT sample, CBC, GBC, umi, round(max_ratio, 6) AS max_ratio, round(normalized_abundance, 6) AS normalized_abundance FROM combos")
def combos(spark, sf_dir):
    return rounded(sc.combos(_umis(spark, sf_dir)))


@query(f"WITH {SCORED} SELECT sample, CBC, GBC, umi, round(p, 6) AS p, round(log10(umi), 6) AS logumi, CASE WHEN p > 1e-9 THEN round(-log10(p), 4) END AS logp FROM scored")
def combo_poisson(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    return rounded(scored.select("sample", "CBC", "GBC", "umi", "p", "logumi", F.when(F.col("p") > 1e-9, F.round("logp", 4)).alias("logp")))


@query(f"WITH {SCORED}, {status_sql()} SELECT sample, CBC, GBC, umi, status FROM status")
def combo_status(spark, sf_dir):
    return sc.support(_scored(spark, sf_dir), LOOSE).select("sample", "CBC", "GBC", "umi", "status")


@query(f"""WITH {SCORED}, own AS ({fx.SAMPLE_PARAMS}), status AS (SELECT s.*, CASE WHEN umi >= coalesce(o.umi_treshold, 2) AND p <= coalesce(o.p_treshold, 1) AND max_ratio >= coalesce(o.max_ratio_treshold, 0.05)
AND normalized_abundance >= coalesce(o.normalized_abundance_treshold, 0.05) THEN 'supported' ELSE 'unsupported' END AS status FROM scored s LEFT JOIN own o USING (sample)) SELECT sample, CBC, GBC, umi, status FROM status""")
def combo_status_by_sample(spark, sf_dir):
    return sc.support(_scored(spark, sf_dir), LOOSE, fx.sample_params(spark, sf_dir)).select("sample", "CBC", "GBC", "umi", "status")


#: Barcodes of the fixture with the numbers 0 to 3, as columns of a matrix.
MATRIX = ["GBC0", "GBC1", "GBC2", "GBC3"]


@query(f"""WITH {CELLS}, named AS (SELECT c.*, g.name FROM cells c JOIN (SELECT concat('GBC', cast(i AS string)) AS name, substring(translate(md5(concat('GBC', cast(i AS string))), {fx.DNA}), 1, 18) AS GBC FROM range(4) t(i)) g USING (GBC))
SELECT sample, CBC, """ + ", ".join(f"round(coalesce(avg(umi) FILTER (name = '{n}'), 0), 6) AS {n}" for n in MATRIX) + " FROM named GROUP BY ALL")
def cell_gbc_matrix(spark, sf_dir):
    names = spark.range(4).select(F.concat(F.lit("GBC"), F.col("id").cast("string")).alias("name")).select("name", F.substring(F.translate(F.md5(F.col("name").cast("binary")), "0123456789abcdef", "ACGTACGTACGTACGT"), 1, 18).alias("GBC"))
    named = _cells(spark, sf_dir).join(F.broadcast(names), "GBC").select("sample", "CBC", F.col("name").alias("GBC"), "umi")
    return rounded(sc.cell_matrix(named, MATRIX))


#: All thirty barcodes of the fixture.
WHOLE = [f"GBC{i}" for i in range(30)]


@query(f"""WITH {CELLS}, named AS (SELECT c.*, g.name FROM cells c LEFT JOIN (SELECT concat('GBC', cast(i AS string)) AS name, substring(translate(md5(concat('GBC', cast(i AS string))), {fx.DNA}), 1, 18) AS GBC FROM range(30) t(i)) g USING (GBC))
SELECT sample, CBC, """ + ", ".join(f"round(coalesce(avg(umi) FILTER (name = '{n}'), 0), 6) AS {n}" for n in WHOLE) + " FROM named GROUP BY ALL")
def cell_gbc_matrix_whole(spark, sf_dir):
    """Every cell, and a column for every barcode there is."""
    names = spark.range(30).select(F.concat(F.lit("GBC"), F.col("id").cast("string")).alias("name")).select("name", F.substring(F.translate(F.md5(F.col("name").cast("binary")), "0123456789abcdef", "ACGTACGTACGTACGT"), 1, 18).alias("GBC"))
    named = _cells(spark, sf_dir).join(names, "GBC", "left").select("sample", "CBC", F.col("name").alias("GBC"), "umi")
    return rounded(sc.cell_matrix(named, WHOLE))


@query(f"WITH {CELLS} SELECT sample, moi, count(*)::bigint AS n_cells FROM moi GROUP BY ALL")
def moi_distribution(spark, sf_dir):
    return sc.moi_distribution(_cells(spark, sf_dir))


@query(f"WITH {CELLS} SELECT sample, round(median(moi), 6) AS median_moi, round(stddev_samp(moi), 6) AS std_moi FROM moi GROUP BY ALL")
def moi_stats(spark, sf_dir):
    return rounded(sc.moi_stats(_cells(spark, sf_dir)))


@query(f"WITH {CELLS}, {clones_sql('cells', 'clones')} SELECT sample, clone, GBC_set, n_cells, round(prevalence, 6) AS prevalence FROM clones")
def clones(spark, sf_dir):
    return rounded(sc.clones(_cells(spark, sf_dir)))


STRICT = ScParams()
STRICT_CELLS = CELLS.replace(status_sql(), status_sql("5", "1", "0.75", "0.75"))


@query(f"WITH {STRICT_CELLS}, {ONE}, {clones_sql('one', 'clones')} SELECT sample, clone, GBC_set, n_cells, round(prevalence, 6) AS prevalence FROM clones")
def clones_unique(spark, sf_dir):
    cells = sc.cell_gbc(sc.support(_scored(spark, sf_dir), STRICT))
    return rounded(sc.clones(sc.unique_cells(cells)))


@query(f"WITH {STRICT_CELLS}, {ONE} SELECT sample, CBC || '_' || sample AS cell_id, GBC FROM one")
def cells(spark, sf_dir):
    return sc.cell_table(sc.cell_gbc(sc.support(_scored(spark, sf_dir), STRICT)))


@query(f"""WITH {CELLS}, {clones_sql('cells', 'clones')}, each AS (SELECT sample, unnest(string_split(GBC_set, ';')) AS GBC FROM clones), per AS (SELECT sample, GBC, count(*) AS k FROM each GROUP BY ALL)
SELECT p.sample, (SELECT count(*) FROM clones c WHERE c.sample = p.sample)::bigint AS n_sets, count(*)::bigint AS n_gbcs, round(1 - count(*) / sum(k), 6) AS redundancy, round(median(k), 6) AS median_occurrence, round(stddev_samp(k), 6) AS std_occurrence FROM per p GROUP BY p.sample""")
def gbc_set_stats(spark, sf_dir):
    return rounded(sc.set_stats(sc.clones(_cells(spark, sf_dir))))


@query(f"WITH {CELLS}, {clones_sql('cells', 'clones')} SELECT sample, GBC, count(*)::bigint AS n_sets FROM (SELECT sample, unnest(string_split(GBC_set, ';')) AS GBC FROM clones) e GROUP BY ALL")
def gbc_occurrences(spark, sf_dir):
    return sc.gbc_occurrences(sc.clones(_cells(spark, sf_dir)))


@query(f"""WITH {CELLS}, {ONE}, {clones_sql('one', 'clones')}
SELECT s.sample, count(DISTINCT GBC)::bigint AS "unique_good_GBCs", count(*) FILTER (status = 'unsupported')::bigint AS unsupported_combos, count(*) FILTER (status = 'supported')::bigint AS supported_combos, count(DISTINCT CBC)::bigint AS "starting_CBCs",
(SELECT round(median(moi), 6) FROM moi m WHERE m.sample = s.sample) AS observed_moi_median, (SELECT round(stddev_samp(moi), 6) FROM moi m WHERE m.sample = s.sample) AS observed_moi_std,
(SELECT coalesce(sum(n_cells), 0)::bigint FROM clones c WHERE c.sample = s.sample) AS uniquely_barcoded_cells, (SELECT count(*)::bigint FROM clones c WHERE c.sample = s.sample) AS n_clones,
(SELECT count(*)::bigint FROM clones c WHERE c.sample = s.sample AND n_cells >= 10) AS n_clones_10plus FROM status s GROUP BY s.sample""")
def sc_metrics(spark, sf_dir):
    return rounded(sc.run_metrics(sc.support(_scored(spark, sf_dir), LOOSE)))


@query(f"WITH {SCORED} SELECT sample, round(median(umi), 6) AS median_umi, round(median(p), 6) AS median_p, round(median(max_ratio), 6) AS median_max_ratio, round(median(normalized_abundance), 6) AS median_normalized_abundance FROM scored GROUP BY sample")
def combo_medians(spark, sf_dir):
    return rounded(sc.combo_medians(_scored(spark, sf_dir)))


@query(f"""WITH {NEAREST}, fixed AS (SELECT e.sample, e.CBC, m.correct_GBC AS GBC, e.UMI FROM el e JOIN mapped m ON e.sample = m.sample AND e.GBC = m.GBC), {COMBOS.removeprefix(ELEMENTS + ', ').replace('FROM el GROUP', 'FROM fixed GROUP')},
status AS (SELECT * FROM combos), cells AS (SELECT * FROM combos WHERE umi >= 2 AND max_ratio >= 0.05 AND normalized_abundance >= 0.05),
pseudo AS (SELECT sample, GBC AS gbc, sum(umi) AS umi FROM cells GROUP BY ALL), seen AS (SELECT DISTINCT sample, GBC AS gbc FROM status)
SELECT r.sample, count(*)::bigint AS n_bulk, (SELECT count(*) FROM seen s WHERE s.sample = r.sample)::bigint AS n_sc, count(p.umi)::bigint AS n_common, round(avg(CASE WHEN EXISTS (SELECT 1 FROM seen s WHERE s.sample = r.sample AND s.gbc = r.gbc) THEN 1 ELSE 0 END), 6) AS bulk_found,
round(corr(p.umi, CASE WHEN p.umi IS NOT NULL THEN r.read_count END), 6) AS abundance_corr FROM ref r LEFT JOIN pseudo p ON p.sample = r.sample AND p.gbc = r.gbc GROUP BY r.sample""")
def pseudobulk_corr(spark, sf_dir):
    elements, bulk_, mapped = _mapped(spark, sf_dir)
    status = sc.support(sc.poisson(sc.combos(sc.umi_counts(sc.correct_with_bulk(elements, mapped)))), LOOSE)
    return rounded(sc.bulk_check(status, bulk_))


@query(f"WITH {COMBOS} SELECT sample, row_number() OVER (PARTITION BY sample ORDER BY umi DESC, CBC, GBC) AS rank, umi FROM combos UNION ALL SELECT DISTINCT sample, 0::bigint, 0::bigint FROM combos")
def umi_rank_curve(spark, sf_dir):
    return sc.umi_rank_curve(sc.combos(_umis(spark, sf_dir)))


@query(f"WITH {CELLS}, {clones_sql('cells', 'clones')} SELECT sample, clone, n_cells, row_number() OVER (PARTITION BY sample ORDER BY n_cells DESC, GBC_set) AS n_larger FROM clones")
def clone_size_curve(spark, sf_dir):
    return sc.clone_size_curve(sc.clones(_cells(spark, sf_dir)))


@query(f"""WITH {COMBOS}, q AS (SELECT sample, count(*)::bigint AS n, quantile_cont(umi, 0.25) AS q1, quantile_cont(umi, 0.5) AS median, quantile_cont(umi, 0.75) AS q3 FROM combos GROUP BY 1)
SELECT q.sample, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, min(umi) FILTER (umi >= q1 - 1.5 * (q3 - q1) AND umi <= q3 + 1.5 * (q3 - q1)) AS low, max(umi) FILTER (umi >= q1 - 1.5 * (q3 - q1) AND umi <= q3 + 1.5 * (q3 - q1)) AS high,
count(*) FILTER (umi < q1 - 1.5 * (q3 - q1) OR umi > q3 + 1.5 * (q3 - q1))::bigint AS n_outliers FROM combos c JOIN q USING (sample) GROUP BY ALL""")
def umi_box_stats(spark, sf_dir):
    return rounded(sc.box_stats(sc.combos(_umis(spark, sf_dir))))


@query(f"WITH {SCORED} SELECT sample, least(floor(max_ratio * 20), 19)::bigint AS ratio_bin, least(floor(normalized_abundance * 20), 19)::bigint AS abundance_bin, count(*)::bigint AS n FROM scored GROUP BY ALL")
def support_density(spark, sf_dir):
    return sc.support_density(_scored(spark, sf_dir))


@query(f"WITH {SCORED}, {status_sql()} SELECT sample, count(*)::bigint AS n_combos, round(100 * count(*) FILTER (status = 'supported') / count(*), 6) AS retained_percent FROM status GROUP BY sample")
def retained_share(spark, sf_dir):
    return rounded(sc.retained_share(sc.support(_scored(spark, sf_dir), LOOSE)))


@query(f"WITH el AS ({fx.SC_ELEMENTS}) SELECT sample, count(DISTINCT GBC)::bigint AS unique_gbc_sc FROM el GROUP BY 1")
def unique_sc_gbcs(spark, sf_dir):
    return sc.unique_gbcs(fx.sc_elements(spark, sf_dir))


# -- reads to elements

ALIGNED = f"aligned AS ({fx.ALIGNED_READS}), cb AS (SELECT DISTINCT sample, CB FROM aligned WHERE CB <> '-' AND substring(CB, 1, 1) <> 'A'), tagged AS (SELECT * FROM aligned a WHERE contig = 'lentiCassette' AND flag & 4 = 0 AND CB <> '-')"
KEPT = f"{ALIGNED}, kept AS (SELECT * FROM tagged t WHERE EXISTS (SELECT 1 FROM cb WHERE cb.sample = t.sample AND cb.CB = t.CB)), mol AS (SELECT *, dense_rank() OVER (PARTITION BY sample, CB ORDER BY pos, UB) - 1 AS MI FROM kept)"
CONSENSUS = f"""{KEPT}, bases AS (SELECT sample, CB, MI, i AS place, substring(seq, i + 1, 1) AS base, ascii(substring(qual, i + 1, 1)) - 33 AS q FROM mol CROSS JOIN range(53) t(i)),
votes AS (SELECT sample, CB, MI, place, base, sum(CASE WHEN q >= 30 AND base <> 'N' THEN q ELSE 0 END) AS weight, count(*) FILTER (q >= 30 AND base <> 'N') AS votes FROM bases GROUP BY ALL),
places AS (SELECT sample, CB, MI, place, sum(votes) AS depth, arg_max(base, row(weight, -ascii(base))) AS base, arg_max(votes, row(weight, -ascii(base))) AS agree FROM votes GROUP BY ALL),
big AS (SELECT sample, CB, MI FROM mol GROUP BY ALL HAVING count(*) >= 3),
called AS (SELECT sample, CB, MI::bigint AS MI, string_agg(CASE WHEN depth > 0 THEN base ELSE 'N' END, '' ORDER BY place) AS seq, max(depth)::bigint AS cD, CASE WHEN sum(depth) > 0 THEN 1 - sum(CASE WHEN depth > 0 THEN agree ELSE 0 END) / sum(depth) ELSE 1 END AS error_rate
           FROM places JOIN big USING (sample, CB, MI) GROUP BY ALL)"""


def _reads(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    reads = fx.aligned_reads(spark, sf_dir)
    barcodes = reads.where("CB <> '-' and substring(CB, 1, 1) <> 'A'").select("sample", "CB").distinct()
    return reads, barcodes


def _kept(spark, sf_dir) -> DataFrame:
    reads, barcodes = _reads(spark, sf_dir)
    return consensus.in_cells(consensus.tagged(reads, "lentiCassette"), barcodes)


@query(f"WITH {KEPT} SELECT sample, read_id, CB, UB FROM kept")
def cb_semi_join(spark, sf_dir):
    reads, barcodes = _reads(spark, sf_dir)
    return consensus.in_cells(consensus.tagged(reads, "lentiCassette"), barcodes).select("sample", "read_id", "CB", "UB")


@query(f"WITH {ALIGNED} SELECT sample, CB, ((row_number() OVER (PARTITION BY sample ORDER BY CB) - 1) // 3)::bigint AS chunk FROM cb")
def cb_chunks(spark, sf_dir):
    return consensus.chunks(_reads(spark, sf_dir)[1], 3)


@query(f"WITH {KEPT} SELECT sample, read_id, MI::bigint AS MI FROM mol")
def umi_groups(spark, sf_dir):
    return consensus.molecules(_kept(spark, sf_dir)).select("sample", "read_id", "MI")


@query(f"WITH {CONSENSUS} SELECT sample, CB, MI, seq, cD, round(error_rate, 6) AS error_rate FROM called WHERE cD >= 3 AND error_rate <= 0.2")
def umi_consensus(spark, sf_dir):
    called = consensus.consensus(_kept(spark, sf_dir), min_reads=3)
    return rounded(consensus.keep_consensus(called, min_reads=3))


@query(f"""WITH {CONSENSUS}, wrong AS (SELECT b.sample, b.CB, b.MI, b.place, avg(CASE WHEN b.base <> substring(c.seq, b.place + 1, 1) THEN 1 ELSE 0 END) AS dissent FROM bases b JOIN called c USING (sample, CB, MI) WHERE b.q >= 30 AND b.base <> 'N' GROUP BY ALL)
SELECT c.sample, c.CB, c.MI, string_agg(CASE WHEN coalesce(w.dissent, 1) <= 0.2 THEN substring(c.seq, i + 1, 1) ELSE 'N' END, '' ORDER BY i) AS seq FROM called c CROSS JOIN range(53) t(i) LEFT JOIN wrong w ON w.sample = c.sample AND w.CB = c.CB AND w.MI = c.MI AND w.place = i GROUP BY ALL""")
def consensus_masked(spark, sf_dir):
    return consensus.masked_consensus(_kept(spark, sf_dir), min_reads=3).select("sample", "CB", "MI", "seq")


@query(f"""WITH {CONSENSUS} SELECT sample, 'read_' || (row_number() OVER (PARTITION BY sample, CB ORDER BY MI) - 1) AS "read_ID", CB AS "CBC", MI::varchar AS "UMI", substring(seq, 34, 18) AS "GBC", cD::varchar AS n_consensus_read FROM called WHERE cD >= 3 AND error_rate <= 0.2""")
def elements(spark, sf_dir):
    called = consensus.keep_consensus(consensus.consensus(_kept(spark, sf_dir), min_reads=3), min_reads=3)
    return consensus.elements(called)


def _posterior_sql(pre: float = 45, post: float = 40) -> str:
    two = lambda p, q: f"({p} * (1 - {q}) + (1 - {p}) * {q} + 2e0 / 3 * {p} * {q})"
    e, pre = two(f"pow(10e0, {-post / 10})", "pow(10e0, -q / 10e0)"), f"pow(10e0, {-pre / 10})"
    return f"""{KEPT}, bases AS (SELECT sample, CB, MI, i AS place, substring(seq, i + 1, 1) AS base, ascii(substring(qual, i + 1, 1)) - 33 AS q FROM mol CROSS JOIN range(53) t(i)),
points AS (SELECT *, round((ln(1 - {e}) - ln({e} / 3)) / 1e-6)::bigint AS w FROM bases WHERE q >= 30 AND base <> 'N'),
sums AS (SELECT m.sample, m.CB, m.MI, i AS place, letter, coalesce(sum(w), 0) AS w, count(w) AS votes FROM (SELECT sample, CB, MI FROM mol GROUP BY ALL HAVING count(*) >= 3) m CROSS JOIN range(53) t(i) CROSS JOIN (SELECT unnest(['A', 'C', 'G', 'T']) AS letter) l
         LEFT JOIN points p ON p.sample = m.sample AND p.CB = m.CB AND p.MI = m.MI AND p.place = i AND p.base = letter GROUP BY ALL),
tops AS (SELECT sample, CB, MI, place, max(w) AS top, sum(votes) AS depth, min(letter) FILTER (w = high) AS letter, count(*) FILTER (w = high) AS n_top, max(votes) FILTER (w = high) AS agree, sum(exp((w - high) * 1e-6)) - 1 AS rest
         FROM (SELECT *, max(w) OVER (PARTITION BY sample, CB, MI, place) AS high FROM sums) x GROUP BY ALL),
calls AS (SELECT *, depth > 0 AND n_top = 1 AS known, rest / (1 + rest) AS wrong FROM tops),
quals AS (SELECT sample, CB, MI, place, depth, CASE WHEN known THEN letter ELSE 'N' END AS letter, CASE WHEN known THEN agree ELSE 0 END AS agree, CASE WHEN known THEN greatest(2, least(93, floor(-10 * log10({two(pre, 'wrong')}) + 0.001)::int)) ELSE 2 END AS quality FROM calls),
posterior AS (SELECT sample, CB, MI::bigint AS MI, string_agg(letter, '' ORDER BY place) AS seq, string_agg(chr(quality + 33), '' ORDER BY place) AS qual, max(depth)::bigint AS cD, min(depth)::bigint AS cM, CASE WHEN sum(depth) > 0 THEN 1 - sum(agree) / sum(depth) ELSE 1 END AS error_rate,
                     string_agg((depth - agree)::bigint, ',' ORDER BY place) AS errors FROM quals GROUP BY ALL)"""


@query(f"WITH {_posterior_sql()} SELECT sample, CB, MI, seq, qual, cD, cM, round(error_rate, 6) AS error_rate, errors FROM posterior")
def consensus_posterior(spark, sf_dir):
    called = consensus.posterior_consensus(_kept(spark, sf_dir), min_reads=3)
    return rounded(called.drop("depth").withColumn("errors", F.array_join(F.transform("errors", lambda x: x.cast("string")), ",")))


@query(f"""WITH {_posterior_sql()}, judged AS (SELECT *, depth >= 3 AND quality >= 45 AND depth - agree <= 0.2 * depth AS good FROM quals),
masked AS (SELECT sample, CB, MI::bigint AS MI, string_agg(CASE WHEN good THEN letter ELSE 'N' END, '' ORDER BY place) AS seq, string_agg(CASE WHEN good THEN chr(quality + 33) ELSE '#' END, '' ORDER BY place) AS qual, count(*) FILTER (NOT good OR letter = 'N') AS unknown FROM judged GROUP BY ALL)
SELECT m.sample, m.CB, m.MI, m.seq, m.qual, p.cD FROM masked m JOIN posterior p USING (sample, CB, MI) WHERE p.cD >= 3 AND p.error_rate <= 0.05 AND unknown <= 0.2 * 53""")
def consensus_filtered(spark, sf_dir):
    called = consensus.posterior_consensus(_kept(spark, sf_dir), min_reads=3)
    return consensus.filter_posterior(called, min_reads=3, min_base_quality=45, max_read_error_rate=0.05).select("sample", "CB", "MI", "seq", "qual", "cD")


@query(f"WITH {ALIGNED} SELECT sample, count(*) FILTER (flag & 4 = 0)::bigint AS mapped_reads, count(*) FILTER (flag & 4 <> 0)::bigint AS unmapped_reads FROM aligned GROUP BY 1")
def read_counters(spark, sf_dir):
    return sequences.alignment_counts(fx.aligned_reads(spark, sf_dir))


TENX = f"""r1 AS (SELECT event_id AS read_id, concat(CASE WHEN event_id % 5 = 0 THEN concat('N', substring(CBC, 2, 15)) ELSE CBC END, UMI, 'TTTT') AS seq FROM ({fx.SC_ELEMENTS}) a), list AS (SELECT DISTINCT CBC AS CB FROM ({fx.SC_ELEMENTS}) b WHERE substring(CBC, 1, 1) <> 'T')"""


@query(f"""WITH {TENX}, cut AS (SELECT read_id, substring(seq, 1, 16) AS CR, substring(seq, 17, 12) AS UB FROM r1), d AS (SELECT DISTINCT CR FROM cut),
near AS (SELECT d.CR, list.CB, hamming(d.CR, list.CB) AS h FROM d JOIN list ON hamming(d.CR, list.CB) <= 1), best AS (SELECT CR, min(CB) AS CB FROM near n WHERE h = 0 OR NOT EXISTS (SELECT 1 FROM near z WHERE z.CR = n.CR AND z.h = 0) GROUP BY CR HAVING count(*) = 1)
SELECT read_id, CB, UB FROM cut JOIN best USING (CR)""")
def cell_tags(spark, sf_dir):
    el = fx.sc_elements(spark, sf_dir)
    r1 = el.select(F.col("event_id").alias("read_id"), F.concat(F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("N"), F.substring("CBC", 2, 15))).otherwise(F.col("CBC")), "UMI", F.lit("TTTT")).alias("seq"))
    return consensus.cell_tags(r1, el.where("substring(CBC, 1, 1) <> 'T'").select(F.col("CBC").alias("CB")))


# -- dataflow and documents


@query("""WITH t AS (SELECT n_name AS sample, CASE WHEN n_nationkey % 3 = 0 THEN NULL WHEN n_nationkey % 3 = 1 THEN 0 ELSE n_nationkey END::bigint AS total_reads, n_regionkey::bigint AS mapped_reads FROM nation)
SELECT sample, coalesce(nullif(total_reads, 0), mapped_reads) AS reads FROM t""")
def sample_metrics_fallback(spark, sf_dir):
    t = spark.read.parquet(f"{sf_dir}/nation.parquet")
    k = F.col("n_nationkey")
    total = F.when(k % 3 == 0, F.lit(None)).when(k % 3 == 1, 0).otherwise(k).cast("long")
    return t.select(F.col("n_name").alias("sample"), channels.or_else(total, F.col("n_regionkey").cast("long")).alias("reads"))


@query("""WITH t AS (SELECT n_name AS sample, CASE WHEN n_nationkey % 5 = 4 THEN n_nationkey END AS a, CASE WHEN n_regionkey = 2 THEN n_name END AS b FROM nation)
SELECT (SELECT arg_min(a, sample) FROM t WHERE a IS NOT NULL)::bigint AS a, (SELECT arg_min(b, sample) FROM t WHERE b IS NOT NULL) AS b""")
def first_known_value(spark, sf_dir):
    t = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_name").alias("sample"), F.when(F.col("n_nationkey") % 5 == 4, F.col("n_nationkey").cast("long")).alias("a"), F.when(F.col("n_regionkey") == 2, F.col("n_name")).alias("b"))
    return channels.first_known(t, ["a", "b"])


@query("""WITH sheet AS (SELECT n_name AS sample, concat('/data/', n_name, '/x.bam') AS folder, CASE WHEN n_nationkey % 2 = 0 THEN 'TENX' ELSE 'GBC' END AS library, n_regionkey FROM nation)
SELECT s.sample, r.r_name AS region, s.library, split_part(regexp_extract(s.folder, '([^/]+)$', 1), '.', 1) AS name FROM sheet s JOIN region r ON s.n_regionkey = r.r_regionkey WHERE s.library = 'TENX'""")
def channel_join(spark, sf_dir):
    nation, region = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("nation", "region"))
    sheet = nation.select(F.col("n_name").alias("sample"), F.concat(F.lit("/data/"), "n_name", F.lit("/x.bam")).alias("fastq_folder"), F.when(F.col("n_nationkey") % 2 == 0, "TENX").otherwise("GBC").alias("library"))
    tenx, _ = channels.split_libraries(sheet)
    named = channels.join(tenx, nation.select(F.col("n_name").alias("sample"), F.col("n_regionkey").alias("r_regionkey")))
    whole = channels.combine(named, region, "r_regionkey")
    return whole.select("sample", F.col("r_name").alias("region"), F.lit("TENX").alias("library"), channels.cell_name(F.col("fastq_folder")).alias("name"))


@query("SELECT sample, unnest(parts) AS part FROM (SELECT n_name AS sample, list_transform(range(n_regionkey), lambda i: concat(n_name, '_', i)) AS parts FROM nation) t")
def channel_flatten(spark, sf_dir):
    t = spark.read.parquet(f"{sf_dir}/nation.parquet")
    parts = F.when(F.col("n_regionkey") > 0, F.transform(F.sequence(F.lit(0), F.col("n_regionkey") - 1), lambda i: F.concat("n_name", F.lit("_"), i.cast("string"))))
    return channels.flatten(t.select(F.col("n_name").alias("sample"), parts.alias("part")), "part")


@query("""WITH t AS (SELECT r_name AS folder, r_regionkey AS k FROM region) SELECT folder, CASE WHEN k % 2 = 0 THEN concat('id', k) ELSE folder END AS sample, CASE WHEN k % 3 = 0 THEN NULL ELSE round(k * 1.5, 6) END AS moi FROM t""")
def sample_resolution(spark, sf_dir):
    t = spark.read.parquet(f"{sf_dir}/region.parquet")
    k = F.col("r_regionkey")
    empty = F.expr("cast(map() as map<string,double>)")
    ident = F.when(k % 2 == 0, F.concat(F.lit("id"), k.cast("string")))
    samples = F.array(F.struct(F.lit(None).cast("string").alias("id"), empty.alias("metrics")), F.struct(ident.alias("id"), F.when(k % 3 != 0, F.create_map(F.lit("moi"), (k * 1.5).cast("double"))).otherwise(empty).alias("metrics")))
    named = t.select(F.col("r_name").alias("folder"), samples.alias("s")).select("folder", "s", channels.sample_id(F.col("s"), F.col("folder")).alias("sample"))
    return rounded(named.select("folder", "sample", channels.sample_metrics(F.col("s"), F.col("sample"))["moi"].alias("moi")))



@query("""SELECT n_name AS sample, (k + 3)::bigint AS "unique_good_GBCs", (7 * k)::bigint AS unsupported_combos, (k * k)::bigint AS supported_combos, 1.25 + k AS observed_moi_median, CASE WHEN k % 4 = 0 THEN NULL ELSE 0.5 END AS observed_moi_std_or_null,
(100 + k)::bigint AS "starting_CBCs", (50 + k)::bigint AS uniquely_barcoded_cells, k::bigint AS n_clones, (k // 2)::bigint AS n_clones_10plus FROM (SELECT n_name, n_nationkey AS k FROM nation) t""".replace("1.25 + k AS observed_moi_median, CASE WHEN k % 4 = 0 THEN NULL ELSE 0.5 END AS observed_moi_std_or_null", "CASE WHEN k % 4 <> 0 THEN (1.25 + k)::double END AS observed_moi_median, CASE WHEN k % 4 <> 0 THEN 0.5::double END AS observed_moi_std"))
def clone_summary_parse(spark, sf_dir):
    k = F.col("n_nationkey")
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    std = F.when(k % 4 == 0, "nan").otherwise("0.50")
    lines = F.array(
        text("# Custom lines"), text('- Unique, "good" GBCs: ', k + 3), text("- n unsupported CBC-GBC combos (N.B.): ", 7 * k), text("- n supported CBC-GBC combos (N.B.): ", k * k), text("- Observed MOI (from supported): ", F.lit(1.25) + k, " median, (+-", std, ")"),
        text("- n starting CBC (all): ", 100 + k), text("- n uniquely barcoded cells: ", 50 + k), text("- n clones: ", k), text("- n clones>=10 cells: ", F.floor(k / 2)),
    )
    t = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_name").alias("sample"), F.explode(lines).alias("value"))
    return rounded(tables.clone_summary(t))


from strandlake import registry_cells, registry_files  # noqa: E402, F401  (register their queries)
