"""Queries of barcode matching, UMI collapse and cell calling."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake import fixtures as fx
from strandlake.operators import cells, consensus, remap
from strandlake.registry import _kept, query, rounded, untold

FIRST = f"first AS ({fx.FIRST_READS}), list AS ({fx.WHITELIST})"


@query(f"""WITH {FIRST}, cut AS (SELECT sample, read_id, substring(seq, 1, 16) AS CR, substring(qual, 1, 16) AS CQ, substring(seq, 17, 12) AS UB FROM first),
seen AS (SELECT sample, CR, count(*) AS n FROM cut GROUP BY ALL), exact AS (SELECT sample, CR AS CB, n FROM seen WHERE CR IN (SELECT CB FROM list)),
near AS (SELECT s.sample, s.CR, l.CB, coalesce(e.n, 0) AS n, list_filter(range(1, 17), lambda i: substring(s.CR, i, 1) <> substring(l.CB, i, 1))[1] AS place
         FROM seen s JOIN list l ON hamming(s.CR, l.CB) = 1 LEFT JOIN exact e ON e.sample = s.sample AND e.CB = l.CB WHERE NOT EXISTS (SELECT 1 FROM exact x WHERE x.sample = s.sample AND x.CB = s.CR)),
weighed AS (SELECT c.sample, c.read_id, c.UB, n.CB, (n.n + 1) * pow(10e0, -(ascii(substring(c.CQ, n.place, 1)) - 33) / 10e0) AS w FROM cut c JOIN near n ON c.sample = n.sample AND c.CR = n.CR),
best AS (SELECT sample, read_id, UB, arg_max(CB, w) AS CB, max(w) / sum(w) AS posterior FROM weighed GROUP BY ALL)
SELECT sample, read_id, CB, UB, round(posterior, 6) AS posterior FROM best WHERE posterior >= 0.975
UNION ALL SELECT c.sample, c.read_id, c.CR, c.UB, 1.0::double FROM cut c JOIN exact e ON e.sample = c.sample AND e.CB = c.CR""")
def barcode_posterior(spark, sf_dir):
    return rounded(cells.match_barcodes(fx.first_reads(spark, sf_dir), fx.whitelist(spark, sf_dir), by=("sample",)))


COLLAPSED = f"""tagged AS ({fx.GENE_UMIS}), counts AS (SELECT sample, CB, gene, UB, count(*) AS n FROM tagged WHERE regexp_matches(UB, '^[ACGT]{{12}}$') AND NOT regexp_matches(UB, '^(A+|C+|G+|T+)$') GROUP BY ALL),
moved AS (SELECT a.sample, a.CB, a.gene, a.UB AS own, a.n, arg_max(b.UB, row(b.n, translate(b.UB, 'ACGT', 'TGCA'))) AS UB FROM counts a JOIN counts b ON a.sample = b.sample AND a.CB = b.CB AND a.gene = b.gene AND hamming(a.UB, b.UB) <= 1 GROUP BY ALL),
molecules AS (SELECT sample, CB, gene, UB, sum(n)::bigint AS reads FROM moved GROUP BY ALL)"""


@query(f"WITH {COLLAPSED} SELECT * FROM molecules")
def umi_collapse(spark, sf_dir):
    return cells.collapse_umis(fx.gene_umis(spark, sf_dir))


@query(f"WITH {COLLAPSED}, most AS (SELECT * FROM molecules QUALIFY reads = max(reads) OVER (PARTITION BY sample, CB, UB)) SELECT * FROM most QUALIFY count(*) OVER (PARTITION BY sample, CB, UB) = 1")
def umi_one_gene(spark, sf_dir):
    return cells.collapse_umis(fx.gene_umis(spark, sf_dir), multi_gene=True)


@query(f"WITH {COLLAPSED} SELECT sample, CB, gene, count(*)::bigint AS n FROM molecules GROUP BY ALL")
def gene_matrix(spark, sf_dir):
    return cells.gene_counts(cells.collapse_umis(fx.gene_umis(spark, sf_dir)))


DROPLETS = cells.CellParams(expected_cells=600, ambient_from=100, ambient_to=390, umi_min=20, simulations=2000)


@query(f"""WITH droplets AS ({fx.DROPLET_GENES}), totals AS (SELECT sample, CB, sum(n)::bigint AS total FROM droplets GROUP BY ALL),
top AS (SELECT * FROM totals QUALIFY row_number() OVER (PARTITION BY sample ORDER BY total DESC, CB) <= 7) SELECT sample, greatest(1, floor(min(total) / 10e0 + 0.5))::bigint AS threshold FROM top GROUP BY 1""")
def cell_size_limit(spark, sf_dir):
    return cells.knee(cells.droplet_totals(fx.droplet_genes(spark, sf_dir)), DROPLETS)


@query(f"""WITH droplets AS ({fx.DROPLET_GENES}), totals AS (SELECT sample, CB, sum(n) AS total FROM droplets GROUP BY ALL), ranked AS (SELECT sample, CB, row_number() OVER (PARTITION BY sample ORDER BY total DESC, CB) AS place FROM totals)
SELECT sample, gene, sum(CASE WHEN place > 100 AND place <= 390 THEN n ELSE 0 END)::bigint AS n FROM droplets JOIN ranked USING (sample, CB) GROUP BY ALL""")
def ambient_profile(spark, sf_dir):
    counts = fx.droplet_genes(spark, sf_dir)
    return cells.ambient_counts(counts, cells.droplet_totals(counts), DROPLETS)


@untold
def cell_calls(spark, sf_dir):
    """Simulated p-values: SQL can't express them, the tests hold them against planted cells."""
    return rounded(cells.call_cells(fx.droplet_genes(spark, sf_dir), DROPLETS))


#: A cassette with room for any barcode.
CASSETTE = [("lentiCassette", "TAGCAAACTGGGGCACAAGCTTAATTAAGAATT" + "N" * 18 + "GG")]


@untold
def consensus_remapped(spark, sf_dir):
    """Consensus reads, some with a base lost or put in before the barcode, and the barcode by its place on the cassette."""
    called = consensus.posterior_consensus(_kept(spark, sf_dir), min_reads=3).select("sample", "CB", "MI", "seq", "cD")
    changed = F.when(F.col("MI") % 3 == 1, F.concat(F.substring("seq", 1, 20), F.substring("seq", 22, 60))).when(F.col("MI") % 3 == 2, F.concat(F.substring("seq", 1, 12), F.lit("G"), F.substring("seq", 13, 60))).otherwise(F.col("seq"))
    return remap.remap(called.withColumn("seq", changed), CASSETTE, region=("lentiCassette", 34, 18))
