"""The registered queries of this subpackage: name -> (session, folder) -> table.

Each applies its operator to whole tables with production parameters.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession


def vocabulary(name: str) -> str:
    """A public tokenizer's file; its folder is installed beside the Python libraries."""
    return import_module("public_tokenizers").path(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandlake.llm.packing import op1_packing as op

    return op(_read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandlake.llm.token_files import op2_token_ids as op

    return op(_read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandlake.llm.line_dedup import op3_line_dedup as op

    return op(_read(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandlake.llm.quality import op4_quality as op

    return op(_read(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandlake.llm.simhash import op5_simhash as op

    return op(_read(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandlake.llm.decontaminate import op6_decontaminate as op

    return op(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandlake.llm.toxicity import op7_toxicity as op

    return op(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandlake.llm.secrets import op8_secrets as op

    return op(_read(spark, sf_dir, "documents"))


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandlake.llm.passages import op9_passages as op

    return op(_read(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandlake.llm.language import op10_language as op

    return op(_read(spark, sf_dir, "documents"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandlake.llm.search import op11_search as op

    return op(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandlake.llm.divergence import op12_divergence as op

    return op(_read(spark, sf_dir, "documents"))


def op13_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandlake.llm.suffixes import op13_suffixes as op

    return op(_read(spark, sf_dir, "documents"))


def secret_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The patterns of op8 alone, which SQL can express."""
    from strandlake.llm.secrets import base_values

    return base_values(_read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": op1_packing,
        "op2_token_ids": op2_token_ids,
        "op3_line_dedup": op3_line_dedup,
        "op4_quality": op4_quality,
        "op5_simhash": op5_simhash,
        "op6_decontaminate": op6_decontaminate,
        "op7_toxicity": op7_toxicity,
        "op8_secrets": op8_secrets,
        "op9_passages": op9_passages,
        "op10_language": op10_language,
        "op11_search": op11_search,
        "op12_divergence": op12_divergence,
        "op13_suffixes": op13_suffixes,
        "secret_patterns": secret_patterns,
    }


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINES_SQL = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
keyed AS (SELECT doc_id, i, line, translate(trim(line, {BLANKS}), '{UPPER}', '{LOWER}') AS key FROM (SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS line FROM split) l),
shared AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
judged AS (SELECT k.doc_id, k.i, k.line, s.first IS NOT NULL AND s.first <> k.doc_id AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*)::bigint AS n_lines, count(*) FILTER (gone)::bigint AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM judged GROUP BY doc_id
"""

QUALITY_SQL = f"""
WITH split AS (SELECT doc_id, source, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws,
                      list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, {BLANKS}) <> '') AS ls FROM documents),
words AS (SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS w FROM split),
grams AS (SELECT doc_id, i, w AS a, lead(w, 1) OVER o AS b, lead(w, 2) OVER o AS c FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i FROM grams WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + k)::bigint AS n FROM twice CROSS JOIN (SELECT unnest([0, 1, 2]) AS k) t GROUP BY doc_id),
lined AS (SELECT doc_id, source, text, unnest(xs) AS x FROM (SELECT doc_id, source, text, list_transform(ls, lambda y: trim(lower(y), {BLANKS})) AS xs FROM split) s),
seen AS (SELECT source, x, count(DISTINCT text) AS n FROM lined GROUP BY ALL),
hosts AS (SELECT source, count(DISTINCT text) AS docs FROM split GROUP BY source),
bad AS (SELECT s.source, s.x FROM seen s JOIN hosts h ON s.source IS NOT DISTINCT FROM h.source WHERE n >= 5 AND 100 * n > 10 * docs),
lost AS (SELECT l.doc_id, sum(length(l.x)) AS n, sum(len(list_filter(regexp_split_to_array(l.x, '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))) AS words FROM lined l JOIN bad b ON l.source IS NOT DISTINCT FROM b.source AND l.x = b.x GROUP BY l.doc_id),
whole AS (SELECT doc_id, sum(length(x)) AS n FROM lined GROUP BY doc_id),
told AS (SELECT s.doc_id, len(s.ws)::bigint AS n_words, length(array_to_string(s.ws, ''))::bigint AS word_chars, (length(s.text) - length(regexp_replace(s.text, '[#*$%&|<>]', '', 'g')))::bigint AS n_symbols,
                (len(s.ls) - len(list_distinct(s.ls)))::bigint AS n_dup_lines, coalesce(r.n, 0)::bigint AS n_repeat_words, coalesce(l.n, 0) AS lost, len(s.ws) - coalesce(l.words, 0) AS left_words, coalesce(t.n, 0) - coalesce(l.n, 0) AS stays, coalesce(t.n, 0) AS total
         FROM split s LEFT JOIN repeated r USING (doc_id) LEFT JOIN lost l USING (doc_id) LEFT JOIN whole t USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (lost > 0 AND (left_words < 50 OR 100 * stays < 80 * total)) AS kept FROM told
"""

SECRETS_SQL = """
WITH found AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
kinds AS (SELECT doc_id, list_filter(regexp_extract_all(t, '(?i:password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1), lambda x: length(x) >= 8) AS a,
                 list_filter(regexp_extract_all(t, 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 16) AS k, list_filter(regexp_extract_all(t, '[0-9a-f]+'), lambda x: length(x) >= 32) AS h FROM found)
SELECT doc_id, len(a)::bigint AS n_assign, array_to_string(a, ' ') AS assign_values, len(k)::bigint AS n_access, array_to_string(k, ' ') AS access_values, len(h)::bigint AS n_hex, array_to_string(h, ' ') AS hex_values FROM kinds
"""

BENCHMARK_SQL = f"""
WITH items AS (SELECT item_id::varchar AS item, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
windows AS (SELECT DISTINCT item, least(10, len(ws)) AS size, array_to_string(ws[i:i + 9], ' ') AS w FROM (SELECT item, ws, unnest(range(1, greatest(2, len(ws) - 8))) AS i FROM items WHERE len(ws) > 0) x),
docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
places AS (SELECT doc_id, size, i, array_to_string(ws[i:i + size - 1], ' ') AS w FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM docs CROSS JOIN (SELECT DISTINCT size FROM windows) s) x),
hits AS (SELECT p.doc_id, p.i, p.size, v.item FROM places p JOIN windows v ON p.size = v.size AND p.w = v.w),
marked AS (SELECT doc_id, count(DISTINCT i)::bigint AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS i FROM hits) x GROUP BY doc_id),
named AS (SELECT doc_id, count(*)::bigint AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) x GROUP BY doc_id)
SELECT d.doc_id, len(d.ws)::bigint AS n_words, coalesce(m.n, 0)::bigint AS n_hit, coalesce(a.n, 0)::bigint AS n_items, sha256(coalesce(a.ids, '')) AS items_sha256, coalesce(m.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN marked m USING (doc_id) LEFT JOIN named a USING (doc_id)
"""


SEARCH_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
sums AS (SELECT count(*) FILTER (len(ws) > 0) AS n_docs, sum(len(ws))::bigint AS n_terms FROM docs),
counts AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(ws) AS n, unnest(ws) AS term FROM docs) x GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM counts GROUP BY term),
items AS (SELECT i, item_id, term, count(*) AS c FROM (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark) x GROUP BY ALL),
weights AS (SELECT i, item_id, term, c * floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::bigint AS w FROM items JOIN dfs USING (term) CROSS JOIN sums),
scores AS (SELECT i, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))::bigint AS score FROM weights JOIN counts USING (term) CROSS JOIN sums GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::int AS rank, doc_id, score FROM scores WHERE score > 0 QUALIFY rank <= 20
"""

DIVERGENCE_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
words AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS c FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT g.lang, g.source, coalesce(sum(c.c), 0) AS n FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counts c ON g.lang = c.lang AND g.source = c.source GROUP BY ALL),
shares AS (SELECT s.lang, s.source, k.term, coalesce(c.c, 0) AS c, 1 + (1000000000 * (coalesce(c.c, 0) + 2)::hugeint) // (s.n + 2 * l.v) AS p, 1 + (1000000000 * (k.c + 2)::hugeint) // (l.n + 2 * l.v) AS q
           FROM sizes s JOIN kept k ON s.lang = k.lang JOIN langs l ON s.lang = l.lang LEFT JOIN counts c ON s.lang = c.lang AND s.source = c.source AND k.term = c.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::bigint AS value FROM sizes a JOIN sizes b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::bigint AS value FROM shares WHERE c > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::int AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) x QUALIFY part = 'pair' OR rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB's SQL for the queries that SQL can express on whole tables in reasonable time."""
    return {"op3_line_dedup": LINES_SQL, "op4_quality": QUALITY_SQL, "op6_decontaminate": BENCHMARK_SQL, "op11_search": SEARCH_SQL, "op12_divergence": DIVERGENCE_SQL, "secret_patterns": SECRETS_SQL}
