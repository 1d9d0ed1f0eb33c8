"""The registered queries opN_<name> and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from saleslake.llm import (decontaminate, drift_clusters, exact_dedup, filter_audit, html_blocks, jaccard_join, licenses, lm, packing, pii,
                           simhash, toxicity, url_filter)
from saleslake.llm.queries_sql import OP11_SQL, OP12_SQL, OP13_SQL

TOKENIZER = "byte_bpe_50k.json"
#: Key of the registered query; a production run passes its own secret.
PII_KEY = b"key of the registered query"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES, default="allow")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), 1024)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_entities(_table(spark, sf_dir, "documents"), PII_KEY)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(_table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(_table(spark, sf_dir, "documents"))


def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift_clusters.centroid_clusters(_table(spark, sf_dir, "embeddings"), k=40, rounds=5, seed=2, dim=64)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"), shingle=5, similarity=(80, 100))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_exact_dedup, op2_licenses, op3_simhash, op4_url_filter, op5_decontaminate, op6_packing, op7_pii, op8_html_text,
        op9_toxicity, op10_lm_score, op11_clusters, op12_filter_audit, op13_jaccard)}

OP1_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM t
"""



def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _canonical_lines_sql(text: str) -> str:
    upper, lower = licenses.string.ascii_uppercase, licenses.string.ascii_lowercase
    out = f"translate({text}, {_sql_text(upper + licenses.PLAIN[0])}, {_sql_text(lower + licenses.PLAIN[1])})"
    out = f"regexp_replace({out}, {_sql_text(licenses.COPYRIGHT)}, '', 'g')"
    for old, new in licenses.SPELLINGS:
        out = f"replace({out}, {_sql_text(old)}, {_sql_text(new)})"
    return f"regexp_replace({out}, {_sql_text(licenses.MARKS)}, ' ', 'g')"


def _op2_sql() -> str:
    known = ", ".join(f"({_sql_text(i)}, {_sql_text(t)})" for i, t in licenses.known_texts())
    return rf"""
WITH known AS (
  SELECT canonical, min(license_id) AS license_id FROM (
    SELECT license_id, trim(regexp_replace({_canonical_lines_sql('t')}, '[ \n]+', ' ', 'g'), ' ') AS canonical
    FROM (VALUES {known}) v(license_id, t)) WHERE canonical <> '' GROUP BY canonical),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_canonical_lines_sql("coalesce(text, '')")} AS lines FROM documents),
whole AS (SELECT r, doc_id, lines, trim(regexp_replace(lines, '[ \n]+', ' ', 'g'), ' ') AS canonical FROM docs),
parts AS (SELECT r, trim(regexp_replace(unnest(string_split(lines, chr(10))), ' +', ' ', 'g'), ' ') AS line FROM docs),
hits AS (SELECT r, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS ids
         FROM parts JOIN known ON line = canonical GROUP BY r)
SELECT doc_id, sha256(w.canonical) AS canonical_sha256, k.license_id, coalesce(h.ids, '') AS line_licenses
FROM whole w LEFT JOIN known k ON w.canonical = k.canonical LEFT JOIN hits h ON w.r = h.r
"""


OP4_SQL = r"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
             FROM pages),
parts AS (SELECT page_id, regexp_extract(rest, '^([^/?#]*)', 1) AS raw, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
          FROM cut),
hosts AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts),
rules(rule, rule_host, rule_path, verdict) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
fits AS (SELECT h.*, r.rule, r.verdict, row_number() OVER (PARTITION BY page_id, host, path
                                                           ORDER BY length(rule) DESC, length(rule_host) DESC) AS nth
         FROM (SELECT DISTINCT * FROM hosts) h JOIN rules r
           ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT h.page_id, h.host, h.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM hosts h LEFT JOIN fits f ON h.page_id IS NOT DISTINCT FROM f.page_id AND h.host = f.host AND h.path = f.path AND f.nth = 1
"""

ORACLE_SQL: dict[str, str] = {"op1_exact_dedup": OP1_SQL, "op2_licenses": _op2_sql(), "op4_url_filter": OP4_SQL,
                              "op11_clusters": OP11_SQL, "op12_filter_audit": OP12_SQL, "op13_jaccard": OP13_SQL}
