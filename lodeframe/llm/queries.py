"""The operators' queries over the whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, exact_dedup, line_dedup, minhash, mixing, quality, repeats, simhash, spelling, url_filter, warc, word_lm


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_lm.score_texts(_table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(_table(spark, sf_dir, "documents"))


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removal_report(_table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(_table(spark, sf_dir, "pages"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 (of the text that is left)."""
    left = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), count_cols=("n_lines", "n_removed"))
    return left.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"), keep="largest")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(_table(spark, sf_dir, "documents"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_dedup(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_lm_scoring, op2_simhash, op3_suffix_array, op4_decontamination, op5_mixing, op6_url_filters, op7_warc, op8_line_dedup,
                                   op9_exact_dedup, op10_quality, op11_spelling, op12_minhash)}

ORACLES = {
    "op5_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) AS draw
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS total, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rk
  FROM sized GROUP BY source),
weighed AS (SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w,
                   total * 2.0::DOUBLE AS cap FROM per),
levels AS (
  SELECT *, (sum(total) OVER () * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
water AS (SELECT *, (SELECT arg_min(l.level, row(l.cap / l.w, l.rk)) FROM levels l WHERE l.level * l.w <= l.cap) AS water
          FROM levels),
targets AS (SELECT source, total, CASE WHEN level * w > cap OR water IS NULL THEN cap ELSE least(water * w, cap) END AS target
            FROM water),
cuts AS (SELECT *, CASE WHEN total > 0 THEN CAST(floor(target / total) AS BIGINT) ELSE 0 END AS whole FROM targets),
needs AS (SELECT *, target - whole * total AS need FROM cuts),
runs AS (
  SELECT s.*, n.total, n.target, n.whole, n.need,
         sum(size) OVER (PARTITION BY s.source ORDER BY draw ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM sized s JOIN needs n ON s.source IS NOT DISTINCT FROM n.source),
firsts AS (SELECT *, min(CASE WHEN upto - size / 2.0::DOUBLE > need THEN draw END) OVER (PARTITION BY source) AS cut FROM runs)
SELECT doc_id, size, total AS source_size, target,
       CAST((whole + CASE WHEN need > 0 AND (cut IS NULL OR draw < cut) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM firsts""",
    "op6_url_filters": r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
urls AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
rules(verdict, rule_host, rule_path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, verdict
  FROM urls LEFT JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1""",
    "op7_warc": r"""
WITH payloads AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d, coalesce(html, '') AS h FROM pages),
kept AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS keep FROM payloads)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> keep THEN keep END AS refers_to
FROM kept""",
    "op9_exact_dedup": r"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
}
