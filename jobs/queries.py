"""The jobs as queries: each runs its job twice over the whole tables into one new folder and returns the output as it then stands."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import ingest_documents, usage_report


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below spark.checkpoint.dir; a local one only where that is unset on a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and not (spark.sparkContext.master or "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{(named or 'file://' + tempfile.mkdtemp(prefix='lodeframe-')).rstrip('/')}/{name}-{uuid.uuid4().hex}"


STRATEGIES = {"*": {"size": 1600, "overlap": 200}, "src3": {"size": 400, "overlap": 50}, "src5": {"chunkSize": 6000, "overlap": 7000}}


def job1_ingest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "job1")
    for _ in range(2):
        ingest_documents.run(spark, f"{sf_dir}/documents.parquet", f"{folder}/base", f"{folder}/checkpoint", {"strategies": STRATEGIES})
    chunks = ingest_documents.chunks_now(spark, f"{folder}/base")
    titles = ingest_documents.documents_now(spark, f"{folder}/base").select("document_id", "title", "n_chunks")
    place = F.zip_with("buckets", "weights", lambda b, w: b * w)
    return chunks.join(titles, "document_id").select(
        "document_id", "kb", "title", "n_chunks", "chunk_index", "point_id", "token_count", F.sha2(F.col("content").cast("binary"), 256).alias("content_sha256"),
        F.size("buckets").alias("n_buckets"), F.round(F.aggregate(place, F.lit(0.0), lambda a, x: a + x), 4).alias("centre"))


def job2_usage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "job2")
    for _ in range(2):
        usage_report.run(spark, f"{sf_dir}/events.parquet", f"{sf_dir}/conversations.parquet", f"{folder}/report")
    return spark.read.schema(usage_report.DAILY).parquet(f"{folder}/report/daily")


QUERIES = {f.__name__: f for f in (job1_ingest_documents, job2_usage_report)}

ORACLES = {
    "job1_ingest_documents": r"""
WITH b AS (SELECT doc_id, coalesce(nullif(trim(source), ''), 'unassigned') AS kb, text, regexp_replace(text, '^\s+|\s+$', '', 'g') AS body,
                  CASE source WHEN 'src3' THEN 400 WHEN 'src5' THEN 6000 ELSE 1600 END AS size, CASE source WHEN 'src3' THEN 350 WHEN 'src5' THEN 4000 ELSE 1400 END AS step FROM documents),
s AS (SELECT *, unnest(CASE WHEN length(body) <= size THEN [0] ELSE range(0, CAST(ceil((length(body) - size) / (step * 1.0)) * step AS BIGINT) + 1, step) END) AS st FROM b WHERE body <> ''),
w AS (SELECT doc_id, kb, st, regexp_replace(body[st + 1:st + size], '^\s+|\s+$', '', 'g') AS content FROM s),
c AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY st) - 1 AS i, count(*) OVER (PARTITION BY doc_id) AS n FROM w WHERE content <> ''),
v AS (SELECT doc_id, i, unnest(list_filter(string_split_regex(lower(content), '\s+'), lambda x: x <> '')) AS w FROM c),
h AS (SELECT doc_id, i, sha256(w) AS h FROM v),
k AS (SELECT doc_id, i, CAST(CAST('0x' || h[1:8] AS BIGINT) % 384 AS INTEGER) AS bucket, sum(CASE WHEN h[10] IN ('1','3','5','7','9','b','d','f') THEN -1 ELSE 1 END) AS weight FROM h GROUP BY 1, 2, 3),
e AS (SELECT doc_id, i, count(*) AS n_buckets, sum(bucket * weight) / sqrt(sum(weight * weight)) AS centre FROM k WHERE weight <> 0 GROUP BY 1, 2),
p AS (SELECT doc_id, i, sha256('chunk-' || doc_id || '-' || i) AS p FROM c),
t AS (SELECT doc_id, list_filter(list_transform(string_split_regex(text, '\n'), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '')[1] AS title FROM b)
SELECT c.doc_id AS document_id, kb, trim(regexp_replace(title, '^# ', '')) AS title, n AS n_chunks, CAST(c.i AS INTEGER) AS chunk_index,
       p[1:8] || '-' || p[9:12] || '-' || p[13:16] || '-' || p[17:20] || '-' || p[21:32] AS point_id, CAST(greatest(1, length(content) // 4) AS INTEGER) AS token_count,
       sha256(content) AS content_sha256, CAST(coalesce(n_buckets, 0) AS INTEGER) AS n_buckets, round(coalesce(centre, 0), 4) AS centre
FROM c JOIN p ON p.doc_id = c.doc_id AND p.i = c.i JOIN t ON t.doc_id = c.doc_id LEFT JOIN e ON e.doc_id = c.doc_id AND e.i = c.i""",
    "job2_usage_report": """
WITH e AS (SELECT *, CAST(ts AS DATE) AS day, coalesce(CAST(json_extract(props, '$.k') AS BIGINT), 0) AS k, CASE event_type WHEN 'view' THEN 'started' WHEN 'error' THEN 'failed' ELSE 'completed' END AS kind FROM events),
u AS (SELECT day, event_type AS operation, count(*) AS requests, count(*) FILTER (event_type = 'error') AS failures, CAST(sum(k) AS BIGINT) AS tokens,
      CAST(round(round(sum(value), 4) / count(*)) AS BIGINT) AS mean, count(DISTINCT user_id) AS people FROM e GROUP BY 1, 2),
f AS (SELECT day, user_id, event_id % 7 AS call, arg_min(event_type, event_id) AS operation, arg_max(kind, event_id) AS last, min(event_id) AS a, arg_min(ts, event_id) AS start,
      max(event_id) FILTER (kind <> 'started') AS z, arg_max(ts, event_id) FILTER (kind <> 'started') AS stop FROM e GROUP BY 1, 2, 3),
c AS (SELECT day, operation, count(*) AS calls, count(*) FILTER (last = 'failed') AS bad, avg(CASE WHEN z > a THEN CAST(round((epoch_us(stop) - epoch_us(start)) / 1000.0) AS BIGINT) END) AS ms FROM f GROUP BY 1, 2),
s AS (SELECT o.operation, CAST(d AS DATE) AS day FROM (SELECT DISTINCT operation FROM u) o, generate_series((SELECT min(day) FROM u), (SELECT max(day) FROM u), INTERVAL 1 DAY) g(d))
SELECT s.operation, s.day, coalesce(requests, 0) AS requests, coalesce(failures, 0) AS failures, coalesce(tokens, 0) AS tokens, coalesce(mean, 0) AS avg_latency_ms, coalesce(people, 0) AS active_users,
       CASE WHEN sum(requests) OVER (PARTITION BY s.day) > 0 THEN round(coalesce(requests, 0)::DOUBLE * 1000 / sum(requests) OVER (PARTITION BY s.day)) / 10 ELSE 0.0 END AS share,
       coalesce(calls, 0) AS calls, coalesce(bad, 0) AS calls_failed, coalesce(CAST(round(ms) AS BIGINT), 0) AS avg_call_ms
FROM s LEFT JOIN u USING (day, operation) LEFT JOIN c USING (day, operation)""",
}
