"""The queries of the training-data operators by name, and the SQL of those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import centroids, chat, decontaminate, fingerprint, html_extract, jaccard_join, line_dedup, packing, pii, sharding, toxicity, url_filter, whitening
from .common import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _importable(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _importable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver has it. On a cluster it is installed, and this does nothing."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (known, root) if p)


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.page_texts(read(spark, sf_dir, "pages"))


@query
def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(read(spark, sf_dir, "documents"))


@query
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted_digest(chat.with_control_strings(read(spark, sf_dir, "conversations")))


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.document_shards(read(spark, sf_dir, "documents"))


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digest(read(spark, sf_dir, "documents"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(read(spark, sf_dir, "documents"))


@query
def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read(spark, sf_dir, "documents"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digest(read(spark, sf_dir, "documents"))


@query
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.page_verdicts(read(spark, sf_dir, "pages"))


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(read(spark, sf_dir, "embeddings"))


@query
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(read(spark, sf_dir, "embeddings"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def _lloyd_sql(k: int = 8, rounds: int = 10, seed: int = 3, scale: int = 1024, dimension: int = 64) -> str:
    """Lloyd's algorithm without bounds, one pair of steps for every round."""

    def nearest(turn: int) -> str:
        return f"""a{turn} AS MATERIALIZED (
  SELECT row, vec_id, x, arg_min(struct_pack(c := c, d := d), struct_pack(d := d, c := c)) AS best
  FROM (SELECT v.row, v.vec_id, v.x, m.c, list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(v.x, m.x)])::BIGINT AS d
    FROM v CROSS JOIN c{turn} m) GROUP BY row, vec_id, x)"""

    def means(turn: int) -> str:
        return f"""c{turn + 1} AS MATERIALIZED (
  SELECT o.c, coalesce(n.x, o.x) AS x FROM c{turn} o LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY place) AS x FROM (
      SELECT best.c AS c, place, sum(component)::BIGINT AS s, count(*) AS n
      FROM (SELECT best, unnest(x) AS component, generate_subscripts(x, 1) AS place FROM a{turn}) GROUP BY 1, 2) GROUP BY c) n ON n.c = o.c)"""

    steps = [f"{nearest(t)},\n{means(t)}" for t in range(rounds)] + [nearest(rounds)]
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, [floor({scale} * c::DOUBLE)::BIGINT FOR c IN embedding] AS x FROM embeddings
  WHERE len(embedding) = {dimension} AND len([c FOR c IN embedding IF c IS NOT NULL AND isfinite(c)]) = {dimension}),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h, x) - 1)::INTEGER AS c, x FROM (
    SELECT x, sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')) AS h FROM v ORDER BY h, x LIMIT {k})),
{", ".join(steps)}
SELECT a.vec_id, a.best.c AS cluster, a.best.d AS distance, sum(a.best.d) OVER (PARTITION BY a.best.c)::BIGINT AS cluster_inertia,
  sum(a.best.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(m.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} m ON m.c = a.best.c
"""


SQL = {
    "op11_url_filters": r"""
WITH parsed AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
addressed AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parsed),
rules (r_host, r_path, r_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fitting AS (
  SELECT a.host, a.path, arg_max(r_host || r_path, length(r_host || r_path)) AS rule, arg_max(r_verdict, length(r_host || r_path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM addressed) a JOIN rules
    ON (a.host = r_host OR ends_with(a.host, '.' || r_host)) AND starts_with(a.path, r_path) GROUP BY a.host, a.path)
SELECT page_id, a.host, a.path, rule, coalesce(verdict, 'allow') AS verdict
FROM addressed a LEFT JOIN fitting f ON f.host = a.host AND f.path = a.path
""",
    "op13_centroid_clustering": _lloyd_sql(),
    "op7_ngram_jaccard_join": r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingled AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM worded),
exploded AS (SELECT doc_id, unnest(s) AS g FROM shingled),
sizes AS (SELECT doc_id, len(s) AS n FROM shingled),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM exploded a JOIN exploded b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 75 * ((SELECT n FROM sizes WHERE doc_id = a.doc_id) + (SELECT n FROM sizes WHERE doc_id = b.doc_id) - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM sizes s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.n
""",
}
