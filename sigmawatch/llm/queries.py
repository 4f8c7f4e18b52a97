"""Registered queries of the operators (``opN_<name>``) and of the pipeline, with oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .apportion import mix
from .bit_slices import largest
from .bpe_fst import round_trip
from .chat_grammar import format_turns, read_back, with_trap
from .common import read_table
from .context_mixing import language_model
from .iblt import fingerprints
from .laesa import clusters
from .pii_anchors import find
from .simhash_golay import fingerprint_hex, near_duplicates
from .strassen import hard_negatives
from .toxicity_fm import held_out, toxicity
from .url_sweep import default_rules, judge
from .vamana import nearest


def op1_vamana_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"))


def op2_url_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "pages"), default_rules(spark))


def op3_iblt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read_table(spark, sf_dir, "documents"))


def op4_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", fingerprint_hex("fp").alias("fingerprint"), "component_id")


def op5_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity(docs, read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op6_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return find(docs).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op7_bpe_fst(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op8_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model(read_table(spark, sf_dir, "documents"))


def op9_chat_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = with_trap(read_table(spark, sf_dir, "conversations"))
    return read_back(format_turns(turns))


def op10_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_laesa_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(read_table(spark, sf_dir, "embeddings"))


def op12_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return largest(read_table(spark, sf_dir, "embeddings"))


def op13_strassen_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_vamana_ann": op1_vamana_ann,
    "op2_url_sweep": op2_url_sweep,
    "op3_iblt": op3_iblt,
    "op4_simhash_golay": op4_simhash_golay,
    "op5_toxicity_fm": op5_toxicity_fm,
    "op6_pii_anchors": op6_pii_anchors,
    "op7_bpe_fst": op7_bpe_fst,
    "op8_context_mixing": op8_context_mixing,
    "op9_chat_grammar": op9_chat_grammar,
    "op10_sainte_lague_mix": op10_sainte_lague_mix,
    "op11_laesa_clusters": op11_laesa_clusters,
    "op12_bit_sliced_topk": op12_bit_sliced_topk,
    "op13_strassen_negatives": op13_strassen_negatives,
}


def _integers(factor: int, *columns: str, where: str = "true") -> str:
    """The embeddings that take part, components as exact integers ``z``; ``r`` tells rows apart."""
    listed = "".join(f", {c}" for c in columns)
    return f"""
    SELECT row_number() OVER () AS r{listed},
           list_transform(embedding, lambda x: CAST(floor({factor} * CAST(x AS DOUBLE)) AS BIGINT)) AS z
    FROM embeddings
    WHERE embedding IS NOT NULL AND {where}
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


def _inner(a: str, b: str) -> str:
    return f"CAST(list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1] * p[2])) AS BIGINT)"


def _clusters_sql(k: int = 16, rounds: int = 3, dims: int = 64, factor: int = 64) -> str:
    away = "CAST(list_sum(list_transform(list_zip(v.z, c.z), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)"

    def nearest_sql(at: int) -> str:
        return f"""a{at} AS (
    SELECT r, vec_id, z, c AS cluster, d FROM (
        SELECT v.r, v.vec_id, v.z, c.c, {away} AS d FROM kept v CROSS JOIN c{at} c)
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"""

    steps = [f"kept AS MATERIALIZED ({_integers(factor, 'vec_id', where=f'len(embedding) = {dims}')})",
             f"""c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY ticket, z) - 1 AS c, z
    FROM (SELECT sha256('1:' || vec_id) AS ticket, z FROM kept ORDER BY ticket, z LIMIT {k}))"""]
    for at in range(rounds):
        steps.append(nearest_sql(at))
        steps.append(f"""c{at + 1} AS MATERIALIZED (
    SELECT c0.c, coalesce(m.z, c0.z) AS z FROM c{at} c0 LEFT JOIN (
        SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY j) AS z FROM (
            SELECT cluster, j, CAST(sum(z[j]) AS BIGINT) AS s, count(*) AS n
            FROM a{at}, range(1, {dims + 1}) AS t(j) GROUP BY cluster, j)
        GROUP BY cluster) m ON m.cluster = c0.c)""")
    steps.append(nearest_sql(rounds))
    return "WITH " + ",\n".join(steps) + f"""
SELECT a.vec_id, CAST(a.cluster AS INTEGER) AS cluster, a.d AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.z, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.cluster = c.c
"""

# The five rules of op2_url_sweep; a host fits its subdomains, the longest rule wins.
ORACLE_SQL: dict[str, str] = {"op2_url_sweep": """
WITH rules(action, rule_host, rule_path) AS (VALUES
    ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
    ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
cut AS (
    SELECT row_number() OVER () AS r, page_id, coalesce(strpos(url, '://') > 0, false) AS known,
           substr(url, strpos(url, '://') + 3) AS rest
    FROM pages),
urls AS (
    SELECT r, page_id,
           CASE WHEN known THEN translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                          'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
           CASE WHEN known THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
    FROM cut),
ranked AS (
    SELECT u.*, rule_host || rule_path AS rule, action,
           row_number() OVER (PARTITION BY r ORDER BY length(rule_host) + length(rule_path) DESC NULLS LAST,
                              length(rule_host) DESC NULLS LAST) AS place
    FROM urls u LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
                               AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM ranked WHERE place = 1
""",
    "op11_laesa_clusters": _clusters_sql(),
    "op12_bit_sliced_topk": f"""
WITH v AS MATERIALIZED ({_integers(256, "vec_id", where="vec_id IS NOT NULL")})
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
        SELECT q.vec_id AS query_id, c.vec_id, {_inner("q.z", "c.z")} AS score
        FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id))
WHERE rank <= 5
""",
    "op13_strassen_negatives": f"""
WITH v AS MATERIALIZED (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, z
    FROM ({_integers(256, "vec_id", "label", where="vec_id IS NOT NULL AND label IS NOT NULL")})),
scored AS MATERIALIZED (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, {_inner("a.z", "c.z")} AS score
    FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM (
    SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
           row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
    FROM positives p JOIN scored s USING (anchor_id)
    WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
WHERE rank <= 10
"""}
