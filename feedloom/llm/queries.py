"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from feedloom.llm import (
    ann, covertree, decontaminate, divergence, licenses, lpf, packing, pivots, quality, rollup, simhash, simple8b, toxicity,
)
from feedloom.llm.common import table
from feedloom.session import scratch_path, ship_package

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op3_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"), F.col("id") % 100 == 0)


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return lpf.digests(table(spark, folder, "documents"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("unnamed")


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.corpus_totals(table(spark, folder, "documents"), table(spark, folder, "labels"), scratch_path(spark, "rollup"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    return simple8b.round_trip(table(spark, folder, "documents"))


def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.statements(table(spark, folder, "documents"))


def op11_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def op12_codes(spark: SparkSession, folder: str) -> DataFrame:
    return pivots.compress(table(spark, folder, "embeddings"))


def op13_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return covertree.near_duplicates(table(spark, folder, "embeddings"))


_QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_packing": op2_packing,
    "op3_nearest": op3_nearest,
    "op4_quality": op4_quality,
    "op5_repeats": op5_repeats,
    "op6_decontamination": op6_decontamination,
    "op7_token_counts": op7_token_counts,
    "op8_toxicity": op8_toxicity,
    "op9_token_ids": op9_token_ids,
    "op10_licenses": op10_licenses,
    "op11_divergence": op11_divergence,
    "op12_codes": op12_codes,
    "op13_vectors": op13_vectors,
}

_NEAREST_SQL = """
    WITH v AS (SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings
               WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL)) = 0
                 AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    d AS (SELECT q.vec_id AS query_id, c.vec_id, min(sqrt(list_sum(list_transform(range(1, len(q.e) + 1),
                lambda i: (q.e[i] - c.e[i]) * (q.e[i] - c.e[i]))))) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0 GROUP BY ALL)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM d QUALIFY rank <= 10
"""

_LINKED_SQL = """
    WITH RECURSIVE v AS MATERIALIZED (
        SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e,
               embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
               AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS good FROM embeddings),
    link AS MATERIALIZED (
        SELECT a.r AS a, b.r AS b FROM v a JOIN v b ON a.good AND b.good AND a.r <> b.r AND len(a.e) = len(b.e)
        WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.95),
    reached AS (SELECT r AS a, r AS b FROM v UNION SELECT reached.a, link.b FROM reached JOIN link ON reached.b = link.a),
    least AS (SELECT reached.a, min(vec_id) AS component_id FROM reached JOIN v ON reached.b = v.r GROUP BY reached.a),
    number AS (SELECT a, count(*) AS n FROM link GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
    FROM v JOIN least ON v.r = least.a LEFT JOIN number ON v.r = number.a
"""

_SQL: dict[str, str] = {
    "op3_nearest": _NEAREST_SQL,
    "op10_licenses": licenses.scan_sql(),
    "op11_divergence": divergence.AUDIT_SQL,
    "op12_codes": pivots.codes_sql(),
    "op13_vectors": _LINKED_SQL,
}


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(ship_package(spark), folder)

    return run


def queries() -> dict[str, Query]:
    return {name: _shipped(query) for name, query in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
