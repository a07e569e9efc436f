"""The incremental jobs as streams over the table folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from feedloom import catalog
from feedloom.catalogue.base import first_line, table
from feedloom.operators.vectors import HashingEmbedder
from feedloom.plans.retrieval import vector_table
from feedloom.schemas import EMBEDDED_POSTS, Table
from feedloom.session import scratch_path
from feedloom.streaming import landing

_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


def _table_stream(spark, d, name, schema):
    """A table as a landing place, be it one file or a folder of files: a pattern may
    name either, the plain path of a stream only a folder."""
    return landing.read_landing(spark, f"{d}/{name}.parque[t]", schema)


def _event_stream(spark, d):
    return _table_stream(spark, d, "events", _EVENTS)


def _new_layer(spark):
    layer = f"stream_{uuid.uuid4().hex[:12]}"
    catalog.create_layer(spark, layer, scratch_path(spark, layer))
    return layer


def stream_stage(spark, d):
    """First event per user and type, by way of insert-if-absent; the stream is
    run twice and the second run finds no new file."""
    layer, checkpoint = _new_layer(spark), scratch_path(spark, "checkpoint")
    declared = Table(layer, "events", {
        "event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double",
    }, key=("user_id", "event_type"))
    name = catalog.create_table(spark, declared)
    for _ in range(2):
        landing.insert_stream(_event_stream(spark, d), name, list(declared.key), checkpoint, ["ts", "event_id"])
    return spark.table(name)


def stream_dedupe(spark, d):
    keys = ["user_id", "event_type"]
    out = scratch_path(spark, "distinct")
    landing.distinct_stream(_event_stream(spark, d).select(*keys), keys, out, scratch_path(spark, "checkpoint"))
    return spark.read.schema("user_id bigint, event_type string").parquet(out)


def stream_embed(spark, d):
    """Documents as a stream of posts to chunk vectors."""
    layer = _new_layer(spark)
    ledger = catalog.create_table(spark, EMBEDDED_POSTS, f"{layer}.{EMBEDDED_POSTS.name}")
    embedder = HashingEmbedder.fit(table(spark, d, "documents"), "text")
    index = vector_table(spark, scratch_path(spark, "vectors"))
    docs = _table_stream(spark, d, "documents", "doc_id bigint, text string")
    posts = docs.select(
        F.col("doc_id").cast("string").alias("id"), F.lit("/doc").alias("link"), first_line("text").alias("title"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("published"), F.col("text").alias("content_text"),
    )
    landing.embed_landed_posts(posts, index, embedder, scratch_path(spark, "checkpoint"), ledger, strategy="fixed")
    listed = spark.table(ledger).select(F.col("id").alias("post_id"))
    return index.read().join(listed, "post_id", "left_semi").select("id", F.col("metadata.chunk_text").alias("chunk_text"))


QUERIES = {"stream_stage": stream_stage, "stream_dedupe": stream_dedupe, "stream_embed": stream_embed}

SQL = {
    "stream_stage": """
        SELECT event_id, ts, user_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
    "stream_dedupe": "SELECT DISTINCT user_id, event_type FROM events",
    "stream_embed": r"""
        WITH t AS (
            SELECT doc_id, list_filter(regexp_split_to_array(replace(text, chr(160), ' '), '\s+'), lambda x: x <> '') AS w FROM documents
        ),
        s AS (
            SELECT doc_id, w, unnest(generate_series(0, greatest(len(w) - 51, 0), 250)) AS pos FROM t WHERE len(w) > 0
        )
        SELECT doc_id || '_' || CAST(pos / 250 AS INTEGER) AS id,
               array_to_string(w[pos + 1 : pos + 300], ' ') AS chunk_text
        FROM s""",
}
