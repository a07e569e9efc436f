"""Deltas, dedupe, insert-if-absent, last-write-wins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from feedloom import catalog
from feedloom.catalogue.base import table
from feedloom.operators import upsert
from feedloom.operators.versioned import VersionedFolder
from feedloom.schemas import Table
from feedloom.session import scratch_path


def delta_anti(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    return upsert.delta(docs, table(spark, d, "labels"), ["doc_id"])


def delta_not_in(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    return upsert.delta_not_in(docs, table(spark, d, "labels"), "doc_id")


def delta_not_in_null(spark, d):
    """The ledger holds NULLs: NOT IN yields nothing."""
    done = table(spark, d, "labels").select(F.expr("CASE WHEN quality = 1 THEN doc_id END").alias("doc_id"))
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    return upsert.delta_not_in(docs, done, "doc_id")


def _turns(spark, d):
    """(stored, batch): the user turns are stored already, the batch is all turns."""
    turns = table(spark, d, "conversations")
    stored = upsert.first_per_key(turns.filter("role = 'user'"), ["conv_id", "turn"], ["text"])
    return stored.withColumn("job_id", F.lit("first")), turns.withColumn("job_id", F.lit("second"))


def insert_if_absent(spark, d):
    stored, batch = _turns(spark, d)
    return stored.unionByName(upsert.new_rows(stored, batch, ["conv_id", "turn"], ["role", "text"]))


def insert_if_absent_table(spark, d):
    """The same through catalog tables, the batch loaded twice."""
    stored, batch = _turns(spark, d)
    layer = f"stage_{uuid.uuid4().hex[:12]}"
    declared = Table(layer, "turns", {
        "conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string", "job_id": "string",
    }, key=("conv_id", "turn"))
    catalog.create_layer(spark, layer, scratch_path(spark, layer))
    name = catalog.create_table(spark, declared, buckets=8)
    for rows in (stored, batch, batch):
        upsert.insert_if_absent(spark, name, rows, list(declared.key), ["role", "text"])
    return spark.table(name)


def _corrections(spark, d):
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", "ts", "value")
    fixed = events.filter(F.col("event_type").isin("click", "purchase")).withColumn("value", -F.col("value"))
    return events, fixed


def upsert_last_wins(spark, d):
    events, fixed = _corrections(spark, d)
    return upsert.upsert_latest(events, fixed, ["user_id", "event_type"], ["ts", "event_id"])


def upsert_bucketed(spark, d):
    """The same through a folder of files, in two loads; each comes twice."""
    events, fixed = _corrections(spark, d)
    folder = VersionedFolder(
        spark, scratch_path(spark, "events"),
        "event_id bigint, user_id bigint, event_type string, ts timestamp_ntz, value double", ["user_id"],
    )
    for number, batch in enumerate((events, fixed)):
        for _ in range(2):
            folder.upsert(batch, ["user_id", "event_type"], ["ts", "event_id"], load=("corrections", number))
    return folder.read()


def replace_shrinking_posts(spark, d):
    """Conversations as posts, turns as their chunks; then those with an even number of
    turns come again with their user turns only, some with none."""
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    folder = VersionedFolder(spark, scratch_path(spark, "posts"), "conv_id bigint, turn bigint, role string, text string", ["conv_id"])
    folder.replace(turns)
    again = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n % 2 = 0").select("conv_id")
    folder.replace(turns.where("role = 'user'").join(again, "conv_id", "left_semi"), again)
    return folder.read()


def dedupe_keep_first(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "source")
    return upsert.first_by_value(docs, "text", "doc_id")


def dedupe_pages(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url")
    return upsert.first_per_key(pages, ["url"], ["page_id"])


QUERIES = {
    "delta_anti": delta_anti,
    "delta_not_in": delta_not_in,
    "delta_not_in_null": delta_not_in_null,
    "insert_if_absent": insert_if_absent,
    "insert_if_absent_table": insert_if_absent_table,
    "upsert_last_wins": upsert_last_wins,
    "upsert_bucketed": upsert_bucketed,
    "replace_shrinking_posts": replace_shrinking_posts,
    "dedupe_keep_first": dedupe_keep_first,
    "dedupe_pages": dedupe_pages,
}

_ABSENT = """
    WITH stored AS (
        SELECT conv_id, turn, role, text FROM conversations WHERE role = 'user'
        QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY text) = 1
    ),
    batch AS (
        SELECT conv_id, turn, role, text FROM conversations
        QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY role, text) = 1
    )
    SELECT *, 'first' AS job_id FROM stored
    UNION ALL
    SELECT *, 'second' AS job_id FROM batch b
    WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.conv_id = b.conv_id AND s.turn = b.turn)"""

_LATEST = """
    WITH merged AS (
        SELECT event_id, user_id, event_type, ts, value, 0 AS fresh FROM events
        UNION ALL
        SELECT event_id, user_id, event_type, ts, -value, 1 FROM events
        WHERE event_type IN ('click', 'purchase')
    )
    SELECT event_id, user_id, event_type, ts, value FROM merged
    QUALIFY row_number() OVER (
        PARTITION BY user_id, event_type ORDER BY fresh DESC, ts DESC, event_id DESC) = 1"""

SQL = {
    "delta_anti": """
        SELECT d.doc_id, d.lang, d.source FROM documents d
        LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL""",
    "delta_not_in": """
        SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "delta_not_in_null": """
        SELECT doc_id, lang, source FROM documents
        WHERE doc_id NOT IN (SELECT CASE WHEN quality = 1 THEN doc_id END FROM labels)""",
    "insert_if_absent": _ABSENT,
    "insert_if_absent_table": _ABSENT,
    "upsert_last_wins": _LATEST,
    "upsert_bucketed": _LATEST,
    "replace_shrinking_posts": """
        SELECT conv_id, turn, role, text FROM conversations
        QUALIFY role = 'user' OR count(*) OVER (PARTITION BY conv_id) % 2 = 1""",
    "dedupe_keep_first": """
        SELECT doc_id, text, source FROM documents
        QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
    "dedupe_pages": """
        SELECT page_id, url FROM pages
        QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1""",
}
