"""Landed feed entries to the stage tables."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import catalog
from feedloom.operators.entries import BUILDERS, flat_posts, parse_entries
from feedloom.operators.filters import new_job_id
from feedloom.operators.profile import step_count
from feedloom.operators.upsert import first_per_key, insert_if_absent
from feedloom.schemas import FLAT_POSTS, STAGE_TABLES
from feedloom.session import materialize
from feedloom.sinks.tables import append


FEED_FIELDS = ("id", "link", "title", "summary", "published", "tags", "content")


def _place(root: str | None, layer: str) -> str | None:
    return f"{root}/{layer}" if root else None


def stage_flat_entries(
    spark: SparkSession, entries: DataFrame, order: list[str], job_id: str | None = None,
    ingest_timestamp: dt.datetime | None = None, table: str = FLAT_POSTS.full_name,
) -> None:
    """The flat generation of the same load: one entry per link, the first by
    ``order`` (feed, position), then the entries whose id is new."""
    unique = first_per_key(entries, ["link"], order).drop(*(c for c in order if c not in FEED_FIELDS))
    rows = flat_posts(unique, job_id or new_job_id(), ingest_timestamp or dt.datetime.now())
    insert_if_absent(spark, table, materialize(rows, "flat"), list(FLAT_POSTS.key), ["ingest_timestamp"])


def set_up(spark: SparkSession, layer: str = "stage", buckets: int | None = None, root: str | None = None) -> None:
    """Stage layer and tables, bucketed on their keys when asked; ``root`` names
    the folder of the layer when it is not the session's warehouse."""
    catalog.create_layer(spark, layer, _place(root, layer))
    for table in STAGE_TABLES:
        catalog.create_table(spark, table, f"{layer}.{table.name}", buckets)


def stage_entries(
    spark: SparkSession,
    entries: DataFrame,
    job_id: str | None = None,
    ingest_timestamp: dt.datetime | None = None,
    raw_layer: str = "raw",
    stage_layer: str = "stage",
    date_mode: str = "wall",
    reject_layer: str | None = None,
    root: str | None = None,
    counts: str | None = None,
) -> str:
    """One run: parse every document once, refill the raw tables, then insert
    what is new into stage. Repeating a run changes nothing.

    The raw tables are the run's own, in a layer named after ``raw_layer`` and the job,
    so that runs at the same time do not meet; the layer goes when the run ends. With a
    ``reject_layer`` rows without a complete key land in its tables; otherwise they stop
    the run. A ``counts`` table gets the rows of every step.
    """
    job_id = job_id or new_job_id()
    now = ingest_timestamp or dt.datetime.now()
    parsed = materialize(parse_entries(entries, job_id, now, date_mode), "parsed")
    raw_layer = f"{raw_layer}_{re.sub(r'[^0-9a-zA-Z]', '_', job_id)}"
    catalog.recreate_layer(spark, raw_layer, _place(root, raw_layer))
    if reject_layer:
        catalog.create_layer(spark, reject_layer, _place(root, reject_layer))
    try:
        for table, build in BUILDERS:
            raw, stage = f"{raw_layer}.{table.name}", f"{stage_layer}.{table.name}"
            rejects = catalog.create_table(spark, table, f"{reject_layer}.{table.name}") if reject_layer else None
            build(parsed).write.saveAsTable(raw)
            if counts:
                append(step_count(spark.table(raw), table.name).withColumn("job_id", F.lit(job_id)), counts)
            insert_if_absent(spark, stage, spark.table(raw), list(table.key), ["ingest_timestamp"], rejects, written=True)
    finally:
        catalog.drop_layer(spark, raw_layer)
    return job_id
