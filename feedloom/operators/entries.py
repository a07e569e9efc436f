"""Feed entries to the five relational tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.dates import parse_feed_date
from feedloom.functions.html import author_bio, parts_of_html
from feedloom.functions.values import explode_tags, first_value, lenient_int
from feedloom.operators.filters import drop_null, with_lineage
from feedloom.schemas import AUTHORS, IMAGES, LINKS, POSTS, TAGS

PARTS = ("text", "images", "links", "authors")


def parse_entries(entries: DataFrame, job_id: str, ingest_timestamp: dt.datetime,
                  date_mode: str = "wall", strict: bool = True) -> DataFrame:
    """Entries with parsed date, body HTML and every part of that HTML, in one
    walk per document. Write it once (``session.materialize``), then derive the
    tables from it."""
    parsed = entries.select(
        "id", "link", "title", "summary", "tags",
        parse_feed_date("published", date_mode, strict).alias("published"),
        first_value("content").alias("content_source"),
    )
    return with_lineage(parsed, job_id, ingest_timestamp).withColumn(
        "parts", parts_of_html("content_source", *PARTS)
    )


def _shape(df: DataFrame, table) -> DataFrame:
    return df.select(*(F.col(f"`{c}`").cast(t).alias(c) for c, t in table.columns.items()))


def posts(parsed: DataFrame) -> DataFrame:
    return _shape(parsed.withColumn("content_text", F.col("parts.text")), POSTS)


def tags(parsed: DataFrame) -> DataFrame:
    keyed = parsed.withColumnRenamed("id", "post_id")
    return _shape(explode_tags(keyed, ["post_id", "job_id", "ingest_timestamp"]), TAGS)


def _part_rows(parsed: DataFrame, part: str) -> DataFrame:
    return parsed.select(
        F.col("id").alias("post_id"), "job_id", "ingest_timestamp", F.inline(f"parts.{part}")
    )


def images(parsed: DataFrame) -> DataFrame:
    """Images with a source. Positions are those in the document, so they keep
    gaps; sizes that are not numbers turn NULL."""
    rows = drop_null(_part_rows(parsed, "images"), ["src"])
    return _shape(rows.withColumns({"width": lenient_int("width"), "height": lenient_int("height")}), IMAGES)


def links(parsed: DataFrame) -> DataFrame:
    return _shape(drop_null(_part_rows(parsed, "links"), ["href"]), LINKS)


def authors(parsed: DataFrame) -> DataFrame:
    rows = drop_null(_part_rows(parsed, "authors"), ["name", "image"])
    return _shape(rows.withColumn("bio", author_bio()), AUTHORS)


def flat_posts(entries: DataFrame, job_id: str, ingest_timestamp: dt.datetime) -> DataFrame:
    """One flat row per entry beside its raw JSON, dates as instants
    (``schemas.FLAT_POSTS``)."""
    return entries.select(
        "id", F.col("link").alias("url"), "title",
        parse_feed_date("published", "instant").alias("published_date"),
        first_value("content").alias("content"), "summary",
        F.lit(ingest_timestamp.isoformat(sep=" ")).cast("timestamp").alias("ingest_timestamp"),
        F.lit(job_id).alias("job_id"),
        F.to_json(F.struct(*(f"`{c}`" for c in entries.columns))).alias("raw_feed"),
    )


BUILDERS = ((POSTS, posts), (TAGS, tags), (LINKS, links), (IMAGES, images), (AUTHORS, authors))
