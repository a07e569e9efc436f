"""Feed documents and landed entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.schemas import FEED_ENTRY, FEED_ITEM


def read_feed_items(spark: SparkSession, paths: str | list[str], on_error: str = "fail") -> DataFrame:
    """Items of many RSS documents in one scan, with the file they came from.

    ``on_error='fail'`` stops at the first malformed item; ``'skip'`` leaves
    malformed items and unreadable files out.
    """
    if on_error not in ("fail", "skip"):
        raise ValueError("on_error is 'fail' or 'skip'")
    reader = spark.read.format("xml").option("rowTag", "item").schema(FEED_ITEM)
    reader = reader.option("mode", "FAILFAST" if on_error == "fail" else "DROPMALFORMED")
    reader = reader.option("ignoreCorruptFiles", str(on_error == "skip").lower())
    return reader.load(paths).withColumn("feed", F.col("_metadata.file_path"))


def column_items(feeds: DataFrame, document: str, name: str) -> tuple[DataFrame, DataFrame]:
    """(items, names of broken feeds) of RSS documents that a column holds, as fetched
    responses in a table are. A broken document has no items; a null one is broken."""
    kept = F.from_xml(document, f"channel struct<title: string, item: array<struct<{FEED_ITEM}>>>, broken string",
                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"})
    read = feeds.select(F.col(name).alias("feed"), kept.alias("rss"))
    good = F.col("rss").isNotNull() & F.col("rss.broken").isNull() & F.col("rss.channel").isNotNull()
    items = read.where(good).select("feed", F.inline("rss.channel.item"))
    return items, read.where(~good).select("feed")


def feed_entries(items: DataFrame) -> DataFrame:
    """Items in the nested entry shape of ``schemas.FEED_ENTRY``, plus ``feed``."""
    none = F.lit(None).cast("string")
    tag = lambda c: F.struct(c.alias("term"), none.alias("scheme"), none.alias("label"))
    body = F.struct(
        F.lit("text/html").alias("type"), none.alias("language"), none.alias("base"),
        F.col("`content:encoded`").alias("value"),
    )
    return items.select(
        F.col("guid").alias("id"), "link", "title", F.col("description").alias("summary"),
        F.col("pubDate").alias("published"),
        F.transform(F.coalesce("category", F.array().cast("array<string>")), tag).alias("tags"),
        F.when(F.col("`content:encoded`").isNotNull(), F.array(body))
        .otherwise(F.array().cast("array<struct<type:string,language:string,base:string,value:string>>"))
        .alias("content"),
        *(["feed"] if "feed" in items.columns else []),
    )


def read_feeds(spark: SparkSession, paths: str | list[str], on_error: str = "fail") -> DataFrame:
    return feed_entries(read_feed_items(spark, paths, on_error))


def flat_entries(entries: DataFrame, job_id: str) -> DataFrame:
    """The extract-time projection: one flat row per entry."""
    return entries.select(
        "id", "title", "link", "summary", "tags",
        F.get("content", F.lit(0))["value"].alias("post_source"),
        F.col("published").alias("published_timestamp"),
        F.lit(job_id).alias("job_id"),
    )


def read_entries(spark: SparkSession, paths: str | list[str], lines: bool = False) -> DataFrame:
    """Landed entries: a JSON array per file, or one object per line."""
    return spark.read.schema(FEED_ENTRY).option("multiLine", not lines).option("mode", "FAILFAST").json(paths)


def union_feeds(*feeds: DataFrame) -> DataFrame:
    first, *rest = feeds
    for other in rest:
        first = first.unionByName(other)
    return first
