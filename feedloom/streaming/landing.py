"""Streams that pick up newly landed files.

Each run uses ``availableNow``: it takes the files that the checkpoint has not
seen and stops, like a scheduled job; leave ``once`` off to keep running. A batch
may be replayed after a failure, which the keyed writers turn into a no-op.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from feedloom.operators.upsert import first_per_key, insert_if_absent
from feedloom.operators.versioned import VersionedFolder
from feedloom.plans.feed_etl import stage_entries
from feedloom.plans.retrieval import write_chunks
from feedloom.schemas import EMBEDDED_POSTS, FEED_ENTRY, STAGE_TABLES
from feedloom.session import delete_path, materialize, release, scratch_path
from feedloom.sinks.tables import insert_select
from feedloom.sources.tables import read_current


def _run(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], once: bool, tables=()):
    """Batches run in a session of their own, so the caller's is told to look
    again at the tables they filled."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    query = (writer.trigger(availableNow=True) if once else writer).start()
    if once:
        query.awaitTermination()
        for table in tables:
            stream.sparkSession.catalog.refreshTable(table)
    return query


def read_landing(spark: SparkSession, path: str, schema: str, fmt: str = "parquet",
                 max_files: int = 1000, **options: str) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files)
    return reader.options(**options).load(path)


def insert_stream(stream: DataFrame, table: str, keys: list[str], checkpoint: str,
                  order: list[str] | None = None, once: bool = True):
    """Insert-if-absent of every micro-batch."""

    def each(batch: DataFrame, _: int) -> None:
        insert_if_absent(batch.sparkSession, table, batch, keys, order)

    return _run(stream, checkpoint, each, once, [table])


def stage_landed_entries(spark: SparkSession, path: str, checkpoint: str, once: bool = True,
                         stage_layer: str = "stage", **etl):
    """Newly landed JSON entry files into the stage tables."""
    stream = read_landing(spark, path, FEED_ENTRY, "json", multiLine="true")

    def each(batch: DataFrame, _: int) -> None:
        stage_entries(batch.sparkSession, batch, stage_layer=stage_layer, **etl)

    return _run(stream, checkpoint, each, once, [f"{stage_layer}.{t.name}" for t in STAGE_TABLES])


def embed_landed_posts(stream: DataFrame, vectors: VersionedFolder, embedder, checkpoint: str,
                       ledger: str = EMBEDDED_POSTS.full_name, once: bool = True, **chunking):
    """Posts of every micro-batch to chunk vectors, and their ids to the ledger.

    A batch's number is recorded with its vectors, under the name of the checkpoint:
    a batch that is replayed after a failure embeds and writes nothing again, and only
    the ledger is completed. The copy of its posts goes when the batch is done, so that
    a stream that keeps running does not fill the shared folder."""

    def each(batch: DataFrame, number: int) -> None:
        copy = scratch_path(batch.sparkSession, "posts")
        try:
            posts = materialize(first_per_key(batch, ["id"]), "posts", copy)
            release(batch.sparkSession)  # the texts' shuffle, before the vectors need the disk
            write_chunks(posts, vectors, embedder, (checkpoint, number), **chunking)
            done = posts.select("id")
            insert_select(done.join(read_current(batch.sparkSession, ledger).select("id"), "id", "left_anti"), ledger)
        finally:
            delete_path(batch.sparkSession, copy)

    return _run(stream, checkpoint, each, once, [ledger])


def distinct_stream(stream: DataFrame, keys: list[str], path: str, checkpoint: str,
                    watermark: tuple[str, str] | None = None, once: bool = True):
    """First row per key across all batches, to parquet. Exact with unbounded
    state; with ``watermark=(column, delay)`` state is dropped after the delay,
    for sources whose repeats arrive within it."""
    if watermark:
        unique = stream.withWatermark(*watermark).dropDuplicatesWithinWatermark(keys)
    else:
        unique = stream.dropDuplicates(keys)
    writer = unique.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path)
    query = (writer.trigger(availableNow=True) if once else writer).start()
    if once:
        query.awaitTermination()
    return query
