"""Posts to a searchable vector table, and questions to context."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.cosine import cosine_topk
from feedloom.operators.upsert import delta
from feedloom.operators.vectors import chunk_records, hits_with_metadata, retrieval_context, top_article
from feedloom.operators.versioned import VersionedFolder
from feedloom.schemas import CHUNK_RECORD, EMBEDDED_POSTS
from feedloom.session import materialize
from feedloom.sinks.tables import insert_select
from feedloom.sources.tables import read_current


def vector_table(spark: SparkSession, path: str) -> VersionedFolder:
    """Chunk records in a folder where a post's chunks lie together."""
    return VersionedFolder(spark, path, f"{CHUNK_RECORD}, post_id string", ["post_id"])


def write_chunks(posts: DataFrame, vectors: VersionedFolder, embedder, load: tuple[str, int] | None = None, **chunking) -> bool:
    """Replace all chunks of these posts. ``posts`` is read twice, for its ids
    and for its texts, so it should be a table or a written batch. False, and
    nothing is embedded, if the ``load`` is known. The chunks of a post are made from
    its row, so that new ones are written without shuffling their vectors."""
    records = chunk_records(posts, embedder, **chunking)
    return vectors.replace(
        records.withColumn("post_id", F.col("metadata.post_id")), posts.select(F.col("id").alias("post_id")), load, together=True
    )


def embed_new_posts(
    spark: SparkSession, posts: DataFrame, vectors: VersionedFolder, embedder,
    ledger: str = EMBEDDED_POSTS.full_name, **chunking,
) -> None:
    """Chunk and embed the posts that the ledger does not list, then list them.

    The ids are fixed before the vectors are written; a run that dies between
    the two writes embeds the same posts again, which replaces their chunks.
    """
    pending = materialize(delta(posts, read_current(spark, ledger), ["id"]), "pending")
    if pending.isEmpty():
        return
    write_chunks(pending, vectors, embedder, **chunking)
    insert_select(pending.select("id"), ledger)


def search(questions: DataFrame, vectors: DataFrame, embedder, k: int = 5,
           query_id: str = "query_id", text: str = "question") -> DataFrame:
    """Best k chunks per question with their metadata."""
    asked = embedder.transform(questions.select(query_id, text).filter(F.length(F.trim(text)) > 0), text, "vector")
    hits = materialize(cosine_topk(asked, vectors, k, query_id=query_id), "hits")
    found = hits_with_metadata(hits, vectors.select("id", "metadata"))
    return found.select("query_id", "rank", "score", F.col("item_id").alias("id"), "metadata.*")


def answer_context(questions: DataFrame, vectors: DataFrame, embedder, posts: DataFrame, tags: DataFrame,
                   k: int = 5, query_id: str = "query_id", text: str = "question") -> DataFrame:
    """Per question: context text and the article of the best chunk with tags."""
    hits = materialize(search(questions, vectors, embedder, k, query_id, text), "hits")
    return retrieval_context(hits).join(top_article(hits, posts, tags), "query_id")
