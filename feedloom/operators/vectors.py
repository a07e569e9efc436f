"""Chunk vectors, retrieval context and comparison of texts."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.chunking import explode_chunks
from feedloom.functions.dates import epoch_micros
from feedloom.functions.text import chunk_id, join_ranked, replace_nbsp
from feedloom.operators.marts import post_detail

DIMENSIONS = 768


class HashingEmbedder:
    """Deterministic text vectors: hashed words, IDF weights, unit length.

    Stands where a hosted embedding model would; anything with the same
    ``transform(df, text, out)`` can replace it.
    """

    def __init__(self, model: PipelineModel):
        self.model = model

    @classmethod
    def fit(cls, df: DataFrame, text: str, dimensions: int = DIMENSIONS) -> "HashingEmbedder":
        stages = [
            RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"(?U)\W+"),
            HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dimensions),
            IDF(inputCol="_counts", outputCol="_weights"),
            Normalizer(inputCol="_weights", outputCol="_vector", p=2.0),
        ]
        return cls(Pipeline(stages=stages).fit(df.select(F.coalesce(text, F.lit("")).alias("_text"))))

    def transform(self, df: DataFrame, text: str, out: str = "values") -> DataFrame:
        done = self.model.transform(df.withColumn("_text", F.coalesce(text, F.lit(""))))
        return done.select(*df.columns, vector_to_array("_vector", "float32").alias(out))

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str) -> "HashingEmbedder":
        return cls(PipelineModel.load(path))


def chunk_records(posts: DataFrame, embedder, **chunking) -> DataFrame:
    """Posts to ``schemas.CHUNK_RECORD`` rows: one per chunk, with metadata."""
    source = posts.withColumn("_body", replace_nbsp("content_text"))
    chunks = explode_chunks(source, "_body", ["id", "link", "title", "published"], **chunking)
    return embedder.transform(chunks, "chunk_text", "values").select(
        chunk_id("id", "chunk_index").alias("id"),
        "values",
        F.struct(
            "link", "title", epoch_micros("published").alias("published_timestamp"),
            "chunk_index", F.col("id").alias("post_id"), "chunk_text",
        ).alias("metadata"),
    )


def centroids(items: DataFrame, group: str, vector: str) -> DataFrame:
    """Mean vector per group, by partial aggregation in the JVM."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    return (
        items.select(group, array_to_vector(F.col(vector).cast("array<double>")).alias("_v"))
        .groupBy(group).agg(Summarizer.mean(F.col("_v")).alias("_m"))
        .select(group, vector_to_array("_m").alias("vector"))
    )


def hits_with_metadata(hits: DataFrame, items: DataFrame, item_id: str = "id") -> DataFrame:
    """Attach the item columns to written hits; their size is known, so that few hits
    are broadcast and the items, texts and all, are scanned and not shuffled."""
    return items.withColumnRenamed(item_id, "item_id").join(hits, "item_id")


def retrieval_context(hits: DataFrame, text: str = "chunk_text", sep: str = "\n") -> DataFrame:
    """Texts of each query's hits joined best first (k texts at most)."""
    return hits.groupBy("query_id").agg(join_ranked("rank", text, sep).alias("context"))


def top_article(hits: DataFrame, posts: DataFrame, tags: DataFrame, post_id: str = "post_id") -> DataFrame:
    """The post behind each query's best hit, with its tags; hits as written."""
    best = hits.filter(F.col("rank") == 1).select("query_id", F.col(post_id).alias("id"))
    wanted = best.select("id").distinct()
    some_tags = tags.join(wanted.withColumnRenamed("id", "post_id"), "post_id", "left_semi")
    some_posts = posts.join(wanted, "id", "left_semi")
    return post_detail(some_posts, some_tags).join(best, "id")


def compare_texts(pairs: DataFrame, left: str, right: str, keep: list[str], max_chars: int | None = None) -> DataFrame:
    """Shared words, words of one side only, and Jaccard similarity per pair."""

    def tokens(column: str):
        text = F.col(column) if max_chars is None else F.substring(column, 1, max_chars)
        return F.array_distinct(F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != ""))

    sets = pairs.select(*keep, tokens(left).alias("_l"), tokens(right).alias("_r"))
    return sets.select(
        *keep,
        F.sort_array(F.array_intersect("_l", "_r")).alias("shared"),
        F.sort_array(F.array_except("_l", "_r")).alias("only_left"),
        F.sort_array(F.array_except("_r", "_l")).alias("only_right"),
        (F.size(F.array_intersect("_l", "_r")) / F.nullif(F.size(F.array_union("_l", "_r")), F.lit(0))).alias("jaccard"),
    )
