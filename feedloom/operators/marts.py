"""Feature marts and post reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import word_count
from feedloom.operators.topk import top_groups

TOP_TAGS = 20


def post_length(posts: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return posts.select(*keep, "title", word_count("content_text").alias("word_count"))


def top_tags(tags: DataFrame, k: int = TOP_TAGS) -> DataFrame:
    return top_groups(tags, F.lower("term"), k)


def post_tags(posts: DataFrame, tags: DataFrame, k: int = TOP_TAGS) -> DataFrame:
    """Posts that carry at least one of the k top tags, with those tags as one
    sorted comma list. Case variants count as the same tag.

    Tasks gather each post's set of labels before the only shuffle, which moves
    one small row per post and task however many tags a post has; a set holds k
    labels at most. Texts are never grouped.
    """
    carried = tags.select("post_id", F.lower("term").alias("term")).join(top_tags(tags, k).select("term"), "term", "left_semi")
    labels = carried.groupBy("post_id").agg(F.array_join(F.sort_array(F.collect_set("term")), ",").alias("labels"))
    return _with_labels(posts, labels)


def post_tags_by_raw_term(posts: DataFrame, tags: DataFrame, k: int = TOP_TAGS) -> DataFrame:
    """The literal reading of the mart: tags are counted by raw spelling, so a
    tag may hold several of the k places, and each of its rows then repeats."""
    top = (
        top_groups(tags, F.col("term"), k, "raw").groupBy(F.lower("raw").alias("term"))
        .agg(F.count(F.lit(1)).alias("places"))
    )
    repeated = (
        tags.select("post_id", F.lower("term").alias("term"))
        .join(top, "term")
        .groupBy("post_id", "term").agg(F.sum("places").cast("int").alias("n"))
        .groupBy("post_id")
        .agg(F.sort_array(F.collect_list(F.struct("term", "n"))).alias("t"))
    )
    spread = F.flatten(F.transform("t", lambda x: F.array_repeat(x["term"], x["n"])))
    return _with_labels(posts, repeated.select("post_id", F.array_join(spread, ",").alias("labels")))


def _with_labels(posts: DataFrame, labels: DataFrame) -> DataFrame:
    return posts.select("id", "content_text").join(
        labels.withColumnRenamed("post_id", "id"), "id"
    ).select("id", "content_text", "labels")


def post_detail(posts: DataFrame, tags: DataFrame, columns: tuple[str, ...] = ("title", "content_source", "content_text")) -> DataFrame:
    """Posts with all their tags as one ``', '`` list, NULL without tags."""
    listed = tags.groupBy("post_id").agg(
        F.array_join(F.sort_array(F.collect_list("term")), ", ").alias("tags")
    )
    return posts.join(listed, posts["id"] == listed["post_id"], "left").select(
        posts["id"], *(posts[c] for c in columns), "tags"
    )


def date_range(posts: DataFrame, ts: str = "published") -> DataFrame:
    return posts.agg(F.min(ts).alias("min"), F.max(ts).alias("max"))


def post_count(posts: DataFrame) -> DataFrame:
    return posts.agg(F.count(F.lit(1)).alias("n"))
