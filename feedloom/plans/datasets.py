"""Feature views and training exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import catalog
from feedloom.functions.text import split_labels
from feedloom.operators.marts import post_length
from feedloom.operators.topk import newest
from feedloom.sinks.files import write_csv

TRAINING_ROWS = 10_000

POST_LENGTH = r"""
SELECT title, CAST(size(split(content_text, r'\s+')) AS BIGINT) AS word_count,
       current_timestamp() AS created_at
FROM {stage}.posts
"""

POST_TAGS = """
WITH top_tags AS (
    SELECT lower(term) AS term, count(*) AS total FROM {stage}.tags
    GROUP BY lower(term) ORDER BY total DESC, term LIMIT 20
),
labels AS (
    SELECT post_id, listagg(term, ',') WITHIN GROUP (ORDER BY term) AS labels
    FROM (SELECT DISTINCT post_id, lower(term) AS term FROM {stage}.tags) AS t
    WHERE term IN (SELECT term FROM top_tags)
    GROUP BY post_id
)
SELECT p.id, p.content_text, l.labels, current_timestamp() AS created_at
FROM {stage}.posts p JOIN labels l ON p.id = l.post_id
"""


def refresh_views(spark: SparkSession, stage: str = "stage", ml: str = "ml") -> None:
    catalog.create_layer(spark, ml)
    catalog.create_view(spark, f"{ml}.post_length", POST_LENGTH.format(stage=stage))
    catalog.create_view(spark, f"{ml}.post_tags", POST_TAGS.format(stage=stage))


def export_training_sets(spark: SparkSession, folder: str, ml: str = "ml") -> None:
    """Both feature sets as CSV, labels as a list."""
    write_csv(spark.table(f"{ml}.post_length").select("title", "word_count"), f"{folder}/post-length")
    labelled = spark.table(f"{ml}.post_tags").select("content_text", split_labels("labels").alias("labels"))
    write_csv(labelled, f"{folder}/post-tags")


def training_rows(posts: DataFrame, n: int = TRAINING_ROWS) -> DataFrame:
    """(id, title, word_count) of the n newest posts. Words are counted after
    the choice, so only n texts are read into the sample."""
    recent = newest(posts.select("id", "title", "content_text", "published"), "published", "id", n)
    return post_length(recent, keep=("id",)).select("id", "title", F.col("word_count"))
