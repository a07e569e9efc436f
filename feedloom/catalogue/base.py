"""Shared helpers of the query catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.text import words


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def first_line(text: str) -> Column:
    return F.substring_index(text, "\n", 1)


def posts(spark: SparkSession, folder: str) -> DataFrame:
    """documents as posts."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), first_line("text").alias("title"),
        F.col("text").alias("content_text"), "source", "lang",
    )


def word_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Each distinct word of a document as a tag of it. The words are made
    distinct inside the row, which keeps (term, post_id) a key without a
    shuffle."""
    docs = table(spark, folder, "documents")
    return docs.select(
        F.col("doc_id").alias("post_id"), F.explode(F.array_distinct(words("text"))).alias("term")
    )


def label_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Source and language as the tags of a document, for labelled documents
    only, so that some posts have none."""
    docs = table(spark, folder, "documents").join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_semi")
    return docs.select(F.col("doc_id").alias("post_id"), F.explode(F.array("source", "lang")).alias("term"))
