"""Table functions for SQL: several rows of a text beside its own row."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from feedloom.functions.html import read_parts


@F.udtf(returnType="index int, href string, title string", useArrow=True)
class HtmlLinks:
    """Links of an HTML text with their position; a null text has none."""

    def eval(self, html: str) -> Iterator[tuple]:
        for link in read_parts(html, ("links",))["links"] or []:
            yield link["index"], link["href"], link["title"]


@F.udtf(returnType="index int, src string, width string, height string", useArrow=True)
class HtmlImages:
    """Images of an HTML text with their position, sizes as they are written."""

    def eval(self, html: str) -> Iterator[tuple]:
        for image in read_parts(html, ("images",))["images"] or []:
            yield image["index"], image["src"], image["width"], image["height"]


@F.udtf(returnType="index int, paragraph string", useArrow=True)
class HtmlParagraphs:
    def eval(self, html: str) -> Iterator[tuple]:
        yield from enumerate(read_parts(html, ("paragraphs",))["paragraphs"] or [])


def register(spark: SparkSession) -> None:
    """``html_links``, ``html_images`` and ``html_paragraphs`` for ``LATERAL`` joins."""
    for name, function in (("html_links", HtmlLinks), ("html_images", HtmlImages), ("html_paragraphs", HtmlParagraphs)):
        spark.udtf.register(name, function)
