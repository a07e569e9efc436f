"""Numbers, arrays and JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import _col


def lenient_double(text: Column | str) -> Column:
    return _col(text).try_cast("double")


def lenient_int(text: Column | str) -> Column:
    """Number-like text to int, half-even rounding, anything else NULL."""
    return F.bround(lenient_double(text)).try_cast("int")


def first_value(content: Column | str, field: str = "value") -> Column:
    """Field of the first array element; NULL for an empty or absent array."""
    return F.get(_col(content), 0)[field]


def explode_tags(entries, keep: list[str], tags: str = "tags"):
    """One row per tag struct, parent columns kept."""
    return entries.select(*keep, F.explode(tags).alias("_tag")).select(
        F.col("_tag.term").alias("term"), *keep
    )
