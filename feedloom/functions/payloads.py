"""JSON payloads whose fields drift from row to row, kept as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(payload: Column | str) -> Column:
    """A payload as VARIANT, which any later field is read from without parsing the text
    again; text that is no JSON turns NULL."""
    return F.try_parse_json(payload)


def field(payload: Column | str, path: str, as_type: str) -> Column:
    """The value at ``path``; NULL where it is missing or of no such type."""
    return F.try_variant_get(F.col(payload) if isinstance(payload, str) else payload, path, as_type)


def shape(df: DataFrame, payload: str) -> DataFrame:
    """One row: rows, rows that are no JSON, and the one schema that all payloads fit."""
    read = df.select(F.col(payload).alias("text"), parsed(payload).alias("v"))
    return read.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("text").isNotNull() & F.col("v").isNull()).alias("broken"),
        F.schema_of_variant_agg("v").alias("schema"))
