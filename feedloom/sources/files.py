"""Plain landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_json_array(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Files that hold one JSON array; a file is the unit of parallelism."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read
    return (reader.schema(schema) if schema else reader).json(path)


def load_json_lines(spark: SparkSession, path: str, table: str) -> DataFrame:
    """JSON lines with inferred types into a table."""
    spark.read.json(path).write.mode("overwrite").saveAsTable(table)
    return spark.table(table)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: str | None = None, multi_line: bool = True) -> DataFrame:
    """CSV with a header; types inferred unless a schema is given. Quoted fields
    may hold newlines, hence ``multi_line``; switch it off where they do not, so
    that large files stay splittable."""
    reader = (
        spark.read.option("header", True).option("quote", '"').option("escape", '"')
        .option("multiLine", multi_line)
    )
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
