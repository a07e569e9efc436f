"""Layers, tables and views in the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.schemas import ALL_TABLES, Table


def create_layer(spark: SparkSession, layer: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}{where}")


def drop_layer(spark: SparkSession, layer: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")


def recreate_layer(spark: SparkSession, layer: str, location: str | None = None) -> None:
    """For transient layers that each run rebuilds."""
    drop_layer(spark, layer)
    create_layer(spark, layer, location)


def create_table(spark: SparkSession, table: Table, name: str | None = None, buckets: int | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` with column defaults; returns the name.

    Parquet tables cannot declare a primary key, so keys live in the ``Table``
    and are enforced by ``operators.upsert``. With ``buckets`` the table is
    bucketed on its key: the anti join of an incremental load then reads the
    stored side without shuffling it.
    """
    name = name or table.full_name
    columns = ", ".join(
        f"`{c}` {t}" + (f" DEFAULT {table.defaults[c]}" if c in table.defaults else "")
        for c, t in table.columns.items()
    )
    clustered = ""
    if buckets and table.key:
        keys = ", ".join(f"`{k}`" for k in table.key)
        clustered = f" CLUSTERED BY ({keys}) INTO {buckets} BUCKETS"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{clustered}")
    return name


def create_all(spark: SparkSession, tables: tuple[Table, ...] = ALL_TABLES, buckets: int | None = None) -> None:
    for layer in dict.fromkeys(t.layer for t in tables):
        create_layer(spark, layer)
    for table in tables:
        create_table(spark, table, buckets=buckets)


def clone_empty(spark: SparkSession, source: str, target: str) -> None:
    """An empty table with the columns of ``source``."""
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    spark.sql(f"CREATE TABLE {target} LIKE {source} USING parquet")


def replace_table(df: DataFrame, name: str) -> None:
    """Drop and recreate a per-run table from a frame."""
    df.write.mode("overwrite").saveAsTable(name)


def create_view(spark: SparkSession, name: str, select: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select}")


def databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def tables(spark: SparkSession, layer: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {layer}").select("namespace", "tableName", "isTemporary")


def describe(spark: SparkSession, name: str) -> DataFrame:
    return (
        spark.sql(f"DESCRIBE TABLE {name}")
        .filter(~F.col("col_name").startswith("#") & (F.col("col_name") != ""))
        .select("col_name", "data_type")
    )
