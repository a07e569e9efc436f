"""Table sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def create_from(df: DataFrame, name: str) -> None:
    df.write.mode("errorifexists").saveAsTable(name)


def append(df: DataFrame, name: str) -> None:
    """Append matching columns by name; ``insertInto`` itself goes by position."""
    columns = df.sparkSession.table(name).columns
    df.select(*(f"`{c}`" for c in columns)).write.insertInto(name)


def insert_row(spark: SparkSession, name: str, /, **values) -> None:
    """One row; columns not named take their default."""
    columns = ", ".join(f"`{c}`" for c in values)
    markers = ", ".join(f":{c}" for c in values)
    spark.sql(f"INSERT INTO {name} ({columns}) VALUES ({markers})", args=values)


def insert_select(df: DataFrame, name: str) -> None:
    """Append with the frame's own column list; absent columns take defaults."""
    columns = ", ".join(f"`{c}`" for c in df.columns)
    df.sparkSession.sql(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {{rows}}", rows=df)
