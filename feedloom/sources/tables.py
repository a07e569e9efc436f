"""Warehouse tables, SQL text, inline rows, generated series."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, name: str, columns: list[str] | None = None) -> DataFrame:
    table = spark.table(name)
    return table.select(*columns) if columns else table


def read_current(spark: SparkSession, name: str) -> DataFrame:
    """The table as it is on disk now: a session remembers the file list of a
    table, and a stream or another job may have added to it since."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def query(spark: SparkSession, text: str, args: dict[str, Any] | None = None, **frames: DataFrame) -> DataFrame:
    """SQL with ``:name`` parameters; frames are usable as ``{name}``."""
    return spark.sql(text, args=args, **frames)


def query_file(spark: SparkSession, path: str, args: dict[str, Any] | None = None, **frames: DataFrame) -> DataFrame:
    """The query that a file holds, wherever Spark can read it."""
    return query(spark, spark.read.text(path, wholetext=True).first()[0], args, **frames)


def inline_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def daily_dates(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per day from ``start`` to ``end`` (dates) of each bounds row."""
    return bounds.select(F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias("date"))


def daily_series(dates: DataFrame, measures: dict[str, tuple[int, int]], seed: int = 42) -> DataFrame:
    """Attach reproducible integer measures in [low, high) per date."""

    def measure(name: str, low: int, high: int) -> Column:
        noise = F.xxhash64(F.col("date"), F.lit(name), F.lit(seed))
        return (F.pmod(noise, F.lit(high - low)) + low).cast("int").alias(name)

    return dates.select("date", *(measure(n, lo, hi) for n, (lo, hi) in measures.items()))


def year_series(spark: SparkSession, year: int, seed: int = 42) -> DataFrame:
    """The report series: sales, temperature and web traffic of one year."""
    bounds = spark.range(1).select(
        F.make_date(F.lit(year), F.lit(1), F.lit(1)).alias("start"),
        F.make_date(F.lit(year), F.lit(12), F.lit(31)).alias("end"),
    )
    # Ranges of the three measures.
    ranges = {"sales": (1000, 5000), "temperature": (-1000, 3500), "website_traffic": (500, 10000)}
    series = daily_series(daily_dates(bounds), ranges, seed)
    return series.withColumn("temperature", F.col("temperature") / 100.0)
