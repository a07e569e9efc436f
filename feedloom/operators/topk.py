"""Top-k reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_groups(df: DataFrame, group: Column, k: int = 20, name: str = "term", count: str = "total") -> DataFrame:
    """The k most frequent values; ties by value."""
    return (
        df.groupBy(group.alias(name)).agg(F.count(F.lit(1)).alias(count))
        .orderBy(F.desc(count), F.asc(name)).limit(k)
    )


def newest(df: DataFrame, ts: str, tie: str, n: int = 10_000) -> DataFrame:
    """The n newest rows, ties by ``tie``.

    A plain sort-and-limit sends n rows of every input partition to one task.
    Counting rows per day first (a few thousand groups) gives the day on which
    the n-th newest row lies; older rows are then filtered out in the scan.
    """
    per_day = df.groupBy(F.to_date(ts).alias("d")).agg(F.count(F.lit(1)).alias("c"))
    newer = Window.orderBy(F.desc_nulls_last("d")).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("c").over(newer), F.lit(0))
    # A day counts while fewer than n rows are newer than it.
    cutoff = per_day.withColumn("before", before).filter(F.col("before") < n).agg(F.struct(
        F.min("d").cast("timestamp_ntz").alias("oldest"), (F.count_if(F.col("d").isNull()) > 0).alias("undated")
    )).scalar()
    recent = df.filter((F.col(ts) >= cutoff["oldest"]) | (F.col(ts).isNull() & cutoff["undated"]))
    return recent.orderBy(F.desc_nulls_last(ts), F.asc(tie)).limit(n)


def top_per_group(df: DataFrame, group: list[str], score: str, tie: str, k: int, rank: str = "rank") -> DataFrame:
    """Best k rows of each group with a 1-based rank."""
    window = Window.partitionBy(*group).orderBy(F.desc(score), F.asc(tie))
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)
