"""Table profile, step counts and regression metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_profile(df: DataFrame) -> DataFrame:
    """(column, type, non_null, rows) for every column, in one pass."""
    types = dict(df.dtypes)
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count(f"`{c}`").alias(f"n_{i}") for i, c in enumerate(df.columns)),
    )
    lines = [
        F.struct(
            F.lit(c).alias("column"), F.lit(types[c]).alias("type"),
            F.col(f"n_{i}").alias("non_null"), F.col("rows"),
        )
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*lines)))


def step_count(written: DataFrame, step: str) -> DataFrame:
    """One row (step, rows) of rows that a step has written."""
    return written.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(step).alias("step"), "rows")


# Denominator floor of the percentage error.
EPSILON = 2.220446049250313e-16


def regression_metrics(y: Column, p: Column) -> list[Column]:
    """Aggregates r2, mae, mape over target ``y`` and prediction ``p``.

    R2 is written over variances, which Spark merges without cancellation, so
    large targets keep their digits.
    """
    squared_error = F.sum((y - p) * (y - p))
    total = F.var_pop(y) * F.count(y)
    return [
        (1 - squared_error / F.nullif(total, F.lit(0.0))).alias("r2"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.avg(F.abs(y - p) / F.greatest(F.abs(y), F.lit(EPSILON))).alias("mape"),
    ]


def evaluate(df: DataFrame, target: str, prediction: str, group: list[str] | None = None) -> DataFrame:
    y, p = F.col(target).cast("double"), F.col(prediction).cast("double")
    return df.groupBy(*(group or [])).agg(*regression_metrics(y, p))
