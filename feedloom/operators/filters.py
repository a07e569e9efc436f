"""Row filters, lineage columns and id lookups."""

from __future__ import annotations

import datetime as dt
import uuid
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_job_id(now: dt.datetime | None = None) -> str:
    """One id per run: minute stamp plus a UUID."""
    return f"{(now or dt.datetime.now()):%Y%m%d%H%M}-{uuid.uuid4()}"


def with_lineage(df: DataFrame, job_id: str, ingest_timestamp: dt.datetime) -> DataFrame:
    """The same job id and timestamp on every row of a run."""
    return df.withColumns({
        "job_id": F.lit(job_id),
        "ingest_timestamp": F.lit(ingest_timestamp.isoformat(sep=" ")).cast("timestamp_ntz"),
    })


def drop_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows without NULL in ``columns`` (any column by default)."""
    return df.na.drop(how="any", subset=columns)


def lookup(df: DataFrame, value: Any, column: str = "id") -> DataFrame:
    """At most one row with the given id; the filter reaches the scan."""
    return df.filter(F.col(column) == F.lit(value)).limit(1)


def lookup_many(df: DataFrame, ids: DataFrame, column: str = "id") -> DataFrame:
    """Rows whose id occurs in ``ids``."""
    return df.join(ids.select(column), column, "left_semi")


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()
