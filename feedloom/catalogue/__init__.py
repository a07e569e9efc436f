"""Every operator as a query over the given tables, most with the equal SQL.

Stand-ins: ``documents`` are posts (title = first line, words or
source/lang as tags), ``pages`` hold post HTML, ``events`` and ``lineitem`` give
(post, term) pairs and volume, ``embeddings`` are chunk vectors, ``labels`` the
ids already processed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from feedloom.catalogue import chunks, feeds, graphs, keyed, marts, models, pages, streams, values
from feedloom.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

_PARTS = (marts, keyed, values, pages, chunks, graphs, models, feeds, streams)


def _shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(ship_package(spark), folder)

    return run


def queries() -> dict[str, Query]:
    return {name: _shipped(q) for part in _PARTS for name, q in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.SQL.items()}
