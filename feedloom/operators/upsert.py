"""Keyed loads: first-per-key, deltas, insert-if-absent, last-write-wins.

Skew: per-key choices are written as ``row_number() = 1``. Spark plans that with
a group limit before the shuffle, so a key holding a third of the rows leaves
each task as a single row. Deltas move key columns only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.session import materialize
from feedloom.sources.tables import read_current


def row_hash(df: DataFrame) -> Column:
    """Content hash that settles order among otherwise equal rows."""
    return F.xxhash64(*(f"`{c}`" for c in sorted(df.columns)))


def pick_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def first_per_key(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Keep the first row of each key by ``order``, then by content."""
    return pick_per_key(df, keys, [F.col(o).asc() for o in order or []] + [row_hash(df).asc()])


def first_by_value(df: DataFrame, value: str, order: str) -> DataFrame:
    """Keep the row with the least ``order`` (unique) of each long ``value``. Only
    digests and order values are grouped; the rows themselves are not sorted."""
    firsts = df.groupBy(F.sha2(F.col(value).cast("binary"), 256)).agg(F.min(order).alias(order)).select(order)
    return df.join(firsts, order, "left_semi")


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return pick_per_key(df, keys, [F.col(o).desc() for o in order] + [row_hash(df).asc()])


def split_null_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(usable rows, rows whose key holds a NULL)."""
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    return df.filter(~null_key), df.filter(null_key)


def delta(source: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``source`` not yet in ``done``. NULLs in ``done`` match nothing."""
    return source.join(done.select(*keys), keys, "left_anti")


def delta_not_in(source: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Literal ``NOT IN``: a single NULL in ``done`` empties the result.

    Same meaning as the null-aware anti join, but that join can only broadcast
    its right side; an anti join plus one NULL test scales with ``done``.
    """
    rest = delta(source, done, [key])
    state = done.agg(F.struct(
        (F.count(F.lit(1)) > 0).alias("any_row"), (F.count_if(F.col(key).isNull()) > 0).alias("has_null")
    )).scalar()
    return rest.filter(~state["has_null"] & (F.col(key).isNotNull() | ~state["any_row"]))


def new_rows(stage: DataFrame, batch: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Batch rows to insert: first of each key, absent from ``stage``.

    The stored keys that the batch has are found first, which lets Spark scan the
    stored table and broadcast a small batch, and only those few are taken away
    from the batch.
    """
    fresh = first_per_key(split_null_keys(batch, keys)[0], keys, order)
    hits = stage.select(*keys).join(batch.select(*keys), keys, "left_semi")
    return fresh.join(hits, keys, "left_anti")


def insert_if_absent(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    keys: list[str],
    order: list[str] | None = None,
    rejects: str | None = None,
    written: bool = False,
) -> None:
    """Append the batch rows whose key is new; stored rows never change.

    Safe to repeat: a second run of the same batch adds nothing, neither rows nor
    rejects. Rows with a NULL key go to the ``rejects`` table when one is named;
    without it they raise, as a keyed table would. The batch is written once and
    read from there, whatever stands above it, unless it is ``written`` already.
    """
    stage = read_current(spark, table)
    columns = stage.columns
    batch = batch.select(*(F.col(f"`{c}`").cast(stage.schema[c].dataType).alias(c) for c in columns))
    if not written:
        batch = materialize(batch, "batch")
    bad = split_null_keys(batch, keys)[1].withColumn("_row", row_hash(batch))
    if not bad.isEmpty():  # reads the key columns of what was written
        if not rejects:
            raise ValueError(f"{table}: NULL in key {keys}")
        kept = read_current(spark, rejects)
        known = kept.select(row_hash(kept.select(*columns)).alias("_row"))
        # insertInto leaves the target unchanged for an empty frame.
        bad.join(known, "_row", "left_anti").dropDuplicates(["_row"]).select(*(f"`{c}`" for c in columns)).write.insertInto(rejects)
    new_rows(stage, batch, keys, order).select(*(f"`{c}`" for c in columns)).write.insertInto(table)


def upsert_latest(current: DataFrame, batch: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Last write wins: batch rows replace current rows of the same key; inside
    the batch the highest ``order`` wins."""
    both = current.withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)))
    return last_per_key(both, keys, ["_new", *(order or [])]).drop("_new")


def replace_groups(current: DataFrame, batch: DataFrame, group: list[str]) -> DataFrame:
    """All rows of a group give way when the batch holds that group, so a group
    that shrinks leaves nothing stale behind."""
    return delta(current, batch.select(*group).distinct(), group).unionByName(batch)
