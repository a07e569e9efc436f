"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import release  # noqa: F401


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ids_and_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns only, under fixed names, so that further columns of the input
    can neither clash with an operator's own nor travel through a shuffle. A null
    text counts as empty."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def name_of(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The id of a row as text; without an id the SHA-256 of its text, which has 64
    signs, where an id has 20 at most. A null text counts as empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return F.coalesce(F.col(id_col).cast("long").cast("string"), F.sha2(text, 256))


def unnamed(doc_ids: list, texts: list[bytes]) -> pa.Array:
    """What ``name_of`` says of rows without an id; null for the others."""
    return pa.array([hashlib.sha256(t).hexdigest() if i is None else None for i, t in zip(doc_ids, texts)], pa.string())


def held_out(id_col: str, parts: int, part: int) -> Column:
    """Whether a row belongs to the held-out fold; a null id does not."""
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % parts
    return F.coalesce(fold == part, F.lit(False))


def byte_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8 bytes, without decoding them."""
    return batch.column(name).cast(pa.binary()).to_pylist()


Batches = Iterator[pa.RecordBatch]


def give_back() -> None:
    """Return memory that Arrow and the C library hold for later to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # not glibc
        pass


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run``, after which the worker gives back the memory that it no longer
    uses. Workers outlive their tasks, and idle ones keep what they had at most."""
    def lean_run(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            give_back()
    return lean_run
