"""Packing of token sequences by bounded-space online best fit."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import ids_and_texts, lean
from feedloom.llm.tokens import byte_bpe, packed, word_tokenizer
from feedloom.session import materialize

SEQUENCE = 1024
OPEN_BINS = 2048
END_ID = 2
#: Partitions whose open bins are brought together in the second round.
MERGED = 16


class BestFit:
    """Online best fit with at most ``open_bins`` open bins.

    ``free`` is a bitset: bit f is set while an open bin has f places free. The
    lowest set bit at or above an item's size is the best fit; the lowest set bit
    of all is the fullest bin, which is closed when one bin too many is open.
    """

    def __init__(self, capacity: int, open_bins: int, first: int = 0) -> None:
        self.capacity, self.open_bins, self.next = capacity, open_bins, first
        self.free, self.bins, self.open = 0, [[] for _ in range(capacity + 1)], 0

    def _take(self, space: int) -> int:
        stack = self.bins[space]
        chosen = stack.pop()
        if not stack:
            self.free &= ~(1 << space)
        self.open -= 1
        return chosen

    def place(self, size: int) -> tuple[int, int]:
        """(bin, offset) of an item of 1 to ``capacity``."""
        fitting = self.free >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            chosen = self._take(space)
        else:
            space, chosen = self.capacity, self.next
            self.next += 1
        left = space - size
        if left:
            if self.open == self.open_bins:
                self._take((self.free & -self.free).bit_length() - 1)
            self.bins[left].append(chosen)
            self.free |= 1 << left
            self.open += 1
        return chosen, self.capacity - space

    def still_open(self) -> set[int]:
        return {b for stack in self.bins for b in stack}


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: as they are up to ``size``, else
    pieces of ``size``, of which only the first may be shorter."""
    first = n % size or size
    return [(0, first)] + [(s, size) for s in range(first, n, size)]


_COLUMNS = ("doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset")
_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, part int"


def _pack(path: str, blanks: bool, end_id: int, size: int, open_bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, end = word_tokenizer(path, blanks), packed([end_id])
        part = TaskContext.get().partitionId()
        fit = BestFit(size, open_bins, part << 32)
        for batch in batches:
            pieces = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokenizer.encode_many(batch.column("text"))):
                ids += end
                for number, (start, length) in enumerate(cut(len(ids) // 4, size)):
                    pieces.append((doc_id, number, start, length, zlib.crc32(ids[4 * start:4 * (start + length)])))
            pieces.sort(key=lambda p: -p[3])  # large pieces of a batch first leave small ones to fill up
            placed = [(*p, *fit.place(p[3])) for p in pieces]
            columns = list(zip(*placed)) if placed else [[]] * len(_COLUMNS)
            types = [pa.int64(), pa.int32()] + [pa.int64()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)] + [pa.array([part] * len(placed), pa.int32())],
                [*_COLUMNS, "part"])
    return run


def _merge(size: int, open_bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        # Bins of this round get numbers of their own, beyond those of the first.
        fit = BestFit(size, open_bins, (1 << 62) + (part << 32))
        for batch in batches:
            rows = sorted(zip(batch.column("used").to_pylist(), batch.column("bin").to_pylist()), reverse=True)
            placed = [(b, *fit.place(used)) for used, b in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in placed], pa.int64()) for i in range(3)], ["bin", "into", "base"])
    return run


def pack(
    docs: DataFrame, path: str | None = None, end_id: int = END_ID, size: int = SEQUENCE, open_bins: int = OPEN_BINS,
    merged: int = MERGED, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece.

    Each document is its token ids and ``end_id``. Every task packs the pieces of
    its own rows, so no text is shuffled and no task holds more than one batch and
    its open bins. Bins that are not full at the end of a task are packed again as
    whole items, those of ``merged`` tasks together, by the same best fit; only
    their sizes move. Sequence numbers are unique and otherwise arbitrary; offsets
    are gapless from 0 within a sequence.

    Null and empty texts are one piece of the end id alone; null ids and repeated
    rows are packed like any other row; an empty table gives an empty result.
    """
    path, blanks = byte_bpe(path)
    first = ids_and_texts(docs, id_col, text_col).mapInArrow(lean(_pack(path, blanks, end_id, size, open_bins)), _SCHEMA)
    first = materialize(first, "pieces")
    bins = first.groupBy("bin", "part").agg(F.sum("length").alias("used")).where(F.col("used") < size)
    group = F.floor(F.col("part") / merged)
    again = bins.repartition(group).sortWithinPartitions(F.desc("used"), "bin").select("bin", "used")
    moved = materialize(again.mapInArrow(_merge(size, open_bins), "bin long, into long, base long"), "bins")
    return first.join(moved, "bin", "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.coalesce("into", "bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"),
    )
