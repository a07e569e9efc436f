"""Token ids in a word-aligned binary form: Simple-8b words in blocks.

A 64-bit word has a selector in its top four bits and holds as many ids as fit at
one width. Ids too wide for any selector follow an escape word as they are. Blocks
of ``BLOCK`` ids start at a word of their own, at the offsets stored beside them,
so all blocks are encoded, and all words of one selector decoded, at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import ids_and_texts
from feedloom.llm.tokens import packed, word_bpe, word_tokenizer
from feedloom.session import scratch_path

BLOCK = 1024
END_ID = 1
#: Fixed values of the format: ids per word and bits per id, by selector.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = len(COUNTS)
#: Ids of one stored row at most, unless a single document has more.
ROW_IDS = 1 << 20


def encode(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(words, block_offsets) of unsigned ids; block b starts at word
    ``block_offsets[b]``, and a last offset gives the number of words."""
    ids = ids.astype(np.uint64)
    n = len(ids)
    if not n:
        return np.empty(0, np.uint64), np.zeros(1, np.int64)
    blocks = -(-n // block)
    in_block = np.full(blocks, block)
    in_block[-1] = n - (blocks - 1) * block
    # Selector of a word that would start at each id: the first whose count of
    # next ids, within the block, all fit its width.
    choice = np.full((blocks, block), ESCAPE, np.int8)
    padded = np.zeros(blocks * block, np.uint64)
    padded[:n] = ids
    grid = padded.reshape(blocks, block)
    left = in_block[:, None] - np.arange(block)
    # The first width that holds an id, and the widest of ever longer runs of ids.
    least = np.searchsorted(np.uint64(1) << WIDTHS.astype(np.uint64), grid.reshape(-1), side="right").astype(np.int8)
    most = least = least.reshape(blocks, block)
    for selector in range(len(COUNTS) - 1, -1, -1):
        count = int(COUNTS[selector])
        if count > block:
            break
        # Two runs of the last length, one of which ends where the new one does.
        last = block - most.shape[1] + 1
        while last < count:
            step = min(last, count - last)
            most = np.maximum(most[:, :most.shape[1] - step], most[:, step:])
            last += step
        fits = (most <= selector) & (left[:, :block - count + 1] >= count)
        choice[:, :block - count + 1][fits] = selector
    # Walk all blocks at once from word to word.
    steps = np.append(COUNTS, 1)
    at, rows, starts, owners = np.zeros(blocks, np.int64), np.arange(blocks), [], []
    while len(rows):
        starts.append(rows * block + at[rows])
        owners.append(rows)
        at[rows] += steps[choice[rows, at[rows]]]
        rows = rows[at[rows] < in_block[rows]]
    starts, owners = np.concatenate(starts), np.concatenate(owners)
    order = np.argsort(starts, kind="stable")
    starts, owners = starts[order], owners[order]
    chosen = choice.reshape(-1)[starts]
    # An escape takes a second word.
    place = np.cumsum(np.where(chosen == ESCAPE, 2, 1))
    words = np.zeros(int(place[-1]), np.uint64)
    place -= np.where(chosen == ESCAPE, 2, 1)
    for selector in range(ESCAPE):
        mine = chosen == selector
        if mine.any():
            count, width = int(COUNTS[selector]), int(WIDTHS[selector])
            word = np.full(int(mine.sum()), selector << 60, np.uint64)
            first = starts[mine]
            for k in range(count):
                word |= padded[first + k] << np.uint64(k * width)
            words[place[mine]] = word
    escaped = chosen == ESCAPE
    words[place[escaped]] = np.uint64(ESCAPE << 60)
    words[place[escaped] + 1] = padded[starts[escaped]]
    opens = np.flatnonzero(np.append(True, owners[1:] != owners[:-1]))
    return words, np.append(place[opens], len(words))


def decode(words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The n ids of ``encode``'s words."""
    if not n:
        return np.empty(0, np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)  # words after an escape; their top bits are no selector
    # A raw word never starts a block, so escapes are told apart block by block.
    lanes, ends = offsets[:-1].copy(), offsets[1:]
    if (selectors == ESCAPE).any():
        live = np.flatnonzero(lanes < ends)
        while len(live):
            escape = selectors[lanes[live]] == ESCAPE
            raw[lanes[live][escape] + 1] = True
            lanes[live] += np.where(escape, 2, 1)
            live = live[lanes[live] < ends[live]]
    steps = np.append(COUNTS, 1)
    counts = np.where(raw, 0, steps[np.minimum(selectors, ESCAPE)])
    starts = np.cumsum(counts) - counts
    ids = np.empty(n, np.uint64)
    for selector in range(ESCAPE):
        mine = (selectors == selector) & ~raw
        if mine.any():
            count, width = int(COUNTS[selector]), int(WIDTHS[selector])
            mask = np.uint64((1 << width) - 1)
            word, first = words[mine], starts[mine]
            for k in range(count):
                ids[first + k] = (word >> np.uint64(k * width)) & mask
    escapes = np.flatnonzero((selectors == ESCAPE) & ~raw)
    ids[starts[escapes]] = words[escapes + 1]
    return ids


_FILE = ("shard int, row int, start long, n_ids long, doc_ids array<long>, lengths array<long>, "
         "block_offsets binary, words binary")


def _encode_batches(path: str, blanks: bool, end_id: int, row_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer, end = word_tokenizer(path, blanks), packed([end_id])
        shard, row, start = TaskContext.get().partitionId(), 0, 0
        doc_ids, parts, size = [], [], 0

        def stored() -> pa.RecordBatch:
            words, offsets = encode(np.frombuffer(b"".join(parts), "<u4"))
            cells = [shard, row, start, size, doc_ids, [len(p) // 4 for p in parts],
                     offsets.astype("<i8").tobytes(), words.astype("<u8").tobytes()]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array([c], t) for c, t in zip(cells, types)], [c.split()[0] for c in _FILE.split(", ")])

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokenizer.encode_many(batch.column("text"))):
                ids += end
                if parts and size + len(ids) // 4 > row_ids:
                    yield stored()
                    row, start, doc_ids, parts, size = row + 1, start + size, [], [], 0
                doc_ids.append(doc_id)
                parts.append(ids)
                size += len(ids) // 4
        if parts:
            yield stored()
    return run


def write_ids(
    docs: DataFrame, out: str, path: str | None = None, end_id: int = END_ID, row_ids: int = ROW_IDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Write the token ids of all documents to the folder ``out``.

    Shard after shard and row after row the ids stand in ascending order of
    ``doc_id`` (nulls first; equal ids by the hash of their text), each document's
    followed by ``end_id``. A row of a Parquet file holds whole documents: their
    ids and lengths, the Simple-8b words, the word offset of each block, and the
    number of ids before it in its shard. Null and empty texts are the end id
    alone; an empty table writes no rows.
    """
    path, blanks = word_bpe(path)
    order = ["doc_id", F.xxhash64("text")]
    ordered = ids_and_texts(docs, id_col, text_col).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(_encode_batches(path, blanks, end_id, row_ids), _FILE).write.parquet(out)


def _decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = decode(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["block_offsets"], "<i8"), row["n_ids"])
            lengths = np.array(row["lengths"], np.int64)
            ends = np.cumsum(lengths)
            raw = memoryview(ids.astype("<u4").tobytes())
            crcs = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(row["before"] + row["start"] + ends - lengths),
                 pa.array(lengths), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_index(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, decoded from the files.

    Ids before a shard are a running sum over one number per shard, of which there
    are as many as the write had partitions."""
    stored = spark.read.parquet(out)
    before, sizes = 0, []
    for shard, n in stored.groupBy("shard").agg(F.sum("n_ids")).orderBy("shard").collect():
        sizes.append((shard, before))
        before += n
    bases = spark.createDataFrame(sizes, "shard int, before long")
    return stored.join(F.broadcast(bases), "shard").select(
        "before", "start", "n_ids", "doc_ids", "lengths", "block_offsets", "words"
    ).mapInArrow(_decode_batches, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, path: str | None = None, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the ids below the shared folder and index them from the files."""
    out = scratch_path(docs.sparkSession, "token_ids")
    write_ids(docs, out, path, end_id, id_col=id_col, text_col=text_col)
    return read_index(docs.sparkSession, out)
