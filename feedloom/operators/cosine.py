"""Exact cosine top-k as a join of query blocks with item tiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from feedloom.operators.topk import top_per_group
from feedloom.session import materialize

#: Vectors of one tile or block.
TILE_BYTES = 4 << 20
#: Items that every query block meets under one join key.
GROUP_BYTES = 64 << 20
#: Query blocks of up to this size, as measured, go to the items; more are shuffled with them.
BROADCAST_BYTES = 16 << 20
#: Scores are compared at this many decimals, so copies of a vector tie.
SCORE_DECIMALS = 9


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _packed(df: DataFrame, id_type: str, tile_bytes: int) -> DataFrame:
    """Rows (id, v) to tiles of unit vectors of one length: dim, ids, vectors."""
    ddl = f"dim int, ids array<{id_type}>, vectors binary"
    schema = _arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            ends = np.asarray(lists.offsets, dtype=np.int64)
            flat = np.asarray(lists.values.to_numpy(zero_copy_only=False), dtype=np.float64)
            lengths = np.diff(ends)
            for dim in np.unique(lengths[lengths > 0]).tolist():
                mine = np.flatnonzero(lengths == dim)
                step = max(1, tile_bytes // (8 * dim))
                for at in range(0, len(mine), step):
                    some = mine[at:at + step]
                    rows = flat[ends[some][:, None] + np.arange(dim)]
                    norms = np.linalg.norm(rows, axis=1, keepdims=True)  # a zero vector stays zero
                    unit = np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)
                    cells = [dim], [batch.column(0).take(pa.array(some)).to_pylist()], [unit.tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, schema.types)], schema=schema)

    return df.mapInArrow(run, ddl)


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best scores, ties by id."""
    if len(scores) > k:
        keep = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]


class _Best:
    """The k best items of each query of one block, over the tiles that it has met."""

    def __init__(self, row: dict, k: int) -> None:
        self.ids, self.k = np.asarray(row["q_ids"]), k
        self.vectors = np.frombuffer(row["q_vectors"]).reshape(len(self.ids), -1)
        self.scores: list[np.ndarray] = [np.empty(0)] * len(self.ids)
        self.names: list[np.ndarray | None] = [None] * len(self.ids)
        self.worst = np.full(len(self.ids), -np.inf)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        slab = max(1, (4 << 20) // len(self.ids))
        for at in range(0, len(ids), slab):
            part = ids[at:at + slab]
            sims = np.round(self.vectors @ vectors[at:at + slab].T, SCORE_DECIMALS)
            # A query is touched only where an item reaches its k-th score.
            for i in np.flatnonzero(sims.max(axis=1) >= self.worst):
                near = np.flatnonzero(sims[i] >= self.worst[i])
                found = np.concatenate((self.scores[i], sims[i, near]))
                who = part[near] if self.names[i] is None else np.concatenate((self.names[i], part[near]))
                best = best_of(found, who, self.k)
                self.scores[i], self.names[i] = found[best], who[best]
                if len(best) == self.k:
                    self.worst[i] = self.scores[i][-1]

    def rows(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        done = [i for i, n in enumerate(self.names) if n is not None]
        if done:
            cells = (self.ids[done].repeat([len(self.names[i]) for i in done]), np.concatenate([self.names[i] for i in done]),
                     np.concatenate([self.scores[i] for i in done]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, schema.types)], schema=schema)


def _search(k: int, ddl: str, together: bool):
    """``together``: every tile meets all blocks, whose number is bounded, before the next
    tile comes; otherwise a block meets all tiles of a group before the next block comes."""
    schema = _arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], _Best] = {}
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                key = row["block"], row["group"]
                if key not in held:
                    if not together:
                        for best in held.values():
                            yield from best.rows(schema)
                        held.clear()
                    held[key] = _Best(row, k)
                ids = np.asarray(row["ids"])
                held[key].add(ids, np.frombuffer(row["vectors"]).reshape(len(ids), -1))
        for best in held.values():
            yield from best.rows(schema)

    return run


def cosine_topk(
    queries: DataFrame, corpus: DataFrame, k: int, query_id: str = "query_id", query_vector: str = "vector",
    item_id: str = "id", item_vector: str = "values",
) -> DataFrame:
    """Exact k nearest items per query: (query_id, item_id, score, rank); ties by item id.

    Queries become blocks, items tiles, both of bounded bytes and packed in the tasks.
    The blocks are written first, so that their size is known. Few of them go to the
    items, which are scanned in place and not shuffled. More of them meet groups of
    tiles in a shuffled join: every tile is shuffled once, every block once per group,
    and the driver sees neither. A task keeps k candidates per query, and only those are
    shuffled. Null and empty vectors take no part; a zero vector scores 0; vectors of
    other lengths than the query's are no candidates.
    """
    spark = corpus.sparkSession
    q_type, i_type = dict(queries.dtypes)[query_id], dict(corpus.dtypes)[item_id]
    ddl = f"query_id {q_type}, item_id {i_type}, score double"
    asked = queries.select(F.col(query_id).alias("id"), F.col(query_vector).alias("v")).na.drop()
    items = corpus.select(F.col(item_id).alias("id"), F.col(item_vector).alias("v")).na.drop()
    # Queries of many small tasks would make many small blocks.
    blocks = _packed(asked.hint("rebalance"), q_type, TILE_BYTES).select(
        F.monotonically_increasing_id().alias("block"), "dim", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    blocks = materialize(blocks, "query_blocks")
    size = blocks.agg(F.coalesce(F.sum(F.length("q_vectors")), F.lit(0))).first()[0]
    tiles, groups = _packed(items, i_type, TILE_BYTES), 1
    together = size <= BROADCAST_BYTES
    if not together:
        tiles = materialize(tiles, "item_tiles")
        given = tiles.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("vectors")), F.lit(0)).alias("bytes")).first()
        groups = max(1, -(-given.bytes // GROUP_BYTES), min(spark.sparkContext.defaultParallelism, given.n))
    tiles = tiles.withColumn("group", F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int"))
    blocks = blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    if together:
        met = tiles.join(F.broadcast(blocks), ["group", "dim"])
    else:
        # Blocks lead, so that all tiles of a group follow one block before the next.
        met = blocks.repartition(groups, "group", "dim").hint("merge").join(tiles.repartition(groups, "group", "dim"), ["group", "dim"])
    found = met.select("block", "group", "q_ids", "q_vectors", "ids", "vectors").mapInArrow(_search(k, ddl, together), ddl)
    return top_per_group(found, ["query_id"], "score", "item_id", k)
