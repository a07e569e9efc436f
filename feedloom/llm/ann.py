"""Nearest neighbours by a block matrix join over int8 tiles.

Vectors are packed into tiles of many rows. A tile of candidates meets a block of
queries in one matrix product of int8 codes, which gives every distance with a
bound on its error. Only pairs whose lower bound can still be among a query's k
nearest are computed from the original vectors; the result is exact.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import materialize

TILE_ROWS = 4096
BLOCK_QUERIES = 1024
#: Candidates of a group; a block keeps its heaps from tile to tile of a group.
GROUP_ROWS = 32 * TILE_ROWS
#: int8 codes multiply exactly in float32 for this many components at a time.
_EXACT_DIMS = 1024
#: Relative room for rounding in the bounds; the last word has the exact distance.
_SLACK = 1e-9


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col("v")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & v.isNotNull() & ~F.coalesce(odd, F.lit(True)) & F.exists(v, lambda x: x != 0.0))


def _tiles(rows: int):
    """Rows (id, v) to tiles (dim, n, ids, data); ids are distinct within a tile."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column("id"), dtype=np.int64)
            lists = batch.column("v")
            ends = np.asarray(lists.offsets, dtype=np.int64)
            flat, lengths = np.asarray(lists.values, dtype=np.float64), np.diff(ends)
            layers = np.zeros(len(ids), np.int64)  # how often an id came before in the batch
            order = np.argsort(ids, kind="stable")
            fresh = np.append(True, ids[order][1:] != ids[order][:-1])
            firsts = np.flatnonzero(fresh)
            layers[order] = np.arange(len(ids)) - firsts[np.cumsum(fresh) - 1]
            out: list[tuple[int, int, bytes, bytes]] = []
            for dim, layer in sorted(set(zip(lengths.tolist(), layers.tolist()))):
                mine = np.flatnonzero((lengths == dim) & (layers == layer))
                for first in range(0, len(mine), rows):
                    some = mine[first:first + rows]
                    data = flat[ends[some][:, None] + np.arange(dim)]
                    out.append((dim, len(some), ids[some].tobytes(), data.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int32()),
                 pa.array([r[2] for r in out], pa.binary()), pa.array([r[3] for r in out], pa.binary())],
                ["dim", "n", "ids", "data"])
    return run


_TILE = "dim int, n int, ids binary, data binary"


class _Codes:
    """int8 codes of the rows of a matrix, with scale, lengths and residual lengths."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows = rows
        # Each row is about code * scale.
        peak = np.abs(rows).max(axis=1)
        self.scale = np.maximum(peak / 127.0, np.finfo(np.float64).tiny)
        codes = np.rint(rows / self.scale[:, None])
        near = codes * self.scale[:, None]
        self.codes = codes.astype(np.int8)
        self.norm2 = (rows * rows).sum(axis=1)
        self.norm, self.near_norm = np.sqrt(self.norm2), np.sqrt((near * near).sum(axis=1))
        self.residual = np.sqrt(((rows - near) ** 2).sum(axis=1))


def _bounds(a: _Codes, b: _Codes) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of squared distances between the rows of a and b.

    With x = x' + r for its code x' and residual r, the product of x and y differs
    from that of x' and y' by at most |r_x| |y| + |x'| |r_y|."""
    product = np.zeros((len(a.rows), len(b.rows)))
    for first in range(0, a.rows.shape[1], _EXACT_DIMS):
        part = slice(first, first + _EXACT_DIMS)
        product += a.codes[:, part].astype(np.float32) @ b.codes[:, part].astype(np.float32).T
    product *= a.scale[:, None] * b.scale[None, :]
    error = a.residual[:, None] * b.norm[None, :] + a.near_norm[:, None] * b.residual[None, :]
    both = a.norm2[:, None] + b.norm2[None, :]
    error += _SLACK * both
    middle = both - 2.0 * product
    return (np.nan_to_num(middle - 2.0 * error, nan=-np.inf, posinf=np.inf, neginf=-np.inf),
            np.nan_to_num(middle + 2.0 * error, nan=np.inf, posinf=np.inf, neginf=-np.inf))


def _exact(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Distances of row pairs, summed component after component."""
    return np.sqrt(np.cumsum((queries - rows) ** 2, axis=1)[:, -1])


class _Heaps:
    """The k nearest of each query of one block, over all tiles seen."""

    def __init__(self, ids: np.ndarray, data: np.ndarray, k: int) -> None:
        self.ids, self.codes, self.k = ids, _Codes(data), k
        self.worst = np.full(len(ids), np.inf)  # distance of the k-th nearest so far
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in ids]  # (-distance, -id): the worst on top
        self.held: list[dict[int, float]] = [{} for _ in ids]

    def add(self, ids: np.ndarray, data: np.ndarray) -> None:
        tile = _Codes(data)
        low, high = _bounds(self.codes, tile)
        own = self.ids[:, None] == ids[None, :]
        high[own] = np.inf
        limit = self.worst ** 2 * (1 + _SLACK)
        if len(ids) > self.k:
            limit = np.minimum(limit, np.partition(high, self.k - 1, axis=1)[:, self.k - 1])
        query, row = np.nonzero((low <= limit[:, None]) & ~own)
        for first in range(0, len(query), 1 << 16):
            q, r = query[first:first + (1 << 16)], row[first:first + (1 << 16)]
            scores = _exact(self.codes.rows[q], data[r])
            close = scores <= self.worst[q]
            for i, score, vec in zip(q[close].tolist(), scores[close].tolist(), ids[r[close]].tolist()):
                self._push(i, score, vec)

    def _push(self, i: int, score: float, vec: int) -> None:
        heap, held = self.heaps[i], self.held[i]
        if vec in held:  # another row of the same id
            if score >= held[vec]:
                return
            heap.remove((-held[vec], -vec))
            heapq.heapify(heap)
        elif len(heap) == self.k:
            if (-score, -vec) <= heap[0]:
                return
            held.pop(-heapq.heappop(heap)[1])
        heapq.heappush(heap, (-score, -vec))
        held[vec] = score
        if len(heap) == self.k:
            self.worst[i] = -heap[0][0]

    def rows(self) -> list[tuple[int, int, float]]:
        return [(int(q), -v, -s) for q, heap in zip(self.ids, self.heaps) for s, v in heap]


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(heaps: _Heaps) -> pa.RecordBatch:
            rows = heaps.rows()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.float64())], ["query_id", "vec_id", "score"])

        current, heaps = None, None  # rows come sorted by block: one block's heaps at a time
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != current:
                    if heaps:
                        yield found(heaps)
                    current = row["block"]
                    heaps = _Heaps(np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["q_data"]).reshape(-1, row["dim"]), k)
                heaps.add(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["data"]).reshape(-1, row["dim"]))
        if heaps:
            yield found(heaps)
    return run


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    tile_rows: int = TILE_ROWS, block_queries: int = BLOCK_QUERIES, group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest other rows of each query.

    ``is_query`` is a condition on the column ``id`` (the row's id). ``score`` is
    the Euclidean distance in double precision; ties go to the smaller id. Every
    group of ``group_rows`` candidates meets every block of queries under the
    group's key of a shuffled join: the tiles are shuffled once, the blocks once per
    group. Neither side is broadcast or collected, and a task works on one block
    and one tile at a time. Where a query has fewer candidates it gets all.

    Vectors that are null, zero, empty or hold null or non-finite components take
    no part, nor do rows with a null id; vectors of other lengths than the query's
    are no candidates. An id with several rows is one query per distinct row whose
    results are merged, and one candidate at its smallest distance. An empty table
    or a table without queries gives an empty result.
    """
    rows = materialize(_usable(vectors, id_col, vector_col), "vectors")
    sizes = rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(is_query.cast("long")), F.lit(0)).alias("queries")).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    groups = max(1, -(-sizes.rows // group_rows), min(cores, -(-sizes.rows // tile_rows)))
    blocks = rows.where(is_query).repartition(max(1, -(-sizes.queries // block_queries)), "id").mapInArrow(
        _tiles(block_queries), _TILE)
    asked = blocks.select(
        F.xxhash64("ids", "data").alias("block"), F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("q_group")).repartition(groups, "q_group")
    tiles = rows.mapInArrow(_tiles(min(tile_rows, max(1, -(-sizes.rows // groups)))), _TILE)
    given = tiles.withColumn("group", F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int")).repartition(groups, "group")
    # Blocks lead, so that all tiles of a group follow one block before the next.
    met = asked.hint("merge").join(given, F.col("q_group") == F.col("group")).where("dim = q_dim")
    near = met.select("block", "dim", "q_ids", "q_data", "ids", "data").mapInArrow(
        _search(k), "query_id long, vec_id long, score double")
    best = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
