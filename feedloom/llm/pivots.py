"""Vector codes by product quantisation in whole numbers, with pivots (LAESA).

Distances from every part to a few fixed pivots are computed once and stored. In each
round the distances from the pivots to the entries of a codebook give, by the triangle
inequality, lower bounds of the distance from a part to an entry. Entries are tried in
the order of these bounds, and only while a bound does not exceed the best distance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from feedloom.session import materialize

SCALE = 4096
PARTS, ENTRIES, ROUNDS, PIVOTS = 8, 16, 6, 4
#: Components up to here have squared distances that fit 64 bits.
_SMALL, _SMALL_PART = 1 << 24, 1 << 12
#: Stored distances are float32; bounds give way by this share of both distances.
_SLACK = 1e-6
#: Sums travel as digits to this base, so that they fit a column whatever the components.
_DIGIT = 1 << 40


def whole(rows: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of finite doubles, exact: 64-bit numbers, or Python's where large."""
    if rows.size == 0 or np.abs(rows).max() < _SMALL // SCALE:
        return np.floor(rows * SCALE).astype(np.int64)
    big = [int(x) * SCALE if abs(x) >= 2.0 ** 53 else int(np.floor(x * SCALE)) for x in rows.ravel().tolist()]
    out = np.empty(len(big), object)
    out[:] = big
    return out.reshape(rows.shape)


def bounds_of(dim: int, parts: int) -> list[tuple[int, int]]:
    """Consecutive parts of a vector; equal ones where the length allows it."""
    return [(i * dim // parts, (i + 1) * dim // parts) for i in range(parts)]


def _fit(*arrays: np.ndarray) -> list[np.ndarray]:
    """All as 64-bit numbers where squared distances between them fit, else as Python's."""
    small = all(a.dtype != object and (a.size == 0 or (np.abs(a).max() <= _SMALL and a.shape[-1] <= _SMALL_PART)) for a in arrays)
    return [a if small else a.astype(object) for a in arrays]


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows."""
    x, y = _fit(x, y)
    return ((x - y) ** 2).sum(axis=-1)


def far(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows to pivots, nearly exact; infinite where a double is too small."""
    out = np.empty((len(x), len(pivots)))
    for k, pivot in enumerate(pivots):
        exact = squared(x, np.broadcast_to(pivot, x.shape))
        out[:, k] = [_root(d) for d in exact] if exact.dtype == object else np.sqrt(exact.astype(np.float64))
    return out


def _root(square: int) -> float:
    try:
        return float(square) ** 0.5
    except OverflowError:
        return float("inf")


def assign(x: np.ndarray, entries: np.ndarray, to_pivots: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest entry of each row, its exact squared distance, distances evaluated);
    ties go to the lower entry."""
    between = far(entries, pivots)
    lower = np.zeros((len(x), len(entries)))
    with np.errstate(invalid="ignore", over="ignore"):
        for k in range(len(pivots)):
            one, other = to_pivots[:, k, None].astype(np.float64), between[None, :, k]
            bound = np.abs(one - other) - _SLACK * (one + other) - 1.0
            np.maximum(lower, np.where(np.isfinite(bound), bound, 0.0), out=lower)
    order = np.argsort(lower, axis=1, kind="stable")
    best = order[:, 0].copy()
    distance = squared(x, entries[best])
    evaluated, alive = len(x), np.arange(len(x))
    for turn in range(1, len(entries)):
        entry = order[alive, turn]
        reach = lower[alive, entry]
        near = np.array([int(b) ** 2 <= d for b, d in zip(reach, distance[alive])], bool) if distance.dtype == object else \
            reach * reach * (1 - 1e-12) <= distance[alive]
        alive, entry = alive[near], entry[near]  # bounds only grow with the turns
        if not len(alive):
            break
        evaluated += len(alive)
        exact = squared(x[alive], entries[entry])
        better = (exact < distance[alive]) | ((exact == distance[alive]) & (entry < best[alive]))
        best[alive[better]], distance[alive[better]] = entry[better], exact[better]
    return best, distance, evaluated


def _digits(value: int) -> Iterator[tuple[int, int]]:
    place = 0
    while not -_DIGIT < value < _DIGIT:
        value, digit = divmod(value, _DIGIT)
        yield place, digit
        place += 1
    yield place, value


class _Batch:
    """The vectors of a batch that have the length of the codebooks."""

    def __init__(self, batch: pa.RecordBatch, dim: int) -> None:
        data = batch.column("data").to_pylist()
        self.mine = np.array([i for i, d in enumerate(data) if len(d) == 8 * dim], np.int64)
        self.rows = np.frombuffer(b"".join(data[i] for i in self.mine)).reshape(len(self.mine), dim)
        self.batch = batch

    def far(self, parts: int) -> np.ndarray:
        stored = self.batch.column("far").to_pylist()
        return np.frombuffer(b"".join(stored[i] for i in self.mine), np.float32).reshape(len(self.mine), parts, -1)


def _measured(dim: int, books: list[np.ndarray], pivots: int):
    """Vectors with the distances of their parts to the pivots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("data")
            flat, ends = np.asarray(lists.values, dtype=np.float64), np.asarray(lists.offsets, dtype=np.int64)
            data = pa.array([flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary())
            some = _Batch(pa.RecordBatch.from_arrays([data], ["data"]), dim)
            x = whole(some.rows)
            away: list[bytes | None] = [None] * batch.num_rows
            if len(x):
                with np.errstate(over="ignore"):
                    each = np.stack([far(x[:, a:b], book[:pivots]) for (a, b), book in zip(bounds_of(dim, len(books)), books)], axis=1).astype(np.float32)
                for i, row in zip(some.mine.tolist(), each):
                    away[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), data, pa.array(away, pa.binary())],
                                             ["vec_id", "label", "data", "far"])
    return run


def _totals(dim: int, books: list[np.ndarray], pivots: list[np.ndarray]):
    """Per task, part and entry: how many parts it has and the sum of each component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(book.shape, object) for book in books]
        counts = [np.zeros(len(book), np.int64) for book in books]
        for batch in batches:
            some = _Batch(batch, dim)
            if not len(some.mine):
                continue
            x, away = whole(some.rows), some.far(len(books))
            for part, (a, b) in enumerate(bounds_of(dim, len(books))):
                best, _, _ = assign(x[:, a:b], books[part], away[:, part], pivots[part])
                counts[part] += np.bincount(best, minlength=len(books[part]))
                for entry in np.unique(best):
                    sums[part][entry] += x[best == entry, a:b].sum(axis=0).astype(object)
        out = []
        for part, (number, total) in enumerate(zip(counts, sums)):
            for entry in np.flatnonzero(number).tolist():
                out.append((part, entry, -1, 0, int(number[entry])))
                out += [(part, entry, at, place, digit) for at, value in enumerate(total[entry].tolist()) for place, digit in _digits(value)]
        columns = list(zip(*out)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int32()] * 4 + [pa.int64()])],
                                         ["part", "entry", "at", "place", "value"])
    return run


def _coded(dim: int, books: list[np.ndarray], pivots: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = _Batch(batch, dim)
            codes: list[str | None] = [None] * batch.num_rows
            errors: list[int | None] = [None] * batch.num_rows
            if len(some.mine):
                x, away = whole(some.rows), some.far(len(books))
                found = [assign(x[:, a:b], books[part], away[:, part], pivots[part]) for part, (a, b) in enumerate(bounds_of(dim, len(books)))]
                bests = np.stack([f[0] for f in found], axis=1).tolist()
                totals = sum(f[1].astype(object) for f in found).tolist()
                for i, best, total in zip(some.mine.tolist(), bests, totals):
                    codes[i] = "".join(f"{e:02x}" for e in best)
                    errors[i] = int(total) if total < 1 << 63 else None
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                                             ["vec_id", "label", "code", "error"])
    return run


def _renewed(rows: DataFrame, dim: int, books: list[np.ndarray], pivots: list[np.ndarray]) -> list[np.ndarray]:
    """Codebooks after one round: a bounded number of totals comes to the driver."""
    totals = rows.mapInArrow(_totals(dim, books, pivots), "part int, entry int, at int, place int, value long")
    got: dict[tuple[int, int, int], int] = {}
    for r in totals.groupBy("part", "entry", "at", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        key = (r.part, r.entry, r.at)
        got[key] = got.get(key, 0) + int(r.value) * _DIGIT ** r.place
    after = []
    for part, book in enumerate(books):
        rows_ = []
        for entry, old in enumerate(book.tolist()):
            number = got.get((part, entry, -1))
            rows_.append([got[part, entry, at] // number for at in range(len(old))] if number else old)
        after.append(_integers(rows_, book.shape))
    return after


def _integers(rows: list, shape: tuple[int, ...]) -> np.ndarray:
    out = np.empty(shape, object)
    for i, row in enumerate(rows):
        out[i, :] = row
    return out.astype(np.int64) if out.size == 0 or max(abs(v) for v in out.ravel()) <= _SMALL else out


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, pivots: int = PIVOTS,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256), one row per kept vector.

    Components become floor(4096 x). Each of ``parts`` consecutive parts has a codebook
    that starts as that part of the ``entries`` vectors with the smallest ids and is
    renewed ``rounds`` times by the floored means of the parts nearest to each entry.
    ``code`` has two hex digits per part, ``error`` is the sum of the squared
    distances, ``label_error`` its sum over all rows of the same label (nulls
    together). All of it is exact, whatever the size of the components.

    The vectors are written once, with the distances of their parts to the fixed
    pivots, the first ``pivots`` starting entries; each round is one scan in which every
    task sends one sum per component of each entry. Only these sums, whose number does
    not depend on the rows, come to the driver.

    Null vectors and those with null or non-finite components are left out; zero
    vectors take part. Null ids come last in the choice of the starting entries, equal
    ids by their vectors; with fewer rows the codebooks have fewer entries. A length
    that the parts do not divide gives parts of unequal length. Vectors of another
    length than that of the smallest id keep their row, with null code and error. An error
    beyond 64 bits is null, and so is the error of its label. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    v = F.col("data")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("data"))
    kept = kept.where(v.isNotNull() & ~odd)
    firsts = [r.data for r in kept.orderBy(F.col("vec_id").asc_nulls_last(), "data").limit(entries).collect()]
    label = kept.schema["label"]
    if not firsts:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    dim = len(firsts[0])
    start = whole(np.array([f for f in firsts if len(f) == dim], np.float64).reshape(-1, dim))
    books = [start[:, a:b] for a, b in bounds_of(dim, parts)]
    fixed = [book[:pivots] for book in books]

    shape = StructType([StructField("vec_id", LongType()), label, StructField("data", BinaryType()), StructField("far", BinaryType())])
    rows = materialize(kept.mapInArrow(_measured(dim, books, pivots), shape), "parts")
    for _ in range(rounds):
        books = _renewed(rows, dim, books, fixed)
    shape = StructType([StructField("vec_id", LongType()), label, StructField("code", StringType()), StructField("error", LongType())])
    coded = materialize(rows.mapInArrow(_coded(dim, books, fixed), shape), "codes")
    lost = F.count_if(F.col("code").isNotNull() & F.col("error").isNull()) > 0
    total = F.sum(F.col("error").cast("decimal(20,0)"))
    by_label = materialize(coded.groupBy(F.col("label").alias("l")).agg(
        F.when(~lost, total).try_cast("long").alias("label_error")), "label_errors")
    text = ",".join(str(c) for book in books for entry in book.tolist() for c in entry)
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("l"))).select(
        "vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256"))


def codes_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same over ``embeddings`` in plain SQL, by comparing every part with every entry;
    for vectors of one length that the parts divide."""
    steps = [f"""
        kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT)) AS e
            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS MATERIALIZED (
            SELECT r, p, e[p * (len(e) // {parts}) + 1 : (p + 1) * (len(e) // {parts})] AS x FROM kept, range({parts}) t(p)),
        b0 AS MATERIALIZED (
            SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id, r) - 1 AS j, x AS c FROM parts JOIN kept USING (r)
            QUALIFY j < {entries})"""]
    for n in range(rounds + 1):
        steps.append(f"""
        a{n} AS MATERIALIZED (
            SELECT r, parts.p, x, min(struct_pack(d := list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))), j := j)) AS best
            FROM parts JOIN b{n} ON parts.p = b{n}.p GROUP BY ALL)""")
        if n < rounds:
            steps.append(f"""
        s{n} AS (SELECT p, best.j AS j, i, CAST(floor(CAST(sum(x[i]) AS DOUBLE) / count(*)) AS BIGINT) AS m
                 FROM a{n}, range(1, len(x) + 1) t(i) GROUP BY p, best.j, i),
        b{n + 1} AS MATERIALIZED (
            SELECT b.p, b.j, coalesce(s.c, b.c) AS c FROM b{n} b
            LEFT JOIN (SELECT p, j, list(m ORDER BY i) AS c FROM s{n} GROUP BY p, j) s ON b.p = s.p AND b.j = s.j)""")
    last = f"a{rounds}"
    return "WITH " + ",".join(steps) + f""",
        coded AS (SELECT r, string_agg(printf('%02x', best.j), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM {last} GROUP BY r)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, j)) FROM b{rounds}) AS codebooks_sha256
        FROM coded JOIN kept USING (r)
    """
