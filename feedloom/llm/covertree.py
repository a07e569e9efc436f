"""Near-duplicate vectors by dual traversal of cover trees.

On unit vectors a cosine of at least c is a distance of at most sqrt(2 - 2c). The
levels of a cover tree have halving radii and are nested: the first child of a node
has the node's own centre. Two trees are walked together. A pair of nodes is left out
when even their nearest points must be too far apart, taken whole when even their
farthest points must be near enough, and opened otherwise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.components import connected_components
from feedloom.session import materialize

COSINE = 0.95
#: Vectors of one tree; a task holds two trees.
TILE_BYTES = 8 << 20
#: Sample for the upper tree, which only orders the vectors; results do not depend on it.
SAMPLE_BYTES, SAMPLE_ROWS = 4 << 20, 2048
#: Rows of tree roots that meet in one task, and partners of a tree under one join key.
ROOT_ROWS, PARTNERS = 1024, 64
#: Nodes with so few points are not divided.
LEAF_POINTS = 32
_BLOCK = 1024
#: Distances from products of unit vectors are this exact.
_SLACK = 1e-6


def _distance(products: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * products))


def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, which changes no cosine and keeps squares finite."""
    _, exponent = np.frexp(np.abs(rows).max(axis=1))
    return np.ldexp(rows, -exponent[:, None])


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


class CoverTree:
    """Node i has the points ``order[start[i]:end[i]]``, all within ``radius[i]`` of the
    point ``centre[i]``, and the children ``first[i]:last[i]`` (none: a leaf). Children
    come by falling radius, so that single points are together."""

    def __init__(self, points: np.ndarray) -> None:
        n = len(points)
        self.order = np.arange(n)
        self.start, self.end, self.centre, self.radius, self.first, self.last = [0], [n], [0], [0.0], [0], [0]
        away = _distance(points @ points[0])
        self.radius[0] = float(away.max())
        pending = [(0, away)]
        while pending:
            node, away = pending.pop()
            if self.end[node] - self.start[node] <= LEAF_POINTS or self.radius[node] <= _SLACK:
                continue
            members = self.order[self.start[node]:self.end[node]]
            half = 2.0 ** (math.ceil(math.log2(self.radius[node])) - 1)
            groups = self._cover(points, members, self.centre[node], away, half)
            self.first[node] = len(self.start)
            at = self.start[node]
            for centre, mine, near in groups:
                child = len(self.start)
                self.order[at:at + len(mine)] = mine
                for column, value in ((self.start, at), (self.end, at + len(mine)), (self.centre, centre),
                                      (self.radius, float(near.max())), (self.first, 0), (self.last, 0)):
                    column.append(value)
                at += len(mine)
                if len(mine) > LEAF_POINTS:
                    pending.append((child, near))
            self.last[node] = len(self.start)

    @staticmethod
    def _cover(points, members, centre, away, half):
        """(centre, members, their distances) of balls of radius ``half`` whose centres
        are more than ``half`` apart; the node's own centre is the first of them."""
        inside = away <= half
        balls = [(centre, members[inside], away[inside])]
        rest = members[~inside]
        least = 1.0 - half * half / 2.0
        while len(rest):
            some = points[rest[:256]]
            near = some @ some.T >= least
            free, chosen = np.ones(len(some), bool), []
            for i in range(len(some)):
                if free[i]:
                    chosen.append(i)
                    free &= ~near[i]
                    free[i] = False
            centres = rest[chosen]
            products = points[rest] @ points[centres].T
            products[chosen, np.arange(len(chosen))] = np.inf  # a centre stays in its own ball
            nearest = products.argmax(axis=1)
            product = products[np.arange(len(rest)), nearest]
            covered = (product >= least) | (np.arange(len(rest)) < len(some))
            distance = np.where(np.isinf(product), 0.0, _distance(np.minimum(product, 1.0)))
            order = np.argsort(nearest[covered], kind="stable")
            mine, far, which = rest[covered][order], distance[covered][order], nearest[covered][order]
            ends = np.searchsorted(which, np.arange(len(chosen) + 1))
            for ball, c in enumerate(centres):
                balls.append((int(c), mine[ends[ball]:ends[ball + 1]], far[ends[ball]:ends[ball + 1]]))
            rest = rest[~covered]
        return sorted(balls, key=lambda ball: (-float(ball[2].max()), -len(ball[1])))

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """(whole numbers, radii) of the nodes, centres as places in the order."""
        place = np.empty(len(self.order), np.int64)
        place[self.order] = np.arange(len(self.order))
        whole = np.array([self.start, self.end, place[np.asarray(self.centre)], self.first, self.last], dtype=np.int64)
        return whole, np.array(self.radius)


class _Side:
    """One tree of a traversal, read from its row."""

    def __init__(self, row: dict, side: str) -> None:
        self.ids = np.frombuffer(row[side + "ids"], np.int64)
        self.copies = np.frombuffer(row[side + "copies"], np.int64)
        self.data = np.frombuffer(row[side + "data"]).reshape(len(self.ids), -1)
        self.unit = unit(self.data)
        self.single = self.unit.astype(np.float32)
        self.start, self.end, centre, self.first, self.last = np.frombuffer(row[side + "nodes"], np.int64).reshape(5, -1)
        self.radius, self.centre = np.frombuffer(row[side + "radii"]), centre
        self.weight = np.append(0, np.cumsum(self.copies))
        self.linked = np.zeros(len(self.ids) + 1, np.int64)  # as differences from point to point

    def opened(self, node: int, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """(points, nodes) below a node; point p alone is the node -1 - p. Leaves too wide
        to be decided as a whole come as their points, so that many are compared at a time."""
        if node < 0 or not self.last[node]:
            return np.arange(*self.span(node)), np.zeros(0, np.int64)
        children = np.arange(self.first[node], self.last[node])
        size = self.end[children] - self.start[children]
        loose = (self.last[children] == 0) & ((self.radius[children] > reach / 2) | (size == 1))
        start, size = self.start[children[loose]], size[loose]
        points = np.repeat(start - np.append(0, np.cumsum(size))[:-1], size) + np.arange(size.sum())
        return points, children[~loose]

    def span(self, node: int) -> tuple[int, int]:
        return (-1 - node, -node) if node < 0 else (int(self.start[node]), int(self.end[node]))

    def balls(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Centres and radii of nodes."""
        node = np.maximum(nodes, 0)
        return self.unit[np.where(nodes < 0, -1 - nodes, self.centre[node])], np.where(nodes < 0, 0.0, self.radius[node])

    def add(self, points: np.ndarray, number: np.ndarray | int) -> None:
        np.add.at(self.linked, points, number)
        np.subtract.at(self.linked, points + 1, number)


class _Sets:
    """Disjoint sets of numbers; the least of a set stands for it."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def roots(self, of: np.ndarray) -> np.ndarray:
        at = self.parent[of]
        while True:
            up = self.parent[at]
            if (up == at).all():
                self.parent[of] = at
                return at
            at = up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            differ = a != b
            a, b = a[differ], b[differ]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


class Traversal:
    """All links between the points of two trees, or within one tree (``same``):
    how many each point has, and sets of points that links hold together."""

    def __init__(self, a: _Side, b: _Side, same: bool, cosine: float) -> None:
        self.a, self.b, self.same, self.cosine = a, b, same, cosine
        self.reach = math.sqrt(2.0 - 2.0 * cosine)
        self.shift = 0 if same else len(a.ids)
        self.sets = _Sets(self.shift + len(b.ids))
        pending = [(0, 0)]
        while pending:
            pending += self._open(*pending.pop())

    def _open(self, i: int, j: int) -> list[tuple[int, int]]:
        own = self.same and i == j
        points, rows = self.a.opened(i, self.reach)
        others, columns = self.b.opened(j, self.reach)
        self._points(points, others, own)
        found = self._nodes(rows, np.append(columns, -1 - others), own)
        if not own:  # within one node this half is the same
            found += self._nodes(-1 - points, columns, False)
        return found

    def _nodes(self, rows: np.ndarray, columns: np.ndarray, own: bool) -> list[tuple[int, int]]:
        """Pairs of nodes that bounds decide neither way; the others are dealt with."""
        found = []
        for first in range(0, len(rows), _BLOCK):
            r = rows[first:first + _BLOCK]
            centre, radius = self.a.balls(r)
            for start in range(0, len(columns), _BLOCK):
                c = columns[start:start + _BLOCK]
                other, radii = self.b.balls(c)
                products = centre @ other.T
                widest = radius.max() + radii.max() + self.reach + _SLACK
                x, y = np.nonzero(products >= 1.0 - widest * widest / 2.0)
                if own:  # each pair once; points of the same node are never among the rows
                    once = (c[y] < 0) | (c[y] >= r[x])
                    x, y = x[once], y[once]
                distance, both = _distance(products[x, y]), radius[x] + radii[y]
                close = distance - both <= self.reach + _SLACK
                whole = close & (distance + both <= self.reach - _SLACK)
                for k in np.flatnonzero(whole):
                    self._whole(int(r[x[k]]), int(c[y[k]]))
                undecided = close & ~whole
                found += list(zip(r[x[undecided]].tolist(), c[y[undecided]].tolist()))
        return found

    def _whole(self, i: int, j: int) -> None:
        """All points of one node are linked with all of another."""
        a, b = self.a, self.b
        points, others = np.arange(*a.span(i)), np.arange(*b.span(j))
        if self.same and i == j:
            a.add(points, a.weight[points[-1] + 1] - a.weight[points[0]] - a.copies[points])
        else:
            for side, mine, other, theirs in ((a, points, b, others), (b, others, a, points)):
                weight = other.weight[theirs[-1] + 1] - other.weight[theirs[0]]
                side.linked[mine[0]] += weight
                side.linked[mine[-1] + 1] -= weight
        self.sets.join(points, np.full(len(points), others[0] + self.shift))
        self.sets.join(others + self.shift, np.full(len(others), points[0]))

    def _points(self, points: np.ndarray, others: np.ndarray, own: bool) -> None:
        """Links between points by blocks of products in single precision; what these
        cannot decide is computed from the vectors as given."""
        a, b = self.a, self.b
        error = (a.data.shape[1] + 8) * 2.0 ** -22
        for first in range(0, len(points), _BLOCK):
            for start in range(0, len(others), _BLOCK):
                p, q = points[first:first + _BLOCK], others[start:start + _BLOCK]
                if own and first > start:
                    continue
                products = a.single[p] @ b.single[q].T
                near = products >= self.cosine - error
                if not near.any():
                    continue
                x, y = np.nonzero(near & (products <= self.cosine + error))
                near[x, y] = self._exact(a.data[p[x]], b.data[q[y]]) >= self.cosine
                if own:  # each pair once
                    near &= p[:, None] < q[None, :]
                rows, columns = near.any(axis=1), near.any(axis=0)
                if not rows.any():
                    continue
                a.add(p[rows], near[rows] @ b.copies[q])
                b.add(q[columns], a.copies[p] @ near[:, columns])
                roots = np.append(self.sets.roots(p[rows]), self.sets.roots(q[columns] + self.shift))
                if (roots != roots[0]).any():
                    x, y = np.nonzero(near)
                    self.sets.join(p[x], q[y] + self.shift)

    @staticmethod
    def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        def total(values: np.ndarray) -> np.ndarray:
            return np.cumsum(values, axis=1)[:, -1] if len(values) else np.zeros(0)

        return total(x * y) / (np.sqrt(total(x * x)) * np.sqrt(total(y * y)))

    def results(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(points, their number of links) and (points, the point that stands for their set)."""
        for side in (self.a,) if self.same else (self.a, self.b):
            number = np.cumsum(side.linked)[:-1]
            some = np.flatnonzero(number)
            yield side.ids[some], np.zeros(len(some), np.int64), number[some]
        ids = self.a.ids if self.same else np.append(self.a.ids, self.b.ids)
        roots = self.sets.roots(np.arange(len(ids)))
        moved = np.flatnonzero(roots != np.arange(len(ids)))
        yield ids[moved], ids[roots[moved]], np.zeros(len(moved), np.int64)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist())).reshape(-1, dim)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes; a negative zero becomes zero, so that equal vectors have equal bytes."""
    for batch in batches:
        lists = batch.column("v")
        flat = np.asarray(lists.values, dtype=np.float64) + 0.0
        ends = np.asarray(lists.offsets, dtype=np.int64)
        data = [scaled(flat[a:b][None])[0].tobytes() for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(data, pa.binary())], ["id", "data"])


def _placed(sample: dict[int, np.ndarray]):
    """Each vector's place in the upper tree: that of its nearest sample."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            place = np.zeros(len(dims), np.int32)
            for dim in np.unique(dims):
                if int(dim) in sample:
                    mine = np.flatnonzero(dims == dim)
                    place[mine] = (unit(_matrix(batch.column("data").take(pa.array(mine)), int(dim))) @ sample[int(dim)].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], [*batch.schema.names, "place"])
    return run


_TREE = "tile long, dim int, root binary, reach double, ids binary, copies binary, data binary, nodes binary, radii binary"


def _tree(table: pa.Table) -> pa.Table:
    """The vectors of one tile, all of one length, as a tree in a row."""
    table = table.combine_chunks()
    dim = table.column("dim")[0].as_py()
    order = np.argsort(np.asarray(table.column("class")))
    data = _matrix(table.column("data"), dim)[order]
    points = unit(data)
    tree = CoverTree(points)
    whole, radii = tree.arrays()
    ids, copies = (np.asarray(table.column(c))[order][tree.order] for c in ("class", "copies"))
    row = {"tile": table.column("tile")[0].as_py(), "dim": dim, "root": points[0].tobytes(), "reach": float(radii[0]), "ids": ids.tobytes(),
           "copies": copies.tobytes(), "data": data[tree.order].tobytes(), "nodes": whole.tobytes(), "radii": radii.tobytes()}
    return pa.Table.from_pylist([row], schema=pa.schema([
        ("tile", pa.int64()), ("dim", pa.int32()), ("root", pa.binary()), ("reach", pa.float64()), ("ids", pa.binary()),
        ("copies", pa.binary()), ("data", pa.binary()), ("nodes", pa.binary()), ("radii", pa.binary())]))


def _near_roots(reach: float):
    """Pairs of trees whose roots are near enough, of two blocks of roots."""
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["tile"])
        tiles, blocks = (np.array([r[c] for r in rows]) for c in ("tile", "block"))
        roots, radii = np.stack([np.frombuffer(r["root"]) for r in rows]), np.array([r["reach"] for r in rows])
        low, high = rows[0]["low"], rows[0]["high"]
        near = _distance(roots @ roots.T) <= radii[:, None] + radii[None, :] + reach + _SLACK
        np.fill_diagonal(near, True)
        near &= (blocks == low)[:, None] & (blocks == high)[None, :]
        if low == high:
            near &= tiles[:, None] <= tiles[None, :]
        x, y = np.nonzero(near)
        return pa.table({"one": pa.array(tiles[x], pa.int64()), "other": pa.array(tiles[y], pa.int64())})
    return run


def _traverse(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):  # two trees in memory at a time
                row = batch.slice(at, 1).to_pylist()[0]
                same = row["one"] == row["other"]
                a = _Side(row, "a_")
                for columns in Traversal(a, a if same else _Side(row, "b_"), same, cosine).results():
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["class", "with", "links"])
    return run


def _salted(tiles: DataFrame, salts: int, side: str) -> DataFrame:
    """Trees under several join keys each, so that no key has more than ``PARTNERS`` or so."""
    kept = [F.col(c).alias(side + c) for c in ("ids", "copies", "data", "nodes", "radii")]
    return tiles.select(F.col("tile").alias("one" if side == "a_" else "other"), *kept,
                        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))


def links(classes: DataFrame, cosine: float = COSINE, tile_rows: int | None = None) -> DataFrame:
    """(class, with, links) of distinct vectors (class, copies, dim, data): rows with
    ``links`` > 0 add to the links of a class, the others hold two classes together."""
    spark = classes.sparkSession
    size = classes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max("dim"), F.lit(1)).alias("dim")).first()
    some = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * size.dim)))
    picked = classes.where(F.pmod(F.xxhash64("data"), F.lit(max(1, size.n))) < some).select("dim", "data").collect()
    sample = {}
    for dim in {r.dim for r in picked}:
        points = unit(np.stack([np.frombuffer(d) for d in sorted(bytes(r.data) for r in picked if r.dim == dim)]))
        sample[dim] = points[CoverTree(points).order]
    placed = materialize(classes.mapInArrow(_placed(sample), "class long, copies long, dim int, data binary, place int"), "placed")

    # Neighbours in the upper tree share a tile; a place with many vectors has several.
    least = math.isqrt(4 * spark.sparkContext.defaultParallelism) + 1
    lookup, tile, filled, before = [], -1, 0, None
    for r in sorted(placed.groupBy("dim", "place").count().collect()):
        rows = tile_rows or max(1, min(TILE_BYTES // (8 * r.dim), max(1024, -(-size.n // least))))
        parts = -(-r["count"] // rows)
        if parts > 1 or r.dim != before or filled + r["count"] > rows:
            tile, filled = tile + 1, 0
        lookup.append((r.dim, r.place, tile, parts))
        filled += r["count"]
        if parts > 1:
            tile, before = tile + parts - 1, None  # the next place opens a new one
        else:
            before = r.dim
    where = spark.createDataFrame(lookup, "dim int, place int, base long, parts int")
    dealt = placed.join(F.broadcast(where), ["dim", "place"]).select(  # as many rows as the sample at most
        (F.col("base") + F.pmod(F.xxhash64("class"), F.col("parts"))).alias("tile"), "class", "copies", "dim", "data")
    trees = materialize(dealt.groupBy("tile").applyInArrow(_tree, _TREE), "trees")

    # Blocks of roots meet in a grid; only near trees bring their vectors together.
    blocks = max(1, -(-(tile + 1) // ROOT_ROWS))
    block = F.pmod(F.xxhash64("tile"), F.lit(blocks)).cast("int")
    roots = trees.select("tile", "dim", "root", "reach", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("partner"))
    grid = roots.select("tile", "root", "reach", "block", "dim", F.least("block", "partner").alias("low"), F.greatest("block", "partner").alias("high"))
    pairs = grid.groupBy("dim", "low", "high").applyInArrow(_near_roots(math.sqrt(2.0 - 2.0 * cosine)), "one long, other long")
    salts = max(1, -(-(tile + 1) // PARTNERS))
    pairs = materialize(pairs.withColumn("salt", F.pmod(F.xxhash64("one", "other"), F.lit(salts)).cast("int")), "tree_pairs")
    met = pairs.join(_salted(trees, salts, "a_").hint("merge"), ["one", "salt"]).join(_salted(trees, salts, "b_").hint("merge"), ["other", "salt"])
    return materialize(met.drop("salt").mapInArrow(_traverse(cosine), "class long, with long, links long"), "vector_links")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding",
                    tile_rows: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``.

    ``n_links`` is the number of other rows whose cosine is at least ``cosine``,
    ``component_id`` the smallest id that links reach, and a row is kept if that is
    its own. The result is exact. Equal vectors are one class, found by digest, and are
    compared once. A bounded sample orders the classes into tiles of bounded size; each
    tile is a cover tree, and trees whose roots are near enough meet in a join. A task
    sends the number of links per class and one row per class that it links to others,
    never the pairs. In data without any structure no roots are far apart, so that
    all tiles meet.

    Vectors that are null, zero, empty or hold null or non-finite components link with
    nothing: no links, their own id, kept. Vectors of other lengths do not link.
    Repeated rows count as other vectors. A row without an id links as any other; its
    component is the smallest id reached, null and kept if there is none.
    """
    v = F.col("v")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = v.isNotNull() & ~F.coalesce(odd, F.lit(True)) & F.exists(v, lambda x: x != 0.0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.withColumn("good", F.coalesce(usable, F.lit(False)))
    data = rows.where("good").select("id", "v").mapInArrow(_vectors, "id long, data binary")
    keyed = materialize(data.withColumn("key", F.sha2("data", 256)), "vectors")
    grouped = keyed.groupBy("key").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("data").alias("data"))
    classes = materialize(grouped.select(
        F.monotonically_increasing_id().alias("class"), "key", "least", "copies", (F.length("data") / 8).cast("int").alias("dim"), "data"), "classes")

    found = links(classes.select("class", "copies", "dim", "data"), cosine, tile_rows)
    number = found.where("links > 0").groupBy("class").agg(F.sum("links").alias("links"))
    held = connected_components(found.where("links = 0").select(F.col("class").alias("a"), F.col("with").alias("b")))
    known = classes.select("class", "key", "least", "copies").join(held, F.col("class") == F.col("node"), "left").join(number, "class", "left").select(
        "key", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "class").alias("component"))
    known = materialize(known, "linked")
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialize(known.join(least, "component").select("key", "n_links", "component_id"), "components")
    linked = keyed.select("id", "key").join(named, "key").select("id", "n_links", "component_id")
    alone = rows.where("not good").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
