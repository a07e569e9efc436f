import hashlib
from collections import Counter
from fractions import Fraction
from math import floor, inf, nan

import numpy as np
import pytest

from feedloom.llm import covertree, pivots

LINKS = "vec_id long, embedding array<double>, class long, data string"
CODES = "vec_id long, embedding array<double>, label int, code string, far int"


def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def plain_links(rows, least=0.95):
    n = len(rows)
    near = [[j for j in range(n) if i != j and usable(rows[i][1]) and usable(rows[j][1]) and len(rows[i][1]) == len(rows[j][1])
             and cosine(rows[i][1], rows[j][1]) >= least] for i in range(n)]
    out, component = [], list(range(n))
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        component = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(near[i]), component, rows[i][0] == component))
    return Counter(out)


def cosine(a, b):
    a, b = np.array(a) / np.abs(a).max(), np.array(b) / np.abs(b).max()
    return float(a @ b) / (np.sqrt(a @ a) * np.sqrt(b @ b))


def clustered(seed, groups, size, dim, noise):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.normal(size=dim)
        rows += [(centre + noise * rng.normal(size=dim)).tolist() for _ in range(size)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("tile", [None, 16])
def test_links_equal_brute_force(spark, tile):
    vectors = clustered(1, 6, 25, 8, 0.15) + clustered(2, 2, 30, 8, 0.01) + clustered(3, 40, 1, 8, 0.0)
    chain = [[float(np.cos(a)), float(np.sin(a))] + [0.0] * 6 for a in np.arange(0, 3, 0.3)]  # neighbours link, ends do not
    rows = list(enumerate(vectors + chain, 100))
    rows += [(7, vectors[0]), (7, vectors[0]), (8, [2 * x for x in vectors[0]]), (9, vectors[1]), (9, vectors[60])]
    rows += [(None, vectors[2]), (None, [0.0] * 7 + [1.0])]
    rows += [(1, None), (2, []), (3, [0.0] * 8), (4, [1.0, None] * 4), (5, [nan] * 8), (6, [inf] * 8), (10, [1e-300] * 8), (11, [1e300] * 8),
             (12, [1.0]), (13, [3.0]), (14, [-3.0]), (15, [-0.0, 1.0]), (16, [0.0, 1.0])]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], LINKS).repartition(5)
    got = covertree.near_duplicates(frame, tile_rows=tile)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert Counter(tuple(r) for r in got.collect()) == plain_links(rows)


def test_links_on_the_threshold(spark):
    """19 / 20 is 0.95 exactly; a little less is no link."""
    rows = [(1, [1.0, 0, 0, 0, 0]), (2, [19.0, 6, 1, 1, 1]), (3, [18.9999, 6, 1, 1, 1])]
    got = covertree.near_duplicates(spark.createDataFrame([(i, list(map(float, v)), 1, "x") for i, v in rows], LINKS))
    assert {tuple(r) for r in got.collect()} == {(1, 1, 1, True), (2, 2, 1, False), (3, 1, 1, False)}


def test_links_of_nothing(spark):
    assert covertree.near_duplicates(spark.createDataFrame([], LINKS)).count() == 0
    none = covertree.near_duplicates(spark.createDataFrame([(3, None, 1, "x")], LINKS)).collect()
    assert [tuple(r) for r in none] == [(3, 0, 3, True)]


@pytest.mark.parametrize("noise", [0.0, 0.02, 0.3, 2.0])
def test_cover_tree_levels(noise):
    points = covertree.unit(np.array(clustered(4, 5, 80, 6, noise)) + 1e-9)
    tree = covertree.CoverTree(points)
    assert sorted(tree.order.tolist()) == list(range(400))
    for i in range(len(tree.start)):
        mine = tree.order[tree.start[i]:tree.end[i]]
        away = np.linalg.norm(points[mine] - points[tree.centre[i]], axis=1)
        assert tree.centre[i] in mine and away.max() <= tree.radius[i] + covertree._SLACK
        children = range(tree.first[i], tree.last[i])
        if children:
            assert [tree.start[c] for c in children][1:] == [tree.end[c] for c in children][:-1]
            assert tree.centre[i] in [tree.centre[c] for c in children]  # nested
            assert max(tree.radius[c] for c in children) < tree.radius[i] + covertree._SLACK


def test_whole_nodes_are_not_opened(monkeypatch):
    """A tight group is counted by bounds; few of its pairs are computed."""
    rng = np.random.default_rng(5)
    points = np.eye(4)[0] + 1e-3 * rng.normal(size=(3000, 4))
    tree = covertree.CoverTree(covertree.unit(points))
    whole, radii = tree.arrays()
    row = {"ids": np.arange(3000), "copies": np.ones(3000, np.int64), "data": points[tree.order], "nodes": whole, "radii": radii}
    side = covertree._Side({"a_" + k: v.tobytes() for k, v in row.items()}, "a_")
    pairs, compare = [], covertree.Traversal._points
    monkeypatch.setattr(covertree.Traversal, "_points", lambda self, p, q, own: (pairs.append(len(p) * len(q)), compare(self, p, q, own)))
    found = list(covertree.Traversal(side, side, True, 0.95).results())
    assert found[0][2].tolist() == [2999] * 3000 and len(found[1][0]) == 2999
    assert sum(pairs) < 3000 * 3000 / 10


def plain_codes(rows, parts=8, rounds=6):
    kept = [(i, [floor(Fraction(x) * 4096) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = len(kept[0][1])
    cuts = [(p * dim // parts, (p + 1) * dim // parts) for p in range(parts)]
    books = [[r[1][a:b] for r in kept[:16] if len(r[1]) == dim] for a, b in cuts]
    mine = [r for r in kept if len(r[1]) == dim]

    def nearest(x, book):
        return min((sum((s - t) ** 2 for s, t in zip(x, entry)), j) for j, entry in enumerate(book))

    for _ in range(rounds):
        for p, (a, b) in enumerate(cuts):
            groups = {}
            for r in mine:
                groups.setdefault(nearest(r[1][a:b], books[p])[1], []).append(r[1][a:b])
            books[p] = [[sum(c) // len(groups[j]) for c in zip(*groups[j])] if j in groups else e for j, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    coded = []
    for i, x, label in kept:
        found = [nearest(x[a:b], books[p]) for p, (a, b) in enumerate(cuts)] if len(x) == dim else None
        error = sum(f[0] for f in found) if found else None
        coded.append((i, "".join(f"{f[1]:02x}" for f in found) if found else None, error, label))
    out = Counter()
    for i, code, error, label in coded:
        errors = [e for _, c, e, other in coded if other == label and c]
        total = sum(errors) if errors and max(errors) < 1 << 63 else None
        out[i, code, error if error is not None and error < 1 << 63 else None, total if total is not None and total < 1 << 63 else None, digest] += 1
    return out


def coded(spark, rows):
    frame = spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], CODES).repartition(4)
    return Counter(tuple(r) for r in pivots.compress(frame).collect())


def test_codes_equal_plain_rounds(spark):
    rng = np.random.default_rng(6)
    rows = [(int(i), rng.normal(size=24).tolist(), [0, 0, 0, 1, None][i % 5]) for i in rng.permutation(150)]
    rows += [rows[3], rows[3], (200, [0.0] * 24, 1), (201, None, 1), (202, [None] * 24, 1), (203, [nan] * 24, 1), (204, [inf] * 24, 1),
             (None, rows[0][1], 2), (205, [1.0] * 23, 2), (206, [], 3), (5, rows[9][1], 0)]
    assert coded(spark, rows) == plain_codes(rows)


@pytest.mark.parametrize("size", [2.0**20, 1e9, 1e18, 1e300])
def test_codes_of_large_components(spark, size):
    rng = np.random.default_rng(7)
    rows = [(i, (rng.normal(size=9) * (size if i % 3 else 1.0)).tolist(), i % 2) for i in range(40)]
    assert coded(spark, rows) == plain_codes(rows)


def test_codes_of_few_rows(spark):
    assert coded(spark, []) == Counter()
    rows = [(2, [1.0, 2.0, 3.0], 1), (1, [0.5, 0.0, -1.0], None)]
    assert coded(spark, rows) == plain_codes(rows)


def test_bounds_prune_and_keep_the_nearest():
    rng = np.random.default_rng(8)
    entries = rng.integers(-4000, 4000, (16, 8))
    x = entries[rng.integers(0, 16, 3000)] + rng.integers(-300, 300, (3000, 8))
    best, distance, evaluated = pivots.assign(x, entries, pivots.far(x, entries[:4]).astype(np.float32), entries[:4])
    every = ((x[:, None] - entries[None]) ** 2).sum(2)
    assert best.tolist() == every.argmin(1).tolist() and distance.tolist() == every.min(1).tolist()
    assert evaluated < 3000 * 16 / 4
