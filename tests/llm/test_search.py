import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import ann, decontaminate, licenses

VECTORS = "vec_id long, embedding array<double>, score string, id string"


def plain_nearest(rows, every, k):
    usable = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = Counter()
    for q in {i for i, _ in usable if i % every == 0}:
        best = {}
        for qi, qv in usable:
            for i, v in usable:
                if qi == q and i != q and len(v) == len(qv):
                    d = 0.0
                    for a, b in zip(qv, v):
                        d += (a - b) * (a - b)
                    best[i] = min(best.get(i, np.inf), float(np.sqrt(d)))
        for rank, (d, i) in enumerate(sorted((d, i) for i, d in best.items())[:k], 1):
            out[q, rank, i, d] += 1
    return out


@pytest.mark.parametrize("tile, block, group", [(4096, 1024, 131072), (7, 3, 20)])
def test_nearest_equals_brute_force(spark, tile, block, group):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(120)]
    rows += [(i, rows[i % 7][1]) for i in range(120, 150)]  # ties
    rows += [rows[10], rows[10], (20, [5.0] * 8), (10, [0.1] * 8)]  # repeated rows, ids with several vectors
    rows += [(200, None), (210, []), (220, [0.0] * 8), (230, [1.0, None] * 4), (240, [float("nan")] * 8), (250, [float("inf")] * 8),
             (None, [1.0] * 8), (260, [1e-300] * 8), (270, [1e150] * 8), (280, [1.0, 2.0]), (281, [1.5, 2.0])]
    frame = spark.createDataFrame([(i, v, "a", "b") for i, v in rows], VECTORS)
    got = ann.nearest(frame, F.col("id") % 10 == 0, 5, tile_rows=tile, block_queries=block, group_rows=group)
    assert Counter(tuple(r) for r in got.collect()) == plain_nearest(rows, 10, 5)


def test_nearest_of_nothing(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert ann.nearest(empty, F.col("id") % 10 == 0).count() == 0
    one = spark.createDataFrame([(10, [1.0], "", "")], VECTORS)
    assert ann.nearest(one, F.col("id") % 10 == 0).count() == 0
    assert ann.nearest(one, F.col("id") % 11 == 1).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(40, 1100)) * 10.0 ** rng.integers(-3, 3, (40, 1)), rng.normal(size=(50, 1100))
    low, high = ann._bounds(ann._Codes(a), ann._Codes(b))
    true = ((a[:, None] - b[None]) ** 2).sum(2)
    assert (low <= true).all() and (true <= high).all()


def plain_distance(item, text):
    """Least edit distance of ``item`` to any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (w != t)))
        row = new
    return min(row)


def test_best_match():
    rng = np.random.default_rng(6)
    for _ in range(200):
        item, text = rng.integers(0, 5, rng.integers(1, 9)), rng.integers(0, 5, rng.integers(0, 20))
        distance, start, end = decontaminate.best_match(item, text)
        assert distance == plain_distance(item, text) == plain_distance(item, text[start:end])


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        rng.choice([lambda: words.insert(at, "new%d" % rng.randrange(99)), lambda: words.pop(at),
                    lambda: words.__setitem__(at, "sub%d" % rng.randrange(99))])()
    return words


def test_passages_equal_brute_force(spark, docs):
    rng = random.Random(7)
    vocabulary = ["the", "of", "and"] + [f"w{i}" for i in range(200)]
    items = [(i, [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 6, 15, 30, 60]))]) for i in range(40)]
    texts = []
    for d in range(250):
        words = rng.choices(vocabulary, k=rng.randrange(60))
        if d % 2:
            _, item = rng.choice(items)
            words += edited(rng, item, rng.randrange(int(.3 * len(item)) + 1)) + rng.choices(vocabulary, k=rng.randrange(30))
        texts.append((d, words))
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    shown = [(d, " ".join(w).title() + ".") for d, w in texts]
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.find_passages(docs(shown), frame).collect()}
    want = {}
    for d, words in texts:
        for i, item in items:
            distance = plain_distance(item, words)
            if distance <= int(decontaminate.EDITS * len(item)):
                want[d, i] = distance
    assert got.items() <= want.items()
    assert len(got) >= 0.98 * len(want)
    assert all(got[k] == 0 for k, v in want.items() if v == 0)
    many = decontaminate.find_passages(docs(shown), frame, group_bytes=500)  # several passes
    assert {(r.doc_id, r.item_id): r.distance for r in many.collect()} == got


def test_sampled_places_agree_often_enough():
    """At the most edits allowed, the places of a walk agree with AGREEMENT or more."""
    rng = random.Random(8)
    for length in (15, 36, 75):
        walk = decontaminate.Embedding(length, 200)
        rates = []
        for _ in range(40):
            words = [rng.randrange(1, 5000) for _ in range(length)]
            other = list(words)
            for _ in range(int(decontaminate.EDITS * length)):
                at = rng.randrange(len(other))
                rng.choice([lambda: other.insert(at, 0), lambda: other.pop(at), lambda: other.__setitem__(at, 0)])()
            other = (other + [0] * length)[:length]
            pair = np.array([words, other], np.uint64)
            rates.append(np.mean([len(set(walk.keys(pair, r).tolist())) == 1 for r in range(200)]))
        assert np.mean(rates) >= decontaminate.AGREEMENT


def test_passages_odd_rows(spark, odd, docs):
    items = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, " ... ", "x"), (4, "A b, c d e!", "x"), (4, "a b c d e", "x"), (None, "one", "x")],
                                  "item_id long, text string, distance string")
    got = Counter((r.doc_id, r.item_id, r.distance) for r in decontaminate.find_passages(odd, items).collect())
    assert got == {(4, 4, 0): 4, (None, 4, 0): 2, (8, None, 0): 1}
    assert decontaminate.find_passages(docs([]), items).count() == 0
    assert decontaminate.find_passages(odd, items.limit(0)).count() == 0
    left = decontaminate.without_passages(odd, items)
    assert left.columns == odd.columns
    assert Counter(r.doc_id for r in left.collect()) == {None: 1, 1: 1, 2: 1, 3: 1, 5: 1, 6: 1, 7: 1}
    assert [r.text for r in left.where("doc_id IS NULL").collect()] == [None]


def plain_licenses(rows):
    out = Counter()
    templates = [(name, set(licenses.bigrams(licenses.normalized_words(text)))) for name, text in licenses.TEMPLATES]
    for i, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            grams = set(licenses.bigrams(licenses.normalized_words(line)))
            best = max(((2 * len(grams & t) / (len(grams) + len(t)), -k) for k, (_, t) in enumerate(templates) if grams), default=(0, 0))
            if best[0] >= licenses.THRESHOLD:
                out[i, n, templates[-best[1]][0], round(best[0], 9)] += 1
    return out


def test_licenses(docs, odd):
    rng = random.Random(9)
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "license"), (None, "Released under the MIT License."), (5, "x " * 5000 + "MIT")]
    for i, (_, text) in enumerate(licenses.TEMPLATES * 6):
        words = text.split()
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = rng.choice(["the", "NEW", "--", "2"])
        rows.append((10 + i, "prose before\n  " + "  ".join(words).upper() + "\nand " + text))
    rows += rows[-3:]
    got = Counter((r.doc_id, r.line_no, r.license, round(r.dice, 9)) for r in licenses.scan(docs(rows)).collect())
    assert got == plain_licenses(rows) and len(got) > 60
    assert licenses.scan(docs([])).count() == 0 and licenses.scan(odd).count() == 0
    plan = licenses.scan(docs(rows))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def plain_statements(text):
    """All windows of all sizes, without any pruning."""
    words, line_of = [], []
    for i, line in enumerate(text.split("\n")):
        own = licenses.normalized_words(line)
        words += own
        line_of += [i] * len(own)
    pairs, found = [f"{a} {b}" for a, b in zip(words, words[1:])], []
    for place, (name, template) in enumerate(licenses.TEMPLATES + licenses.TEXTS):
        length = len(licenses.normalized_words(template)) - 1
        grams = set(licenses.bigrams(licenses.normalized_words(template)))
        for start in range(len(pairs)):
            seen, best = set(), (0, 0)
            for end in range(start + 1, min(len(pairs), start + int(length * 1.5)) + 1):
                seen.add(pairs[end - 1])
                best = max(best, (2 * len(grams & seen) / (len(grams) + len(seen)), start - end))
            if best[0] >= licenses.THRESHOLD:
                found.append((-best[0], -len(grams), place, start, start - best[1], name))
    taken = []
    for w in sorted(found):
        if all(o[3] > w[4] or w[3] > o[4] for o in taken):
            taken.append(w)
    lines = {(line, name) for _, line, name, _ in plain_licenses([(0, text)])}
    return [(line_of[w[3]], w[5], round(-w[0], 9)) for w in taken
            if not any((line, w[5]) in lines for line in range(line_of[w[3]], line_of[w[4]] + 1))]


def test_licenses_over_several_lines_and_inside_lines(docs, odd):
    rng = random.Random(3)
    prose = lambda n: " ".join(rng.choice("of the and software in this is to a license under".split()) for _ in range(n))
    wrap = lambda text, k: "\n".join("# " + " ".join(text.split()[i:i + k]) for i in range(0, len(text.split()), k))
    mit, gpl = licenses.TEXTS[0][1], licenses.TEXTS[3][1]
    rows = [(1, "Copyright 2024 A. Body\n\n" + wrap(mit, 9)), (2, wrap(gpl, 8) + "\nint main"), (3, "Released under the\nMIT License."),
            (4, prose(40) + " Released under the MIT License. " + prose(30) + " Licensed under CC BY 4.0. " + prose(9)),
            (None, "about it: " + " ".join(gpl.split())), (5, "Released under the MIT License."), (6, prose(200)), (7, "Released under the")]
    for i, (_, text) in enumerate(licenses.TEMPLATES + licenses.TEXTS):
        words = text.split()
        for _ in range(rng.randint(0, len(words) // 9)):
            words[rng.randrange(len(words))] = rng.choice(["x", "thing"])
        rows.append((20 + i, prose(8) + "\n" + wrap(" ".join(words), rng.randint(3, 12)) + " " + prose(8)))
    got = Counter((r.doc_id, r.line_no, r.license, round(r.dice, 9)) for r in licenses.statements(docs(rows)).collect())
    want = plain_licenses(rows) + Counter((i, *w) for i, t in rows for w in plain_statements(t))
    assert got == want
    assert {(1, 2, "MIT", 1.0), (2, 0, "GPL-3.0-or-later", 1.0), (3, 0, "MIT", 1.0), (4, 0, "MIT", 1.0), (4, 0, "CC-BY-4.0", 1.0),
            (None, 0, "GPL-3.0-or-later", 1.0), (5, 0, "MIT", 1.0)} <= set(got)
    assert not {6, 7} & {r[0] for r in got} and sum(r[0] == 5 for r in got) == 1
    assert licenses.statements(docs([])).count() == 0 and licenses.statements(odd).count() == 0
    plan = licenses.statements(docs(rows))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_passages_are_found_without_a_frame_of_an_empty_list(spark):
    """Such a frame would start Python workers of its own."""
    texts = spark.range(3).selectExpr("id AS doc_id", "id AS item_id", "'one two three four five six seven' AS text")
    found = decontaminate.find_passages(texts, texts.limit(1))
    assert "ExistingRDD" not in found._jdf.queryExecution().toString()
    assert found.count() == 3 and decontaminate.find_passages(texts, texts.limit(0)).count() == 0
