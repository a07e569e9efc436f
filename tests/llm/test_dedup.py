import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import DataFrameWriter

from feedloom import session
from feedloom.llm import common, components, lpf, simhash


def plain_fingerprint(text):
    """Straight from the definition, bit by bit."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lower + " ":
        if c in " \t\n\x0b\x0c\r":
            words, word = (words + [word] if word else words), ""
        else:
            word += c
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(pairs, ids):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("text", ["", None, "One", "one TWO", "a b c", "É é a  b\tc\x0bd\x1ce", "w " * 500 + "x y z"])
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("length", [simhash.LIST_LENGTH, 1])
def test_links_connect_exactly_the_near_ones(spark, length):
    rng = random.Random(length)
    codes = {rng.getrandbits(64) for _ in range(30)}
    for c in list(codes):
        for _ in range(6):  # chains and balls around every code
            c ^= 1 << rng.randrange(64)
            codes.add(c)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    found = simhash.links(spark.createDataFrame([(c,) for c in signed], "code long"), length).collect()
    near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    assert {tuple(sorted(r)) for r in found} <= set(near)
    assert plain_components([tuple(r) for r in found], signed) == plain_components(near, signed)


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)] + [(500, i) for i in range(501, 700)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    nodes = {x for p in pairs for x in p if p[0] != p[1]}
    assert got == {n: c for n, c in plain_components([p for p in pairs if p[0] != p[1]], nodes).items()}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_odd_rows(odd):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    zero = {r.doc_id for r in got if r.fingerprint == "0" * 16}
    assert zero == {1, 2, 3, None}
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {1}
    same = [r for r in got if r.fingerprint == format(simhash.fingerprint(b"a b c d e"), "016x")]
    assert Counter(r.doc_id for r in same) == {4: 2, None: 1} and {r.component_id for r in same} == {4}


def test_keep_one(docs):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(5, text), (3, text), (9, text), (4, "other words here"), (7, None), (6, ""), (None, text), (3, text), (9, "its second text")]
    kept = simhash.keep_one(docs(rows)).collect()
    assert sorted(r.doc_id for r in kept) == [3, 3, 4, 6, 9, 9]
    assert kept[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}
    assert simhash.keep_one(docs([])).count() == 0


def test_keep_one_without_ids(docs):
    """Rows without an id go for those with one; among themselves one text stays."""
    words = [f"w{i}" for i in range(4000)]
    near = " ".join(words), " ".join(words[:-1] + ["end"])
    assert bin(simhash.fingerprint(near[0].encode()) ^ simhash.fingerprint(near[1].encode())).count("1") <= simhash.MAX_BITS
    least = min(near, key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    lone = "a text of its own"
    kept = simhash.keep_one(docs([(None, near[0]), (None, near[1]), (None, near[1]), (None, near[0]), (None, lone)])).collect()
    assert Counter(r.text for r in kept) == {least: 2, lone: 1}
    kept = simhash.keep_one(docs([(None, near[0]), (8, near[1]), (None, lone), (None, ""), (None, None)])).collect()
    assert Counter((r.doc_id, r.text or "") for r in kept) == {(8, near[1]): 1, (None, lone): 1, (None, ""): 2}


def plain_repeats(rows):
    last = lpf._LAST
    texts = [(last if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in texts:
        for p in range(len(b) - lpf.LENGTH + 1):
            w = b[p:p + lpf.LENGTH]
            first[w] = min(first.get(w, last), i)
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - lpf.LENGTH + 1):
            if first[b[p:p + lpf.LENGTH]] < i:
                gone[p:p + lpf.LENGTH] = b"\1" * lpf.LENGTH
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((None if i == last else i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def mixed_rows(seed, n=120):
    rng = random.Random(seed)
    words = ["the", "of", "and", "thing", "ététion", "blé", "re", "ing", "\0\0", "x"]
    base = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(12)]
    rows = []
    for i in range(n):
        k = rng.random()
        if k < .2:
            t = rng.choice(base)
        elif k < .6:
            b = rng.choice(base)
            a = rng.randrange(len(b) // 2)
            t = " ".join(rng.choices(words, k=rng.randrange(20))) + b[a:a + rng.randint(20, 200)] + " ".join(rng.choices(words, k=rng.randrange(20)))
        elif k < .7:
            t = "ab " * rng.randint(1, 80)
        else:
            t = rng.choice([None, "", " ".join(rng.choices(words, k=rng.randint(1, 120)))])
        rows.append((rng.choice([None, i, i, i, rng.randrange(n)]), t))
    return rows


@pytest.mark.parametrize("seed, group", [(5, lpf.GROUP), (5, 1), (6, 2)])
def test_repeats_equal_brute_force(docs, monkeypatch, seed, group):
    rows = mixed_rows(seed)
    found = lpf.remove_repeats(docs(rows), group=group).selectExpr(
        "doc_id", "n_bytes", "aggregate(spans, 0L, (s, x) -> s + x.end - x.start)", "size(spans)", "sha2(kept, 256)")
    assert Counter(tuple(r) for r in found.collect()) == plain_repeats(rows)


@pytest.mark.parametrize("often", [0, 1, 3])
def test_hot_anchors_are_counted_apart_with_equal_results(docs, often):
    """All, many and some anchors count as hot, with ids that are null or come twice."""
    rows = mixed_rows(7)
    found = lpf.remove_repeats(docs(rows), often=often).selectExpr(
        "doc_id", "n_bytes", "aggregate(spans, 0L, (s, x) -> s + x.end - x.start)", "size(spans)", "sha2(kept, 256)")
    assert Counter(tuple(r) for r in found.collect()) == plain_repeats(rows)


def test_anchors_are_dealt_once_and_hot_ones_are_known(spark):
    keyed = spark.createDataFrame(
        [(1, 5, 7, None, None), (1, 6, 3, None, None), (2, 5, 7, None, None), (2, 6, 7, None, None), (3, 5, 4, 9, b"x"), (4, 5, 4, None, None)],
        "h long, c long, id long, top long, more binary")
    found = lpf._shared(keyed)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted(tuple(r) for r in found.select("h", "c", "id", "top", "least", "mixed").collect()) == [
        (1, 5, 7, None, 3, True), (1, 6, 3, None, 3, True), (3, 5, 4, 9, 4, False)]
    text = b"".join(b"the same sixteen bytes and more %d, " % i for i in range(400)) + np.random.default_rng(3).bytes(20_000)
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text], pa.binary())], ["id", "text"])
    some, none, wide = (pa.Table.from_batches(lpf._surroundings([batch], often, tasks)) for often, tasks in ((64, 50), (1 << 20, 50), (64, 2)))
    hot = Counter(some["h"].to_pylist())
    assert any(some["often"].to_pylist()) and not any(none["often"].to_pylist()) and not any(wide["often"].to_pylist())
    assert some["often"].to_pylist() == [hot[h] > max(64, len(some) // 50) for h in some["h"].to_pylist()]


def test_repeats_odd_rows(odd, docs):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert Counter(tuple(r) for r in lpf.digests(odd).collect()) == plain_repeats(rows)
    assert lpf.digests(docs([])).count() == 0


def test_segments_give_the_same_anchors(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [rng.integers(97, 100, n).astype(np.uint8).tobytes() for n in (0, 49, 50, 51, 3000, 0, 700)]
    bounds = np.cumsum([0] + [len(t) for t in texts])
    whole = lpf.anchors(b"".join(texts), bounds)
    monkeypatch.setattr(lpf, "_SEGMENT", 100)
    parts = lpf.anchors(b"".join(texts), bounds)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
    for b, t in zip(bounds, texts):  # every window has one, whatever stands around its text
        own = lpf.anchors(t, np.array([0, len(t)]))[0]
        assert (np.diff(own) <= lpf.LENGTH - lpf.ANCHOR + 1).all()
        assert set((own + b).tolist()) == {p for p in whole[0].tolist() if b <= p < b + len(t)}


def test_previous_smaller():
    values = np.random.default_rng(2).integers(0, 30, 500)
    want = [max((j for j in range(i) if values[j] < values[i]), default=-1) for i in range(500)]
    assert lpf.previous_smaller(values).tolist() == want


def test_cut_repeats_keeps_columns_and_characters(docs):
    passage = "".join(chr(233 + i % 9) + "q" for i in range(60))
    rows = [(1, passage), (2, "begin " + passage + " end"), (3, passage), (4, "short"), (None, passage)]
    out = {r.doc_id: r for r in lpf.without_repeats(docs(rows)).collect()}
    assert out[1].text == passage and out[4].text == "short" and None not in out
    assert out[2].text == "begin  end" and out[2].n_chars == 10
    assert 3 not in out


def test_cut_repeats_without_ids(docs):
    """Rows without an id come after all ids and after one another by their texts."""
    passage, other = "".join(f"p{i} " for i in range(60)), "".join(f"other{i} " for i in range(30))
    rows = [(None, "A" + other), (None, other + "B"), (None, passage + "C"), (5, passage), (None, "plain"), (None, "plain"), (None, None)]
    out = [(r.doc_id, r.text) for r in lpf.without_repeats(docs(rows)).collect()]
    rest = [t for i, t in out if i is None]
    assert Counter(rest) - Counter(["A" + other, other + "B", "A", "B"]) == Counter(["C", "plain", "plain", None])
    assert (5, passage) in out and sorted(t for t in rest if t and t not in ("C", "plain")) in (["A", other + "B"], ["A" + other, "B"])
    assert len(out) == 7


def test_cut_repeats_gives_rows_of_one_id_their_own_texts(docs):
    passage, other = "".join(f"p{i} " for i in range(60)), "".join(f"other{i} " for i in range(30))
    rows = [(1, passage), (9, "begin " + passage + "end"), (9, other), (9, "short"), (8, passage), (8, "own " + other[:40]), (7, "x" + passage), (7, passage + "y")]
    out = Counter((r.doc_id, r.text, r.n_chars) for r in lpf.without_repeats(docs(rows)).collect())
    want = [(1, passage), (9, "begin end"), (9, other), (9, "short"), (8, "own " + other[:40]), (7, "x"), (7, "y")]
    assert out == Counter((i, t, len(t)) for i, t in want)


def test_cut_repeats_leaves_no_surroundings_or_texts_on_disk(spark, docs, monkeypatch, tmp_path):
    """What the decisions were made from goes before the documents are joined."""
    made = []

    def path(spark, name):
        made.append((name, tmp_path / f"{name}-{len(made)}"))
        return str(made[-1][1])

    for module in (lpf, session):
        monkeypatch.setattr(module, "scratch_path", path)
    passage = "".join(f"p{i} " for i in range(60))
    out = lpf.without_repeats(docs([(1, passage), (2, "begin " + passage + "end"), (3, "x" + passage)]))
    assert {name for name, at in made if at.exists()} == {"copies", "firsts", "decided", "changed"}
    assert {(r.doc_id, r.text) for r in out.collect()} == {(1, passage), (2, "begin end"), (3, "x")}


def test_cutting_repeats_takes_one_python_worker_per_task(docs, monkeypatch):
    """No stage feeds one Python function from another: every worker more stays in memory."""
    plans, write = [], DataFrameWriter.parquet

    def written(self, path, *args, **kwargs):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", written)
    passage = "".join(f"p{i} é" for i in range(60))
    out = lpf.without_repeats(docs([(1, passage), (2, "begin " + passage + "end"), (3, "x" + passage[1:]), (4, "y" + passage[40:])]))
    out.collect()
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    depth = []
    for plan in plans:
        above = []  # (indent, whether it is a Python node) of the nodes above in the same stage
        for line in plan.split("== Initial Plan ==")[0].splitlines():
            node = re.search(r"\w", line)
            if not node:
                continue
            indent = node.start()
            while above and above[-1][0] >= indent:
                above.pop()
            if "Exchange" in line:
                above.append((indent, None))
                continue
            above.append((indent, "MapInArrow" in line))
            stage = []
            for _, python in reversed(above):
                if python is None:
                    break
                stage.append(python)
            depth.append(sum(stage))
    assert max(depth) == 1


def test_arrow_memory_is_given_back_after_a_task(monkeypatch):
    calls = []
    pool = type("Pool", (), {"release_unused": lambda self: calls.append(1)})()
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: pool)
    run = common.lean(lambda batches: (b + 1 for b in batches))
    some = run(iter([1, 2]))
    assert next(some) == 2 and not calls
    assert list(some) == [3] and calls == [1]
