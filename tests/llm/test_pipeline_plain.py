"""All stages against a plain chain on a small table with null ids, repeated rows,
two texts of one id, empty texts and further columns."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
from test_dedup import plain_components, plain_fingerprint
from test_search import plain_distance
from test_tokens import library

import corpus_pipeline
from feedloom.llm import decontaminate, lpf, packing, simhash, tokens

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, code int, component string, id string, unnamed string"
TOXIC = "vermin"


def made():
    """(rows, items): rows are (doc_id, text)."""
    rng = random.Random(5)

    def words(n):
        return [f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.randrange(4000)}" for _ in range(n)]

    rows = [(i, " ".join(words(rng.randrange(30, 70)))) for i in range(100, 220)]
    for i in range(300, 360):
        body = words(40)
        for _ in range(4):
            body.insert(rng.randrange(len(body)), TOXIC)
        rows.append((i, " ".join(body)))
    rows.append((None, " ".join(words(30) + [TOXIC] * 4)))
    long = words(1500)
    near = long[:700] + ["changed"] + long[701:]
    rows += [(12, " ".join(long)), (11, " ".join(long)), (13, " ".join(near)), (None, " ".join(long)), (None, " ".join(near))]
    lone = " ".join(words(45))
    rows += [(None, lone), (None, lone)]
    passage = " ".join(words(25))
    rows += [(20, passage + " first end"), (21, " ".join(words(20)) + passage + " second"), (22, passage), (None, "unnamed " + passage + " " + " ".join(words(12)))]
    items = [(1, words(30)), (2, words(12)), (3, []), (4, words(40))]
    rows += [(30, " ".join(words(10) + items[0][1] + words(9))), (31, " ".join(words(10) + items[1][1])), (None, " ".join(items[0][1] + words(25)))]
    edited = items[3][1][:10] + ["other"] + items[3][1][11:]
    rows += [(32, " ".join(words(5) + edited + words(5)))]
    rows += [(40, " ".join(words(33))), (40, " ".join(words(34)))]
    rows += [(41, " ".join(words(35)))] * 2
    rows += [(50, None), (51, ""), (52, "  "), (None, None), (60, "x" * 7000)]
    rng.shuffle(rows)
    return rows, [(i, " ".join(w)) for i, w in items] + [(5, None)]


def name(row):
    return str(row[0]) if row[0] is not None else hashlib.sha256((row[1] or "").encode()).hexdigest()


def plain_one_of_each(rows):
    codes = [plain_fingerprint(t) for _, t in rows]
    distinct = sorted(set(codes))
    near = [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= simhash.MAX_BITS]
    group = plain_components(near, distinct)
    first = {}
    for row, code in zip(rows, codes):
        rank = (row[0] is None, row[0] if row[0] is not None else name(row))
        first[group[code]] = min(first.get(group[code], rank), rank)
    stay = {name(row) for row, code in zip(rows, codes) if str(first[group[code]][1]) == name(row)}
    return [row for row in rows if name(row) in stay]


def plain_cut(rows):
    # No passage of the fixture is in unnamed rows alone, so their own order is free.
    keys = [(i is None, i if i is not None else name((i, t))) for i, t in rows]
    first = {}
    for key, (_, t) in zip(keys, rows):
        for p in range(len(t or "") - lpf.LENGTH + 1):
            w = t[p:p + lpf.LENGTH]
            first[w] = min(first.get(w, key), key)
    out = []
    for key, (i, t) in zip(keys, rows):
        gone = set()
        for p in range(len(t or "") - lpf.LENGTH + 1):
            if first[t[p:p + lpf.LENGTH]] < key:
                gone.update(range(p, p + lpf.LENGTH))
        left = "".join(c for p, c in enumerate(t) if p not in gone) if gone else t
        if not gone or left:
            out.append((i, left))
    return out


def plain_clean(rows, items):
    wanted = [t.split() for _, t in items if t]
    leaky = {name(r) for r in rows for w in wanted if plain_distance(w, (r[1] or "").split()) <= int(decontaminate.EDITS * len(w))}
    return [r for r in rows if name(r) not in leaky]


def test_run_equals_a_plain_chain(spark, tmp_path):
    rows, items = made()
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, "c", "i", "u") for i, t in rows], DOCUMENTS).repartition(3).write.parquet(
        str(tmp_path / "documents.parquet"))
    labels = {i: int(TOXIC in (t or "")) for i, t in rows if i is not None}
    spark.createDataFrame([(i, y, 1) for i, y in labels.items()], "doc_id long, toxic int, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    toxic = {name(r) for r in rows if TOXIC in (r[1] or "")}
    kept = [r for r in rows if name(r) not in toxic]
    alone = plain_one_of_each(kept)
    cut = plain_cut(alone)
    clean = plain_clean(cut, items)
    assert len(rows) > len(kept) > len(alone) > len(cut) > len(clean) > 100 and any(i is None for i, _ in clean)

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    path, _ = tokens.byte_bpe()
    want = Counter()
    for i, text in clean:
        ids = library(path, text or "") + np.array([packing.END_ID], "<u4").tobytes()
        for k, (start, length) in enumerate(packing.cut(len(ids) // 4, packing.SEQUENCE)):
            want[i, k, start, length, zlib.crc32(ids[4 * start:4 * (start + length)])] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    used = Counter()
    for r in got:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= packing.SEQUENCE
