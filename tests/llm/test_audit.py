import random
import re
from collections import Counter

import numpy as np
import pytest

from feedloom.llm import divergence

SHAPE = "doc_id long, text string, lang string, source string, term string, n long, block int"


def plain_audit(rows):
    """(lang, source, part, item, value, rank) by counting every term in every source."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
            for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in mine for t in set(d[2]))
        kept = {t for t, n in seen.items() if n >= 10}

        def shares(some):
            counts = Counter(t for d in some for t in d[2] if t in kept)
            total = sum(counts.values())
            return counts, {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        _, q = shares(mine)
        groups = {s: shares([d for d in mine if d[1] == s]) for s in {d[1] for d in mine}}
        for source, (counts, p) in groups.items():
            pairs = {o: sum((p[t] - r[t]) ** 2 // (p[t] + r[t]) for t in kept) for o, (_, r) in groups.items() if o != source}
            above = {t: (p[t] - q[t]) ** 2 // (p[t] + q[t]) for t in kept if counts[t] and p[t] > q[t]}
            for part, values, most in (("pair", pairs, len(pairs)), ("term", above, 10)):
                for rank, (v, item) in enumerate(sorted((-v, i.encode()) for i, v in values.items())[:most], 1):
                    out.add((lang, source, part, item.decode(), -v, rank))
    return out


def made(seed=1, sources=7):
    rng = random.Random(seed)
    vocabulary = ["the", "THE", "Café", "naïve", "漢字", "a"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    rows = []
    for i in range(240):
        source = f"s{int(rng.random() ** 2 * sources)}" if i % 3 else "hot"
        words = rng.choices(vocabulary, k=rng.randint(0, 25))
        rows.append((rng.choice([" ", "-", "\n", "9"]).join(words), rng.choice(["en", "de"]), source))
    rows += [(None, "en", "empty"), ("", "fr", "alone"), ("x", None, None), ("one two", None, "few"), ("the " * 40000, "en", "long"),
             ("é" * 50, "en", "s1"), rows[0], rows[0]]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i % 50 or None, t, lang, s, "x", 1, 2) for i, (t, lang, s) in enumerate(rows)], SHAPE)


@pytest.mark.parametrize("cells, block", [(1 << 19, 256), (40, 2)])
def test_audit_equals_plain_counting(spark, cells, block):
    rows = made()
    got = divergence.audit(frame(spark, rows), cells, block)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == plain_audit(rows)


def test_audit_of_nothing(spark):
    assert divergence.audit(frame(spark, [])).count() == 0
    got = {tuple(r) for r in divergence.audit(frame(spark, [("a b", "en", "x"), (None, "en", "y")])).collect()}
    assert got == {("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)}  # no term is in ten documents


def test_runs_spell_out_the_column():
    rng = np.random.default_rng(2)
    for _ in range(200):
        column = rng.integers(0, 3, rng.integers(1, 15))
        rows = np.flatnonzero(column)
        starts, values = divergence.runs(rows, column[rows], len(column))
        assert np.repeat(values, np.diff(np.append(starts, len(column)))).tolist() == column.tolist()
        assert starts[0] == 0 and (np.diff(values) != 0).all()


def test_terms_in_pieces():
    text = ("Ab é-" * 300000).encode()
    assert Counter(t for piece in divergence.terms(text) for t in piece) == {b"ab": 300000, "é".encode(): 300000}
