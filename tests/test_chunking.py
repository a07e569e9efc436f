import random
import re

import pytest
from pyspark.sql import functions as F

from feedloom.functions import chunking as ch


def test_recursive_examples():
    assert ch.split_recursive("short", 350, 75) == ["short"]
    assert ch.split_recursive("", 350, 75) == []
    assert ch.split_recursive("aaaa bbbb cccc dddd", 10, 5) == ["aaaa bbbb", "bbbb cccc", "cccc dddd"]
    assert ch.split_recursive("one two\n\nthree four five", 12, 0) == ["one two", "three four", "five"]


def test_recursive_without_separators():
    pieces = ch.split_recursive("x" * 1000, 350, 75)
    assert [len(p) for p in pieces] == [350, 350, 350, 175]


@pytest.mark.parametrize("seed", range(20))
def test_recursive_properties(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(["word", " ", "\n", "\n\n", "x" * 40, ". "]) for _ in range(400))
    size, overlap = rng.randint(20, 80), rng.randint(0, 19)
    pieces = ch.split_recursive(text, size, overlap)
    assert all(len(p) <= size for p in pieces)
    assert all(p in text and p == p.strip() for p in pieces)
    whole = ch.split_recursive(text, size, 0)
    assert "".join("".join(whole).split()) == "".join(text.split())


def brute_windows(words, size, overlap):
    out, start = [], 0
    while words:
        out.append(" ".join(words[start:start + size]))
        if start + size >= len(words):
            break
        start += size - overlap
    return out


@pytest.mark.parametrize("n", [0, 1, 49, 50, 51, 299, 300, 301, 550, 551, 1000])
def test_fixed_windows(spark, n):
    words = [f"w{i}" for i in range(n)]
    df = spark.createDataFrame([(" ".join(words),)], "t string")
    assert df.select(ch.fixed_windows("t").alias("c")).first().c == brute_windows(words, 300, 50)


def plain_sentences(text, size, overlap):
    """Sentences packed one by one; whole sentences of up to ``overlap`` words are repeated."""
    units = []
    for sentence in re.split(r"(?<=[.!?])[ \t\n\r\f\v]+|\n+", text):
        tokens = re.findall(r"[^ \t\n\r\f\v]+", sentence)
        units += [tokens[i:i + size] for i in range(0, len(tokens), size)]
    out, open_ = [], []
    for unit in units:
        if open_ and sum(map(len, open_)) + len(unit) > size:
            out.append(open_)
            while open_ and (sum(map(len, open_)) > overlap or sum(map(len, open_)) + len(unit) > size):
                open_ = open_[1:]
        open_ = open_ + [unit]
    return [" ".join(" ".join(u) for u in chunk) for chunk in out + ([open_] if open_ else [])]


def sentences(spark, text, size, overlap):
    return spark.createDataFrame([(text,)], "t string").select(ch.sentence_chunks("t", size, overlap).alias("c")).first().c


def test_sentences(spark):
    text = "One two three. Four five! Six? " + " ".join(f"w{i}" for i in range(12))
    assert sentences(spark, text, 6, 2) == ["One two three. Four five! Six?", "w0 w1 w2 w3 w4 w5", "w6 w7 w8 w9 w10 w11"]
    assert sentences(spark, "A b. C d. E f. G h.", 4, 2) == ["A b. C d.", "C d. E f.", "E f. G h."]
    assert sentences(spark, "", 4, 2) == [] and sentences(spark, " \n. ", 4, 2) == ["."] and sentences(spark, None, 4, 2) is None


def test_sentences_equal_plain_packing(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(["ab", "c", " ", ". ", "! ", "\n", "\n\n", ".", " \n "]) for _ in range(rng.randint(0, 300))) for _ in range(60)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for size, overlap in ((1, 0), (5, 0), (8, 3), (20, 19)):
        got = df.select(ch.sentence_chunks("t", size, overlap).alias("c"), "t").collect()
        assert [r.c for r in got] == [plain_sentences(r.t, size, overlap) for r in got]


def test_sentences_stay_in_the_jvm(spark):
    plan = spark.range(1).select(ch.sentence_chunks(F.col("id").cast("string")).alias("c"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_paragraphs_and_nulls(spark):
    df = spark.createDataFrame([("a\n\nb\n\n", 1), (None, 2)], "t string, id int")
    got = ch.explode_chunks(df, "t", ["id"], "paragraph").collect()
    assert [tuple(r) for r in got] == [(1, 0, "a"), (1, 1, "b"), (1, 2, "")]
    for strategy in ("recursive", "fixed", "sentence"):
        assert {r.id for r in ch.explode_chunks(df, "t", ["id"], strategy).collect()} == {1}


def test_bad_sizes():
    with pytest.raises(ValueError):
        ch.fixed_windows(F.lit("x"), 10, 10)
