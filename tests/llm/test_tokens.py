import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feedloom.llm import packing, rollup, simple8b, tokens
from feedloom.session import scratch_path

PIECES = ["a", " ", "\n", "b'", "é", "́", "The", "1", "\t", ".", " x", "<|endoftext|>", " ", "'s", "ÿ", ",", "<|",
          "\x85", " ", "\x1d", "Σ", "İ", "ﬁ", "--", "ß", "\r\n", "　", "word", " Word,"]


def library(path, text):
    return np.array(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("vocabulary", [tokens.byte_bpe, tokens.word_bpe])
@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), max_size=12))
def test_cached_words_equal_the_library(vocabulary, texts):
    path, blanks = vocabulary()
    mine = tokens.WordTokenizer(path, blanks, limit=5)  # both generations turn over
    whole = Tokenizer.from_file(path)
    want = [np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes() for text in texts * 2]
    assert [mine.encode(text) for text in texts * 2] == want
    assert list(mine.encode_many(pa.array(texts * 2, pa.string()))) == want


def test_texts_in_pieces(monkeypatch):
    """Nulls, slices of a batch, and texts that fill pieces."""
    monkeypatch.setattr(tokens, "PIECE_BYTES", 40)
    path, blanks = tokens.byte_bpe()
    texts = ["the cat sat on the mat " * 5, None, "", "one\ntwo words", " uneven ", "x", "long " * 30 + "end"] * 3
    mine = tokens.WordTokenizer(path, blanks)
    want = [library(path, t or "") for t in texts]
    assert list(mine.encode_many(pa.array(texts, pa.string()))) == want
    assert list(mine.encode_many(pa.array(texts, pa.string()).slice(4, 9))) == want[4:13]
    assert list(mine.encode_many(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("vocabulary, merged", [(tokens.byte_bpe, 3), (tokens.word_bpe, 1)])
def test_words_share_their_letters(vocabulary, merged):
    """Words that differ in marks behind them, or in case where the tokenizer has none, are merged once."""
    path, blanks = vocabulary()
    mine = tokens.WordTokenizer(path, blanks)
    calls, merge = [], mine.cache.merge
    mine.cache.merge = lambda word: calls.append(word) or merge(word)
    texts = ["Größer größer, größer. größer!? GRÖSSER GRÖßER;;", "größer--- größer) -- größer"]
    assert list(mine.encode_many(pa.array(texts[:1]).cast(pa.string()))) == [library(path, texts[0])]
    assert list(mine.encode_many(pa.array(texts[1:]).cast(pa.string()))) == [library(path, texts[1])]
    assert len(calls) == len(set(calls)) == merged + 1 + blanks  # and GRÖSSER; with blanks the first word has none


@settings(max_examples=60, deadline=None)
@given(sizes=st.lists(st.integers(1, 64), max_size=120), bins=st.integers(1, 6))
def test_best_fit(sizes, bins):
    fit = packing.BestFit(64, bins)
    used = Counter()
    for size in sizes:
        chosen, offset = fit.place(size)
        assert offset == used[chosen] and offset + size <= 64
        used[chosen] += size
        assert fit.open <= bins


@pytest.mark.parametrize("n, want", [(1, [(0, 1)]), (64, [(0, 64)]), (65, [(0, 1), (1, 64)]), (200, [(0, 8), (8, 64), (72, 64), (136, 64)])])
def test_cut(n, want):
    assert packing.cut(n, 64) == want


def packed_right(rows, texts, size):
    path, _ = tokens.byte_bpe()
    by_doc, by_bin = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_bin.setdefault(r.sequence_id, []).append(r)
    for pieces in by_bin.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == np.cumsum([0] + [r.length for r in pieces])[:-1].tolist()
        assert sum(r.length for r in pieces) <= size
    for doc_id, text in texts.items():
        ids = library(path, text or "") + np.array([packing.END_ID], "<u4").tobytes()
        pieces = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [(r.start, r.length) for r in pieces] == packing.cut(len(ids) // 4, size)
        assert [r.ids_crc32 for r in pieces] == [zlib.crc32(ids[4 * r.start:4 * (r.start + r.length)]) for r in pieces]
    return by_bin


def test_pack(docs):
    rng = random.Random(1)
    texts = {i: rng.choice([None, "", "word " * rng.randint(1, 300), "<|endoftext|> a  b"]) for i in range(150)}
    rows = packing.pack(docs(texts.items()), size=128).collect()
    bins = packed_right(rows, texts, 128)
    assert len(bins) <= 1.05 * sum(r.length for r in rows) / 128 + 2  # the tasks' open bins are merged


def test_pack_odd_rows(odd, docs):
    rows = packing.pack(odd).collect()
    assert sum(r.piece == 0 for r in rows) == odd.count()
    assert packing.pack(docs([])).count() == 0


IDS = st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=300)


@settings(max_examples=80, deadline=None)
@given(ids=IDS, block=st.sampled_from([1, 7, 64, 1024]))
def test_simple8b_round_trip(ids, block):
    ids = np.array(ids, np.uint64)
    words, offsets = simple8b.encode(ids, block)
    assert (simple8b.decode(words, offsets, len(ids), block) == ids).all()
    assert offsets[-1] == len(words)
    for b in range(len(offsets) - 1):  # a block can be read alone
        part = ids[b * block:(b + 1) * block]
        own = words[offsets[b]:offsets[b + 1]]
        assert (simple8b.decode(own, np.array([0, len(own)]), len(part), block) == part).all()


def test_token_files(docs):
    texts = {i: t for i, t in enumerate(["The Thing, of É", "", None, "x" * 3000, "a b"] * 9)}
    path, _ = tokens.word_bpe()
    out = {r.doc_id: r for r in simple8b.round_trip(docs(list(texts.items())[::-1])).collect()}
    start = 0
    for i in sorted(texts):
        ids = library(path, texts[i] or "") + np.array([simple8b.END_ID], "<u4").tobytes()
        assert tuple(out[i]) == (i, start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4


def test_token_files_odd_rows(spark, odd, docs):
    rows = sorted(simple8b.round_trip(odd).collect(), key=lambda r: r.start)
    assert len(rows) == odd.count()
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    ids = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert ids == sorted(ids)
    assert simple8b.round_trip(docs([])).count() == 0
    out = scratch_path(spark, "ids")
    simple8b.write_ids(odd, out, row_ids=5)  # many rows a shard
    assert sorted(map(tuple, simple8b.read_index(spark, out).collect()), key=str) == sorted(map(tuple, rows), key=str)


def counts(spark, rows):
    return spark.createDataFrame([(i, s, "en", "v1", n) for i, s, n in rows], "doc_id long, source string, lang string, version string, tokens long")


def test_rollup_deltas(spark):
    roll = rollup.TokenRollup(spark, scratch_path(spark, "rollup"))
    totals = lambda: {(r.source, r.version): (r.docs, r.tokens) for r in roll.totals().collect()}
    assert totals() == {}
    assert roll.commit("a", inserts=counts(spark, [(1, "x", 10), (2, "x", 5), (3, None, 7), (None, "x", 1), (2, "x", 5)]))
    assert totals() == {("x", "v1"): (4, 21), (None, "v1"): (1, 7)}
    assert not roll.commit("a", inserts=counts(spark, [(9, "x", 99)]))  # committed once
    assert totals() == {("x", "v1"): (4, 21), (None, "v1"): (1, 7)}
    gone = spark.createDataFrame([(2,), (2,), (None,), (77,)], "doc_id long")
    roll.commit("b", deletes=gone, revisions=counts(spark, [(3, "y", 8), (4, "y", 2)]))
    assert totals() == {("x", "v1"): (2, 11), ("y", "v1"): (2, 10)}
    roll.commit("c", deletes=gone)  # nothing stands to be taken back
    assert totals() == {("x", "v1"): (2, 11), ("y", "v1"): (2, 10)}
    assert sorted((str(r.doc_id), r.tokens) for r in roll.current().collect()) == [("1", 10), ("3", 8), ("4", 2), ("None", 1)]


def test_rollup_failed_batch_starts_again(spark):
    roll = rollup.TokenRollup(spark, scratch_path(spark, "rollup"))
    counts(spark, [(1, "x", 10)]).selectExpr("*", "1 AS sign").write.parquet(f"{roll.path}/ledger/a")  # died before its commit
    assert roll.totals().count() == 0 and roll.committed() == []
    assert roll.commit("a", inserts=counts(spark, [(1, "x", 3)]))
    assert [tuple(r) for r in roll.totals().collect()] == [("x", "en", "v1", 1, 3)]


def test_corpus_totals(spark, docs):
    rows = [(1, "one two"), (2, "bad words"), (3, "poor THING!!"), (4, None), (5, "")]
    labels = spark.createDataFrame([(2, 0, 1), (3, 0, 0), (1, 1, 0), (None, 0, 1), (99, 0, 0)], "doc_id long, quality int, toxic int")
    got = {(r.version): (r.docs, r.tokens) for r in rollup.corpus_totals(docs(rows), labels, scratch_path(spark, "rollup")).collect()}
    n = lambda make, text: len(library(make()[0], text)) // 4
    assert got == {"byte_bpe_50k": (3, n(tokens.byte_bpe, "one two")), "words": (1, 2)}
    assert rollup.corpus_totals(docs([]), labels, scratch_path(spark, "rollup")).count() == 0
