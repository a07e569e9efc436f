"""Near-duplicates by 64-bit SimHash fingerprints.

Fingerprints that differ in at most two bits differ in at most two of their eight
bytes, so they share at least six positional bytes. An inverted index over
positional bytes brings such fingerprints together, a tally of the shared bytes
keeps the pairs that reach six, and the exact bit count decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import byte_texts, ids_and_texts, lean, name_of, unnamed
from feedloom.llm.components import connected_components
from feedloom.session import materialize

SEED = 42
SHINGLE = 3
MAX_BITS = 2  # bits in which linked fingerprints may differ
LEAST_BYTES = 8 - MAX_BITS  # positional bytes that they share at least
#: Posting lists up to this length are tallied pair by pair; longer ones are
#: linked through shared neighbours, with a number of rows in proportion to the list.
LIST_LENGTH = 64
_BLOCK = 1 << 16
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: bytes, size: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash over word shingles, repeats included; a text without words gives 0."""
    words = text.lower().split()  # on bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < size:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        shingles, n = map(b" ".join, zip(*(words[i:] for i in range(size)))), len(words) - size + 1
    set_bits = np.zeros((8, 8), dtype=np.int64)
    for first in range(0, n, _BLOCK):
        block = min(_BLOCK, n - first)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, islice(shingles, block), repeat(seed)), np.uint64, block)
        octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
        for k in range(8):
            set_bits[k] += np.bincount(octets[:, k], minlength=256) @ _BITS
    above = (set_bits * 2 > n).reshape(64)
    return int(np.packbits(above, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = byte_texts(batch)
        codes = np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64)
        names = unnamed(batch.column("doc_id").to_pylist(), texts)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(codes), names], ["doc_id", "code", "unnamed"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, code, unnamed) per row of ``docs``; ``code`` holds the 64 bits as a long,
    ``unnamed`` is the SHA-256 of the text of a row without an id."""
    return ids_and_texts(docs, id_col, text_col).mapInArrow(lean(_fingerprints), "doc_id long, code long, unnamed string")


def _octet(code: Column, place: int) -> Column:
    return F.shiftrightunsigned(code, 8 * place).bitwiseAND(F.lit(0xFF))


def _postings(codes: DataFrame) -> DataFrame:
    """(word, code): the inverted index. Two differing bytes touch at most two of
    the four byte pairs (0,1), (2,3), (4,5), (6,7), so two of these pairs are equal:
    each choice of two gives one index word of four positional bytes."""
    code = F.col("code")
    words = []
    for number, (i, j) in enumerate(combinations(range(4), 2)):
        mask = (0xFFFF << 16 * i) | (0xFFFF << 16 * j)
        signed = mask - (1 << 64) if mask >> 63 else mask
        words.append(F.struct(F.lit(number).alias("places"), code.bitwiseAND(F.lit(signed)).alias("octets")))
    return codes.select("code", F.explode(F.array(*words)).alias("word"))


def links(codes: DataFrame, list_length: int = LIST_LENGTH) -> DataFrame:
    """(a, b): links between distinct fingerprints that together connect exactly
    those at ``MAX_BITS`` or fewer bits. ``codes`` has one row per fingerprint.

    Index words with one posting have no pair and go first. Short posting lists
    are joined with themselves. A long list, whose pairs would grow with its
    square, is linked through neighbours instead: two fingerprints lie within two
    bits exactly if they share a code at one bit or less from both, so each of its
    fingerprints emits these 65 codes and is linked to the least one that has the
    same; those links are all of pairs within two bits.
    """
    index = _postings(codes)
    lengths = index.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    index = materialize(index.join(lengths, "word").select("word", "code", "n"), "postings")

    short = index.where(F.col("n") <= list_length)
    pairs = short.select("word", F.col("code").alias("a")).join(
        short.select("word", F.col("code").alias("b")), "word").where("a < b").select("a", "b")
    a, b = F.col("a"), F.col("b")
    shared = sum((_octet(a, k) == _octet(b, k)).cast("int") for k in range(8))
    tallied = pairs.where(shared >= LEAST_BYTES).where(F.bit_count(a.bitwiseXOR(b)) <= MAX_BITS)

    crowded = index.where(F.col("n") > list_length).select("code").distinct()
    flips = F.array(F.lit(0).cast("long"), *(F.lit(-(1 << 63) if k == 63 else 1 << k) for k in range(64)))
    near = crowded.select("code", F.explode(F.transform(flips, lambda m: F.col("code").bitwiseXOR(m))).alias("near"))
    least = near.groupBy("near").agg(F.min("code").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    through = near.join(least, "near").where("code <> b").select(F.col("code").alias("a"), "b")
    return tallied.unionByName(through).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", list_length: int = LIST_LENGTH
) -> DataFrame:
    """(doc_id, fingerprint, component_id, unnamed, first_unnamed) for every row of ``docs``.

    ``component_id`` is the smallest id among the documents that can be reached by
    links. Null and empty texts and texts without words have fingerprint 0 and
    link like any other; repeated rows stay repeated and share a component; a null
    id keeps its row and is never the smallest id (all ids null: null). ``unnamed``
    is the SHA-256 of the text of a row without an id, ``first_unnamed`` the least of
    the component. Only one row per fingerprint takes part in the search, so large groups of copies cost
    nothing there. An empty table gives an empty result; further columns of
    ``docs`` are not looked at.
    """
    codes = materialize(fingerprints(docs, id_col, text_col), "codes")
    least = codes.groupBy("code").agg(F.min("doc_id").alias("first_id"), F.min("unnamed").alias("first_unnamed"))
    distinct = materialize(least, "distinct")
    groups = connected_components(links(distinct.select("code"), list_length))
    labelled = distinct.join(groups, distinct.code == groups.node, "left").select(
        "code", "first_id", "first_unnamed", F.coalesce("component", "code").alias("component"))
    firsts = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"), F.min("first_unnamed").alias("first_unnamed"))
    named = labelled.select("code", "component").join(firsts, "component").select("code", "component_id", "first_unnamed")
    return codes.join(named, "code").select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id", "unnamed", "first_unnamed")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without later near-duplicates: of each group the
    document with the smallest id stays. Rows of one id stay or go together. Rows
    with a null id come after all ids and are told apart by their text: of a group
    without any id the rows with the text of least SHA-256 stay."""
    groups = near_duplicates(docs, id_col, text_col)
    first = F.coalesce(F.col("component_id").cast("string"), "first_unnamed")
    name = F.coalesce(F.col("doc_id").cast("string"), "unnamed")
    gone = groups.groupBy(name.alias("_gone")).agg(F.max(name == first).alias("kept")).where(~F.col("kept")).select("_gone")
    # Written first: Spark then knows their size, and texts need not move for a few ids.
    return docs.join(materialize(gone, "gone"), name_of(id_col, text_col) == F.col("_gone"), "left_anti")
