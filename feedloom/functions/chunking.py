"""Splitting a whole column of texts into chunks.

Every strategy returns ``array<string>``; ``explode_chunks`` turns it into rows
with a 0-based position. Fixed windows, sentences and paragraphs stay JVM-side;
recursive packing runs in Arrow batches, marked non-deterministic so that
Spark does not copy the call into a filter and run it twice.
"""

from __future__ import annotations

import re
from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import _col, words

# Default sizes, and separators from coarse to fine.
RECURSIVE_SIZE, RECURSIVE_OVERLAP = 350, 75
TOKENS_SIZE, TOKENS_OVERLAP = 300, 50
SEPARATORS = ("\n\n", "\n", " ", "")


def _check(size: int, overlap: int) -> None:
    if size <= 0 or not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")


def fixed_windows(text: Column | str, size: int = TOKENS_SIZE, overlap: int = TOKENS_OVERLAP) -> Column:
    """Windows of ``size`` words, each repeating the last ``overlap`` words."""
    _check(size, overlap)

    def windows(tokens: Column) -> Column:
        last = F.greatest(F.size(tokens) - overlap - 1, F.lit(0))
        starts = F.sequence(F.lit(0), last, F.lit(size - overlap))
        cut = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i + 1, F.lit(size)), " "))
        return F.when(F.size(tokens) > 0, cut).otherwise(F.array().cast("array<string>"))

    # The one-element array binds the words, so a text is split once and not
    # once per window.
    return F.get(F.transform(F.array(words(text)), windows), F.lit(0))


def paragraphs(text: Column | str, separator: str = "\n\n") -> Column:
    return F.split(_col(text), re.escape(separator) if separator.strip() else separator)


def _pieces(text: str, sep: str) -> list[str]:
    """Cut before each separator; the separator stays with what follows."""
    if not sep:
        return list(text)
    head, *tail = text.split(sep)
    return [p for p in (head, *(sep + t for t in tail)) if p]


def _pack(pieces, size, overlap, out):
    """Greedy packing; the tail of a chunk, up to ``overlap``, opens the next."""
    window, used = deque(), 0

    def emit():
        chunk = "".join(window).strip()
        if chunk:
            out.append(chunk)

    for piece in pieces:
        if used + len(piece) > size and window:
            emit()
            while window and (used > overlap or used + len(piece) > size):
                used -= len(window.popleft())
        window.append(piece)
        used += len(piece)
    emit()


def split_recursive(text: str, size: int, overlap: int, separators=SEPARATORS) -> list[str]:
    """Split at the coarsest separator present, descending only into pieces that
    are still too long."""
    level = next((i for i, s in enumerate(separators) if not s or s in text), len(separators) - 1)
    finer = separators[level + 1:]
    out: list[str] = []
    fitting: list[str] = []
    for piece in _pieces(text, separators[level]):
        if len(piece) < size:
            fitting.append(piece)
            continue
        if fitting:
            _pack(fitting, size, overlap, out)
            fitting = []
        if finer:
            out.extend(split_recursive(piece, size, overlap, finer))
        else:
            out.append(piece)
    if fitting:
        _pack(fitting, size, overlap, out)
    return out


def recursive_chunks(
    text: Column | str,
    size: int = RECURSIVE_SIZE,
    overlap: int = RECURSIVE_OVERLAP,
    separators: tuple[str, ...] = SEPARATORS,
) -> Column:
    _check(size, overlap)

    @F.pandas_udf("array<string>")
    def run(batch: pd.Series) -> pd.Series:
        return batch.map(lambda t: None if t is None else split_recursive(t, size, overlap, separators))

    return run.asNondeterministic()(_col(text))


#: Ends of sentences: white space after a full stop or its like, line ends.
SENTENCE_END = r"(?<=[.!?])\s+|\n+"
_SPAN = "struct<start:int,end:int>"


def _spans(lengths: Column, size: int, overlap: int) -> Column:
    """Greedy packing of units of ``lengths`` words: (start, end) in words of each chunk.

    One fold over the units. It remembers the chunks so far, where the open one starts,
    how many words came, and the lengths of the open chunk's units, of which there
    are no more than ``size``.
    """
    start = F.struct(
        F.array().cast(f"array<{_SPAN}>").alias("out"), F.lit(0).alias("start"), F.lit(0).alias("at"),
        F.array().cast("array<int>").alias("window"))

    def step(acc: Column, n: Column) -> Column:
        full = (acc["at"] > acc["start"]) & (acc["at"] - acc["start"] + n > size)
        # The longest tail of whole units that may open the next chunk.
        room = F.least(F.lit(overlap), F.lit(size) - n)
        tail = F.aggregate(
            F.reverse(acc["window"]), F.struct(F.lit(0).alias("words"), F.lit(0).alias("units"), F.lit(True).alias("open")),
            lambda t, m: F.struct(
                F.when(t["open"] & (t["words"] + m <= room), t["words"] + m).otherwise(t["words"]).alias("words"),
                F.when(t["open"] & (t["words"] + m <= room), t["units"] + 1).otherwise(t["units"]).alias("units"),
                (t["open"] & (t["words"] + m <= room)).alias("open")))
        unit = F.array(n)
        kept = F.when(tail["units"] > 0, F.concat(F.slice(acc["window"], -tail["units"], tail["units"]), unit)).otherwise(unit)
        span = F.array(F.struct(acc["start"].alias("start"), acc["at"].alias("end")))
        return F.when(full, F.struct(
            F.concat(acc["out"], span).alias("out"), (acc["at"] - tail["words"]).alias("start"), (acc["at"] + n).alias("at"), kept.alias("window"),
        )).otherwise(F.struct(
            acc["out"].alias("out"), acc["start"].alias("start"), (acc["at"] + n).alias("at"), F.concat(acc["window"], unit).alias("window")))

    def finish(acc: Column) -> Column:
        last = F.array(F.struct(acc["start"].alias("start"), acc["at"].alias("end")))
        return F.when(acc["at"] > 0, F.concat(acc["out"], last)).otherwise(acc["out"])

    return F.aggregate(lengths, start, step, finish)


def sentence_chunks(text: Column | str, size: int = TOKENS_SIZE, overlap: int = TOKENS_OVERLAP) -> Column:
    """Whole sentences up to ``size`` words, whole sentences of up to ``overlap`` words
    repeated; a longer sentence is cut in words. All of it in the JVM."""
    _check(size, overlap)
    number = F.transform(F.split(_col(text), SENTENCE_END), lambda s: F.size(words(s)))
    units = F.flatten(F.transform(F.filter(number, lambda n: n > 0), lambda n: F.transform(
        F.sequence(F.lit(0), n - 1, F.lit(size)), lambda i: F.least(F.lit(size), n - i))))

    def cut(tokens: Column) -> Column:
        return F.transform(_spans(units, size, overlap), lambda s: F.array_join(F.slice(tokens, s["start"] + 1, s["end"] - s["start"]), " "))

    # The one-element array binds the words, as for the windows.
    return F.when(_col(text).isNotNull(), F.get(F.transform(F.array(words(text)), cut), F.lit(0)))


STRATEGIES = {
    "recursive": recursive_chunks,
    "fixed": fixed_windows,
    "sentence": sentence_chunks,
    "paragraph": paragraphs,
}


def explode_chunks(df: DataFrame, text: str, keep: list[str], strategy: str = "recursive", **options) -> DataFrame:
    """Rows (keep…, chunk_index, chunk_text) for one of ``STRATEGIES``."""
    chunks = STRATEGIES[strategy](text, **options)
    return df.select(*keep, F.posexplode(chunks).alias("chunk_index", "chunk_text"))
