"""Text columns, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NBSP = chr(160)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_count(text: Column | str) -> Column:
    """Pieces between runs of whitespace; '' counts 1, NULL stays NULL."""
    return F.size(F.split(_col(text), r"\s+")).cast("bigint")


def words(text: Column | str) -> Column:
    return F.array_remove(F.split(_col(text), r"\s+"), "")


def replace_nbsp(text: Column | str) -> Column:
    return F.translate(_col(text), NBSP, " ")


def split_labels(labels: Column | str) -> Column:
    """Comma list to array, tolerant of blanks after the commas."""
    return F.split(_col(labels), r",\s*")


def chunk_id(parent: Column | str, index: Column | str) -> Column:
    return F.concat_ws("_", _col(parent).cast("string"), _col(index).cast("string"))


def not_blank(text: Column | str) -> Column:
    return F.length(F.regexp_replace(_col(text), r"\s+", "")) > 0


def contains_text(text: Column | str, needle: str) -> Column:
    """``LIKE '%needle%'`` with the needle taken literally."""
    return _col(text).contains(needle)


def remove_first(text: Column | str, needle: Column | str) -> Column:
    """Drop the first occurrence of ``needle`` and strip what is left."""
    text, needle = _col(text), _col(needle)
    at = F.call_function("locate", needle, text)
    cut = F.concat(
        F.call_function("left", text, at - 1),
        F.substr(text, at + F.length(needle)),
    )
    left = F.when((at > 0) & (F.length(needle) > 0), cut).otherwise(text)
    return F.regexp_replace(left, r"^\s+|\s+$", "")


def prefix(text: Column | str, length: int = 2000) -> Column:
    return F.substring(_col(text), 1, length)


def join_ranked(rank: Column | str, text: Column | str, sep: str = "\n") -> Column:
    """Aggregate: texts of a bounded group joined in rank order."""
    pairs = F.sort_array(F.collect_list(F.struct(_col(rank).alias("r"), _col(text).alias("t"))))
    return F.array_join(F.transform(pairs, lambda p: p["t"]), sep)
