"""Feed dates and day predicates.

Feeds carry dates such as ``Tue, 17 Sep 2024 10:03:44 -0700``. Three readings of
the same text are in use; ``mode`` picks one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import _col

_BODY = "d MMM yyyy HH:mm:ss"


def _without_weekday(text: Column) -> Column:
    return F.regexp_replace(F.trim(text), r"^[A-Za-z]{3},\s*", "")


def _offset(text: Column) -> Column:
    """Zone suffix as +HHMM."""
    raw = F.regexp_extract(F.trim(text), r"\s([+-]\d{2}:?\d{2}|Z)$", 1)
    return F.when(raw == "Z", F.lit("+0000")).otherwise(F.replace(raw, F.lit(":"), F.lit("")))


def _body(text: Column) -> Column:
    return F.regexp_replace(_without_weekday(text), r"\s+([+-]\d{2}:?\d{2}|Z)$", "")


def parse_feed_date(text: Column | str, mode: str = "wall", strict: bool = True) -> Column:
    """``wall``: clock as written, zone dropped (timestamp_ntz).
    ``utc``: moved to UTC, zone dropped (timestamp_ntz).
    ``instant``: a point in time (timestamp).
    ``iso``: ISO-8601 text with the original offset.

    ``strict`` raises on malformed text, otherwise it turns NULL.
    """
    text = _col(text)
    if mode == "instant":
        whole = F.when(text.isNotNull(), F.concat_ws(" ", _body(text), _offset(text)))
        return F.to_timestamp(whole, f"{_BODY} Z") if strict else F.try_to_timestamp(whole, F.lit(f"{_BODY} Z"))
    if mode not in ("wall", "utc", "iso"):
        raise ValueError(f"unknown mode {mode!r}")
    body, offset = _body(text), _offset(text)
    if strict:
        wall = F.to_timestamp_ntz(body, F.lit(_BODY))
    else:
        wall = F.try_to_timestamp(body, F.lit(_BODY)).cast("timestamp_ntz")
    if mode == "wall":
        return wall
    if mode == "utc":
        # Taking the written offset away needs no session zone, hence no guess
        # about hours that a zone has twice or not at all.
        number = lambda c: c.cast("int") if strict else c.try_cast("int")
        hours = number(F.substring(offset, 1, 3))
        minutes = number(F.concat(F.substring(offset, 1, 1), F.substring(offset, 4, 2)))
        return wall - F.make_dt_interval(F.lit(0), hours, minutes)
    return F.concat(
        F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"),
        F.substring(offset, 1, 3), F.lit(":"), F.substring(offset, 4, 2),
    )


def day_text(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd")


def on_day_before(ts: Column | str, as_of: dt.date) -> Column:
    """Rows of the day before ``as_of``, as a range parquet can prune on."""
    day = as_of - dt.timedelta(days=1)
    lo = F.lit(day.isoformat()).cast("timestamp_ntz")
    hi = F.lit(as_of.isoformat()).cast("timestamp_ntz")
    return (_col(ts) >= lo) & (_col(ts) < hi)


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970, reading a zone-less timestamp as UTC."""
    since = _col(ts).cast("timestamp_ntz") - F.lit("1970-01-01").cast("timestamp_ntz")
    return (since.cast("interval second").cast("decimal(20,6)") * 1_000_000).cast("bigint")
