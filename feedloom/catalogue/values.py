"""Scalar functions over columns of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.catalogue.base import table
from feedloom.functions import dates, text, values


def _feed_dates(spark, d):
    """Order dates, with a clock time, written the way feeds write them."""
    at = F.expr("o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 86400)")
    zone = F.expr("CASE WHEN o_orderpriority < '3' THEN '-0700' WHEN o_orderpriority < '5' THEN '+0000' ELSE '+0530' END")
    orders = table(spark, d, "orders").select("o_orderkey", at.alias("at"), zone.alias("zone"))
    return orders.select(
        "o_orderkey", F.concat(F.date_format("at", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" "), F.col("zone")).alias("published")
    )


def _parsed(mode):
    def run(spark, d):
        rows = _feed_dates(spark, d)
        return rows.select("o_orderkey", "published", dates.parse_feed_date("published", mode).alias("parsed"))

    return run


def date_parse_instant(spark, d):
    rows = _feed_dates(spark, d)
    return rows.select("o_orderkey", F.unix_micros(dates.parse_feed_date("published", "instant")).alias("micros"))


def epoch_metadata(spark, d):
    return table(spark, d, "events").select(
        text.chunk_id("user_id", "event_id").alias("id"), dates.epoch_micros("ts").alias("published_timestamp")
    )


def lenient_number(spark, d):
    """Numbers, percentages and words in one text column."""
    raw = F.expr("""CASE event_type WHEN 'error' THEN 'n/a' WHEN 'view' THEN concat(value, '%')
                    WHEN 'click' THEN concat(event_id, '.5') ELSE cast(value AS string) END""")
    return table(spark, d, "events").select("event_id", values.lenient_int(raw).alias("number"))


def json_fields(spark, d):
    parsed = F.from_json("props", "k bigint")
    rows = table(spark, d, "events").select("event_id", parsed.alias("p"))
    return rows.select("event_id", F.col("p.k").alias("k"), F.to_json("p").alias("again"))


def text_functions(spark, d):
    docs = table(spark, d, "documents")
    first_word = F.get(text.words("text"), F.lit(0))
    return docs.select(
        "doc_id",
        F.size(text.split_labels(text.replace_nbsp("text"))).cast("bigint").alias("comma_parts"),
        text.not_blank("text").alias("has_text"),
        text.remove_first("text", first_word).alias("without_first_word"),
        text.contains_text("text", "the").alias("has_the"),
    )


QUERIES = {
    "date_parse_wall": _parsed("wall"),
    "date_parse_utc": _parsed("utc"),
    "date_parse_iso": _parsed("iso"),
    "date_parse_instant": date_parse_instant,
    "epoch_metadata": epoch_metadata,
    "lenient_number": lenient_number,
    "json_fields": json_fields,
    "text_functions": text_functions,
}

_DATES = """
    WITH d AS (
        SELECT o_orderkey, o_orderdate + to_seconds(o_orderkey % 86400) AS moment,
               CASE WHEN o_orderpriority < '3' THEN '-0700' WHEN o_orderpriority < '5' THEN '+0000' ELSE '+0530' END AS zone,
               CASE WHEN o_orderpriority < '3' THEN -420 WHEN o_orderpriority < '5' THEN 0 ELSE 330 END AS minutes
        FROM orders
    ),
    t AS (SELECT *, strftime(moment, '%a, %d %b %Y %H:%M:%S') || ' ' || zone AS published FROM d)"""

SQL = {
    "date_parse_wall": _DATES + " SELECT o_orderkey, published, moment AS parsed FROM t",
    "date_parse_utc": _DATES + " SELECT o_orderkey, published, moment - to_minutes(minutes) AS parsed FROM t",
    "date_parse_iso": _DATES + """
        SELECT o_orderkey, published,
               strftime(moment, '%Y-%m-%dT%H:%M:%S') || substring(zone, 1, 3) || ':' || substring(zone, 4, 2) AS parsed
        FROM t""",
    "date_parse_instant": _DATES + " SELECT o_orderkey, epoch_us(moment - to_minutes(minutes)) AS micros FROM t",
    "epoch_metadata": "SELECT user_id || '_' || event_id AS id, epoch_us(ts) AS published_timestamp FROM events",
    "lenient_number": """
        SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN NULL
               WHEN 'click' THEN CAST(round_even(event_id + 0.5, 0) AS INTEGER)
               ELSE CAST(round_even(value, 0) AS INTEGER) END AS number
        FROM events""",
    "json_fields": """
        SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
               '{"k":' || json_extract_string(props, '$.k') || '}' AS again
        FROM events""",
    "text_functions": r"""
        WITH w AS (
            SELECT *, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')[1] AS first_word FROM documents
        )
        SELECT doc_id, CAST(len(regexp_split_to_array(replace(text, chr(160), ' '), ',\s*')) AS BIGINT) AS comma_parts,
               len(regexp_replace(text, '\s+', '', 'g')) > 0 AS has_text,
               regexp_replace(CASE WHEN instr(text, first_word) > 0
                    THEN substring(text, 1, instr(text, first_word) - 1) || substring(text, instr(text, first_word) + len(first_word))
                    ELSE text END, '^\s+|\s+$', '', 'g') AS without_first_word,
               contains(text, 'the') AS has_the
        FROM w""",
}
