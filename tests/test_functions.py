import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedloom.functions import dates, payloads, tables, text, values


def one(spark, column, value, type_="string"):
    return spark.createDataFrame([(value,)], f"x {type_}").select(column.alias("y")).first().y


@pytest.mark.parametrize("value, count", [("", 1), (None, None), ("  a b  c ", 5), ("a\n b", 2)])
def test_word_count(spark, value, count):
    assert one(spark, text.word_count("x"), value) == count


DATE = "Tue, 17 Sep 2024 10:03:44 -0700"


def test_date_modes(spark):
    assert one(spark, dates.parse_feed_date("x"), DATE) == dt.datetime(2024, 9, 17, 10, 3, 44)
    assert one(spark, dates.parse_feed_date("x", "utc"), DATE) == dt.datetime(2024, 9, 17, 17, 3, 44)
    assert one(spark, dates.parse_feed_date("x", "iso"), DATE) == "2024-09-17T10:03:44-07:00"
    micros = one(spark, F.unix_micros(dates.parse_feed_date("x", "instant")), DATE)
    assert micros == 1726592624000000


def test_utc_mode_in_another_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, dates.parse_feed_date("x", "utc"), DATE) == dt.datetime(2024, 9, 17, 17, 3, 44)
        # 06:30 UTC is an hour that New York has twice on that day.
        twice = "Sun, 03 Nov 2024 06:30:00 +0000"
        assert one(spark, dates.parse_feed_date("x", "utc"), twice) == dt.datetime(2024, 11, 3, 6, 30)
        for stamp, seconds in ((dt.datetime(2024, 1, 1, 0, 0, 1), 1704067201), (dt.datetime(2024, 11, 3, 6, 30), 1730615400),
                               (dt.datetime(1969, 12, 31, 23, 59, 59), -1)):
            assert one(spark, dates.epoch_micros("x"), stamp, "timestamp_ntz") == seconds * 1_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("mode", ["wall", "utc", "iso", "instant"])
def test_bad_dates(spark, mode):
    assert one(spark, dates.parse_feed_date("x", mode, strict=False), "yesterday") is None
    assert one(spark, dates.parse_feed_date("x", mode), None) is None
    with pytest.raises(Exception):
        one(spark, dates.parse_feed_date("x", mode), "yesterday")


def test_one_digit_day_and_z_zone(spark):
    assert one(spark, dates.parse_feed_date("x", "utc"), "Sun, 1 Dec 2024 00:00:00 Z") == dt.datetime(2024, 12, 1)


def test_day_before(spark):
    as_of = dt.date(2024, 3, 1)
    for stamp, expected in [
        (dt.datetime(2024, 2, 29, 0, 0), True), (dt.datetime(2024, 2, 29, 23, 59, 59), True),
        (dt.datetime(2024, 3, 1), False), (dt.datetime(2024, 2, 28, 23, 59, 59), False),
    ]:
        assert one(spark, dates.on_day_before("x", as_of), stamp, "timestamp_ntz") is expected


@pytest.mark.parametrize("value, number", [("100%", None), ("12.5", 12), ("13.5", 14), (None, None), ("40", 40), ("NaN", None)])
def test_lenient_int(spark, value, number):
    assert one(spark, values.lenient_int("x"), value) == number


def test_first_value(spark):
    schema = "x array<struct<value:string>>"
    df = spark.createDataFrame([([("a",), ("b",)],), ([],), (None,)], schema)
    assert [r.y for r in df.select(values.first_value("x").alias("y")).collect()] == ["a", None, None]


@pytest.mark.parametrize("value, needle, left", [
    ("Ann writes. Ann reads.", "Ann", "writes. Ann reads."), ("abc", "x", "abc"), (" abc ", "", "abc"), ("aXb", "X", "ab"),
])
def test_remove_first(spark, value, needle, left):
    assert one(spark, text.remove_first("x", F.lit(needle)), value) == left


def test_small_text_functions(spark):
    assert one(spark, text.replace_nbsp("x"), "a b") == "a b"
    assert one(spark, text.split_labels("x"), "a, b,c") == ["a", "b", "c"]
    assert one(spark, text.not_blank("x"), " \n") is False
    assert one(spark, text.prefix("x", 2), "abc") == "ab"
    assert one(spark, text.chunk_id("x", F.lit(3)), "p") == "p_3"
    assert one(spark, text.contains_text("x", "50%"), "at 50% off") is True


def test_payloads(spark):
    rows = [('{"k": 1}',), ('{"k": "x", "more": {"n": [1, 2.5]}}',), ("{bad",), (None,), ("7",)]
    df = spark.createDataFrame(rows, "p string")
    read = df.select(payloads.parsed("p").alias("v"))
    got = read.select(payloads.field("v", "$.k", "int").alias("k"), payloads.field("v", "$.more.n[1]", "double").alias("n")).collect()
    assert [tuple(r) for r in got] == [(1, None), (None, 2.5), (None, None), (None, None), (None, None)]
    shape = payloads.shape(df.limit(4), "p").first()
    assert (shape.rows, shape.broken) == (4, 1) and "more" in shape.schema and "k" in shape.schema


def test_table_functions(spark):
    tables.register(spark)
    html = '<p>one</p><a href="/a">A</a><a name="n">N</a><img src="i.png" width="3"><p>two</p>'
    df = spark.createDataFrame([(1, html), (2, None), (3, "plain")], "id int, html string")
    links = spark.sql("SELECT id, l.* FROM {df}, LATERAL html_links(html) AS l ORDER BY id, index", df=df).collect()
    assert [tuple(r) for r in links] == [(1, 0, "/a", "A"), (1, 1, None, "N")]
    assert spark.sql("SELECT src, width FROM {df}, LATERAL html_images(html)", df=df).first() == ("i.png", "3")
    assert [r.paragraph for r in spark.sql("SELECT * FROM {df}, LATERAL html_paragraphs(html) ORDER BY index", df=df).collect()] == ["one", "two"]
