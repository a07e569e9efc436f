"""Every query with SQL equals it on whole tables; the others return rows."""

import json

import pytest
from check import compare, connect
from pyspark.sql import functions as F

from feedloom import catalogue

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_query(spark, con, name):
    ok, note = compare(spark, con, FOLDER, name)
    assert ok is not False, note
    if name != "delta_not_in_null":  # which yields nothing by definition
        assert not note.startswith("0 rows"), note


def test_every_sql_has_a_query():
    assert set(catalogue.oracle_sql()) <= set(catalogue.queries())


@pytest.mark.parametrize("name", ["stream_stage", "stream_dedupe", "stream_embed"])
def test_streams_over_table_folders(spark, con, tmp_path, name):
    for table in ("events", "documents"):
        spark.read.parquet(f"{FOLDER}/{table}.parquet").repartition(3).write.parquet(str(tmp_path / f"{table}.parquet"))
    ok, note = compare(spark, con, str(tmp_path), name)
    assert ok, note


@pytest.mark.parametrize("name", ["html_images", "html_authors"])
def test_made_pages_are_parsed_by_all_tasks(spark, name):
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert catalogue.queries()[name](spark, FOLDER).rdd.getNumPartitions() == width


def test_json_arrays_of_many_pieces(spark, tmp_path):
    from feedloom.catalogue.feeds import _json_arrays

    wide = spark.range(0, 50, 1, 2).select("id", F.repeat(F.lit("é\"x "), 10_000).alias("v")).where("id > 24")
    _json_arrays(wide, str(tmp_path / "a"))
    texts = [f.read_text() for f in (tmp_path / "a").glob("part-*")]
    assert sorted(len(json.loads(t)) for t in texts) in ([25], [0, 25])
    assert sorted(r["id"] for t in texts for r in json.loads(t)) == list(range(25, 50))
