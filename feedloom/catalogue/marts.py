"""Marts, reports, profiles, top-k."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import functions as F

from feedloom import catalog
from feedloom.catalogue.base import label_tags, posts, table, word_tags
from feedloom.catalogue.pages import SQL as HTML_SQL
from feedloom.functions import payloads
from feedloom.functions.dates import day_text, on_day_before
from feedloom.functions.tables import register
from feedloom.operators import marts, topk
from feedloom.operators.filters import lookup, lookup_many
from feedloom.operators.profile import evaluate, table_profile
from feedloom.plans import datasets
from feedloom.session import scratch_path
from feedloom.sinks.tables import append
from feedloom.sources.files import read_csv
from feedloom.sources.tables import daily_dates, query, query_file

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# Columns per table with their types, for the profile SQL.
COLUMNS = {
    "region": "r_regionkey int r_name string",
    "nation": "n_nationkey int n_name string n_regionkey int",
    "customer": "c_custkey bigint c_name string c_nationkey int c_acctbal double c_mktsegment string",
    "supplier": "s_suppkey bigint s_name string s_nationkey int s_acctbal double",
    "part": "p_partkey bigint p_name string p_brand string p_type string p_size int p_retailprice double",
    "orders": "o_orderkey bigint o_custkey bigint o_orderstatus string o_totalprice double o_orderdate timestamp_ntz o_orderpriority string",
    "lineitem": "l_orderkey bigint l_partkey bigint l_suppkey bigint l_linenumber int l_quantity double l_extendedprice double "
                "l_discount double l_tax double l_returnflag string l_linestatus string l_shipdate timestamp_ntz",
    "events": "event_id bigint ts timestamp_ntz user_id bigint event_type string value double props string",
    "documents": "doc_id bigint text string lang string source string n_chars bigint",
    "embeddings": "vec_id bigint embedding array<float> label int",
    "pages": "page_id bigint url string html string",
    "benchmark": "item_id bigint text string",
    "labels": "doc_id bigint quality int toxic int",
    "conversations": "conv_id bigint turn bigint role string text string",
}

AS_OF = dt.date(2024, 1, 15)


def post_length(spark, d):
    return marts.post_length(posts(spark, d), keep=("id",))


def post_count(spark, d):
    return marts.post_count(posts(spark, d))


def date_range(spark, d):
    return marts.date_range(table(spark, d, "events"), "ts")


def top_tags(spark, d):
    return marts.top_tags(word_tags(spark, d))


def post_tags_mart(spark, d):
    return marts.post_tags(posts(spark, d), word_tags(spark, d))


def post_tags_compat(spark, d):
    return marts.post_tags_by_raw_term(posts(spark, d), word_tags(spark, d))


def post_detail_with_tags(spark, d):
    return marts.post_detail(posts(spark, d), label_tags(spark, d), ("title", "content_text"))


def yesterday_posts(spark, d):
    events = table(spark, d, "events").filter(on_day_before("ts", AS_OF))
    return events.select("event_id", "user_id", day_text("ts").alias("day"))


def point_lookup(spark, d):
    return lookup(table(spark, d, "documents"), 7, "doc_id").select("doc_id", "lang", "source", "n_chars")


def ids_lookup(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return lookup_many(docs, table(spark, d, "labels"), "doc_id")


def newest_rows(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return topk.newest(orders, "o_orderdate", "o_orderkey", 10_000)


def name_like(spark, d):
    return (
        table(spark, d, "part").filter(F.col("p_name").contains("red"))
        .groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))
    )


def regression_metrics(spark, d):
    lines = table(spark, d, "lineitem").withColumn("guess", F.col("l_quantity") * 1500.0)
    scores = evaluate(lines, "l_extendedprice", "guess", ["l_returnflag"])
    return scores.select("l_returnflag", *(F.round(m, 6).alias(m) for m in ("r2", "mae", "mape")))


def profile_all(spark, d):
    parts = [
        table_profile(table(spark, d, t)).select(F.lit(t).alias("table_name"), F.col("column").alias("column_name"), "type", "non_null", "rows")
        for t in TABLES
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _views(spark, d):
    """The two mart views over stage tables of posts and tags; (stage, mart) layers."""
    run = uuid.uuid4().hex[:12]
    stage, mart = f"stage_{run}", f"ml_{run}"
    for layer in (stage, mart):
        catalog.create_layer(spark, layer, scratch_path(spark, layer))
    posts(spark, d).select("id", "title", "content_text").write.saveAsTable(f"{stage}.posts")
    word_tags(spark, d).write.saveAsTable(f"{stage}.tags")
    datasets.refresh_views(spark, stage, mart)
    return mart


def mart_views(spark, d):
    """Both views as a user reads them."""
    mart = _views(spark, d)
    length = spark.table(f"{mart}.post_length").select("title", F.col("word_count").cast("string").alias("value"))
    tags = spark.table(f"{mart}.post_tags").select(F.col("id").cast("string").alias("title"), F.col("labels").alias("value"))
    return length.withColumn("view", F.lit("post_length")).unionByName(tags.withColumn("view", F.lit("post_tags")))


def training_export(spark, d):
    """The exported training set of labels, read back from CSV."""
    folder = scratch_path(spark, "training")
    datasets.export_training_sets(spark, folder, _views(spark, d))
    back = read_csv(spark, f"{folder}/post-tags", "content_text string, labels string")
    labels = F.array_join(F.from_json("labels", "array<string>"), "|")
    return back.select(F.md5("content_text").alias("body"), labels.alias("labels"))


def series_daily(spark, d):
    """One row per day of the whole order period, with that day's orders."""
    orders = table(spark, d, "orders")
    bounds = orders.agg(F.to_date(F.min("o_orderdate")).alias("start"), F.to_date(F.max("o_orderdate")).alias("end"))
    per_day = orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    return daily_dates(bounds).join(per_day, "date", "left").select("date", F.coalesce("n", F.lit(0)).alias("n"))


def sql_text(spark, d):
    """SQL text over a frame, with a bound parameter."""
    return query(
        spark,
        "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM {events} "
        "WHERE value >= :least GROUP BY event_type",
        {"least": 10.0}, events=table(spark, d, "events"),
    )


def sql_file(spark, d):
    """SQL that a file in a shared folder holds, over a frame, with a bound parameter."""
    path = scratch_path(spark, "sql")
    text = "SELECT lang, source, count(*) AS n, max(n_chars) AS longest\nFROM {docs}\nWHERE n_chars >= :least\nGROUP BY lang, source"
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.text(path)
    return query_file(spark, path, {"least": 100}, docs=table(spark, d, "documents"))


def table_copy(spark, d):
    """A per-job table made twice, and an empty copy of its structure that gets some rows."""
    layer = f"copy_{uuid.uuid4().hex[:12]}"
    catalog.create_layer(spark, layer, scratch_path(spark, layer))
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    for rows in (docs.withColumn("n_chars", F.lit(0).cast("bigint")), docs):
        catalog.replace_table(rows, f"{layer}.job")
    catalog.clone_empty(spark, f"{layer}.job", f"{layer}.copy")
    append(spark.table(f"{layer}.job").where("lang <> 'en'"), f"{layer}.copy")
    tables = (spark.table(f"{layer}.{t}").withColumn("table_name", F.lit(t)) for t in ("job", "copy"))
    return reduce(lambda a, b: a.unionByName(b), tables)


def event_payloads(spark, d):
    """Payloads whose shape drifts by event type, some of them broken."""
    drifted = F.expr("""CASE event_type WHEN 'purchase' THEN concat('{"k": "x", "cart": {"total": ', value, ', "lines": [1, 2]}}')
                        WHEN 'click' THEN concat('{', props) ELSE props END""")
    events = table(spark, d, "events").select("event_id", payloads.parsed(drifted).alias("v"))
    return events.select(
        "event_id", F.col("v").isNull().alias("broken"), payloads.field("v", "$.k", "bigint").alias("k"),
        payloads.field("v", "$.cart.total", "double").alias("total"), payloads.field("v", "$.cart.lines[1]", "int").alias("line"))


def lateral_links(spark, d):
    """Links by a table function in SQL."""
    register(spark)
    return query(spark, "SELECT page_id, l.* FROM {pages}, LATERAL html_links(html) AS l WHERE l.href IS NOT NULL", pages=table(spark, d, "pages"))


QUERIES = {
    "post_length": post_length,
    "post_count": post_count,
    "date_range": date_range,
    "top_tags": top_tags,
    "post_tags_mart": post_tags_mart,
    "post_tags_compat": post_tags_compat,
    "post_detail_with_tags": post_detail_with_tags,
    "yesterday_posts": yesterday_posts,
    "point_lookup": point_lookup,
    "ids_lookup": ids_lookup,
    "newest_rows": newest_rows,
    "name_like": name_like,
    "regression_metrics": regression_metrics,
    "table_profile": profile_all,
    "series_daily": series_daily,
    "mart_views": mart_views,
    "training_export": training_export,
    "sql_text": sql_text,
    "sql_file": sql_file,
    "table_copy": table_copy,
    "event_payloads": event_payloads,
    "lateral_links": lateral_links,
}

WORD_TAGS = """
tags AS (
    SELECT DISTINCT doc_id AS post_id, term
    FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\\s+')) AS term FROM documents)
    WHERE term <> ''
)"""

SQL = {
    "post_length": r"""
        SELECT doc_id AS id, string_split(text, chr(10))[1] AS title,
               CAST(len(regexp_split_to_array(text, '\s+')) AS BIGINT) AS word_count
        FROM documents""",
    "post_count": "SELECT count(*) AS n FROM documents",
    "date_range": 'SELECT min(ts) AS "min", max(ts) AS "max" FROM events',
    "top_tags": f"""
        WITH {WORD_TAGS}
        SELECT lower(term) AS term, count(*) AS total FROM tags
        GROUP BY lower(term) ORDER BY total DESC, term LIMIT 20""",
    "post_tags_mart": f"""
        WITH {WORD_TAGS},
        top AS (SELECT lower(term) AS term, count(*) AS total FROM tags
                GROUP BY lower(term) ORDER BY total DESC, lower(term) LIMIT 20),
        used AS (SELECT DISTINCT post_id, lower(term) AS term FROM tags
                 WHERE lower(term) IN (SELECT term FROM top))
        SELECT d.doc_id AS id, d.text AS content_text, l.labels
        FROM documents d JOIN (
            SELECT post_id, string_agg(term, ',' ORDER BY term) AS labels FROM used GROUP BY post_id
        ) l ON d.doc_id = l.post_id""",
    "post_tags_compat": f"""
        WITH {WORD_TAGS},
        top AS (SELECT term AS raw, lower(term) AS low, count(*) AS total FROM tags
                GROUP BY term ORDER BY total DESC, term LIMIT 20),
        used AS (SELECT t.post_id, lower(t.term) AS term FROM tags t JOIN top ON lower(t.term) = top.low)
        SELECT d.doc_id AS id, d.text AS content_text, l.labels
        FROM documents d JOIN (
            SELECT post_id, string_agg(term, ',' ORDER BY term) AS labels FROM used GROUP BY post_id
        ) l ON d.doc_id = l.post_id""",
    "post_detail_with_tags": """
        WITH tags AS (
            SELECT doc_id AS post_id, unnest([source, lang]) AS term FROM documents
            WHERE doc_id IN (SELECT doc_id FROM labels)
        )
        SELECT d.doc_id AS id, string_split(d.text, chr(10))[1] AS title, d.text AS content_text, t.tags
        FROM documents d LEFT JOIN (
            SELECT post_id, string_agg(term, ', ' ORDER BY term) AS tags FROM tags GROUP BY post_id
        ) t ON d.doc_id = t.post_id""",
    "yesterday_posts": """
        SELECT event_id, user_id, strftime(ts, '%Y-%m-%d') AS day FROM events
        WHERE strftime(ts, '%Y-%m-%d') = strftime(DATE '2024-01-15' - INTERVAL 1 DAY, '%Y-%m-%d')""",
    "point_lookup": "SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id = 7 LIMIT 1",
    "ids_lookup": """
        SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)""",
    "newest_rows": """
        SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
        ORDER BY o_orderdate DESC, o_orderkey LIMIT 10000""",
    "name_like": "SELECT p_type, count(*) AS n FROM part WHERE p_name LIKE '%red%' GROUP BY p_type",
    "regression_metrics": """
        WITH l AS (SELECT l_returnflag, l_extendedprice AS y, l_quantity * 1500.0 AS p FROM lineitem),
        m AS (SELECT l_returnflag, avg(y) AS mean FROM l GROUP BY l_returnflag)
        SELECT l_returnflag,
               round(1 - sum((y - p) * (y - p)) / sum((y - mean) * (y - mean)), 6) AS r2,
               round(avg(abs(y - p)), 6) AS mae,
               round(avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)), 6) AS mape
        FROM l JOIN m USING (l_returnflag) GROUP BY l_returnflag""",
    "table_profile": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{kind}' AS type, count({c}) AS non_null, count(*) AS rows FROM {t}"
        for t in TABLES for c, kind in zip(COLUMNS[t].split()[::2], COLUMNS[t].split()[1::2])
    ),
    "series_daily": """
        WITH bounds AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders),
        days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds)
        SELECT days.date, count(o_orderkey) AS n FROM days
        LEFT JOIN orders ON CAST(o_orderdate AS DATE) = days.date GROUP BY days.date""",
    "sql_file": "SELECT lang, source, count(*) AS n, max(n_chars) AS longest FROM documents WHERE n_chars >= 100 GROUP BY lang, source",
    "table_copy": """
        SELECT doc_id, lang, n_chars, 'job' AS table_name FROM documents
        UNION ALL SELECT doc_id, lang, n_chars, 'copy' FROM documents WHERE lang <> 'en'""",
    "event_payloads": """
        SELECT event_id, event_type = 'click' AS broken,
               CASE WHEN event_type NOT IN ('click', 'purchase') THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
               CASE WHEN event_type = 'purchase' THEN value END AS total, CASE WHEN event_type = 'purchase' THEN 2 END AS line
        FROM events""",
    "lateral_links": HTML_SQL["html_links"],
    "sql_text": """
        SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events
        WHERE value >= 10.0 GROUP BY event_type""",
}

SQL["training_export"] = f"SELECT md5(content_text) AS body, replace(labels, ',', '|') AS labels FROM ({SQL['post_tags_mart']})"
SQL["mart_views"] = f"""
    SELECT title, CAST(word_count AS VARCHAR) AS value, 'post_length' AS view FROM ({SQL['post_length']})
    UNION ALL
    SELECT CAST(id AS VARCHAR), labels, 'post_tags' FROM ({SQL['post_tags_mart']})"""
