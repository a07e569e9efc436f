"""Feed files, file round trips, the whole ETL."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from feedloom import catalog
from feedloom.catalogue.base import table
from feedloom.catalogue.pages import VISIBLE, unescaped
from feedloom.functions.html import pieces
from feedloom.operators import entries as ent
from feedloom.plans import feed_etl
from feedloom.schemas import FLAT_POSTS, LOAD_COUNTS
from feedloom.session import scratch_path
from feedloom.sinks import files as sink
from feedloom.sources import feeds, files
from feedloom.sources.tables import query
from feedloom.streaming import landing

NOW = dt.datetime(2024, 9, 21, 18, 21)
CONTENT = "http://purl.org/rss/1.0/modules/content/"
PUBLISHED = "Tue, 17 Sep 2024 10:03:44 -0700"


def _items(spark, d):
    """Pages as feed items; page language and protocol are the categories."""
    return table(spark, d, "pages").select(
        F.col("page_id").cast("string").alias("guid"),
        F.col("url").alias("link"),
        F.concat(F.lit("Page "), "page_id").alias("title"),
        F.lit("a page").alias("description"),
        F.lit(PUBLISHED).alias("pubDate"),
        F.array(
            F.regexp_extract("html", '<html lang="([a-z]+)"', 1), F.substring_index("url", ":", 1)
        ).alias("category"),
        F.col("html").alias("content:encoded"),
    )


def _entries(spark, d):
    return feeds.feed_entries(_items(spark, d))


def _item_text():
    escaped = F.replace("link", F.lit("&"), F.lit("&amp;"))
    element = lambda tag, value: F.concat(F.lit(f"<{tag}>"), value, F.lit(f"</{tag}>"))
    body = F.concat(F.lit("<![CDATA["), F.col("`content:encoded`"), F.lit("]]>"))
    return F.concat(
        F.lit('<item><guid isPermaLink="false">'), "guid", F.lit("</guid>"),
        element("link", escaped), element("title", F.col("title")), element("description", F.col("description")),
        element("pubDate", F.col("pubDate")),
        F.array_join(F.transform("category", lambda c: element("category", c)), ""),
        element("content:encoded", body),
        F.lit("</item>"),
    )


def _line(text):
    return pa.RecordBatch.from_pydict({"value": pa.array([text], pa.string())})


def _as_feed(items):
    """Lines of feed documents, one document per partition, bodies in CDATA."""
    lines = items.select(_item_text().alias("value"))

    def wrap(batches):
        yield _line(f'<rss version="2.0" xmlns:content="{CONTENT}"><channel><title>all</title>')
        yield from batches
        yield _line("</channel></rss>")

    return lines.mapInArrow(wrap, "value string")


def feed_xml(spark, d):
    """Pages landed as XML feeds and read back."""
    folder = scratch_path(spark, "feed")
    _as_feed(_items(spark, d)).write.text(folder)
    entries = feeds.read_feeds(spark, folder)
    return entries.select(
        "id", "link", "title", "published", F.array_join("tags.term", ",").alias("terms"),
        F.md5(F.get("content", F.lit(0))["value"]).alias("body"),
    )


def entries_json(spark, d):
    """Entries landed as JSON lines by a job and read back with the declared
    schema, projected flat."""
    folder = sink.write_job_artifact(_entries(spark, d), scratch_path(spark, "jobs"), "job-1")
    flat = feeds.flat_entries(feeds.read_entries(spark, folder, lines=True), "job-1")
    return flat.select("id", "title", "link", "published_timestamp", "job_id", F.md5("post_source").alias("body"))


def flat_posts(spark, d):
    posts = ent.flat_posts(_entries(spark, d), "job-1", NOW)
    return posts.select(
        "id", "url", F.unix_micros("published_date").alias("published_micros"), "job_id",
        F.get_json_object("raw_feed", "$.link").alias("raw_link"),
    )


def flat_stage(spark, d):
    """Two feeds with the same pages, loaded twice: one row per link."""
    layer = f"flat_{uuid.uuid4().hex[:12]}"
    catalog.create_layer(spark, layer, scratch_path(spark, layer))
    name = catalog.create_table(spark, FLAT_POSTS, f"{layer}.post")
    entries = _entries(spark, d)
    both = feeds.union_feeds(*(entries.withColumn("feed", F.lit(f)) for f in ("one", "two")))
    for _ in range(2):
        feed_etl.stage_flat_entries(spark, both.withColumn("at", F.col("id").cast("bigint")), ["feed", "at"], "job-1", NOW, name)
    return spark.table(name).select("id", "url", "job_id", F.md5("content").alias("body"))


def _parsed(spark, d):
    return ent.parse_entries(_entries(spark, d), "job-1", NOW)


def etl_posts(spark, d):
    return ent.posts(_parsed(spark, d)).select("id", "link", "title", "content_text", "job_id", "published", "ingest_timestamp")


def etl_tags(spark, d):
    return ent.tags(_parsed(spark, d))


def etl_links(spark, d):
    return ent.links(_parsed(spark, d)).select("post_id", "index", "href", "title")


def _illustrated(spark, d):
    """The feed items, each with a picture of the part and an author section of the
    customer of its number."""
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("n"), F.expr(
        """concat('<div><img src="/img/', p_partkey, '.png" width="', p_size, '" height="', p_retailprice, '"><img alt="none"></div>')""").alias("picture"))
    people = table(spark, d, "customer").select(F.col("c_custkey").alias("m"), F.expr(
        """concat('<h3>About the Authors</h3><p><img src="/face/', c_custkey, '.png"><strong>', c_name, '</strong> of ', c_mktsegment, '</p>')""").alias("author"))
    items = _items(spark, d).withColumn("number", F.col("guid").cast("bigint"))
    both = items.join(parts, F.col("number") == F.col("n"), "left").join(people, F.col("number") == F.col("m"), "left")
    body = F.concat(F.col("`content:encoded`"), F.coalesce("picture", F.lit("")), F.coalesce("author", F.lit("")))
    return both.withColumn("content:encoded", body).select(*(f"`{c}`" for c in items.columns if c != "number"))


def _layers(spark):
    run = uuid.uuid4().hex[:12]
    root, names = scratch_path(spark, "etl"), dict(stage_layer=f"stage_{run}", raw_layer=f"raw_{run}")
    feed_etl.set_up(spark, names["stage_layer"], root=root)
    return names | dict(root=root)


def feed_etl_run(spark, d):
    """The whole run, done twice, into stage tables; keys and values of all five tables."""
    layers, entries = _layers(spark), feeds.feed_entries(_illustrated(spark, d))
    for _ in range(2):
        feed_etl.stage_entries(spark, entries, ingest_timestamp=NOW, **layers)
    more = {
        "posts": F.col("title"), "tags": F.lit(""), "links": F.col("title"),
        "images": F.concat_ws("|", F.col("width").cast("string"), F.col("height").cast("string")), "authors": F.concat_ws("|", "image", "bio"),
    }
    parts = []
    for t, _build in ent.BUILDERS:
        post, *rest = ["id"] if t.name == "posts" else ["post_id", *(k for k in t.key if k != "post_id")]
        parts.append(spark.table(f"{layers['stage_layer']}.{t.name}").select(
            F.lit(t.name).alias("table_name"), F.col(post).alias("post_id"),
            F.concat_ws("|", *(F.col(f"`{r}`").cast("string") for r in rest)).alias("rest"), more[t.name].alias("more"),
        ))
    return reduce(lambda a, b: a.unionByName(b), parts)


def etl_rejects(spark, d):
    """Entries of German pages come without an id; the run is done twice. What its reject
    tables hold, each bad row once."""
    layers = _layers(spark)
    rejects = f"bad_{layers['stage_layer']}"
    bad = F.get("tags.term", F.lit(0)) == "de"
    entries = _entries(spark, d).withColumn("id", F.when(~bad, F.col("id")))
    for _ in range(2):
        feed_etl.stage_entries(spark, entries, "job-1", NOW, reject_layer=rejects, **layers)
    shown = {"posts": ["link"], "tags": ["term"], "links": ["index", "href", "title"]}
    return reduce(lambda a, b: a.unionByName(b), (
        spark.table(f"{rejects}.{t}").select(F.lit(t).alias("table_name"), F.concat_ws("|", *(F.col(c).cast("string") for c in columns)).alias("row"))
        for t, columns in shown.items()))


def etl_counts(spark, d):
    """Rows of every step of a load."""
    layers = _layers(spark)
    counts = catalog.create_table(spark, LOAD_COUNTS, f"{layers['stage_layer']}.{LOAD_COUNTS.name}")
    feed_etl.stage_entries(spark, feeds.feed_entries(_illustrated(spark, d)), "job-1", NOW, counts=counts, **layers)
    return spark.table(counts)


def stream_entries(spark, d):
    """Entries landed as JSON arrays in two deliveries, the second with all of the
    first again; the stream stages each after it has landed."""
    layers, entries = _layers(spark), _entries(spark, d)
    landing_folder, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    first = F.get("tags.term", F.lit(0)) == "en"
    for delivery in (entries.where(first), entries.withColumn("title", F.concat("title", F.lit(" again")))):
        _json_arrays(delivery, landing_folder, "append")
        landing.stage_landed_entries(spark, landing_folder, checkpoint, ingest_timestamp=NOW, **layers)
    stage = layers["stage_layer"]
    tags = spark.table(f"{stage}.tags").groupBy(F.col("post_id").alias("id")).agg(F.count(F.lit(1)).alias("n_tags"))
    return spark.table(f"{stage}.posts").select("id", "link", "title").join(tags, "id")


def feeds_in_column(spark, d):
    """One feed document per host, as fetched responses in a table; those of German
    pages break off. Entries of the good ones, names of the broken ones."""
    items = _items(spark, d).withColumns({
        "host": F.substring_index(F.substring_index("link", "/", 3), "/", -1), "bad": F.get("category", F.lit(0)) == "de"})
    documents = items.withColumn("item", _item_text()).groupBy("host", "bad").agg(F.concat_ws("", F.sort_array(F.collect_list("item"))).alias("body"))
    text = F.concat(F.lit(f'<rss version="2.0" xmlns:content="{CONTENT}"><channel><title>all</title>'), "body", F.lit("</channel></rss>"))
    documents = documents.withColumn("document", F.when(~F.col("bad"), text).otherwise(F.substring(text, 1, 200)))
    found, broken = feeds.column_items(documents, "document", "host")
    entries = feeds.feed_entries(found).select("feed", "id", "link", "title", F.md5(F.get("content", F.lit(0))["value"]).alias("body"))
    return entries.unionByName(broken, allowMissingColumns=True)


def csv_round_trip(spark, d):
    """Texts with newlines and quotes, and arrays, through CSV."""
    folder = scratch_path(spark, "csv")
    docs = table(spark, d, "documents").select("doc_id", "text", F.array("lang", "source").alias("labels"))
    sink.write_csv(docs, folder)
    back = files.read_csv(spark, folder, "doc_id bigint, text string, labels string")
    return back.select(
        "doc_id", F.md5("text").alias("body"), F.array_join(F.from_json("labels", "array<string>"), ",").alias("labels")
    )


def jsonl_round_trip(spark, d):
    folder = scratch_path(spark, "jsonl")
    sink.write_json_lines(table(spark, d, "documents"), folder)
    back = files.read_json_lines(spark, folder, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return back.select("doc_id", F.md5("text").alias("body"), "lang", "source", "n_chars")


def _json_arrays(df, folder, mode="errorifexists"):
    """One JSON array per written file."""
    lines = df.select(F.to_json(F.struct(*(f"`{c}`" for c in df.columns))).alias("value"))

    def wrap(batches):
        opening = "["
        for batch in batches:
            for some in pieces(batch.column(0)):
                marks = pa.array([opening] + [","] * (len(some) - 1))
                yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(marks, some, "")], ["value"])
                opening = ","
        yield _line("]" if opening == "," else "[]")

    lines.mapInArrow(wrap, "value string").write.mode(mode).text(folder)


def entries_array(spark, d):
    """Entries landed as a JSON array per file."""
    folder = scratch_path(spark, "arrays")
    _json_arrays(_entries(spark, d), folder)
    flat = feeds.flat_entries(feeds.read_entries(spark, folder), "job-1")
    return flat.select("id", "title", "link", "published_timestamp", "job_id", F.md5("post_source").alias("body"))


def jsonl_inferred(spark, d):
    """JSON lines with inferred types through a table."""
    folder, name = scratch_path(spark, "jsonl"), f"inferred_{uuid.uuid4().hex[:12]}"
    sink.write_json_lines(table(spark, d, "documents"), folder)
    catalog.create_layer(spark, name, scratch_path(spark, name))
    return files.load_json_lines(spark, folder, f"{name}.documents").select(
        "doc_id", F.md5("text").alias("body"), "lang", "source", "n_chars")


def csv_inferred(spark, d):
    """Types of a CSV file found by reading it."""
    folder = scratch_path(spark, "csv")
    sink.write_csv(table(spark, d, "part"), folder)
    return files.read_csv(spark, folder)


def sql_to_csv(spark, d):
    """The whole result of a query as CSV, read back."""
    docs = table(spark, d, "documents")
    result = query(spark, "SELECT doc_id, text, n_chars * 2 AS twice FROM {docs} WHERE lang <> :lang", {"lang": "en"}, docs=docs)
    back = files.read_csv(spark, sink.write_query_csv(result, scratch_path(spark, "query")), "doc_id bigint, text string, twice bigint")
    return back.select("doc_id", F.md5("text").alias("body"), "twice")


def feeds_skip_bad(spark, d):
    """Feeds of which one file breaks off: its last item is left out."""
    folder = scratch_path(spark, "feed")
    _as_feed(_items(spark, d)).write.text(folder)
    broken = F.lit("<rss><channel><item><guid>broken</guid><title>no end")
    spark.range(1).select(broken.alias("value")).write.mode("append").text(folder)
    return feeds.read_feeds(spark, folder, on_error="skip").select("id", "link", F.md5(F.get("content", F.lit(0))["value"]).alias("body"))


def parquet_by_language(spark, d):
    folder = scratch_path(spark, "parquet")
    sink.write_parquet(table(spark, d, "documents"), folder, partition_by=["lang"])
    return files.read_parquet(spark, folder).select("doc_id", "lang", "source", F.md5("text").alias("body"))


QUERIES = {
    "feed_xml": feed_xml,
    "entries_json": entries_json,
    "flat_posts": flat_posts,
    "flat_stage": flat_stage,
    "etl_posts": etl_posts,
    "etl_tags": etl_tags,
    "etl_links": etl_links,
    "feed_etl_run": feed_etl_run,
    "etl_rejects": etl_rejects,
    "etl_counts": etl_counts,
    "stream_entries": stream_entries,
    "feeds_in_column": feeds_in_column,
    "csv_round_trip": csv_round_trip,
    "jsonl_round_trip": jsonl_round_trip,
    "parquet_by_language": parquet_by_language,
    "entries_array": entries_array,
    "jsonl_inferred": jsonl_inferred,
    "csv_inferred": csv_inferred,
    "sql_to_csv": sql_to_csv,
    "feeds_skip_bad": feeds_skip_bad,
}

_TAGS = """
    SELECT CAST(page_id AS VARCHAR) AS post_id,
           unnest([regexp_extract(html, '<html lang="([a-z]+)"', 1), string_split(url, ':')[1]]) AS term
    FROM pages"""

_LINKS = f"""
    SELECT CAST(page_id AS VARCHAR) AS post_id,
           CAST(unnest(generate_series(0, len(hrefs) - 1)) AS INTEGER) AS index,
           unnest(hrefs) AS href, unnest(list_transform(titles, lambda x: {unescaped('x')})) AS title
    FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs,
                 regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS titles FROM pages)"""

SQL = {
    "feed_xml": f"""
        SELECT CAST(page_id AS VARCHAR) AS id, url AS link, 'Page ' || page_id AS title, '{PUBLISHED}' AS published,
               regexp_extract(html, '<html lang="([a-z]+)"', 1) || ',' || string_split(url, ':')[1] AS terms,
               md5(html) AS body
        FROM pages""",
    "entries_json": f"""
        SELECT CAST(page_id AS VARCHAR) AS id, 'Page ' || page_id AS title, url AS link,
               '{PUBLISHED}' AS published_timestamp, 'job-1' AS job_id, md5(html) AS body
        FROM pages""",
    "flat_posts": """
        SELECT CAST(page_id AS VARCHAR) AS id, url, epoch_us(TIMESTAMP '2024-09-17 17:03:44') AS published_micros,
               'job-1' AS job_id, url AS raw_link
        FROM pages""",
    "flat_stage": """
        SELECT CAST(page_id AS VARCHAR) AS id, url, 'job-1' AS job_id, md5(html) AS body FROM pages
        QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1""",
    "etl_posts": f"""
        SELECT CAST(page_id AS VARCHAR) AS id, url AS link, 'Page ' || page_id AS title,
               {unescaped(unescaped(VISIBLE))} AS content_text, 'job-1' AS job_id,
               TIMESTAMP '2024-09-17 10:03:44' AS published, TIMESTAMP '2024-09-21 18:21:00' AS ingest_timestamp
        FROM pages""",
    "etl_tags": f"""
        SELECT term, post_id, 'job-1' AS job_id, TIMESTAMP '2024-09-21 18:21:00' AS ingest_timestamp FROM ({_TAGS})""",
    "etl_links": _LINKS,
    "feed_etl_run": f"""
        WITH n AS (SELECT CAST(page_id AS VARCHAR) AS post_id, page_id FROM pages)
        SELECT 'posts' AS table_name, post_id, '' AS rest, 'Page ' || post_id AS more FROM n
        UNION ALL
        SELECT DISTINCT 'tags', post_id, term, '' FROM ({_TAGS})
        UNION ALL
        SELECT DISTINCT 'links', post_id, index || '|' || href, title FROM ({_LINKS})
        UNION ALL
        SELECT 'images', post_id, '0|/img/' || p_partkey || '.png', p_size || '|' || CAST(round_even(p_retailprice, 0) AS INTEGER)
        FROM n JOIN part ON p_partkey = page_id
        UNION ALL
        SELECT 'images', post_id, CASE WHEN p_partkey IS NULL THEN '0' ELSE '2' END || '|/face/' || c_custkey || '.png', ''
        FROM n JOIN customer ON c_custkey = page_id LEFT JOIN part ON p_partkey = page_id
        UNION ALL
        SELECT 'authors', post_id, '0|' || c_name, '/face/' || c_custkey || '.png|of ' || c_mktsegment
        FROM n JOIN customer ON c_custkey = page_id""",
    "etl_rejects": f"""
        WITH bad AS (SELECT CAST(page_id AS VARCHAR) AS post_id, url FROM pages WHERE regexp_extract(html, '<html lang="([a-z]+)"', 1) = 'de')
        SELECT DISTINCT 'posts' AS table_name, url AS row FROM bad
        UNION ALL
        SELECT DISTINCT 'tags', term FROM ({_TAGS}) SEMI JOIN bad USING (post_id)
        UNION ALL
        SELECT DISTINCT 'links', index || '|' || href || '|' || title FROM ({_LINKS}) SEMI JOIN bad USING (post_id)""",
    "etl_counts": f"""
        SELECT 'job-1' AS job_id, 'posts' AS step, count(*) AS rows FROM pages
        UNION ALL SELECT 'job-1', 'tags', count(*) FROM ({_TAGS})
        UNION ALL SELECT 'job-1', 'links', count(*) FROM ({_LINKS})
        UNION ALL SELECT 'job-1', 'images', (SELECT count(*) FROM pages JOIN part ON p_partkey = page_id) + (SELECT count(*) FROM pages JOIN customer ON c_custkey = page_id)
        UNION ALL SELECT 'job-1', 'authors', count(*) FROM pages JOIN customer ON c_custkey = page_id""",
    "stream_entries": f"""
        SELECT CAST(page_id AS VARCHAR) AS id, url AS link,
               'Page ' || page_id || CASE WHEN regexp_extract(html, '<html lang="([a-z]+)"', 1) = 'en' THEN '' ELSE ' again' END AS title, n_tags
        FROM pages JOIN (SELECT post_id, count(DISTINCT term) AS n_tags FROM ({_TAGS}) GROUP BY post_id) ON post_id = CAST(page_id AS VARCHAR)""",
    "feeds_in_column": """
        WITH p AS (SELECT *, string_split(url, '/')[3] AS feed, regexp_extract(html, '<html lang="([a-z]+)"', 1) = 'de' AS bad FROM pages)
        SELECT feed, CAST(page_id AS VARCHAR) AS id, url AS link, 'Page ' || page_id AS title, md5(html) AS body FROM p WHERE NOT bad
        UNION ALL
        SELECT DISTINCT feed, NULL, NULL, NULL, NULL FROM p WHERE bad""",
    "csv_round_trip": "SELECT doc_id, md5(text) AS body, lang || ',' || source AS labels FROM documents",
    "jsonl_round_trip": "SELECT doc_id, md5(text) AS body, lang, source, n_chars FROM documents",
    "jsonl_inferred": "SELECT doc_id, md5(text) AS body, lang, source, n_chars FROM documents",
    "csv_inferred": "SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
    "sql_to_csv": "SELECT doc_id, md5(text) AS body, n_chars * 2 AS twice FROM documents WHERE lang <> 'en'",
    "feeds_skip_bad": "SELECT CAST(page_id AS VARCHAR) AS id, url AS link, md5(html) AS body FROM pages",
    "parquet_by_language": "SELECT doc_id, lang, source, md5(text) AS body FROM documents",
}

SQL["entries_array"] = SQL["entries_json"]
