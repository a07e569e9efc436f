"""HTML queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.catalogue.base import table
from feedloom.functions.html import author_bio, parts_of_html
from feedloom.functions.values import lenient_int


def html_text(spark, d):
    parsed = table(spark, d, "pages").select("page_id", parts_of_html("html", "text").alias("p"))
    return parsed.select("page_id", F.col("p.text").alias("content_text"))


def html_links(spark, d):
    parsed = table(spark, d, "pages").select("page_id", parts_of_html("html", "links").alias("p"))
    return parsed.select("page_id", F.inline("p.links")).na.drop(subset=["href"])


def html_paragraphs(spark, d):
    parsed = table(spark, d, "pages").select("page_id", parts_of_html("html", "paragraphs").alias("p"))
    return parsed.select("page_id", F.posexplode("p.paragraphs").alias("index", "paragraph"))


def html_page_paragraphs(spark, d):
    """All paragraphs of a page joined by a blank line."""
    parsed = table(spark, d, "pages").select("page_id", parts_of_html("html", "paragraphs").alias("p"))
    return parsed.select("page_id", F.array_join("p.paragraphs", "\n\n").alias("content"))


def _dealt(rows):
    """Short rows of which long pages are made: a small file is read by one task, and the
    parsing of its pages goes to all of them."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def html_images(spark, d):
    """Every part as a small product page: a sized image, one without source,
    one with a relative width."""
    page = F.expr("""concat('<div><p>', p_name, '</p><img src="/img/', p_partkey, '.png" width="', p_size,
        '" height="', p_retailprice, '"><img alt="none"><img src="/b/', p_partkey, '" width="100%"></div>')""")
    parts = _dealt(table(spark, d, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"))
    parsed = parts.select("p_partkey", parts_of_html(page, "images").alias("p"))
    rows = parsed.select("p_partkey", F.inline("p.images")).na.drop(subset=["src"])
    return rows.withColumns({"width": lenient_int("width"), "height": lenient_int("height")})


def html_authors(spark, d):
    """Every customer as the author of a post: one full entry, entries without
    image or name, a nested paragraph that is no sibling."""
    page = F.expr("""concat('<p>Intro</p><h3>About the Authors</h3><p><img src="/a/', c_custkey, '.png"><strong>',
        c_name, '</strong> works in <b>', c_mktsegment, '</b> &amp; likes ', c_name, '.</p><p>No name</p><div><p><strong>x</strong>',
        '<img src="y"></p></div><p><strong>No image</strong> here</p><p><img src="/z.png"><strong> Z </strong>end</p>')""")
    people = _dealt(table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"))
    parsed = people.select("c_custkey", parts_of_html(page, "authors").alias("p"))
    rows = parsed.select("c_custkey", F.inline("p.authors")).na.drop(subset=["name", "image"])
    return rows.withColumn("bio", author_bio())


QUERIES = {
    "html_text": html_text,
    "html_links": html_links,
    "html_paragraphs": html_paragraphs,
    "html_page_paragraphs": html_page_paragraphs,
    "html_images": html_images,
    "html_authors": html_authors,
}


def unescaped(text: str) -> str:
    """SQL for the entities that occur in the pages, ampersand last."""
    for entity, char in (("&quot;", "'\"'"), ("&copy;", "chr(169)"), ("&middot;", "chr(183)"), ("&amp;", "'&'")):
        text = f"replace({text}, '{entity}', {char})"
    return text


VISIBLE = (
    "regexp_replace(regexp_replace(regexp_replace(html, '<(script|style)[^>]*>.*?</(script|style)>', '', 'gs'), "
    "'<!--.*?-->', '', 'gs'), '<[^>]*>', '', 'g')"
)

# A paragraph that opens with <b> is never closed and lasts until </article>.
_PARAGRAPHS = f"""
    WITH a AS (
        SELECT page_id, string_split(regexp_extract(html, '<article>(.*)</article>', 1, 's'), '<p>') AS pieces FROM pages
    ),
    p AS (
        SELECT page_id, CAST(i - 2 AS INTEGER) AS index,
               CASE WHEN pieces[i] LIKE '<b>%' THEN array_to_string(pieces[i:], '')
                    ELSE string_split(pieces[i], '</p>')[1] END AS body
        FROM (SELECT page_id, pieces, unnest(generate_series(2, len(pieces))) AS i FROM a)
    ),
    t AS (
        SELECT page_id, index,
               array_to_string(list_transform(regexp_split_to_array(body, '<[^>]*>'),
                   lambda x: trim({unescaped('x')}, E' \\n\\t\\r')), '') AS paragraph
        FROM p
    )"""

SQL = {
    "html_text": f"SELECT page_id, {unescaped(unescaped(VISIBLE))} AS content_text FROM pages",
    "html_links": f"""
        SELECT page_id, CAST(unnest(generate_series(0, len(hrefs) - 1)) AS INTEGER) AS index,
               unnest(hrefs) AS href, unnest(list_transform(titles, lambda x: {unescaped('x')})) AS title
        FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs,
                     regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS titles FROM pages)""",
    "html_paragraphs": _PARAGRAPHS + " SELECT page_id, index, paragraph FROM t",
    "html_page_paragraphs": _PARAGRAPHS + """
        SELECT page_id, string_agg(paragraph, chr(10) || chr(10) ORDER BY index) AS content FROM t GROUP BY page_id""",
    "html_images": """
        SELECT p_partkey, CAST(0 AS INTEGER) AS index, '/img/' || p_partkey || '.png' AS src,
               p_size AS width, CAST(round_even(p_retailprice, 0) AS INTEGER) AS height FROM part
        UNION ALL
        SELECT p_partkey, 2, '/b/' || p_partkey, NULL, NULL FROM part""",
    "html_authors": """
        SELECT c_custkey, CAST(0 AS INTEGER) AS index, c_name AS name, '/a/' || c_custkey || '.png' AS image,
               'works in ' || c_mktsegment || ' & likes ' || c_name || '.' AS bio FROM customer
        UNION ALL
        SELECT c_custkey, 3, 'Z', '/z.png', 'end' FROM customer""",
}
