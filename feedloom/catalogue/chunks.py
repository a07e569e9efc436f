"""Chunking, vectors, retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.catalogue.base import label_tags, posts, table
from feedloom.functions.chunking import (
    RECURSIVE_SIZE, TOKENS_OVERLAP, TOKENS_SIZE, explode_chunks, recursive_chunks, sentence_chunks,
)
from feedloom.functions.text import word_count
from feedloom.operators import cosine, vectors
from feedloom.session import materialize

TOP_K = 10
CONTEXT_K = 5


def chunk_fixed(spark, d):
    return explode_chunks(table(spark, d, "documents"), "text", ["doc_id"], "fixed")


def chunk_paragraph(spark, d):
    return explode_chunks(table(spark, d, "documents"), "text", ["doc_id"], "paragraph", separator="\n")


def chunk_recursive(spark, d):
    return explode_chunks(table(spark, d, "documents"), "text", ["doc_id"], "recursive")


def chunk_sentence(spark, d):
    return explode_chunks(table(spark, d, "documents"), "text", ["doc_id"], "sentence")


def _cover(chunks):
    """Digest of all characters of the chunks but whitespace."""
    return F.md5(F.regexp_replace(F.array_join(chunks, ""), r"[\s\x{A0}]+", ""))


def chunk_recursive_cover(spark, d):
    """Without overlap the chunks hold every visible character of the text once."""
    docs = table(spark, d, "documents").select("doc_id", recursive_chunks("text", overlap=0).alias("c"))
    too_long = F.size(F.filter("c", lambda c: F.length(c) > RECURSIVE_SIZE)).cast("bigint")
    return docs.select("doc_id", _cover("c").alias("body"), too_long.alias("too_long"))


def chunk_sentence_cover(spark, d):
    docs = table(spark, d, "documents").select("doc_id", sentence_chunks("text", overlap=0).alias("c"))
    too_long = F.size(F.filter("c", lambda c: word_count(c) > TOKENS_SIZE)).cast("bigint")
    return docs.select("doc_id", _cover("c").alias("body"), too_long.alias("too_long"))


def _centroid_hits(spark, d, k):
    """One query per label: the mean of its vectors, against all vectors."""
    items = table(spark, d, "embeddings")
    hits = cosine.cosine_topk(
        vectors.centroids(items, "label", "embedding"), items, k, "label", "vector", "vec_id", "embedding"
    )
    return materialize(hits, "hits")


def cosine_topk(spark, d):
    return _centroid_hits(spark, d, TOP_K).withColumn("score", F.round("score", 6))


def cosine_topk_all(spark, d):
    """Every vector as a query against all of them."""
    items = table(spark, d, "embeddings")
    hits = cosine.cosine_topk(items, items, 3, "vec_id", "embedding", "vec_id", "embedding")
    return hits.withColumn("score", F.round("score", 6))


def rag_context(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    hits = vectors.hits_with_metadata(_centroid_hits(spark, d, CONTEXT_K), docs)
    return vectors.retrieval_context(hits, "text")


def rag_top_article(spark, d):
    docs = posts(spark, d).select("id", "title", F.col("content_text").alias("content_source"), "content_text")
    hits = _centroid_hits(spark, d, 1)
    return vectors.top_article(hits.withColumn("post_id", F.col("item_id")), docs, label_tags(spark, d)).select(
        "query_id", "id", "title", "content_text", "tags"
    )


def chunk_records(spark, d):
    """Documents to chunk records with hashed 768-dimensional vectors, cut in
    fixed windows."""
    docs = posts(spark, d).select(
        F.col("id").cast("string"), F.lit("/doc").alias("link"), "title", "content_text",
        F.lit("2024-01-01").cast("timestamp_ntz").alias("published"),
    )
    embedder = vectors.HashingEmbedder.fit(docs, "content_text")
    records = vectors.chunk_records(docs, embedder, strategy="fixed")
    return records.select("id", "metadata.*", F.size("values").alias("dimensions"))


def text_search(spark, d):
    """Benchmark texts as questions against the chunk vectors of all documents."""
    docs = posts(spark, d).select(F.col("id").alias("doc_id"), F.col("content_text").alias("text"))
    embedder = vectors.HashingEmbedder.fit(docs, "text")
    chunks = explode_chunks(docs, "text", ["doc_id"], "fixed").select(
        F.concat_ws("_", "doc_id", "chunk_index").alias("id"), "chunk_text"
    )
    index = materialize(embedder.transform(chunks, "chunk_text", "values").select("id", "values"), "index")
    asked = embedder.transform(table(spark, d, "benchmark"), "text", "vector")
    return cosine.cosine_topk(asked, index, 3, "item_id")


def doc_compare(spark, d):
    """Each turn of a conversation against the next one."""
    turns = table(spark, d, "conversations")
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"))
    pairs = turns.select("conv_id", "turn", "text").join(following, ["conv_id", "turn"])
    compared = vectors.compare_texts(pairs, "text", "reply", ["conv_id", "turn"])
    joined = {c: F.array_join(c, " ") for c in ("shared", "only_left", "only_right")}
    return compared.withColumns({**joined, "jaccard": F.round("jaccard", 6)})


QUERIES = {
    "chunk_fixed": chunk_fixed,
    "chunk_paragraph": chunk_paragraph,
    "chunk_recursive": chunk_recursive,
    "chunk_sentence": chunk_sentence,
    "chunk_recursive_cover": chunk_recursive_cover,
    "chunk_sentence_cover": chunk_sentence_cover,
    "chunk_records": chunk_records,
    "cosine_topk": cosine_topk,
    "cosine_topk_all": cosine_topk_all,
    "rag_context": rag_context,
    "rag_top_article": rag_top_article,
    "text_search": text_search,
    "doc_compare": doc_compare,
}


def _hits(k: int) -> str:
    return f"""
    WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    parts AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e),
    means AS (SELECT label, i, avg(x) AS x FROM parts GROUP BY label, i),
    q AS (SELECT label AS query_id, list(x ORDER BY i) AS v FROM means GROUP BY label),
    scored AS (
        SELECT q.query_id, e.vec_id AS item_id, round(list_cosine_similarity(q.v, e.v), 9) AS score FROM q, e
    ),
    hits AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS INTEGER) AS rank
        FROM scored QUALIFY rank <= {k}
    )"""


_COVER = r"""
    SELECT doc_id, md5(regexp_replace(text, '[\s\x{A0}]+', '', 'g')) AS body, CAST(0 AS BIGINT) AS too_long FROM documents"""

SQL = {
    "chunk_fixed": r"""
        WITH t AS (
            SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM documents
        ),
        s AS (
            SELECT doc_id, w, unnest(generate_series(0, greatest(len(w) - 51, 0), 250)) AS pos FROM t WHERE len(w) > 0
        )
        SELECT doc_id, CAST(pos / 250 AS INTEGER) AS chunk_index,
               array_to_string(w[pos + 1 : pos + 300], ' ') AS chunk_text
        FROM s""",
    "chunk_records": r"""
        WITH t AS (
            SELECT doc_id, string_split(text, chr(10))[1] AS title,
                   list_filter(regexp_split_to_array(replace(text, chr(160), ' '), '\s+'), lambda x: x <> '') AS w FROM documents
        ),
        s AS (
            SELECT *, unnest(generate_series(0, greatest(len(w) - 51, 0), 250)) AS pos FROM t WHERE len(w) > 0
        )
        SELECT doc_id || '_' || CAST(pos / 250 AS INTEGER) AS id, '/doc' AS link, title,
               epoch_us(TIMESTAMP '2024-01-01') AS published_timestamp, CAST(pos / 250 AS INTEGER) AS chunk_index,
               CAST(doc_id AS VARCHAR) AS post_id, array_to_string(w[pos + 1 : pos + 300], ' ') AS chunk_text,
               CAST(768 AS INTEGER) AS dimensions
        FROM s""",
    "chunk_paragraph": """
        SELECT doc_id, CAST(generate_subscripts(p, 1) - 1 AS INTEGER) AS chunk_index, unnest(p) AS chunk_text
        FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)""",
    "chunk_sentence": rf"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w,
                   string_split(regexp_replace(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), '\n+', chr(1), 'g'), chr(1)) AS s
            FROM documents),
        n AS (
            SELECT doc_id, unnest(list_transform(s, lambda x: len(list_filter(regexp_split_to_array(x, '\s+'), lambda y: y <> '')))) AS n,
                   generate_subscripts(s, 1) AS k FROM w),
        cut AS (SELECT doc_id, k, start, least({TOKENS_SIZE}, n - start) AS n FROM n, range(0, n, {TOKENS_SIZE}) t(start)),
        u AS MATERIALIZED (
            SELECT doc_id, n, row_number() OVER same AS i, CAST(sum(n) OVER same - n AS BIGINT) AS pos FROM cut
            WINDOW same AS (PARTITION BY doc_id ORDER BY k, start)),
        starts AS MATERIALIZED (SELECT doc_id, list(pos ORDER BY pos) AS p, CAST(sum(n) AS BIGINT) AS total FROM u GROUP BY doc_id),
        fold AS (
            SELECT doc_id, 0::BIGINT AS i, 0::BIGINT AS start, NULL::BIGINT AS a, NULL::BIGINT AS b FROM starts
            UNION ALL
            SELECT f.doc_id, u.i,
                   CASE WHEN u.pos > f.start AND u.pos - f.start + u.n > {TOKENS_SIZE}
                        THEN list_min(list_filter(p, lambda x: x >= greatest(f.start, u.pos - least({TOKENS_OVERLAP}, {TOKENS_SIZE} - u.n)))) ELSE f.start END,
                   CASE WHEN u.pos > f.start AND u.pos - f.start + u.n > {TOKENS_SIZE} THEN f.start END, u.pos
            FROM fold f JOIN u ON u.doc_id = f.doc_id AND u.i = f.i + 1 JOIN starts s ON s.doc_id = f.doc_id),
        spans AS (
            SELECT doc_id, i, a, b FROM fold WHERE a IS NOT NULL
            UNION ALL
            SELECT doc_id, i + 1, start, total FROM fold JOIN starts USING (doc_id)
            QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY i DESC) = 1)
        SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS chunk_index,
               array_to_string(w[a + 1 : b], ' ') AS chunk_text
        FROM spans JOIN w USING (doc_id)""",
    "chunk_recursive_cover": _COVER,
    "chunk_sentence_cover": _COVER,
    "cosine_topk_all": """
        WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        scored AS (SELECT q.vec_id AS query_id, e.vec_id AS item_id, round(list_cosine_similarity(q.v, e.v), 9) AS score FROM e q, e)
        SELECT query_id, item_id, round(score, 6) AS score,
               CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS INTEGER) AS rank
        FROM scored QUALIFY rank <= 3""",
    "cosine_topk": _hits(TOP_K) + " SELECT query_id, item_id, round(score, 6) AS score, rank FROM hits",
    "rag_context": _hits(CONTEXT_K) + """
        SELECT query_id, string_agg(text, chr(10) ORDER BY rank) AS context
        FROM hits JOIN documents ON doc_id = item_id GROUP BY query_id""",
    "rag_top_article": _hits(1) + """
        , tags AS (
            SELECT doc_id AS post_id, unnest([source, lang]) AS term FROM documents
            WHERE doc_id IN (SELECT doc_id FROM labels)
        )
        SELECT query_id, doc_id AS id, string_split(text, chr(10))[1] AS title, text AS content_text,
               (SELECT string_agg(term, ', ' ORDER BY term) FROM tags WHERE post_id = doc_id) AS tags
        FROM hits JOIN documents ON doc_id = item_id""",
    "doc_compare": r"""
        WITH w AS (
            SELECT conv_id, turn, list_distinct(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '')) AS s
            FROM conversations
        ),
        p AS (SELECT a.conv_id, a.turn, a.s AS l, b.s AS r FROM w a JOIN w b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)
        SELECT conv_id, turn,
               array_to_string(list_sort(list_intersect(l, r)), ' ') AS shared,
               array_to_string(list_sort(list_filter(l, lambda x: NOT list_contains(r, x))), ' ') AS only_left,
               array_to_string(list_sort(list_filter(r, lambda x: NOT list_contains(l, x))), ' ') AS only_right,
               round(len(list_intersect(l, r)) / nullif(len(list_distinct(list_concat(l, r))), 0), 6) AS jaccard
        FROM p""",
}
