import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from feedloom import catalog, session
from feedloom.operators.vectors import HashingEmbedder
from feedloom.plans import datasets, feed_etl, retrieval
from feedloom.schemas import EMBEDDED_POSTS, FEED_ENTRY, LOAD_COUNTS
from feedloom.sources.feeds import read_entries
from feedloom.sources.files import read_csv
from feedloom.streaming import landing

NOW = dt.datetime(2024, 9, 21, 18, 21)
HTML = (
    '<p>Hello <a href="/x">there</a><a name="n">no</a></p><img src="i.png" width="100%" height="13.5"><img>'
    '<h3>About the Authors</h3><p><img src="a.png"><strong>Ann</strong> writes.</p>'
)


def entry(i, **other):
    return dict(id=i, link=f"http://x/{i}", title=f"Title {i}", summary="s", published="Tue, 17 Sep 2024 10:03:44 -0700",
                tags=[dict(term="AWS"), dict(term=f"t{i}")], content=[dict(value=HTML)]) | other


def land(folder, name, *entries):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(entries))


@pytest.fixture
def layers(spark):
    names = dict(stage_layer="s_test", raw_layer="r_test")
    catalog.recreate_layer(spark, "s_test")
    feed_etl.set_up(spark, "s_test", buckets=4)
    yield names
    for layer in ("s_test", "r_test", "bad_test"):
        catalog.drop_layer(spark, layer)


def test_feed_etl(spark, layers, tmp_path, rows):
    land(tmp_path, "one.json", entry("a"), entry("b", content=[], tags=[]), entry("a", title="later"))
    entries = read_entries(spark, str(tmp_path / "one.json"))
    for job in ("j1", "j2"):
        feed_etl.stage_entries(spark, entries, job, NOW, **layers)
    posts = spark.table("s_test.posts").orderBy("id").collect()
    assert [(p.id, p.job_id) for p in posts] == [("a", "j1"), ("b", "j1")]
    assert posts[0].published == dt.datetime(2024, 9, 17, 10, 3, 44) and posts[0].ingest_timestamp == NOW
    assert posts[0].content_text.startswith("Hello there") and posts[1].content_text is None
    assert rows(spark.table("s_test.tags").select("term", "post_id"), "term") == [("AWS", "a"), ("ta", "a")]
    assert rows(spark.table("s_test.links").select("post_id", "index", "href", "title")) == [("a", 0, "/x", "there")]
    assert rows(spark.table("s_test.images").select("post_id", "index", "src", "width", "height"), "index") == [
        ("a", 0, "i.png", None, 14), ("a", 2, "a.png", None, None),
    ]
    assert rows(spark.table("s_test.authors").select("post_id", "index", "name", "image", "bio")) == [
        ("a", 0, "Ann", "a.png", "writes."),
    ]


def test_rows_without_key(spark, layers, tmp_path):
    land(tmp_path, "one.json", entry("a"), entry(None))
    entries = read_entries(spark, str(tmp_path / "one.json"))
    with pytest.raises(ValueError):
        feed_etl.stage_entries(spark, entries, "j", NOW, **layers)
    feed_etl.stage_entries(spark, entries, "j", NOW, reject_layer="bad_test", **layers)
    assert spark.table("s_test.posts").count() == 1 and spark.table("bad_test.posts").count() == 1


def test_raw_layer_is_the_runs_own(spark, layers, tmp_path):
    """The raw layer of another run stays, that of this run goes; steps are counted."""
    land(tmp_path, "one.json", entry("a"), entry("b"))
    catalog.recreate_layer(spark, "r_test_other")
    counts = catalog.create_table(spark, LOAD_COUNTS, "s_test.load_counts")
    try:
        feed_etl.stage_entries(spark, read_entries(spark, str(tmp_path / "one.json")), "job 1", NOW, counts=counts, **layers)
        names = {r.namespace for r in catalog.databases(spark).collect()}
        assert "r_test_other" in names and "r_test_job_1" not in names
        assert {(r.step, r.rows) for r in spark.table(counts).collect()} == {("posts", 2), ("tags", 4), ("links", 2), ("images", 4), ("authors", 2)}
    finally:
        catalog.drop_layer(spark, "r_test_other")


def test_datasets(spark, layers, tmp_path, rows):
    land(tmp_path / "in", "one.json", *(entry(str(i)) for i in range(30)))
    feed_etl.stage_entries(spark, read_entries(spark, str(tmp_path / "in")), "j", NOW, **layers)
    datasets.refresh_views(spark, "s_test", "ml_test")
    try:
        assert spark.table("ml_test.post_length").columns == ["title", "word_count", "created_at"]
        labels = {r.id: r.labels for r in spark.table("ml_test.post_tags").collect()}
        assert len(labels) == 30 and labels["0"] == "aws,t0" and labels["9"] == "aws"
        datasets.export_training_sets(spark, str(tmp_path / "out"), "ml_test")
        lengths = read_csv(spark, str(tmp_path / "out/post-length"))
        assert lengths.count() == 30 and lengths.dtypes[1] == ("word_count", "int")
        tags = read_csv(spark, str(tmp_path / "out/post-tags")).select(F.from_json("labels", "array<string>").alias("l"))
        assert {tuple(r.l) for r in tags.collect()} >= {("aws", "t0"), ("aws",)}
        assert datasets.training_rows(spark.table("s_test.posts"), 10).count() == 10
    finally:
        catalog.drop_layer(spark, "ml_test")


@pytest.fixture
def posts(spark):
    texts = {"p1": "cats purr and sleep. " * 60, "p2": "rockets fly to orbit. " * 60, "p3": ""}
    return spark.createDataFrame(
        [(k, f"/{k}", k.upper(), dt.datetime(2024, 1, 1), v, f"<p>{v}</p>") for k, v in texts.items()],
        "id string, link string, title string, published timestamp_ntz, content_text string, content_source string",
    )


@pytest.fixture
def ledger(spark):
    catalog.recreate_layer(spark, "g_test")
    yield catalog.create_table(spark, EMBEDDED_POSTS, f"g_test.{EMBEDDED_POSTS.name}")
    catalog.drop_layer(spark, "g_test")


def test_embed_and_answer(spark, posts, ledger, tmp_path, rows):
    embedder = HashingEmbedder.fit(posts, "content_text")
    index = retrieval.vector_table(spark, str(tmp_path / "v"))
    retrieval.embed_new_posts(spark, posts.filter("id = 'p1'"), index, embedder, ledger)
    first = index.read().count()
    for _ in range(2):
        retrieval.embed_new_posts(spark, posts, index, embedder, ledger)
    chunks = index.read()
    assert first > 1 and chunks.count() == chunks.select("id").distinct().count() > first
    assert {r.id for r in spark.table(ledger).collect()} == {"p1", "p2", "p3"} and spark.table(ledger).count() == 3
    assert chunks.filter("size(values) <> 768 OR length(metadata.chunk_text) > 350").isEmpty()
    assert chunks.first().metadata.published_timestamp == 1704067200000000

    asked = spark.createDataFrame([(1, "which rockets reach orbit"), (2, "  ")], "query_id int, question string")
    tags = spark.createDataFrame([("p2", "space"), ("p2", "fuel"), ("p1", "pets")], "post_id string, term string")
    answers = retrieval.answer_context(asked, chunks, embedder, posts, tags, k=2).collect()
    assert len(answers) == 1
    assert answers[0].id == "p2" and answers[0].tags == "fuel, space" and "rockets" in answers[0].context
    assert answers[0].context.count("\n") == 1


def test_a_shorter_post_leaves_no_stale_chunks(spark, posts, tmp_path):
    embedder = HashingEmbedder.fit(posts, "content_text")
    index = retrieval.vector_table(spark, str(tmp_path / "v"))
    retrieval.write_chunks(posts, index, embedder)
    others = index.read().filter("post_id <> 'p1'").count()
    short = posts.filter("id = 'p1'").withColumn("content_text", F.lit("just this"))
    retrieval.write_chunks(short, index, embedder)
    got = index.read()
    assert [r.metadata.chunk_text for r in got.filter("post_id = 'p1'").collect()] == ["just this"]
    assert got.filter("post_id <> 'p1'").count() == others


def test_stream_of_landed_entries(spark, layers, tmp_path):
    """A second run takes only the new file; known ids stay as they were."""
    land(tmp_path / "in", "1.json", entry("a"), entry("b"))
    for expected, name, extra in ((2, None, None), (3, "2.json", (entry("b", title="changed"), entry("c")))):
        if name:
            land(tmp_path / "in", name, *extra)
        landing.stage_landed_entries(spark, str(tmp_path / "in"), str(tmp_path / "cp"), ingest_timestamp=NOW, **layers)
        assert spark.table("s_test.posts").count() == expected
    titles = {r.id: r.title for r in spark.table("s_test.posts").collect()}
    assert titles == {"a": "Title a", "b": "Title b", "c": "Title c"}


def test_stream_of_posts_to_vectors(spark, posts, ledger, tmp_path):
    embedder = HashingEmbedder.fit(posts, "content_text")
    index = retrieval.vector_table(spark, str(tmp_path / "v"))
    for part in ("p1", "p2"):
        posts.filter(F.col("id") == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        shape = "id string, link string, title string, published timestamp_ntz, content_text string"
        stream = landing.read_landing(spark, str(tmp_path / "in"), shape)
        landing.embed_landed_posts(stream, index, embedder, str(tmp_path / "cp"), ledger)
    assert {r.post_id for r in index.read().select("post_id").distinct().collect()} == {"p1", "p2"}
    assert spark.table(ledger).count() == 2


def test_new_vectors_are_written_without_a_shuffle(spark, posts, ledger, tmp_path, monkeypatch, rows):
    """Vectors are dealt only where older rows join them; ids that are null or come twice and
    texts that are null or empty are listed once each, chunks are those of one row, and
    no copy of a batch stays."""
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path / "shared"))
    kind, hints = type(posts), []
    monkeypatch.setattr(kind, "hint", lambda self, name, *a, run=kind.hint: hints.append(name) or run(self, name, *a))
    embedder = HashingEmbedder.fit(posts, "content_text")
    index = retrieval.vector_table(spark, session.scratch_path(spark, "index"))
    shape = "id string, link string, title string, published timestamp_ntz, content_text string"
    day, long = dt.datetime(2024, 1, 1), " ".join(f"word{i}" for i in range(700))
    loads = [
        [("a", long), ("a", long), ("b", None), ("c", ""), (None, "no id"), (None, "no id")],
        [("d", "new text"), (None, None)],
        [("a", "shorter"), ("e", None)],
    ]
    for number, load in enumerate(loads):
        batch = spark.createDataFrame([(i, "/x", "t", day, t) for i, t in load], shape)
        batch.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = landing.read_landing(spark, str(tmp_path / "in"), shape)
        landing.embed_landed_posts(stream, index, embedder, str(tmp_path / "cp"), ledger, strategy="fixed")
        assert hints.count("rebalance") == (number == 2)
    got = sorted(rows(index.read().selectExpr("id", "post_id", "metadata.chunk_index", "size(values)")), key=repr)
    assert got == sorted([("a_0", "a", 0, 768), ("d_0", "d", 0, 768), ("0", None, 0, 768)], key=repr)
    assert [r[0] for r in rows(index.read().where("post_id = 'a'").select("metadata.chunk_text"))] == ["shorter"]
    ids = [r.id for r in spark.table(ledger).collect()]
    assert sorted(i for i in ids if i) == ["a", "b", "c", "d", "e"] and ids.count(None) == 2
    assert list(tmp_path.glob("shared/**/index-*")) and not list(tmp_path.glob("shared/**/posts-*"))


def test_a_replayed_batch_embeds_nothing(spark, posts, ledger, tmp_path):
    """The batch's number is in the version: the same batch again changes nothing, even if
    the ledger was not reached before."""
    embedder = HashingEmbedder.fit(posts, "content_text")
    index = retrieval.vector_table(spark, str(tmp_path / "v"))
    assert retrieval.write_chunks(posts, index, embedder, ("stream", 0))
    version, rows = index.version(), index.read().count()

    late = posts.withColumn("id", F.concat("id", F.lit("-late")))
    assert not index.replace(posts, posts.select(F.col("id").alias("post_id")), ("stream", 0))
    assert not retrieval.write_chunks(late, index, embedder, ("stream", 0))
    assert index.version() == version and index.read().count() == rows
    assert retrieval.write_chunks(late, index, embedder, ("stream", 1)) and index.read().count() == 2 * rows


def test_distinct_stream_across_batches(spark, tmp_path):
    shape = "k int, ts timestamp"
    for watermark in (None, ("ts", "1 hour")):
        home = tmp_path / str(bool(watermark))
        for batch in ([(1,), (2,), (1,)], [(2,), (3,)]):
            df = spark.createDataFrame([(k, dt.datetime(2024, 1, 1)) for (k,) in batch], shape)
            df.coalesce(1).write.mode("append").parquet(str(home / "in"))
            landing.distinct_stream(
                landing.read_landing(spark, str(home / "in"), shape, max_files=1), ["k"], str(home / "out"), str(home / "cp"), watermark
            )
        assert sorted(r.k for r in spark.read.parquet(str(home / "out")).collect()) == [1, 2, 3]


def test_entry_schema_is_readable(spark):
    assert spark.createDataFrame([], FEED_ENTRY).columns[0] == "id"
