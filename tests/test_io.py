import json

import pytest

from feedloom import catalog
from feedloom.schemas import ALL_TABLES, Table
from feedloom.sinks import files as sink
from feedloom.sinks import tables as into
from feedloom.sources import feeds, files
from feedloom.sources import tables as src

ITEM = """<item><guid isPermaLink="false">{id}</guid><link>http://x/{id}</link><title>T{id}</title>
<description>d</description><pubDate>Tue, 17 Sep 2024 10:03:44 -0700</pubDate>{extra}</item>"""
FEED = '<?xml version="1.0"?><rss xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>f</title>{items}</channel></rss>'


def land(folder, name, *items):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(FEED.format(items="".join(items)))


def test_feeds(spark, tmp_path):
    full = ITEM.format(id="a", extra="<category>X</category><category>Y</category><content:encoded><![CDATA[<p>hi</p>]]></content:encoded>")
    land(tmp_path / "f", "one.xml", full, ITEM.format(id="b", extra=""))
    land(tmp_path / "f", "two.xml", ITEM.format(id="c", extra=""))
    got = {r.id: r for r in feeds.read_feeds(spark, str(tmp_path / "f")).collect()}
    assert got.keys() == {"a", "b", "c"}
    assert [t.term for t in got["a"].tags] == ["X", "Y"] and got["a"].content[0].value == "<p>hi</p>"
    assert got["b"].content == [] and got["b"].tags == []
    assert got["c"].feed.endswith("two.xml")
    flat = feeds.flat_entries(feeds.read_feeds(spark, str(tmp_path / "f")), "job").orderBy("id").collect()
    assert (flat[0].post_source, flat[1].post_source, flat[0].job_id) == ("<p>hi</p>", None, "job")


def test_bad_feed_policies(spark, tmp_path):
    folder = tmp_path / "bad"
    land(folder, "good.xml", ITEM.format(id="a", extra=""))
    (folder / "broken.xml").write_text("<rss><channel><item><guid>z</guid><title>oops</item></channel></rss>")
    with pytest.raises(Exception):
        feeds.read_feeds(spark, str(folder), "fail").collect()
    assert [r.id for r in feeds.read_feeds(spark, str(folder), "skip").collect()] == ["a"]
    with pytest.raises(ValueError):
        feeds.read_feeds(spark, str(folder), "other")


ENTRY = dict(id="1", link="l", title="t", summary="s", published="p", tags=[dict(term="x", scheme=None, label=None)],
             content=[dict(type="text/html", value="<p>é\n</p>")], extra={"dropped": True})


def test_entries_as_array_and_as_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([ENTRY, ENTRY | {"id": "2"}], indent=1))
    (tmp_path / "b.jsonl").write_text("\n".join(json.dumps(ENTRY | {"id": i}) for i in "34") + "\n")
    array = feeds.read_entries(spark, str(tmp_path / "a.json"))
    lines = feeds.read_entries(spark, str(tmp_path / "b.jsonl"), lines=True)
    both = feeds.union_feeds(array, lines).orderBy("id").collect()
    assert [r.id for r in both] == ["1", "2", "3", "4"]
    assert {r.content[0].value for r in both} == {"<p>é\n</p>"} and "extra" not in both[0].asDict()
    assert files.read_json_array(spark, str(tmp_path / "a.json"), "id string").count() == 2
    assert "extra" in files.read_json_array(spark, str(tmp_path / "a.json")).columns


def test_csv_with_newlines_quotes_and_arrays(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q"\nline, two', ["x", "y"]), (2, None, [])], "id int, text string, labels array<string>")
    sink.write_csv(df, str(tmp_path / "c"))
    back = files.read_csv(spark, str(tmp_path / "c")).orderBy("id").collect()
    assert [(r.id, r.text, json.loads(r.labels)) for r in back] == [(1, 'a "q"\nline, two', ["x", "y"]), (2, None, [])]


def test_job_artifact_is_replaced_by_a_retry(spark, tmp_path):
    one, two = (spark.createDataFrame([(v,)], "v int") for v in (1, 2))
    sink.write_job_artifact(one, str(tmp_path / "jobs"), "a")
    sink.write_job_artifact(one, str(tmp_path / "jobs"), "b")
    sink.write_job_artifact(two, str(tmp_path / "jobs"), "b")
    got = {(r.job_id, r.v) for r in spark.read.json(str(tmp_path / "jobs")).collect()}
    assert got == {("a", 1), ("b", 2)}


def test_query_as_csv(spark, tmp_path):
    df = src.inline_rows(spark, [(1, "a,b"), (2, 'say "x"')], "id int, `v,w` string")
    assert sink.preview(df, 5) == 'id,"v,w"\n1,"a,b"\n2,"say ""x"""'
    assert sink.preview(df, 1) == 'id,"v,w"\n1,"a,b"\n# more than 1 rows'
    many = spark.range(3000).selectExpr("id", "concat('q\"', id) AS v")
    back = spark.read.option("header", True).option("escape", '"').csv(sink.write_query_csv(many, str(tmp_path / "q")))
    assert back.count() == 3000 and back.filter("v = concat('q\"', id)").count() == 3000


@pytest.fixture
def layer(spark):
    catalog.recreate_layer(spark, "iotest")
    yield "iotest"
    catalog.drop_layer(spark, "iotest")
    assert "iotest" not in {r[0] for r in catalog.databases(spark).collect()}


def test_tables(spark, layer, rows, tmp_path):
    declared = Table(layer, "users", {"user_id": "int", "username": "string", "created_at": "timestamp_ntz"},
                     key=("user_id",), defaults={"created_at": "localtimestamp()"})
    name = catalog.create_table(spark, declared)
    assert catalog.create_table(spark, declared) == name
    into.insert_row(spark, name, user_id=1, username="o'neil")
    into.insert_select(src.inline_rows(spark, [("b", 2)], "username string, user_id int"), name)
    into.append(spark.table(name).selectExpr("created_at", "username", "user_id + 10 AS user_id"), name)
    got = spark.table(name).orderBy("user_id").collect()
    assert [(r.user_id, r.username) for r in got] == [(1, "o'neil"), (2, "b"), (11, "o'neil"), (12, "b")]
    assert all(r.created_at for r in got)

    catalog.clone_empty(spark, name, f"{layer}.copy")
    assert spark.table(f"{layer}.copy").columns == spark.table(name).columns and spark.table(f"{layer}.copy").count() == 0
    into.create_from(spark.table(name), f"{layer}.full")
    with pytest.raises(Exception):
        into.create_from(spark.table(name), f"{layer}.full")
    catalog.replace_table(spark.table(name).limit(1), f"{layer}.full")
    assert spark.table(f"{layer}.full").count() == 1
    catalog.create_view(spark, f"{layer}.v", f"SELECT username FROM {name} WHERE user_id > 10")
    assert src.read_table(spark, f"{layer}.v").count() == 2
    assert {r.tableName for r in catalog.tables(spark, layer).collect()} == {"users", "copy", "full", "v"}
    assert rows(catalog.describe(spark, name))[0] == ("user_id", "int")

    (tmp_path / "q.sql").write_text("SELECT username FROM {people} WHERE user_id = :id")
    assert rows(src.query_file(spark, str(tmp_path / "q.sql"), {"id": 2}, people=spark.table(name))) == [("b",)]

    (tmp_path / "p.jsonl").write_text('{"a": 1, "b": "x"}\n')
    assert files.load_json_lines(spark, str(tmp_path / "p.jsonl"), f"{layer}.loaded").dtypes == [("a", "bigint"), ("b", "string")]


def test_all_declared_tables(spark):
    catalog.create_all(spark, buckets=4)
    for t in ALL_TABLES:
        assert {f.name: f.dataType.simpleString() for f in spark.table(t.full_name).schema} == t.columns
    for layer in {t.layer for t in ALL_TABLES}:
        catalog.drop_layer(spark, layer)


def test_series(spark):
    year = src.year_series(spark, 2040)
    assert year.count() == 366 and year.filter("sales < 1000 OR sales >= 5000").isEmpty()
    assert year.exceptAll(src.year_series(spark, 2040)).isEmpty()
    assert not year.exceptAll(src.year_series(spark, 2040, seed=1)).isEmpty()


def test_feeds_held_in_a_column(spark):
    good = """<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>t</title>
        <item><guid isPermaLink="false">1</guid><link>/1</link><category>a</category><category>b</category><content:encoded><![CDATA[<p>x</p>]]></content:encoded></item>
        <item><guid>2</guid></item></channel></rss>"""
    rows = [("good", good), ("cut", good[:200]), ("none", None), ("text", "no feed"), ("empty", "<rss><channel><title>t</title></channel></rss>")]
    items, broken = feeds.column_items(spark.createDataFrame(rows, "name string, doc string"), "doc", "name")
    entries = {r.id: r for r in feeds.feed_entries(items).collect()}
    assert set(entries) == {"1", "2"} and entries["1"].feed == "good" and entries["1"].content[0].value == "<p>x</p>"
    assert [t.term for t in entries["1"].tags] == ["a", "b"] and entries["2"].content == []
    assert {r.feed for r in broken.collect()} == {"cut", "none", "text"}
