import pytest
from pyspark.sql import functions as F

from feedloom import catalog
from feedloom.operators import upsert
from feedloom.operators.versioned import VersionedFolder
from feedloom.schemas import Table


@pytest.fixture
def stage(spark, request):
    layer = f"up_{abs(hash(request.node.name)) % 10**8}"
    catalog.recreate_layer(spark, layer)
    table = Table(layer, "t", {"id": "int", "v": "string"}, key=("id",))
    yield catalog.create_table(spark, table)
    catalog.drop_layer(spark, layer)


def kv(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id int, v string")


def test_insert_if_absent_is_idempotent(spark, stage, rows):
    upsert.insert_if_absent(spark, stage, kv(spark, (1, "old")), ["id"])
    for _ in range(2):
        upsert.insert_if_absent(spark, stage, kv(spark, (1, "x"), (2, "a"), (2, "b")), ["id"], ["v"])
        assert rows(spark.table(stage), "id") == [(1, "old"), (2, "a")]


def test_new_rows(spark, rows):
    old = kv(spark, *((i, "old") for i in range(0, 100, 3)))
    batch = kv(spark, *((i % 60, f"{i:03d}") for i in range(120)), (None, "n"))
    got = rows(upsert.new_rows(old, batch, ["id"], ["v"]), "id")
    assert got == [(i, f"{i:03d}") for i in range(60) if i % 3]


def test_null_keys(spark, stage, rows):
    batch = kv(spark, (None, "x"), (1, "a"))
    with pytest.raises(ValueError):
        upsert.insert_if_absent(spark, stage, batch, ["id"])
    catalog.clone_empty(spark, stage, f"{stage}_rejects")
    for _ in range(2):  # rejects are kept once
        upsert.insert_if_absent(spark, stage, batch, ["id"], rejects=f"{stage}_rejects")
    assert rows(spark.table(stage)) == [(1, "a")]
    assert rows(spark.table(f"{stage}_rejects")) == [(None, "x")]


def test_delta_with_null_in_ledger(spark, rows):
    source, ledger = kv(spark, (1, "a"), (2, "b")), kv(spark, (1, ""), (None, ""))
    assert rows(upsert.delta(source, ledger, ["id"])) == [(2, "b")]
    assert rows(upsert.delta_not_in(source, ledger, "id")) == []


def test_not_in_edges(spark, rows):
    source, empty = kv(spark, (1, "a"), (None, "b")), kv(spark, (0, "")).filter("id > 0")
    assert len(rows(upsert.delta_not_in(source, empty, "id"))) == 2
    assert rows(upsert.delta_not_in(source, kv(spark, (5, "")), "id")) == [(1, "a")]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id AS v")
    kept = upsert.first_per_key(df, ["k"], ["v"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    before, after = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after
    assert kept.filter("k = 0").first().v == 0 and kept.count() == 2001


def test_upsert_latest(spark, rows):
    old = kv(spark, (1, "z"), (2, "y"))
    new = kv(spark, (1, "a"), (3, "b"), (3, "c"))
    assert rows(upsert.upsert_latest(old, new, ["id"], ["v"]), "id") == [(1, "a"), (2, "y"), (3, "c")]


def test_replace_groups_leaves_nothing_stale(spark, rows):
    old = spark.createDataFrame([("p", 0), ("p", 1), ("q", 0)], "post string, chunk int")
    new = spark.createDataFrame([("p", 0)], "post string, chunk int")
    assert rows(upsert.replace_groups(old, new, ["post"]), "post", "chunk") == [("p", 0), ("q", 0)]


SHAPE = "post string, chunk int, v string"


def posts(spark, *rows):
    return spark.createDataFrame(list(rows), SHAPE)


def test_versioned_folder(spark, rows, tmp_path):
    table = VersionedFolder(spark, str(tmp_path / "b"), SHAPE, ["post"])
    assert rows(table.read()) == []
    table.replace(posts(spark, *((f"p{i}", c, "old") for i in range(10) for c in range(3))))
    second = posts(spark, ("p1", 0, "new"), ("p99", 0, "new"))
    for _ in range(2):
        table.replace(second, second.select("post"))
        got = rows(table.read(), "post", "chunk")
        assert len(got) == 30 - 3 + 2
        assert [g for g in got if g[0] == "p1"] == [("p1", 0, "new")]
    table.upsert(posts(spark, ("p2", 1, "x"), ("p2", 1, "y"), ("p77", 0, "z")), ["post", "chunk"], ["v"])
    got = rows(table.read(), "post", "chunk")
    assert ("p2", 1, "y") in got and ("p2", 0, "old") in got and ("p77", 0, "z") in got and len(got) == 30


def test_group_replaced_by_nothing_leaves_nothing(spark, rows, tmp_path):
    table = VersionedFolder(spark, str(tmp_path / "b"), SHAPE, ["post"])
    table.replace(posts(spark, ("p1", 0, "old"), ("p1", 1, "old"), ("p2", 0, "old")))
    for _ in range(2):
        table.replace(posts(spark), spark.createDataFrame([("p1",)], "post string"))
        assert rows(table.read()) == [("p2", 0, "old")]


def files(table):
    return set(table._listed(table.version())["files"])


def test_only_files_with_the_post_are_rewritten(spark, rows, tmp_path):
    table = VersionedFolder(spark, str(tmp_path / "b"), SHAPE, ["post"])
    for i in range(4):
        table.replace(posts(spark, *((f"p{i}", c, "old") for c in range(3)), (f"q{i}", 0, "old")))
    before, reader = files(table), table.read()
    table.replace(posts(spark, ("p2", 0, "new")))
    after = files(table)
    assert len(before - after) == 1 and len(after) == len(before)  # one file gave way to one
    assert len(rows(table.read())) == 16 - 2 and ("q2", 0, "old") in rows(table.read())
    assert len(rows(reader)) == 16  # who began to read before still sees the rows from before
    assert table.drop_old_files() == 1 and len(rows(table.read())) == 14


def test_a_known_load_computes_and_writes_nothing(spark, rows, tmp_path):
    table = VersionedFolder(spark, str(tmp_path / "b"), SHAPE, ["post"])
    assert table.replace(posts(spark, ("p1", 0, "a")), load=("job", 3))
    version = table.version()
    broken = posts(spark, ("p1", 0, "b")).withColumn("v", F.raise_error(F.lit("computed")).cast("string"))
    for number in (2, 3):
        assert not table.replace(broken, posts(spark, ("p1", 0, "b")), load=("job", number))
        assert not table.upsert(broken, ["post"], load=("job", number))
    assert table.version() == version and rows(table.read()) == [("p1", 0, "a")]
    assert table.replace(posts(spark, ("p1", 0, "c")), load=("other", 0)) and rows(table.read()) == [("p1", 0, "c")]


def test_a_load_that_fails_leaves_the_version(spark, rows, tmp_path):
    table = VersionedFolder(spark, str(tmp_path / "b"), SHAPE, ["post"])
    table.replace(posts(spark, ("p1", 0, "a")))
    bad = posts(spark, ("p1", 0, "b")).withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        table.replace(bad, posts(spark, ("p1", 0, "b")))
    assert rows(table.read()) == [("p1", 0, "a")]
    late = table.version() - 1
    with pytest.raises(RuntimeError):
        table._commit(late, {"files": [], "loads": {}})  # another load was first


def test_first_by_value(spark, rows):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (4, None), (5, "b")], "id int, text string")
    kept = upsert.first_by_value(df, "text", "id")
    assert rows(kept, "id") == [(1, "a"), (2, None), (5, "b")]
