import numpy as np
import pytest

from feedloom.operators import cosine, vectors


def frame(spark, matrix, id_name, vec_name):
    return spark.createDataFrame(
        [(i, [float(x) for x in row]) for i, row in enumerate(matrix)], f"{id_name} long, {vec_name} array<float>"
    )


def brute(queries, items, k):
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    sims = np.round(unit(queries) @ unit(items).T, 9)
    return {
        (q, rank + 1): (i, sims[q, i])
        for q in range(len(queries))
        for rank, i in enumerate(np.lexsort((np.arange(len(items)), -sims[q]))[:k])
    }


@pytest.fixture
def shuffled(monkeypatch):
    """Small tiles that meet in a shuffled join."""
    for name, size in (("BROADCAST_BYTES", 0), ("TILE_BYTES", 320), ("GROUP_BYTES", 4000)):
        monkeypatch.setattr(cosine, name, size)


@pytest.mark.parametrize("tiled", [False, True])
def test_topk_equals_brute_force(spark, request, tiled):
    """Copies of one vector hold a third of the items, so ties are common."""
    rng = np.random.default_rng(3)
    items = rng.integers(-3, 4, (900, 8)).astype(float)
    items[::3] = items[0]
    items[5] = 0
    queries = np.vstack([items[:20], rng.normal(size=(10, 8))])
    if tiled:
        request.getfixturevalue("shuffled")
    got = cosine.cosine_topk(
        frame(spark, queries, "query_id", "vector"), frame(spark, items, "id", "values").repartition(7), 6
    )
    want = brute(np.float32(queries).astype(float), items, 6)
    found = {(r.query_id, r.rank): (r.item_id, r.score) for r in got.collect()}
    assert found.keys() == want.keys()
    for at, (item, score) in want.items():
        assert found[at][0] == item and found[at][1] == pytest.approx(score, abs=2e-9), at


@pytest.mark.parametrize("tiled", [False, True])
def test_fewer_items_than_k_and_string_ids(spark, request, tiled):
    if tiled:
        request.getfixturevalue("shuffled")
    items = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", None)], "id string, values array<float>")
    asked = spark.createDataFrame([("q", [2.0, 0.0])], "query_id string, vector array<double>")
    got = cosine.cosine_topk(asked, items, 5).orderBy("rank").collect()
    assert [(r.item_id, r.score, r.rank) for r in got] == [("a", 1.0, 1), ("b", 1.0, 2)]


def test_lengths_and_zero_vectors(spark):
    shape = "id long, v array<double>"
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0]), (3, [0.0, 0.0]), (4, []), (5, None), (6, [0.0, 2.0])], shape)
    got = cosine.cosine_topk(items, items, 5, "id", "v", "id", "v").orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.item_id, r.score) for r in got] == [
        (1, 1, 1.0), (1, 3, 0.0), (1, 6, 0.0), (2, 2, 1.0), (3, 1, 0.0), (3, 3, 0.0), (3, 6, 0.0), (6, 6, 1.0), (6, 1, 0.0), (6, 3, 0.0)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_few_queries_leave_items_in_place(spark):
    items = frame(spark, np.eye(4), "id", "values")
    plan = plan_of(cosine.cosine_topk(frame(spark, np.eye(4), "query_id", "vector"), items, 2))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("hashpartitioning") == plan.count("hashpartitioning(query_id")  # only candidates are shuffled


def test_many_queries_are_shuffled(spark, shuffled):
    items = frame(spark, np.random.default_rng(1).normal(size=(200, 8)), "id", "values")
    plan = plan_of(cosine.cosine_topk(items.toDF("query_id", "vector"), items, 2))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert plan.count("Exchange") == 3  # tiles and blocks once each, then candidates


def test_no_queries(spark):
    items = spark.createDataFrame([(1, [1.0])], "id long, values array<float>")
    asked = items.selectExpr("id AS query_id", "values AS vector").filter("query_id < 0")
    assert cosine.cosine_topk(asked, items, 5).count() == 0


def test_embedder(spark, tmp_path):
    docs = spark.createDataFrame([(1, "red green blue"), (2, "red red"), (3, None), (4, "BLUE green Red")], "id long, text string")
    embedder = vectors.HashingEmbedder.fit(docs, "text")
    embedder.save(str(tmp_path / "m"))
    again = vectors.HashingEmbedder.load(str(tmp_path / "m"))
    one, two = ({r.id: r["values"] for r in e.transform(docs, "text").collect()} for e in (embedder, again))
    assert one == two and len(one[1]) == 768
    assert one[1] == one[4] and sum(x * x for x in one[1]) == pytest.approx(1, abs=1e-5)
    assert set(one[3]) == {0.0}


def test_compare_texts(spark):
    pairs = spark.createDataFrame([(1, "a b c", "B c d"), (2, "", "")], "id int, l string, r string")
    first, second = vectors.compare_texts(pairs, "l", "r", ["id"]).orderBy("id").collect()
    assert (first.shared, first.only_left, first.only_right, first.jaccard) == (["b", "c"], ["a"], ["d"], 0.5)
    assert second.jaccard is None
