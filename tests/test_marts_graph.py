import itertools
import json
import random
from collections import Counter

import pytest

from feedloom.catalogue import graphs
from feedloom.operators import graph, marts, topk


def tags_of(spark, pairs):
    return spark.createDataFrame(pairs, "post_id int, term string")


def test_tag_case(spark, rows):
    tags = tags_of(spark, [(1, "AWS"), (2, "AWS"), (3, "aws"), (1, "x")])
    assert rows(marts.top_tags(tags)) == [("aws", 3), ("x", 1)]
    posts = spark.createDataFrame([(i, f"t{i}") for i in (1, 2, 3, 4)], "id int, content_text string")
    assert rows(marts.post_tags(posts, tags), "id") == [(1, "t1", "aws,x"), (2, "t2", "aws"), (3, "t3", "aws")]
    by_raw = rows(marts.post_tags_by_raw_term(posts, tags), "id")
    assert by_raw == [(1, "t1", "aws,aws,x"), (2, "t2", "aws,aws"), (3, "t3", "aws,aws")]


def test_post_detail_without_tags(spark, rows):
    posts = spark.createDataFrame([(1, "a"), (2, "b")], "id int, title string")
    assert rows(marts.post_detail(posts, tags_of(spark, [(1, "y"), (1, "x")]), ("title",)), "id") == [
        (1, "a", "x, y"), (2, "b", None),
    ]


def test_newest(spark, rows):
    df = spark.range(1000).selectExpr("id", "timestamp_ntz'2024-01-01' + make_dt_interval(CAST(id / 7 AS int)) AS ts")
    with_null = df.selectExpr("id", "CASE WHEN id < 10 THEN NULL ELSE ts END AS ts")
    for n in (1, 7, 8, 500, 995, 2000):
        want = rows(with_null.orderBy(with_null.ts.desc_nulls_last(), "id").limit(n))
        assert sorted(rows(topk.newest(with_null, "ts", "id", n))) == sorted(want), n


def brute_edges(pairs):
    by_post = {}
    for p, t in pairs:
        by_post.setdefault(p, set()).add(t)
    return Counter(e for ts in by_post.values() for e in itertools.combinations(sorted(ts), 2))


def test_edges_small(spark, rows):
    pairs = [(1, "x"), (1, "y"), (2, "y"), (2, "x"), (2, "x"), (3, "z")]
    assert rows(graph.cooccurrence(tags_of(spark, pairs))) == [("x", "y", 2)]


def test_edges_with_a_hot_post(spark):
    """One post holds a third of all rows and needs several blocks."""
    rng = random.Random(1)
    pairs = [(0, f"t{i:04d}") for i in range(700)]
    pairs += [(p, f"t{rng.randrange(800):04d}") for p in range(1, 400) for _ in range(rng.randrange(1, 8))]
    pairs += [(1000, f"t{i:04d}") for i in range(40)]
    got = {(r.src, r.dst): r.weight for r in graph.cooccurrence(tags_of(spark, pairs)).collect()}
    assert got == dict(brute_edges(pairs))


def test_centrality(spark, rows):
    edges = spark.createDataFrame([("a", "b", 2), ("a", "c", 1)], "src string, dst string, weight long")
    assert rows(graph.degree_centrality(edges), "node") == [("a", 2, 1.0, 100.0), ("b", 1, 0.5, 50.0), ("c", 1, 0.5, 50.0)]


def test_repeated_triple_keeps_last_label(spark, rows):
    triples = [("u", "v", "a"), ("v", "u", "r"), ("u", "v", "b")]
    text = json.dumps({"knowledge_graph": [dict(entity1=a, entity2=b, relationship=r) for a, b, r in triples]})
    df = spark.createDataFrame([("p", text), ("q", '{"knowledge_graph": []}'), ("r", "{}")], "post_id string, kg_json string")
    assert rows(graph.knowledge_edges(df), "src") == [("p", "u", "v", "b"), ("p", "v", "u", "r")]
    assert rows(graph.knowledge_edges(df, max_triples=1)) == [("p", "u", "v", "a")]


@pytest.mark.parametrize("repeat", [1, 3])
def test_many_triples(spark, repeat):
    rng = random.Random(2)
    triples = [(rng.choice("abc"), str(i), rng.choice("abc")) for i in range(60)] * repeat
    text = json.dumps({"knowledge_graph": [dict(entity1=a, relationship=r, entity2=b) for a, r, b in triples]})
    df = spark.createDataFrame([("p", text)], "post_id string, kg_json string")
    assert {(r.src, r.dst): r.label for r in graph.knowledge_edges(df).collect()} == {(a, b): r for a, r, b in triples}


def test_edges_of_odd_articles_without_interpreted_lambdas(spark, rows):
    """No JSON, broken JSON, no list, null triples, names and labels; repeated rows stay repeated."""
    texts = [
        None, "{", '{"knowledge_graph": null}', '{"knowledge_graph": []}', '{"knowledge_graph": [null]}',
        '{"knowledge_graph": [{"entity1": "a", "relationship": "r"}, {"entity1": "a", "entity2": null, "relationship": "s"}]}',
        '{"knowledge_graph": [{"entity1": "a", "entity2": "b", "relationship": "r"}, null, {"entity1": "a", "entity2": "b"}, {}]}',
    ]
    df = spark.createDataFrame([*enumerate(texts), (6, texts[6]), (None, texts[5])], "post_id int, kg_json string")
    edges = graph.knowledge_edges(df)
    assert "lambda" not in edges._jdf.queryExecution().executedPlan().toString()
    twice = [(6, None, None, None), (6, "a", "b", None)] * 2
    want = [(4, None, None, None), (5, "a", None, "s"), (None, "a", None, "s"), *twice]
    assert sorted(rows(edges), key=repr) == sorted(want, key=repr)
    first = graph.knowledge_edges(df, max_triples=2)
    want = [(4, None, None, None), (5, "a", None, "s"), (None, "a", None, "s"), *[(6, None, None, None), (6, "a", "b", "r")] * 2]
    assert sorted(rows(first), key=repr) == sorted(want, key=repr)
    assert dict(edges.dtypes) == {"article": "int", "src": "string", "dst": "string", "label": "string"}


def test_edges_of_many_wide_posts_are_counted_in_a_matrix(spark, monkeypatch):
    """Wide posts with more pairs than their terms have, beside small ones with terms of
    the wide ones, with others and with both; pairs are joined nowhere."""
    monkeypatch.setattr(graph, "MATRIX_TERMS", 30)
    monkeypatch.setattr(graph, "MATRIX_ROWS", 64)
    monkeypatch.setattr(graph, "_large_pairs", None)
    rng = random.Random(2)
    pairs = [(p, f"t{i:03d}") for p in range(9) for i in range(100) if rng.random() < 0.8]
    pairs += [(p, f"t{rng.randrange(130):03d}") for p in range(100, 300) for _ in range(rng.randrange(1, 6))]
    pairs += [(p, t) for p in (400, 401, 402) for t in ("é", "t001", "\U0001f600", "￿")]
    for pairs in (pairs, [p for p in pairs if p[0] < 9]):
        edges = graph.cooccurrence(tags_of(spark, pairs))
        got = edges.collect()
        assert {(r.src, r.dst): r.weight for r in got} == dict(brute_edges(pairs)) and len(got) == len(brute_edges(pairs))
        assert dict(edges.dtypes) == {"src": "string", "dst": "string", "weight": "bigint"}


@pytest.mark.parametrize("posts, limits", [(9, {}), (64, {}), (130, {}), (130, {"BIT_POSTS": 129}), (9, {"BIT_BYTES": 1000})])
def test_edges_of_few_wide_posts_are_made_from_bits(spark, monkeypatch, posts, limits):
    """Posts in one and in several words of bits beside small ones, terms in one tile and in
    several; without a process of Python, unless there are too many posts or terms."""
    rng = random.Random(posts)
    for name, value in limits.items():
        monkeypatch.setattr(graph, name, value)
    pairs = [(p, f"t{i:03d}") for p in range(posts) for i in range(100) if rng.random() < 0.8]
    pairs += [(p, t) for p in (400, 401) for t in ("é", "t001", "\U0001f600", "\uffff", "\uffff")] + [(402, "alone"), (403, None), (None, "t001")]
    for terms in (30, 2048):
        monkeypatch.setattr(graph, "MATRIX_TERMS", terms)
        edges = graph.cooccurrence(tags_of(spark, pairs))
        assert ("MapInArrow" in edges._jdf.queryExecution().executedPlan().toString()) == bool(limits)
        got = edges.collect()
        want = brute_edges([p for p in pairs if None not in p])
        assert {(r.src, r.dst): r.weight for r in got} == dict(want) and len(got) == len(want)
        assert dict(edges.dtypes) == {"src": "string", "dst": "string", "weight": "bigint"}


def test_sets_are_not_coalesced_before_their_pairs_are_made(spark):
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sets = spark.createDataFrame([(["a", "b"], 2), (["a", "c", "d"], 1)], "s array<string>, w bigint")
    pairs = graph._set_pairs(sets.groupBy("s").agg({"w": "sum"}).withColumnRenamed("sum(w)", "w"))
    assert pairs.rdd.getNumPartitions() == width
    assert sorted(tuple(r) for r in pairs.select("src", "dst", "w").collect()) == [
        ("a", "b", 2), ("a", "c", 1), ("a", "d", 1), ("c", "d", 1)]


def test_articles_are_dealt_to_all_tasks_and_split_once(spark, rows, tmp_path):
    texts = [(1, None), (2, ""), (3, "a b"), (4, "a b c"), (5, " x y x z\tx "), (6, "p q p w p")]
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    edges = graphs.kg_edges(spark, str(tmp_path))
    plan = edges._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning(8)" in plan and plan.count("split(text") == 1
    # x y x, y x z and x z x: of the pair named twice the later label stays.
    want = [(4, "a", "c", "b"), (5, "x", "x", "z"), (5, "y", "z", "x"), (6, "p", "p", "w"), (6, "q", "w", "p")]
    assert sorted(rows(edges)) == want
