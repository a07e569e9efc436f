import zlib

import numpy as np
import pytest

from feedloom.llm import common, quality, toxicity

LABELS = "doc_id long, quality int, toxic int, score string"


@pytest.fixture(scope="module")
def tables(spark):
    folder = "/root/testdata/sf0.01"
    return common.table(spark, folder, "documents"), common.table(spark, folder, "labels")


def accuracy(found, labels, column):
    truth = {r.doc_id: r[column] for r in labels.collect()}
    rows = [(r.predicted == truth[r.doc_id], r.score) for r in found.collect() if r.held_out and r.doc_id in truth]
    assert all(0 <= s <= 1 for _, s in rows)
    return np.mean([ok for ok, _ in rows])


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    found = quality.quality_scores(docs, labels)
    assert found.count() == docs.count()
    assert accuracy(found, labels, "quality") >= 0.95
    for r in found.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.7)


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    found = toxicity.toxicity_scores(docs, labels)
    assert found.count() == docs.count()
    assert accuracy(found, labels, "toxic") >= 0.9  # a sixth of them toxic, few to learn from
    texts = {r.doc_id: r.text for r in docs.collect()}
    spans = [(texts[r.doc_id][s.start:s.end], s.p) for r in found.collect() for s in r.spans]
    assert spans and all(t.strip() == t and t and p >= toxicity.TAGGED_FROM for t, p in spans)


def test_held_out_labels_are_not_learnt(spark, tables):
    docs, labels = tables
    for scores, parts, part, column in ((quality.quality_scores, 4, 2, "quality"), (toxicity.toxicity_scores, 3, 1, "toxic")):
        turned = labels.withColumn(column, (1 - labels[column]) * common.held_out("doc_id", parts, part).cast("int")
                                   + labels[column] * (~common.held_out("doc_id", parts, part)).cast("int"))
        small = docs.limit(150)
        a, b = ({r.doc_id: r.score for r in scores(small, x).collect()} for x in (labels, turned))
        assert a == b


def test_odd_rows(spark, odd, docs):
    labels = spark.createDataFrame([(4, 1, 0, "a"), (5, 0, 1, "b"), (8, None, None, "c"), (None, 1, 1, "d"), (7, 2, 2, "e"), (4, 1, 0, "a")], LABELS)
    for scores in (quality.quality_scores, toxicity.toxicity_scores):
        got = scores(odd, labels).collect()
        assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
        assert not any(r.held_out for r in got if r.doc_id is None)
        same = {r.score for r in got if r.doc_id == 4}
        assert len(same) == 1
        assert scores(docs([]), labels).count() == 0
    assert {r.score for r in quality.quality_scores(odd, labels.limit(0)).collect()} == {0.5}
    assert {round(r.score, 9) for r in toxicity.toxicity_scores(odd, labels.limit(0)).collect()} == {0.0}
    left = toxicity.without_toxic(odd, labels.limit(0))
    assert left.columns == odd.columns and left.count() == odd.count()


def test_trees_learn_and_are_flat():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.BoostedTrees.fit(x, y)
    assert ((model.predict(x) > 0.5) == y).mean() > 0.97
    t = 3  # one tree walked by hand
    for row in x[:20]:
        node = 0
        while node < model.feature.shape[1]:
            node = 2 * node + 1 + int(row[model.feature[t, node]] > model.threshold[t, node])
        one = quality.BoostedTrees(0.0, model.feature[t:t + 1], model.threshold[t:t + 1], model.leaf[t:t + 1])
        assert np.isclose(one.predict(row[None])[0], 1 / (1 + np.exp(-model.leaf[t, node - model.feature.shape[1]])))
    assert quality.BoostedTrees.fit(x[:0], y[:0]).predict(x[:3]).tolist() == [0.5] * 3
    assert (quality.BoostedTrees.fit(x, np.ones(2000)).predict(x[:3]) > 0.99).all()


def plain_marginals(odds, start, change):
    """By all state sequences of one chain."""
    n = len(odds)
    weight = np.zeros(2**n)
    for s in range(2**n):
        bits = [s >> t & 1 for t in range(n)]
        w = start if bits[0] else 1.0
        for t, b in enumerate(bits):
            w *= (odds[t] if b else 1.0) * (change[bits[t - 1]][b] if t else 1.0)
        weight[s] = w
    return [sum(weight[s] for s in range(2**n) if s >> t & 1) / weight.sum() for t in range(n)]


@pytest.mark.parametrize("lane", [1, 2, 3, 5, 512])
def test_marginals_equal_all_sequences(lane):
    rng = np.random.default_rng(lane)
    change = np.array([[0.9, 0.2], [0.5, 1.7]])
    lengths = [1, 4, 7, 1, 9, 2]
    odds = [np.exp(rng.normal(size=n)) for n in lengths]
    first = np.concatenate([np.arange(n) == 0 for n in lengths])
    got = toxicity.Chain(0.3, change, lane).marginals(np.concatenate(odds), first)
    assert np.allclose(got, np.concatenate([plain_marginals(o, 0.3, change) for o in odds]))


def test_gradient_finds_the_likelihood():
    """Frequencies of a chain without features are learnt."""
    rng = np.random.default_rng(2)
    y, state = [], 0
    for _ in range(4000):
        state = int(rng.random() < (0.1, 0.8)[state])
        y.append(state)
    x, first = np.zeros(4000, np.int64), np.arange(4000) == 0
    tagger = toxicity.Tagger([])
    tagger.fit(x, first, np.array(y, float), rounds=400)
    assert abs(tagger.marginals(x, first).mean() - np.mean(y)) < 0.05


def test_statistics_of_nothing():
    assert len(quality.statistics(b"")) == len(quality.FEATURES) == len(quality.statistics(b"a"))
    assert np.isfinite(quality.statistics(b"")).all()


def test_toxic_rows_without_an_id_go(tables):
    docs, labels = tables
    found = toxicity.toxicity_scores(docs, labels).where("doc_id IS NOT NULL")
    toxic, plain = (docs.join(found.where(f"predicted = {y}").select("doc_id"), "doc_id", "left_semi").select(docs.columns).limit(3).collect() for y in (1, 0))
    unnamed = docs.sparkSession.createDataFrame([(None, *r[1:]) for r in [*toxic, *plain, plain[0]]], docs.schema)
    left = toxicity.without_toxic(docs.unionByName(unnamed), labels).collect()
    texts = sorted(r.text for r in left if r.doc_id is None)
    assert toxic and texts == sorted([*(r.text for r in plain), plain[0].text])
    assert {r.doc_id for r in left} - {None} == {r.doc_id for r in found.where("predicted = 0").collect()}
