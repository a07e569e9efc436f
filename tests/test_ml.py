import math

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from feedloom import catalog
from feedloom.ml import registry, training
from feedloom.operators.profile import evaluate, step_count, table_profile
from feedloom.schemas import JOB_METRICS, JOB_PARAMETERS, MODEL_RUNS, PREDICTIONS


def test_split_ignores_partitioning(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    _, a = training.train_test(df.repartition(3), "k")
    _, b = training.train_test(df.repartition(11), "k")
    assert {r.k for r in a.collect()} == {r.k for r in b.collect()}
    assert 0.17 < a.count() / 5000 < 0.23


def test_metrics(spark):
    df = spark.createDataFrame([(3.0, 2.0), (5.0, 5.0), (0.0, 1.0)], "y double, p double")
    m = evaluate(df, "y", "p").first()
    mean = 8 / 3
    assert m.r2 == pytest.approx(1 - 2 / sum((y - mean) ** 2 for y in (3, 5, 0)))
    assert m.mae == pytest.approx(2 / 3)
    assert m.mape == pytest.approx((1 / 3 + 0 + 1 / training_eps()) / 3)


def training_eps():
    from feedloom.operators.profile import EPSILON

    return EPSILON


def test_best_run_ties(spark):
    metrics = spark.createDataFrame(
        [("a", "mape", 1.0, 1), ("b", "mape", 1.0, 2), ("c", "mape", 0.5, 3), ("a", "r2", 0.1, 9)],
        "job_id string, metric_name string, metric_value float, created_at int",
    )
    runs = spark.createDataFrame(
        [("a", "my post length", "/a"), ("b", "post length 2", "/b"), ("c", "other", "/c")],
        "job_id string, name string, model_path string",
    )
    assert registry.best_run(metrics, runs).first().job_id == "b"


@pytest.fixture(scope="module")
def tables(spark):
    catalog.recreate_layer(spark, "mltest")
    yield {t: catalog.create_table(spark, t, f"mltest.{t.name}") for t in (MODEL_RUNS, JOB_METRICS, JOB_PARAMETERS, PREDICTIONS)}
    catalog.drop_layer(spark, "mltest")


def test_train_record_select_score(spark, tables, tmp_path):
    posts = spark.range(300).select(
        F.col("id").cast("string"),
        F.concat_ws(" ", F.lit("guide"), F.when(F.col("id") % 2 == 0, "long").otherwise("short"), F.lit("story")).alias("title"),
        F.when(F.col("id") % 2 == 0, 100).otherwise(10).cast("bigint").alias("word_count"),
    )
    names = dict(runs=tables[MODEL_RUNS], metrics=tables[JOB_METRICS], parameters=tables[JOB_PARAMETERS])
    job = registry.run_training(spark, posts, "id", str(tmp_path), max_features=50, **names)
    run = spark.table(tables[MODEL_RUNS]).first()
    assert run.job_id == job and run.created_at is not None
    scores = {r.metric_name: r.metric_value for r in spark.table(tables[JOB_METRICS]).collect()}
    assert scores.keys() == {"r2", "mae", "mape"} and scores["r2"] > 0.99 and not math.isnan(scores["mape"])
    settings = {r.parameter_name: r.parameter_value for r in spark.table(tables[JOB_PARAMETERS]).collect()}
    assert settings == {"max_features": "50", "ngram_range": "(1, 2)", "model": "LinearRegression"}

    best = dict(runs=tables[MODEL_RUNS], metrics=tables[JOB_METRICS])
    registry.score_new(spark, posts.filter("id < '2'"), tables[PREDICTIONS], **best)
    before = spark.table(tables[PREDICTIONS]).count()
    for _ in range(2):
        registry.score_new(spark, posts, tables[PREDICTIONS], **best)
    done = spark.table(tables[PREDICTIONS])
    assert 0 < before < 300 and done.count() == 300 and done.select("id").distinct().count() == 300
    assert {r.job_id for r in done.collect()} == {job}

    answers = registry.predict_texts(spark, posts.limit(4).select("title"), **best)
    assert answers.count() == 4 and {r.job_id for r in answers.collect()} == {job}

    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    posts.select("id", "title").write.option("header", True).csv(source)
    registry.predict_files(spark, run.model_path, source, target, "id string, title string")
    assert spark.read.json(target).count() == 300


def test_vocabulary_ties_and_partitioning(spark):
    rows = [(["b", "a", "a b"],), (["a", "c"],), (["c", "b"],), ([],), (None,)]
    grams = spark.createDataFrame(rows, "grams array<string>")
    want = [("a", 2, 1), ("b", 2, 2), ("c", 2, 3)]
    for parts in (1, 5):
        assert [tuple(r) for r in training.vocabulary(grams.repartition(parts), 3).orderBy("rank").collect()] == want
    assert training.vocabulary(grams.limit(0)).count() == 0


def test_grams(spark):
    df = spark.createDataFrame([("A big-city Tale, é été x",), ("",)], "title string")
    got = training.gram_pipeline().fit(df).transform(df).collect()
    assert got[0].grams == ["big", "city", "tale", "été", "big city", "city tale", "tale été"] and got[1].grams == []


def test_least_squares(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 3))
    y = x @ [2.0, -1.0, 0.5] + 7 + 0.1 * rng.normal(size=500)
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)] + [(None, 1.0, 1.0, 1.0)], "a double, b double, c double, y double")
    got = {r.name: r.value for r in training.least_squares(df.repartition(7), ["a", "b", "c"], "y").collect()}
    full = np.column_stack([x, np.ones(500)])
    want, rest, *_ = np.linalg.lstsq(full, y, rcond=None)
    assert [got[k] for k in ("a", "b", "c", "intercept")] == pytest.approx(want.tolist())
    assert got["r2"] == pytest.approx(1 - rest[0] / ((y - y.mean()) ** 2).sum()) and got["rows"] == 500
    flat = spark.createDataFrame([(1.0, 2.0)] * 3, "a double, y double")
    got = {r.name: r.value for r in training.least_squares(flat, ["a"], "y").collect()}
    assert got["a"] == 0 and got["intercept"] == 2 and got["r2"] is None
    assert [tuple(r) for r in training.least_squares(flat.limit(0), ["a"], "y").collect()] == [("rows", 0.0)]


def test_classifier(spark):
    df = spark.range(400).selectExpr("id", "id % 2 AS goal", "CASE WHEN id % 2 = 0 THEN 'in' ELSE 'out' END AS type", "id * 1.0 AS dist")
    model, report = training.fit_classifier(df, "id", "goal", ["dist"], ["type"])
    assert report.first().test_log_loss < 0.2 < report.first().base_log_loss
    assert training.classify(model, df, ["id", "goal"]).filter("prediction = goal").count() > 390


def test_classifier_after_an_observation(spark):
    """A session that has observed rows holds what tasks cannot take; models must not bring it."""
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    test_classifier(spark)


def test_profile_and_counts(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert {tuple(r) for r in table_profile(df).collect()} == {("a", "int", 2, 2), ("b", "string", 1, 2)}
    assert [tuple(r) for r in step_count(df, "seen").collect()] == [("seen", 2)]
