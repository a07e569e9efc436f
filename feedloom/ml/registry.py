"""Run tables: metrics and parameters in long form, best run, wide report."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.ml.training import MAX_FEATURES, MODEL_NAME, NGRAM_RANGE, fit_length, predict
from feedloom.operators.filters import new_job_id
from feedloom.operators.upsert import delta
from feedloom.schemas import JOB_METRICS, JOB_PARAMETERS, MODEL_RUNS, PREDICTIONS
from feedloom.sinks.files import write_json_lines
from feedloom.sinks.tables import append, insert_row
from feedloom.sources.files import read_csv
from feedloom.sources.tables import read_current

METRICS = ("r2", "mae", "mape")


def to_long(wide: DataFrame, ids: list[str], values: list[str], name: str, value: str, as_type: str) -> DataFrame:
    """One row per (ids, value column)."""
    typed = wide.select(*ids, *(F.col(v).cast(as_type).alias(v) for v in values))
    return typed.unpivot(ids, values, name, value)


def metrics_long(wide: DataFrame, ids: list[str], metrics: tuple[str, ...] = METRICS) -> DataFrame:
    return to_long(wide, ids, list(metrics), "metric_name", "metric_value", "float")


def parameters_long(wide: DataFrame, ids: list[str], parameters: list[str]) -> DataFrame:
    return to_long(wide, ids, parameters, "parameter_name", "parameter_value", "string")


def runs_wide(metrics: DataFrame, parameters: DataFrame | None = None,
              metric_names: tuple[str, ...] = METRICS, parameter_names: tuple[str, ...] = ()) -> DataFrame:
    """One row per run with a column per metric and parameter. Naming the
    columns up front spares Spark a pass to find them."""
    wide = metrics.groupBy("job_id").pivot("metric_name", list(metric_names)).agg(F.first("metric_value"))
    if parameters is None:
        return wide
    settings = parameters.groupBy("job_id").pivot("parameter_name", list(parameter_names)).agg(F.first("parameter_value"))
    return wide.join(settings, "job_id", "left")


def best_run(metrics: DataFrame, runs: DataFrame, name_contains: str = "post length", metric: str = "mape") -> DataFrame:
    """The run with the lowest metric among runs of that name; ties go to the
    newest, then to the job id."""
    candidates = metrics.filter(F.col("metric_name") == metric).join(
        runs.filter(F.col("name").contains(name_contains)).select("job_id", "model_path"), "job_id"
    )
    return candidates.orderBy(F.asc("metric_value"), F.desc("created_at"), F.asc("job_id")).limit(1)


def run_training(
    spark: SparkSession,
    data: DataFrame,
    key: str,
    model_root: str,
    name: str = MODEL_NAME,
    max_features: int = MAX_FEATURES,
    ngram_range: tuple[int, int] = NGRAM_RANGE,
    runs: str = MODEL_RUNS.full_name,
    metrics: str = JOB_METRICS.full_name,
    parameters: str = JOB_PARAMETERS.full_name,
) -> str:
    """Fit, save the model below ``model_root`` and record the run; returns its
    job id."""
    job_id, now = new_job_id(), dt.datetime.now()
    model, scores = fit_length(data, key, max_features, ngram_range)
    folder = f"{model_root}/runs/{job_id}"
    path = f"{folder}/model"
    model.write().overwrite().save(path)
    insert_row(spark, runs, job_id=job_id, name=name, gcs_path=folder, model_path=path)
    stamp = [F.lit(job_id).alias("job_id"), F.lit(now).cast("timestamp_ntz").alias("created_at")]
    append(metrics_long(scores.select(*stamp, *METRICS), ["job_id", "created_at"]), metrics)
    settings: dict[str, Any] = {
        "max_features": max_features, "ngram_range": str(tuple(ngram_range)), "model": "LinearRegression",
    }
    wide = scores.select(*stamp, *(F.lit(v).alias(k) for k, v in settings.items()))
    append(parameters_long(wide, ["job_id", "created_at"], list(settings)), parameters)
    return job_id


def load_best(spark: SparkSession, runs: str = MODEL_RUNS.full_name, metrics: str = JOB_METRICS.full_name,
              name_contains: str = "post length"):
    """(model, its run row); the row is one line, read to find the model path."""
    row = best_run(read_current(spark, metrics), read_current(spark, runs), name_contains).first()
    if row is None:
        raise LookupError(f"no run named like {name_contains!r}")
    return PipelineModel.load(row.model_path), row


def score_new(
    spark: SparkSession, posts: DataFrame, predictions: str = PREDICTIONS.full_name, **best
) -> None:
    """Score posts without a prediction and append them."""
    pending = delta(posts.select("id", "title"), read_current(spark, predictions), ["id"])
    if pending.isEmpty():
        return
    model, run = load_best(spark, **best)
    scored = predict(model, pending, ["id"]).withColumns({
        "job_id": F.lit(run.job_id),
        "created_at": F.lit(dt.datetime.now()).cast("timestamp_ntz"),
    })
    append(scored, predictions)


def predict_texts(spark: SparkSession, texts: DataFrame, **best) -> DataFrame:
    """Titles scored by the best model, each beside that model's run."""
    model, run = load_best(spark, **best)
    info = ("job_id", "metric_name", "metric_value", "model_path")
    return predict(model, texts, texts.columns).withColumns({c: F.lit(run[c]) for c in info})


def predict_files(spark: SparkSession, model_path: str, source: str, target: str, schema: str) -> None:
    """CSV instances in, JSON lines with their prediction out."""
    instances = read_csv(spark, source, schema)
    write_json_lines(predict(PipelineModel.load(model_path), instances, instances.columns), target)
