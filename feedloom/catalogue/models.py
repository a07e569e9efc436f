"""Training, run tables, selection, scoring."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from feedloom import catalog
from feedloom.catalogue.base import posts, table
from feedloom.ml import registry, training
from feedloom.operators.marts import post_length
from feedloom.operators.profile import regression_metrics
from feedloom.schemas import JOB_METRICS, JOB_PARAMETERS, MODEL_RUNS, PREDICTIONS
from feedloom.session import scratch_path
from feedloom.sinks.files import write_csv
from feedloom.sinks.tables import insert_select
from feedloom.sources.files import read_json_lines


def _runs_wide(spark, d):
    """Each supplier as a run: how well 1,500 per unit predicts its prices."""
    scores = regression_metrics(F.col("l_extendedprice"), F.col("l_quantity") * 1500.0)
    return (
        table(spark, d, "lineitem").groupBy(F.concat(F.lit("run-"), "l_suppkey").alias("job_id"))
        .agg(F.max("l_shipdate").alias("created_at"), *scores)
    )


def _metrics(spark, d):
    wide = _runs_wide(spark, d).select("job_id", "created_at", *(F.round(m, 3).alias(m) for m in registry.METRICS))
    return registry.metrics_long(wide, ["job_id", "created_at"])


def metrics_long(spark, d):
    return _metrics(spark, d).withColumn("metric_value", F.round(F.col("metric_value").cast("double"), 2))


def parameters_long(spark, d):
    wide = table(spark, d, "part").select(F.concat(F.lit("run-"), "p_partkey").alias("job_id"), "p_brand", "p_type", "p_size")
    return registry.parameters_long(wide, ["job_id"], ["p_brand", "p_type", "p_size"])


def best_model(spark, d):
    runs = table(spark, d, "supplier").select(
        F.concat(F.lit("run-"), "s_suppkey").alias("job_id"),
        F.expr("CASE WHEN s_acctbal > 0 THEN concat('post length ', s_name) ELSE s_name END").alias("name"),
        F.concat(F.lit("/models/"), "s_suppkey").alias("model_path"),
    )
    best = registry.best_run(_metrics(spark, d), runs)
    return best.withColumn("metric_value", F.round(F.col("metric_value").cast("double"), 2))


def experiment_wide(spark, d):
    settings = table(spark, d, "supplier").select(
        F.concat(F.lit("run-"), "s_suppkey").alias("job_id"), "s_name", "s_nationkey"
    )
    long = registry.parameters_long(settings, ["job_id"], ["s_name", "s_nationkey"])
    wide = registry.runs_wide(_metrics(spark, d), long, parameter_names=("s_name", "s_nationkey"))
    return wide.select(
        "job_id", *(F.round(F.col(m).cast("double"), 2).alias(m) for m in registry.METRICS), "s_name", "s_nationkey"
    )


def split_parts(spark, d):
    """Sizes of the train and test parts."""
    docs = table(spark, d, "documents").select("doc_id")
    part = F.when(training.split_slot("doc_id") < training.TEST_TENTHS, "test").otherwise("train")
    return docs.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))


def vocabulary(spark, d):
    """The most frequent words and word pairs of the titles."""
    titles = post_length(posts(spark, d), keep=("id",)).select(F.coalesce("title", F.lit("")).alias("title"))
    return training.vocabulary(training.gram_pipeline().fit(titles).transform(titles))


def price_fit(spark, d):
    """Prices by quantity, from sums of squares and products."""
    fit = training.least_squares(table(spark, d, "lineitem"), ["l_quantity"], "l_extendedprice")
    return fit.withColumn("value", F.round("value", 6))


def predict_files(spark, d):
    """A model trained, saved and used on a CSV file of titles, beside what it gives for
    the table; results come back as JSON lines."""
    docs = posts(spark, d).select("id", F.coalesce("title", F.lit("")).alias("title"))
    model, _ = training.fit_length(post_length(posts(spark, d), keep=("id",)), "id", max_features=200, ngram_range=(1, 1))
    path, source, target = (scratch_path(spark, n) for n in ("model", "instances", "predictions"))
    model.write().save(path)
    write_csv(docs, source)
    registry.predict_files(spark, path, source, target, "id bigint, title string")
    direct = training.predict(model, docs, ["id"]).withColumnRenamed("length_pred", "direct")
    back = read_json_lines(spark, target, "id bigint, length_pred double")
    return back.join(direct, "id", "full").select("id", (F.abs(F.col("length_pred") - F.col("direct")) < 0.01).alias("same"))


def train_post_length(spark, d):
    """Held-out metrics of the title regression, long form."""
    data = post_length(posts(spark, d), keep=("id",))
    _, scores = training.fit_length(data, "id")
    return registry.metrics_long(scores.withColumn("job_id", F.lit("run")), ["job_id"])


def batch_score(spark, d):
    """Train, record, select, then score the documents without a label; the
    labelled ones count as scored. A second pass adds nothing."""
    layer = f"ml_{uuid.uuid4().hex[:12]}"
    catalog.create_layer(spark, layer, scratch_path(spark, layer))
    names = {t: catalog.create_table(spark, t, f"{layer}.{t.name}") for t in (MODEL_RUNS, JOB_METRICS, JOB_PARAMETERS, PREDICTIONS)}
    docs = posts(spark, d).withColumn("id", F.col("id").cast("string"))
    registry.run_training(
        spark, post_length(docs, keep=("id",)), "id", scratch_path(spark, "models"),
        runs=names[MODEL_RUNS], metrics=names[JOB_METRICS], parameters=names[JOB_PARAMETERS],
    )
    scored = table(spark, d, "labels").select(
        F.col("doc_id").cast("string").alias("id"), F.lit(0.0).cast("float").alias("length_pred"), F.lit("earlier").alias("job_id")
    )
    insert_select(scored, names[PREDICTIONS])
    for _ in range(2):
        registry.score_new(spark, docs, names[PREDICTIONS], runs=names[MODEL_RUNS], metrics=names[JOB_METRICS])
    source = F.when(F.col("job_id") == "earlier", "earlier").otherwise("model")
    return spark.table(names[PREDICTIONS]).select(
        "id", source.alias("scored_by"), F.col("length_pred").isNotNull().alias("has_prediction")
    )


def classify_quality(spark, d):
    """Quality of labelled documents from language, source and length."""
    data = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars").join(table(spark, d, "labels"), "doc_id")
    model, _ = training.fit_classifier(data, "doc_id", "quality", ["n_chars"], ["lang", "source"])
    return training.classify(model, data, ["doc_id"])


def classifier_log_loss(spark, d):
    """Rows held out of the fit, and whether the classifier explains the rows of the fit at
    least as well as their base rate, as any fit must."""
    data = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars").join(table(spark, d, "labels"), "doc_id")
    model, _ = training.fit_classifier(data, "doc_id", "quality", ["n_chars"], ["lang", "source"])
    scored = training.classify(model, data, ["doc_id", "quality"]).withColumn("slot", training.split_slot("doc_id"))
    fitted, share = F.col("slot") < 8, F.avg(F.when(F.col("slot") < 8, F.col("quality")))
    loss = F.avg(F.when(fitted, -F.ln(F.when(F.col("quality") == 1, F.col("score")).otherwise(1 - F.col("score")))))
    base = -share * F.ln(share) - (1 - share) * F.ln(1 - share)
    return scored.agg(
        F.count_if(~fitted).alias("n_held_out"), F.count_if(fitted).alias("n_fitted"), (loss <= base + 1e-6).alias("explains"))


QUERIES = {
    "metrics_long": metrics_long,
    "parameters_long": parameters_long,
    "best_model": best_model,
    "experiment_wide": experiment_wide,
    "split_parts": split_parts,
    "vocabulary": vocabulary,
    "price_fit": price_fit,
    "predict_files": predict_files,
    "train_post_length": train_post_length,
    "batch_score": batch_score,
    "classify_quality": classify_quality,
    "classifier_log_loss": classifier_log_loss,
}

_RUNS = """
    WITH l AS (SELECT 'run-' || l_suppkey AS job_id, l_shipdate, l_extendedprice AS y, l_quantity * 1500.0 AS p FROM lineitem),
    m AS (SELECT job_id, avg(y) AS mean FROM l GROUP BY job_id),
    wide AS (
        SELECT job_id, max(l_shipdate) AS created_at,
               CAST(round(1 - sum((y - p) * (y - p)) / sum((y - mean) * (y - mean)), 3) AS FLOAT) AS r2,
               CAST(round(avg(abs(y - p)), 3) AS FLOAT) AS mae,
               CAST(round(avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)), 3) AS FLOAT) AS mape
        FROM l JOIN m USING (job_id) GROUP BY job_id
    ),
    metrics AS (UNPIVOT wide ON r2, mae, mape INTO NAME metric_name VALUE metric_value)"""

SQL = {
    "split_parts": f"""
        SELECT CASE WHEN CAST('0x' || substr(md5(doc_id || ':{training.SPLIT_SEED}'), 1, 8) AS BIGINT) % 10 < {training.TEST_TENTHS}
                    THEN 'test' ELSE 'train' END AS part, count(*) AS n
        FROM documents GROUP BY part""",
    "vocabulary": rf"""
        WITH w AS (SELECT doc_id, regexp_extract_all(lower(string_split(text, chr(10))[1]), '[\p{{L}}\p{{M}}\p{{Nd}}\p{{Pc}}]{{2,}}') AS w FROM documents),
        g AS (
            SELECT unnest(w) AS term FROM w
            UNION ALL
            SELECT w[i] || ' ' || w[i + 1] FROM w, range(1, len(w)) t(i)),
        c AS (SELECT term, count(*) AS total FROM g GROUP BY term ORDER BY total DESC, term LIMIT {training.MAX_FEATURES})
        SELECT term, total, CAST(row_number() OVER (ORDER BY total DESC, term) AS INTEGER) AS rank FROM c""",
    "price_fit": """
        WITH f AS (
            SELECT regr_slope(l_extendedprice, l_quantity) AS l_quantity, regr_intercept(l_extendedprice, l_quantity) AS intercept,
                   regr_r2(l_extendedprice, l_quantity) AS r2, CAST(count(*) AS DOUBLE) AS rows FROM lineitem)
        SELECT name, round(value, 6) AS value FROM (UNPIVOT f ON l_quantity, intercept, r2, rows INTO NAME name VALUE value)""",
    "predict_files": "SELECT doc_id AS id, true AS same FROM documents",
    "classifier_log_loss": f"""
        SELECT count(*) FILTER (slot >= 8) AS n_held_out, count(*) FILTER (slot < 8) AS n_fitted, true AS explains
        FROM (SELECT CAST('0x' || substr(md5(doc_id || ':{training.SPLIT_SEED}'), 1, 8) AS BIGINT) % 10 AS slot
              FROM documents JOIN labels USING (doc_id))""",
    "batch_score": """
        SELECT CAST(doc_id AS VARCHAR) AS id,
               CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'earlier' ELSE 'model' END AS scored_by,
               true AS has_prediction
        FROM documents""",
    "metrics_long": _RUNS + """
        SELECT job_id, created_at, metric_name, round(CAST(metric_value AS DOUBLE), 2) AS metric_value FROM metrics""",
    "parameters_long": """
        SELECT 'run-' || p_partkey AS job_id, unnest(['p_brand', 'p_type', 'p_size']) AS parameter_name,
               unnest([p_brand, p_type, CAST(p_size AS VARCHAR)]) AS parameter_value
        FROM part""",
    "best_model": _RUNS + """
        , runs AS (
            SELECT 'run-' || s_suppkey AS job_id,
                   CASE WHEN s_acctbal > 0 THEN 'post length ' || s_name ELSE s_name END AS name,
                   '/models/' || s_suppkey AS model_path FROM supplier
        )
        SELECT m.job_id, m.created_at, m.metric_name, round(CAST(m.metric_value AS DOUBLE), 2) AS metric_value, r.model_path
        FROM metrics m JOIN runs r ON m.job_id = r.job_id
        WHERE m.metric_name = 'mape' AND r.name LIKE '%post length%'
        ORDER BY m.metric_value, m.created_at DESC, m.job_id LIMIT 1""",
    "experiment_wide": _RUNS + """
        SELECT w.job_id, round(CAST(r2 AS DOUBLE), 2) AS r2, round(CAST(mae AS DOUBLE), 2) AS mae,
               round(CAST(mape AS DOUBLE), 2) AS mape, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey
        FROM wide w LEFT JOIN supplier ON w.job_id = 'run-' || s_suppkey""",
}
