"""Title to word count regression and the tabular classifier."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    CountVectorizerModel, NGram, OneHotEncoder, RegexTokenizer, SQLTransformer, StringIndexer, VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.operators.profile import evaluate
from feedloom.session import materialize, scratch_path

# Defaults of a training run.
MAX_FEATURES = 5000
NGRAM_RANGE = (1, 2)
MODEL_NAME = "post length linear regression"
SPLIT_SEED = 882
TEST_TENTHS = 2


def split_slot(key: str, seed: int = SPLIT_SEED, slots: int = 10) -> Column:
    """Slot 0..slots-1 by a digest of key and seed: the same row lands in the same part
    however the data is partitioned, and in any engine that has MD5."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(slots))


def train_test(df: DataFrame, key: str, test_tenths: int = TEST_TENTHS) -> tuple[DataFrame, DataFrame]:
    slot = split_slot(key)
    return df.filter(slot >= test_tenths), df.filter(slot < test_tenths)


def gram_pipeline(ngram_range: tuple[int, int] = NGRAM_RANGE) -> Pipeline:
    """Lower-case words of two characters or more, then all word n-grams, as ``grams``."""
    low, high = ngram_range
    sizes = range(low, high + 1)
    joined = ", ".join(f"gram{n}" for n in sizes)
    return Pipeline(stages=[
        RegexTokenizer(inputCol="title", outputCol="words", pattern=r"(?U)\b\w\w+\b", gaps=False),
        *(NGram(n=n, inputCol="words", outputCol=f"gram{n}") for n in sizes),
        SQLTransformer(statement=f"SELECT *, concat({joined}) AS grams FROM __THIS__"),
    ])


def vocabulary(grams: DataFrame, max_features: int = MAX_FEATURES, column: str = "grams") -> DataFrame:
    """(term, total, rank) of the most frequent terms; equal totals go by term, so the
    result does not depend on the partitioning. Terms are counted in the tasks first; of
    the counts, every task sends ``max_features`` at most."""
    counts = grams.select(F.explode(column).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("total"))
    first = counts.orderBy(F.desc("total"), F.asc("term")).limit(max_features)
    return first.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("total"), F.asc("term"))))


def fit_length(
    data: DataFrame, key: str, max_features: int = MAX_FEATURES, ngram_range: tuple[int, int] = NGRAM_RANGE, reg_param: float = 0.01
) -> tuple[PipelineModel, DataFrame]:
    """(model, one row r2/mae/mape on the held-out fifth).

    Word n-grams are made once and written; the vocabulary and the fit read them. A
    little ridge keeps the fit defined when there are more grams than rows.
    """
    data = data.select(key, F.coalesce("title", F.lit("")).alias("title"), F.col("word_count").cast("double"))
    grams = gram_pipeline(ngram_range).fit(data)
    ready = materialize(grams.transform(data.na.drop(subset=["word_count"])).select(key, "grams", "word_count"), "training")
    train, test = train_test(ready, key)
    terms = [r.term for r in vocabulary(train, max_features).orderBy("rank").select("term").collect()]  # max_features at most
    counts = CountVectorizerModel.from_vocabulary(terms or [""], inputCol="grams", outputCol="features")
    regression = LinearRegression(
        featuresCol="features", labelCol="word_count", predictionCol="length_pred",
        # The closed form would build and factor a dense matrix of all grams.
        solver="l-bfgs", regParam=reg_param,
    ).fit(counts.transform(train))
    scored = regression.transform(counts.transform(test)).select("word_count", "length_pred")
    return PipelineModel([*grams.stages, counts, regression]), evaluate(scored, "word_count", "length_pred")


def least_squares(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """(name, value): coefficients, ``intercept``, ``r2`` and ``rows`` of the least squares
    fit, from sums of squares and products alone.

    Every task reads its rows once and sends the sums of products of its columns, a row
    per column; they are added up, and a matrix of one row and column per feature is
    solved on the driver. Rows with a null or NaN value are left out. For features in
    the hundreds; where they depend on each other the shortest solution is taken.
    """
    columns = [*features, target]
    rows = df.select(*(F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns))).na.drop()

    def products(batches):
        total = np.zeros((len(columns) + 1, len(columns) + 1))
        for batch in batches:
            x = np.column_stack([np.ones(batch.num_rows), *(np.asarray(batch.column(i)) for i in range(len(columns)))])
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["line", "sums"])

    sums = rows.mapInArrow(products, "line int, sums array<double>").groupBy("line").agg(
        vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))
    lines = {r.line: r.sums for r in sums.collect()}  # one line per column
    spark = df.sparkSession
    n = lines[0][0] if lines else 0.0
    if not n:
        return spark.createDataFrame([("rows", 0.0)], "name string, value double")
    total = np.array([lines[i] for i in range(len(lines))])
    mean = total[0, 1:] / n
    centred = total[1:, 1:] - n * np.outer(mean, mean)
    slopes = np.linalg.lstsq(centred[:-1, :-1], centred[:-1, -1], rcond=None)[0]
    explained, spread = float(slopes @ centred[:-1, -1]), float(centred[-1, -1])
    out = [*zip(features, map(float, slopes)), ("intercept", float(mean[-1] - slopes @ mean[:-1])),
           ("r2", explained / spread if spread else None), ("rows", float(n))]
    return spark.createDataFrame(out, "name string, value double")


def predict(model: PipelineModel, texts: DataFrame, keep: list[str]) -> DataFrame:
    done = model.transform(texts.withColumn("title", F.coalesce("title", F.lit(""))))
    return done.select(*keep, F.col("length_pred").cast("float").alias("length_pred"))


def without_summary(model: LogisticRegressionModel) -> LogisticRegressionModel:
    """The model alone, as it was saved. The summary of a fresh fit refers to the session;
    tasks would carry it along, which fails once the session holds more than tasks can take."""
    path = scratch_path(SparkSession.active(), "classifier")
    model.write().save(path)
    return LogisticRegressionModel.load(path)


def fit_classifier(
    data: DataFrame, key: str, label: str, numeric: list[str], categorical: list[str], seed: int = SPLIT_SEED
) -> tuple[PipelineModel, DataFrame]:
    """Binary classifier on tabular columns, 80/10/10 split by key hash. The
    regularisation with the least validation log loss wins.

    Returns (model, one row with the log loss of each part and that of the base rate).
    """
    columns = [key, label, *numeric, *categorical]
    data = materialize(data.select(*columns).na.drop().withColumn("_slot", split_slot(key, seed)), "classifier")
    train = data.filter("_slot < 8")
    valid = data.filter("_slot = 8")
    test = data.filter("_slot = 9")
    indexed, hot = [f"{c}_i" for c in categorical], [f"{c}_h" for c in categorical]
    features = []
    if categorical:
        features += [
            StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=hot),
        ]
    features.append(VectorAssembler(inputCols=numeric + hot, outputCol="features"))
    prepared = Pipeline(stages=features).fit(train)
    ready = materialize(prepared.transform(train).select(label, "features"), "features")
    measure = MulticlassClassificationEvaluator(metricName="logLoss", labelCol=label)
    best, best_loss = None, float("inf")
    for reg in (0.0, 0.01, 0.1):
        candidate = PipelineModel(prepared.stages + [without_summary(LogisticRegression(labelCol=label, regParam=reg).fit(ready))])
        loss = measure.evaluate(candidate.transform(valid))
        if best is None or loss < best_loss:
            best, best_loss = candidate, loss
    test_loss = measure.evaluate(best.transform(test))
    # Who always gives the share of ones in the training part loses this much on the test part.
    share = F.avg(F.when(F.col("_slot") < 8, F.col(label).cast("double")))
    share = F.least(F.greatest(share, F.lit(1e-15)), F.lit(1 - 1e-15))
    ones = F.avg(F.when(F.col("_slot") == 9, F.col(label).cast("double")))
    report = data.agg(F.count(F.lit(1)).alias("n_rows"), (-ones * F.ln(share) - (1 - ones) * F.ln(1 - share)).alias("base_log_loss")).select(
        "n_rows", F.lit(best_loss).alias("valid_log_loss"), F.lit(test_loss).alias("test_log_loss"), "base_log_loss"
    )
    return best, report


def classify(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    return model.transform(df).select(
        *keep, F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("score"),
    )
