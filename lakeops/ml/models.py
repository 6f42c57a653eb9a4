"""Fitting, searching, scoring and keeping ``pyspark.ml`` models."""

from __future__ import annotations

import random
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.ranking import seeded_key


def vector_of(column: str) -> Column:
    """A feature vector from an array column."""
    return array_to_vector(F.col(column))


def assembled(df: DataFrame, columns: list[str], label: str, keep: list[str] | None = None) -> DataFrame:
    """``features`` and ``label``, with the columns in ``keep``."""
    chain = VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="skip")
    named = df.withColumn("label", F.col(label).cast("double"))
    return chain.transform(named).select(*(keep or []), "features", "label")


def forest_regressor(rows: int = 0, cap: int | None = None, **settings) -> RandomForestRegressor:
    """A forest whose trees see all rows or, with ``cap``, about that many of ``rows`` each."""
    share = 1.0 if cap is None else min(1.0, cap / max(rows, 1))
    return RandomForestRegressor(subsamplingRate=share, **settings)


def fit_and_score(models: dict[str, Estimator], train: DataFrame, test: DataFrame, evaluator: Evaluator,
                  parallelism: int = 4) -> DataFrame:
    """Fit each model and give one ``model, score`` row.

    Up to ``parallelism`` models are fitted at a time: a fit is many short jobs, most of which leave cores idle.
    """
    # wrapped one by one, so that each thread has its own copy of the caller's local properties
    runs = [
        inheritable_thread_target(train.sparkSession)(lambda m=m: float(evaluator.evaluate(m.fit(train).transform(test))))
        for m in models.values()
    ]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        scores = list(zip(models, pool.map(lambda run: run(), runs)))
    return train.sparkSession.createDataFrame(scores, "model string, score double")


def cross_scores(model: Estimator, grid: list, df: DataFrame, evaluator: Evaluator, id_columns: list[str],
                 folds: int = 5, seed: int = 42, parallelism: int = 4):
    """Cross-validated search; returns (fitted search, table of parameters and mean score).

    A row's fold comes from its seeded key, so folds do not depend on the partitioning.
    """
    folded = with_fold(df, id_columns, folds, seed)
    search = CrossValidator(estimator=model, estimatorParamMaps=grid, evaluator=evaluator,
                            numFolds=folds, seed=seed, parallelism=parallelism, foldCol="fold").fit(folded)
    rows = [
        (i, ", ".join(sorted(f"{p.name}={v}" for p, v in grid[i].items())), float(score))
        for i, score in enumerate(search.avgMetrics)
    ]
    return search, df.sparkSession.createDataFrame(rows, "draw int, parameters string, score double")


def with_fold(df: DataFrame, id_columns: list[str], folds: int, seed: int) -> DataFrame:
    """``df`` with its ``fold``, from 0, by the seeded key."""
    key = F.conv(F.substring(seeded_key(id_columns, seed), 1, 8), 16, 10).cast("bigint")
    return df.withColumn("fold", (key % folds).cast("int"))


def grid_of(choices: dict) -> list:
    """All combinations of the given values per parameter."""
    builder = ParamGridBuilder()
    for param, values in choices.items():
        builder = builder.addGrid(param, values)
    return builder.build()


def drawn_from(grid: list, n: int, seed: int = 42) -> list:
    """``n`` combinations at random, without repeats."""
    return random.Random(seed).sample(grid, min(n, len(grid)))


def sweep(model: Estimator, param, values: Iterable, train: DataFrame, test: DataFrame, evaluator: Evaluator) -> DataFrame:
    """Train and test score for each value of one parameter."""
    rows = []
    for value in values:
        fitted = model.copy({param: value}).fit(train)
        rows.append((str(value), float(evaluator.evaluate(fitted.transform(train))),
                     float(evaluator.evaluate(fitted.transform(test)))))
    return train.sparkSession.createDataFrame(rows, "value string, train_score double, test_score double")


def with_probability(predictions: DataFrame, keep: list[str]) -> DataFrame:
    """Label, predicted label and the probability of the predicted label."""
    highest = F.array_max(vector_to_array("probability")).alias("pred_prob")
    return predictions.select(*keep, F.col("prediction").cast("int").alias("pred_class"), highest)


def named_weights(model: Model, names: list[str]) -> list[tuple[str, float]]:
    """Importances or coefficients by feature name."""
    weights = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
    return [(n, float(w)) for n, w in zip(names, weights.toArray())]


def weights_table(spark, model: Model, names: list[str]) -> DataFrame:
    return spark.createDataFrame(named_weights(model, names), "feature string, weight double")


def pair_regression(pairs: DataFrame, regularisation: float = 0.01, iterations: int = 100) -> PipelineModel:
    """Softmax regression of the next character on the one-hot previous one.

    One row per pair of characters, weighted by its count, stands for all its
    occurrences, so the fit's size is the alphabet squared whatever the text holds.
    """
    index = StringIndexer(inputCols=["c1", "c2"], outputCols=["c1_index", "label"], stringOrderType="alphabetAsc")
    hot = OneHotEncoder(inputCols=["c1_index"], outputCols=["features"], dropLast=False)
    softmax = LogisticRegression(family="multinomial", regParam=regularisation, maxIter=iterations, weightCol="n",
                                 standardization=False)
    return Pipeline(stages=[index, hot, softmax]).fit(pairs.withColumn("n", F.col("n").cast("double")))


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_chain(path: str) -> PipelineModel:
    return PipelineModel.load(path)
