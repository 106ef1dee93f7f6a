"""Classifiers, parameter search and scoring on Spark ML."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import partial
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.values import fold_of
from tablewright.operators.features import min_max_vector

ROWS_DEALT = 1_000_000  # rows in a partition of a search; fewer save less than the second stage of a step costs
NUMBERS_DEALT = 8_000_000  # features, label and fold of those rows, 64 MB of doubles


def logistic(label: str, *, features: str = "features", reg: float = 0.0, c: float | None = None,
             n: int | None = None, max_iter: int = 100) -> LogisticRegression:
    """L2 logistic regression; ``c`` with the row count ``n`` gives the inverse-strength form."""
    model = LogisticRegression(featuresCol=features, labelCol=label, maxIter=max_iter)
    if c is None:
        return model.setRegParam(reg)
    if not n:
        raise ValueError("the inverse-strength form needs the row count n")
    return model.setRegParam(1 / (c * n)).setStandardization(False)


def linear_svm(label: str, *, features: str = "features", reg: float = 0.0,
               max_iter: int = 100) -> LinearSVC:
    """Linear support vector machine with hinge loss."""
    return LinearSVC(featuresCol=features, labelCol=label, regParam=reg, maxIter=max_iter)


def param_grid(estimator: Estimator, grid: Mapping[str, Sequence]) -> list[dict]:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def feature_pipeline(estimator: Estimator, features: Sequence[str]) -> Pipeline:
    """Assemble, scale to [0, 1] and classify; the scaler is fitted with the classifier."""
    return Pipeline(stages=[assembler(features), *_scaled(estimator)])


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="_assembled")


def _scaled(estimator: Estimator) -> list[Estimator]:
    return [min_max_vector("_assembled", estimator.getFeaturesCol()), estimator]


def fold_table(train: DataFrame, features: Sequence[str], label: str, key: Sequence[str] | str | None = None, *,
               folds: int = 5, seed: int = 42) -> DataFrame:
    """The assembled features, the label and, with a key, the fold: what a search reads of its rows.

    Searches over the same rows and features can share one such table, persisted. With a key, rows
    are counted and dealt over `dealt_partitions`; without one the folds depend on how they lie, so they stay.
    """
    rows = assembler(features).transform(train.select(*[F.col(c) for c in (*features, label)], *(
        [] if key is None else [fold_of(key, folds, seed + 1).alias("_fold")])))
    rows = rows.drop(*[c for c in features if c != label])
    dealt = 1 if key is None else dealt_partitions(train.count(), len(features))
    return rows.repartition(dealt) if dealt > 1 else rows


def dealt_partitions(rows: int, features: int) -> int:
    """How many partitions the fits of a search read; 1 leaves rows as they were read.

    A file gives one split per row group, often one in all, and each of a thousand steps
    waits for the task that has most rows.
    """
    return max(math.ceil(rows / ROWS_DEALT), math.ceil(rows * (features + 2) / NUMBERS_DEALT))


class PooledCrossValidator(CrossValidator):
    """Spark's search, with the fits of all folds in one pool and the stages before the classifier fitted once a fold.

    The fits of a fold differ in length. Fold by fold, most of the pool waits for the longest.
    """

    def _fit(self, dataset: DataFrame) -> CrossValidatorModel:
        grid, evaluator = self.getEstimatorParamMaps(), self.getEvaluator()
        *before, classifier = self.getEstimator().getStages()
        target = inheritable_thread_target(dataset.sparkSession)

        def scaled(fold: tuple[DataFrame, DataFrame]) -> list[DataFrame]:
            scaler = Pipeline(stages=before).fit(fold[0])
            return [scaler.transform(rows) for rows in fold]

        def measured(train: DataFrame, validation: DataFrame, params: dict) -> float:
            return evaluator.evaluate(classifier.fit(train, params).transform(validation))

        with ThreadPool(self.getParallelism()) as pool:
            folds = pool.map(lambda f: f(), [target(partial(scaled, fold)) for fold in self._kFold(dataset)], chunksize=1)
            found = pool.map(lambda f: f(), [target(partial(measured, *fold, params)) for fold in folds for params in grid], chunksize=1)
        areas = np.array(found).reshape(len(folds), len(grid))
        means = areas.mean(axis=0)
        best = np.argmax(means) if evaluator.isLargerBetter() else np.argmin(means)
        refitted = self.getEstimator().fit(dataset, grid[best])
        return self._copyValues(CrossValidatorModel(refitted, means.tolist(), stdMetrics=areas.std(axis=0).tolist()))


def search_folds(estimator: Estimator, grid: Mapping[str, Sequence], data: DataFrame, *, features: Sequence[str],
                 folds: int = 5, metric: str = "areaUnderROC", parallelism: int = 4, seed: int = 42) -> CrossValidatorModel:
    """`cross_validate` over a persisted `fold_table`; the best model takes rows with the features again."""
    search = PooledCrossValidator(
        estimator=Pipeline(stages=_scaled(estimator)),
        estimatorParamMaps=param_grid(estimator, grid),
        evaluator=BinaryClassificationEvaluator(labelCol=estimator.getLabelCol(), metricName=metric),
        numFolds=folds, parallelism=parallelism, seed=seed)
    if "_fold" in data.columns:
        search = search.setFoldCol("_fold")
    found = search.fit(data)
    found.bestModel = PipelineModel([assembler(features), *found.bestModel.stages])
    return found


def cross_validate(estimator: Estimator, grid: Mapping[str, Sequence], train: DataFrame, *,
                   features: Sequence[str], key: Sequence[str] | str | None = None, folds: int = 5,
                   metric: str = "areaUnderROC", parallelism: int = 4,
                   seed: int = 42) -> CrossValidatorModel:
    """Search the grid over k folds and refit the best on all of ``train``.

    With a key, folds are fixed by its hash and do not change with partitioning.
    """
    data = fold_table(train, features, estimator.getLabelCol(), key, folds=folds, seed=seed).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return search_folds(estimator, grid, data, features=features, folds=folds, metric=metric, parallelism=parallelism, seed=seed)
    finally:
        data.unpersist()


def score(model, df: DataFrame) -> DataFrame:
    """Add prediction, decision value and, where the model has one, probability of class 1."""
    scored = model.transform(df)
    out = [F.col(c) for c in df.columns]
    out.append(F.col("prediction"))
    out.append(vector_to_array("rawPrediction")[1].alias("decision"))
    if "probability" in scored.columns:
        out.append(vector_to_array("probability")[1].alias("probability"))
    return scored.select(*out)


def classifier_of(model: CrossValidatorModel | PipelineModel):
    pipeline = model.bestModel if isinstance(model, CrossValidatorModel) else model
    return pipeline.stages[-1]


def best_params(model: CrossValidatorModel) -> DataFrame:
    """(param, value) of the searched parameters in the refitted winner."""
    classifier = classifier_of(model)
    searched = sorted({p.name for grid in model.getEstimatorParamMaps() for p in grid})
    chosen = {p.name: v for p, v in classifier.extractParamMap().items()}
    return SparkSession.active().createDataFrame(
        [(name, float(chosen[name])) for name in searched], "param string, value double")


def refit_scaler(model: PipelineModel, df: DataFrame) -> PipelineModel:
    """The same classifier behind a scaler fitted anew on the given table."""
    assembler, scaler, classifier = model.stages
    fresh = min_max_vector(scaler.getInputCol(), scaler.getOutputCol()).fit(assembler.transform(df))
    return PipelineModel([assembler, fresh, classifier])
