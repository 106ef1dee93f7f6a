"""How a search uses its cores: rows dealt over partitions, fits of all folds in one pool."""

import threading

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from tablewright.operators import models as M


def one_split(spark, n):
    """Rows as a file of one row group gives them, with a label that x explains in part."""
    return spark.range(0, n, 1, 1).select(
        "id", (F.col("id") * 7919 % n).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("z"),
    ).withColumn("y", (F.col("x") + F.col("id") * 31 % n > n).cast("double"))


def test_rows_of_one_split_are_dealt_and_stay_whole(spark, monkeypatch):
    df = one_split(spark, 350)
    assert M.fold_table(df, ["x", "z"], "y", "id").rdd.getNumPartitions() == 1
    as_read = sorted(map(str, M.fold_table(df, ["x", "z"], "y", "id").collect()))
    monkeypatch.setattr(M, "ROWS_DEALT", 100)
    dealt = M.fold_table(df, ["x", "z"], "y", "id")
    sizes = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) <= 100
    assert sorted(map(str, dealt.collect())) == as_read
    # Without a key the folds follow from where rows lie.
    assert M.fold_table(df, ["x", "z"], "y").rdd.getNumPartitions() == 1


def test_partitions_grow_with_rows_and_features():
    assert [M.dealt_partitions(n, 2) for n in (0, 90_000, 810_000, 4_860_000)] == [0, 1, 1, 5]
    assert M.dealt_partitions(4_860_000, 98) == 61


def test_fits_of_different_folds_run_at_the_same_time(spark):
    meeting, fits = threading.Barrier(4), []

    class Meeting(LogisticRegression):
        def _fit(self, dataset):
            fits.append(self)
            if len(fits) <= 4:  # the fifth is the refit
                meeting.wait(60)
            return super()._fit(dataset)

    estimator = Meeting(labelCol="y", maxIter=2)
    found = M.cross_validate(estimator, {"regParam": [0.1]}, one_split(spark, 200), features=["x", "z"], key="id", folds=4)
    assert len(fits) == 5 and len(found.avgMetrics) == 1


def test_a_search_finds_what_the_search_of_spark_finds(spark, monkeypatch):
    monkeypatch.setattr(M, "ROWS_DEALT", 100)
    df, grid = one_split(spark, 350), {"regParam": [0.01, 30.0], "maxIter": [1, 20]}
    estimator = M.logistic("y")
    plain = CrossValidator(
        estimator=Pipeline(stages=M._scaled(estimator)), estimatorParamMaps=M.param_grid(estimator, grid), numFolds=3, foldCol="_fold",
        evaluator=BinaryClassificationEvaluator(labelCol="y")).fit(M.fold_table(df, ["x", "z"], "y", "id", folds=3).persist())
    found = M.cross_validate(estimator, grid, df, features=["x", "z"], key="id", folds=3)
    assert found.avgMetrics == pytest.approx(plain.avgMetrics, abs=1e-9)
    assert found.stdMetrics == pytest.approx(plain.stdMetrics, abs=1e-9)
    best, other = M.classifier_of(found), plain.bestModel.stages[-1]
    assert (best.getRegParam(), best.getMaxIter()) == (other.getRegParam(), other.getMaxIter())
    assert best.coefficients.toArray() == pytest.approx(other.coefficients.toArray(), rel=1e-6)
    assert len(found.getEstimatorParamMaps()) == 4
