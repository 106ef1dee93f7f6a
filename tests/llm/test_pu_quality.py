import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm.pu_quality import FEATURES, estimate_prior, feature_table, features, fit, held_out, quality_scores, train, trusted_ids
from tablewright.llm.pu_quality import Model

BIG = "/root/testdata/sf0.01"


def test_features_of_empty_and_long_texts():
    for text in (b"", b" \n", "é ☃".encode(), b"word " * 50000):
        values = features(text)
        assert len(values) == len(FEATURES) and np.isfinite(values).all()


def test_labels_of_the_held_out_fold_are_not_learnt(spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(200)] + [(7, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    ids = {r.id for r in trusted_ids(labels).collect()}
    held = {r.id for r in spark.range(200).select("id").filter(held_out(F.col("id"))).collect()}
    assert not ids & held and 7 not in ids and len(ids | held | {7}) == 200


def test_held_out_accuracy(spark):
    scores = quality_scores(spark, spark.read.parquet(f"{BIG}/documents.parquet"), BIG)
    assert scores.count() == 1000
    rows = scores.filter("held_out").join(spark.read.parquet(f"{BIG}/labels.parquet"), "doc_id").toPandas()
    good, bad = rows[rows.quality == 1], rows[rows.quality == 0]
    assert (good.predicted == 1).mean() > 0.95 and (bad.predicted == 0).mean() > 0.7
    assert ((good.score.values[:, None] > bad.score.values[None, :]).mean()) > 0.97


def planted(spark, n=3000, share=0.7):
    rng = np.random.default_rng(5)
    good = rng.random(n) < share
    table = rng.normal(0, 1, (n, len(FEATURES)))
    table[:, 2] += np.where(good, -3.0, 3.0)
    unlabelled = [(i, x.tolist()) for i, x in enumerate(table.astype(np.float32))]
    return spark.createDataFrame(unlabelled, "id long, features array<float>"), good


def test_prior_and_risk_on_planted_classes(spark):
    table, good = planted(spark)
    trusted = spark.createDataFrame([(i,) for i in range(0, 3000, 3) if good[i]], "id long")
    model = train(table, trusted)
    assert abs(model.prior - 0.7) < 0.06
    x = np.array([r.features for r in table.orderBy("id").collect()])
    assert ((model.scores(x) > 0.5) == good).mean() > 0.95


def test_nothing_to_learn_from(spark, awkward, nothing):
    none = spark.createDataFrame([], "id long")
    table = feature_table(awkward, "doc_id", "text")
    assert set(train(table, none).scores(np.zeros((2, len(FEATURES))))) == {0.5}
    model = train(feature_table(nothing, "doc_id", "text"), none)
    assert model.prior == 0.5


def test_awkward_rows(spark, awkward, nothing, tmp_path):
    spark.createDataFrame([(1, 1, 0), (6, 1, 0), (8, 1, 0), (4, 0, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    rows = quality_scores(spark, awkward, str(tmp_path)).collect()
    assert len(rows) == awkward.count() and all(0.0 <= r.score <= 1.0 and r.held_out is not None for r in rows)
    assert quality_scores(spark, nothing, str(tmp_path)).count() == 0


def test_the_correction_keeps_the_risk_from_running_away(spark):
    """A prior above the truth makes the plain risk unbounded; weights must stay finite."""
    table, good = planted(spark, 600)
    positive = table.filter(F.col("id").isin([i for i in range(600) if good[i]][:60])).select("features")
    start = Model(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(len(FEATURES) + 1), 0.95)
    assert np.isfinite(fit(positive, table, start, rounds=8).weights).all()
    assert 0.05 <= estimate_prior(positive, table, start) <= 0.98


def test_scores_stay_probabilities():
    model = Model(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.full(len(FEATURES) + 1, 1e3), 0.5)
    assert model.scores(np.array([[1e9] * len(FEATURES), [-1e9] * len(FEATURES)])) == pytest.approx([1.0, 0.0])
