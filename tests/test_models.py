"""Scores, searches and selection."""

import pytest
from pyspark.sql import functions as F

from tablewright.operators import evaluate as E
from tablewright.operators import models as M
from tablewright.plans import Candidate, StatisticalConfig, prepare_statistical, select_model
from tablewright.sources import load_model, save_model


def area(spark, rows):
    df = spark.createDataFrame([(float(s) if s is not None else None, float(y)) for s, y in rows], "s double, y double")
    return E.auc_exact(df.repartition(3), "s", "y").first()


def brute(rows):
    pos = [s for s, y in rows if y == 1 and s is not None]
    neg = [s for s, y in rows if y == 0 and s is not None]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("rows,expected", [
    ([(1, 0), (2, 0), (3, 1)], 1.0),
    ([(3, 0), (1, 1)], 0.0),
    ([(1, 0), (1, 1)] * 50, 0.5),
    ([(float("-inf"), 0), (float("inf"), 1), (0, 1)], 1.0),
])
def test_area_in_plain_cases(spark, rows, expected):
    assert area(spark, rows)["auc"] == expected


def test_area_against_all_pairs(spark):
    rows = [((i * 7919 % 211) if i % 17 else None, i * 31 % 5 == 0) for i in range(700)]
    rows += [(100, i % 2) for i in range(350)]  # a third of the rows share one score
    assert area(spark, rows)["auc"] == pytest.approx(brute([(s, int(y)) for s, y in rows]), abs=1e-12)


def test_area_needs_both_classes(spark):
    assert area(spark, [(1, 1), (2, 1)])["auc"] is None


def test_leaderboard_first_of_equals_and_missing_scores(spark):
    scores = E.score_table(spark, [("a", None), ("b", 0.9), ("c", 0.9), ("d", float("nan"))])
    board = {r["model"]: r["is_best"] for r in E.leaderboard(scores).collect()}
    assert board == {"a": False, "b": True, "c": False, "d": False}
    assert E.best_model(E.leaderboard(scores)) == "b"


def test_first_candidate_can_win(spark):
    assert E.best_model(E.leaderboard(E.score_table(spark, [("a", 0.7), ("b", 0.6)]))) == "a"


def test_no_score_at_all(spark):
    board = E.leaderboard(E.score_table(spark, [("a", None)]))
    with pytest.raises(ValueError):
        E.evaluate_best({}, board, spark.range(1), "y")


def signal(spark, n=600):
    return spark.range(n).select(
        "id", (F.col("id") * 7919 % n).cast("double").alias("x"), F.lit(1.0).alias("one"),
    ).withColumn("y", (F.col("x") > n / 3).cast("double"))


def test_selection_finds_the_signal_and_stores_models(spark, tmp_path):
    df = signal(spark)
    cands = [Candidate("noise", M.logistic("y", max_iter=5), {"regParam": [0.1]}, drop=["x"]),
             Candidate("lr", M.logistic("y", max_iter=10), {"regParam": [0.01, 0.1]}),
             Candidate("svm", M.linear_svm("y", max_iter=10), {"regParam": [0.01]},
                       table=df.withColumn("extra", F.col("x") * 2))]
    chosen = select_model(df, cands, label="y", key="id", folds=2, model_dir=str(tmp_path))
    assert chosen.best == "lr"
    auc = {r["model"]: r["rocauc"] for r in chosen.leaderboard.collect()}
    assert auc["lr"] > 0.95 and auc["svm"] > 0.95 and auc["noise"] == 0.5
    stored = {name: f"{tmp_path}/{name}" for name in chosen.models}
    again = E.evaluate_best(stored, chosen.leaderboard, chosen.tests["lr"], "y").first()
    assert again["model"] == "lr" and again["auc"] == auc["lr"]


def test_scale_scopes_and_exact_split(spark):
    cand = [Candidate("lr", M.logistic("y", max_iter=5), {"regParam": [0.1]})]
    chosen = select_model(signal(spark), cand, label="y", key="id", folds=2, exact=True, scale_scope="each")
    assert chosen.tests["lr"].count() == 60
    with pytest.raises(ValueError):
        select_model(signal(spark), cand, label="y", key="id", scale_scope="all")


def test_search_is_repeatable_and_reports_its_winner(spark, tmp_path):
    df = signal(spark, 200)
    fits = [M.cross_validate(M.linear_svm("y"), {"regParam": [0.01, 0.1], "maxIter": [2, 5]}, df.repartition(n),
                             features=["x", "one"], key="id", folds=2) for n in (1, 3)]
    assert fits[0].avgMetrics == pytest.approx(fits[1].avgMetrics)
    assert {r["param"] for r in M.best_params(fits[0]).collect()} == {"regParam", "maxIter"}
    save_model(fits[0], str(tmp_path / "m"))
    assert M.classifier_of(load_model(str(tmp_path / "m"))).coefficients == M.classifier_of(fits[0]).coefficients


def test_inverse_strength_form():
    model = M.logistic("y", c=2.0, n=50)
    assert model.getRegParam() == 0.01 and not model.getStandardization()
    with pytest.raises(ValueError):
        M.logistic("y", c=1.0)


def test_statistical_flow_drops_forest_outliers(spark):
    df = spark.range(800).select(
        "id", F.when(F.col("id") < 5, 500.0).otherwise(F.randn(1)).alias("a"), F.randn(2).alias("b"),
        (F.col("id") % 3).cast("double").alias("c"), (F.col("id") % 2).cast("double").alias("y"))
    cfg = StatisticalConfig(["a", "b"], ["c", "y"], "y", key=["id"], trees=30, sample=128)
    out = prepare_statistical(df, cfg)
    assert out.table.columns == ["id", "a", "b", "y", "c_0", "c_1", "c_2"]
    assert out.table.filter("id < 5").count() == 0
    assert 740 <= out.table.count() <= 775
