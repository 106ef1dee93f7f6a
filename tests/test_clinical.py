"""The whole way on a table with the clinical schema: read, clean, enrich, choose a model."""

import random

import pytest
from pyspark.sql import functions as F

from tablewright.operators import evaluate as E
from tablewright.operators import models as M
from tablewright.operators.split import with_row_key
from tablewright.plans import (
    CLINICAL_RULES,
    CLINICAL_STATISTICAL,
    Candidate,
    PageRates,
    enrich,
    prepare_rules,
    prepare_statistical,
    select_model,
)
from tablewright.sources import FEATURES, MERGED, RAW, bind_schema, read_table, write_table

RATES = PageRates(
    first=[(18, 24, 8.3), (25, 34, 10.6), (35, 44, 11.7), (45, 54, 13.6), (55, 64, 13.7), (65, 74, 8.9), (75, 200, 3.4)],
    second=[(14, 17, 3.0), (18, 24, 5.3), (25, 44, 12.6), (45, 66, 14.9), (65, 200, 8.3)],
    groups={1: 13.1, 0: 10.1})
FLAGS = "sex painloc painexer htn restecg dig prop nitr pro diuretic exang xhypo fbs slope smoke".split()


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    rng = random.Random(5)

    def row():
        target = float(rng.random() < 0.5)
        r = {c: round(rng.gauss(60, 12), 1) for c in RAW.names}
        r.update({c: float(rng.random() < 0.5) for c in FLAGS}, age=float(rng.randint(16, 80)), target=target,
                 trestbps=round(rng.gauss(130, 20), 1), thalach=round(rng.gauss(150 - 30 * target, 12), 1),
                 oldpeak=round(rng.uniform(-1, 5), 1), cp=float(rng.randint(1, 4)))
        if rng.random() < 0.3:
            r["smoke"] = None
        for c in ("prop", "chol", "thaldur", "painloc"):
            if rng.random() < 0.05:
                r[c] = 22.0 if c == "prop" else None
        return tuple(r[c] for c in RAW.names)

    path = str(tmp_path_factory.mktemp("clinical") / "clinical.csv")
    shuffled = RAW.names[::-1]
    write_table(spark.createDataFrame([row() for _ in range(700)], RAW).select(*shuffled), path)
    return read_table(spark, path, RAW)


def test_rules_flow_gives_the_feature_table(raw):
    out = prepare_rules(raw, CLINICAL_RULES)
    assert out.columns == FEATURES.names and out.count() == 700
    bad = out.filter("trestbps < 100 or oldpeak < 0 or oldpeak > 4 or prop > 1 or prop is null or thaldur is null "
                     "or painloc is null or trestbpsxthalach <> trestbps * thalach")
    assert bad.count() == 0
    assert out.filter("smoke is null").count() > 100


def test_enriched_table_has_no_gap_above_the_first_band(raw):
    out = enrich(prepare_rules(raw, CLINICAL_RULES), RATES)
    bind_schema(out, MERGED)
    assert out.columns == MERGED.names
    assert out.filter("age >= 18 and (smoke_source1 is null or smoke_source2 is null)").count() == 0
    assert out.filter("age < 18 and smoke is null and smoke_source1 is not null").count() == 0
    males = out.filter("smoke is null and sex = 1 and age between 25 and 44").select("smoke_source2").distinct()
    assert [r[0] for r in males.collect()] == [12.6 * (10.1 / 13.1) / 100]


def test_statistical_flow_without_a_key(raw):
    out = prepare_statistical(raw, CLINICAL_STATISTICAL)
    names = out.table.columns
    assert "prop_22" not in names and {"prop_0", "prop_1", "sex_0", "sex_1", "target"} <= set(names)
    n = out.table.count()
    assert 500 < n < 670
    spread = out.table.agg(*[F.stddev_pop(c).alias(c) for c in CLINICAL_STATISTICAL.numeric]).first()
    assert all(v == pytest.approx(1) for v in spread)
    counted = out.feature_histogram.groupBy("column").agg(F.sum("n").alias("n")).select("n").distinct()
    assert [r[0] for r in counted.collect()] == [n]


def test_models_are_chosen_from_plain_and_enriched_tables(raw, tmp_path):
    table = with_row_key(prepare_rules(raw, CLINICAL_RULES))
    merged = enrich(table, RATES).filter("smoke_source1 is not null and smoke_source2 is not null")
    lr, svm = M.logistic("target", max_iter=10), M.linear_svm("target", max_iter=5)
    chosen = select_model(table, [
        Candidate("plain lr", lr, {"regParam": [0.01, 0.1]}, drop=["smoke"]),
        Candidate("plain svm", svm, {"regParam": [0.1]}, drop=["smoke"]),
        Candidate("merged lr", lr, {"regParam": [0.01]}, table=merged, drop=["smoke"]),
    ], label="target", key="row_key", folds=2, model_dir=str(tmp_path))
    scores = {r["model"]: r["rocauc"] for r in chosen.leaderboard.collect()}
    assert min(scores.values()) > 0.8 and chosen.best == max(scores, key=scores.get)
    best = E.evaluate_best(chosen.models, chosen.leaderboard, chosen.tests[chosen.best], "target").first()
    assert best["auc"] == scores[chosen.best]
