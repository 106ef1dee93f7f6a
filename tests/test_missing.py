"""One missing marker, and imputing with it."""

import math

import pytest
from pyspark.sql import functions as F

from tablewright.operators import impute as I
from tablewright.operators import missing as M
from tablewright.operators import statistics as S
from tablewright.operators.quantiles import exact_quantiles
from tablewright.plans import RulesConfig, prepare_rules
from tablewright.sources import require_columns


def values(df, col):
    return sorted((r[col] for r in df.collect()), key=lambda v: (v is not None, v))


def test_nan_and_null_inputs_give_the_same_result(spark):
    cfg = RulesConfig(columns=["id", "a", "b", "m"], modes=["m"], ranges={"a": (100, None)}, means=["b"])
    nan = float("nan")
    with_nan = [(1, 50.0, 1.0, nan), (2, nan, nan, 2.0), (3, 120.0, 3.0, 2.0), (4, 140.0, nan, 1.0)]
    with_null = [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in with_nan]
    schema = "id int, a double, b double, m double"
    got = [sorted(map(tuple, prepare_rules(spark.createDataFrame(rows, schema), cfg).collect()))
           for rows in (with_nan, with_null)]
    assert got[0] == got[1]
    # Invalid and missing values take the mean of the valid ones.
    assert [r[1] for r in got[0]] == [130.0, 130.0, 120.0, 140.0]


def test_surrogate_observed_takes_all_rows(spark):
    df = spark.createDataFrame([(50.0,), (None,), (120.0,), (140.0,)], "a double")
    out = I.repair_range(df, "a", lo=100, surrogate="observed", fill_missing=True)
    assert values(out, "a") == pytest.approx([310 / 3, 310 / 3, 120.0, 140.0])


def test_range_repair_leaves_gaps_unless_asked(spark):
    df = spark.createDataFrame([(50.0,), (None,), (120.0,)], "a double")
    assert values(I.repair_range(df, "a", lo=100), "a") == [None, 120.0, 120.0]


def test_mode_ignores_missing_majority_and_breaks_ties_low(spark):
    df = spark.createDataFrame([(None, "b"), (None, "a"), (None, "b"), (3.0, "a"), (1.0, None)], "x double, y string")
    assert S.modes(df, ["x", "y"]) == {"x": 1.0, "y": "a"}


def test_all_null_column_stays_null(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "x double, y double")
    for impute in (I.impute_mode, I.impute_mean, I.impute_median):
        assert values(impute(df, ["x"]), "x") == [None, None]


def test_mode_of_integer_column_keeps_its_type(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "x int")
    out = I.impute_mode(df, ["x"])
    assert out.schema["x"].dataType.simpleString() == "int" and values(out, "x") == [1, 1, 1]


def test_fitted_model_applies_to_another_table(spark):
    train = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    test = spark.createDataFrame([(None,), (10.0,)], "x double")
    assert values(I.fit_mean(train, ["x"]).transform(test), "x") == [2.0, 10.0]


def test_domain_repair_uses_mode_before_repair(spark):
    df = spark.createDataFrame([(22.0,), (22.0,), (1.0,), (None,)], "x double")
    assert values(I.repair_domain_mode(df, ["x"]), "x") == [1.0, 22.0, 22.0, 22.0]


def test_missing_profile_of_empty_table(spark):
    df = spark.createDataFrame([], "x double")
    assert [tuple(r) for r in M.missing_profile(df).collect()] == [("x", 0, None)]


def test_drop_sparse_threshold_is_exclusive(spark):
    rows = [(1.0 if i else None, 1.0 if i > 1 else None, None) for i in range(8)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    assert M.drop_sparse(df, 0.125, protect=["y"]).columns == ["a", "y"]


def test_require_columns(spark):
    with pytest.raises(ValueError, match="target"):
        require_columns(spark.range(1), ["id", "target"])


@pytest.mark.parametrize("small,ranked", [(20_000, 200_000), (0, 200_000), (0, 40), (0, 1)])
def test_quantiles_are_exact_on_every_path(spark, small, ranked):
    rows = [(float((i * 7919) % 1009) ** 2, float(i % 3), None if i % 2 else float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    probs = {c: [0.0, 0.25, 0.5, 0.9, 1.0] for c in "abc"}
    found = exact_quantiles(df, probs, small=small, ranked=ranked)
    for i, c in enumerate("abc"):
        data = sorted(r[i] for r in rows if r[i] is not None)
        for p, got in zip(probs[c], found[c]):
            at = p * (len(data) - 1)
            lower, upper = data[math.floor(at)], data[math.ceil(at)]
            assert got == pytest.approx(lower + (upper - lower) * (at - math.floor(at)), abs=1e-9)


def test_quantile_between_two_hot_values(spark):
    """The wanted ranks sit on either side of two values that fill every bracket."""
    df = spark.createDataFrame([(1.0,)] * 500 + [(2.0,)] * 500 + [(0.0,)] * 3 + [(9.0,)] * 3, "a double").repartition(4)
    assert exact_quantiles(df, {"a": [0.5, 0.4, 0.999]}, small=0, ranked=1) == {"a": [1.5, 1.0, 9.0]}


def test_quantiles_of_mixed_lengths_and_one_value(spark):
    df = spark.createDataFrame([(7.0, None, None)] * 500 + [(7.0, 1.0, None)], "a double, b double, c double")
    assert exact_quantiles(df, {"a": [0.5], "b": [0.5], "c": [0.5]}, small=0, ranked=1) == {
        "a": [7.0], "b": [1.0], "c": [None]}


def test_histogram_of_constant_and_closed_last_bin(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, 10.0), (None, 10.0)], "a double, b double")
    rows = {(r["column"], r["bin"]): (r["lo"], r["hi"], r["n"]) for r in S.histogram(df, ["a", "b"], 2).collect()}
    assert rows == {("a", 0): (4.5, 5.0, 0), ("a", 1): (5.0, 5.5, 2), ("b", 0): (0.0, 5.0, 1), ("b", 1): (5.0, 10.0, 2)}


def test_correlations_do_not_depend_on_the_passes(spark, monkeypatch):
    df = spark.range(200).select(F.col("id").cast("double").alias("a"), (F.col("id") * 3 % 17).cast("double").alias("b"),
                                 (-F.col("id")).cast("double").alias("c"))
    pairwise = {(r["a"], r["b"]): r["corr"] for r in S.correlation_pairs(df, ["a", "b", "c"]).collect()}
    monkeypatch.setattr(S, "PAIRS_PER_PASS", 2)
    passes = {(r["a"], r["b"]): r["corr"] for r in S.correlation_pairs(df, ["a", "b", "c"]).collect()}
    assert pairwise == pytest.approx(passes) and pairwise["a", "c"] == pytest.approx(-1)


def test_empty_rows_go_unless_something_fills_them(spark):
    df = spark.createDataFrame([(None, None), (1.0, None)], "a double, b double")
    assert prepare_rules(df, RulesConfig(["a", "b"], means=["b"])).count() == 1
    assert prepare_rules(df, RulesConfig(["a", "b"], means=["a"])).count() == 2
