"""Scaling, encoding, splits and outliers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import features as X
from tablewright.operators import outliers as O
from tablewright.operators import split as P


def people(spark, n=2000):
    return spark.range(n).select("id", (F.col("id") % 4 == 0).cast("double").alias("y"))


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(2.0, None), (2.0, 1.0)], "a double, b double")
    assert [r["a"] for r in X.standardize(df, ["a"]).collect()] == [0.0, 0.0]
    assert sorted((r["b"] for r in X.min_max(df, ["b"]).collect()), key=str) == [0.0, None]


def test_one_hot_keeps_gaps_as_zeros_and_limits_levels(spark):
    df = spark.createDataFrame([(1.0, "a b"), (0.0, None), (None, "c")], "s double, t string")
    out = X.one_hot(df, ["s", "t"])
    assert out.columns == ["s_0", "s_1", "t_a_b", "t_c"]
    assert sorted(map(tuple, out.collect())) == [(0, 0, 0, 1), (0, 1, 1, 0), (1, 0, 0, 0)]
    with pytest.raises(ValueError, match="levels"):
        X.one_hot(df, ["s"], max_levels=1)


def test_assemble_refuses_gaps(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    with pytest.raises(Exception, match="null"):
        X.assemble(df, ["a", "b"]).collect()


def test_binarize_needs_two_classes(spark):
    df = spark.createDataFrame([("no",), ("yes",)], "y string")
    assert sorted(r["y"] for r in X.binarize_label(df, "y").collect()) == [0.0, 1.0]
    with pytest.raises(ValueError):
        X.binarize_label(df, "y", ["a", "b", "c"])


@pytest.mark.parametrize("split", [
    lambda df: P.stratified_split(df, "y", "id"),
    lambda df: P.exact_split(df, "y", "id"),
    lambda df: P.exact_split(df, "y", "id", boundary_rows=10),
])
def test_split_does_not_depend_on_partitions(spark, split):
    sides = [sorted(map(tuple, split(people(spark).repartition(n)).collect())) for n in (2, 5)]
    assert sides[0] == sides[1]


def test_exact_split_sizes(spark):
    df = P.exact_split(people(spark, 1003), "y", "id", test=0.1)
    sizes = {(r["y"], r["split"]): r["count"] for r in df.groupBy("y", "split").count().collect()}
    assert sizes == {(0.0, "test"): 75, (0.0, "train"): 677, (1.0, "test"): 25, (1.0, "train"): 226}


def test_exact_split_with_null_class_and_tiny_class(spark):
    df = spark.createDataFrame([(i, None if i < 50 else "a") for i in range(100)] + [(100, "rare")], "id long, y string")
    out = P.exact_split(df, "y", "id", boundary_rows=5)
    sizes = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert sizes == {(None, "test"): 5, (None, "train"): 45, ("a", "test"): 5, ("a", "train"): 45, ("rare", "train"): 1}


def test_duplicates_survive_the_split(spark):
    df = spark.createDataFrame([(1, 0.0)] * 5 + [(2, 1.0)] * 3, "id long, y double")
    assert P.stratified_split(df, "y", "id").count() == 8


def test_set_difference_with_nulls_and_many_copies(spark, monkeypatch):
    rows = [(1, None)] * 7 + [(2, "a")] * 3 + [(3, "b")]
    df = spark.createDataFrame(rows, "x int, y string")
    other = spark.createDataFrame([(1, None)] * 2 + [(3, "b"), (4, "c")], "u int, v string")
    assert [tuple(r) for r in P.set_difference(df, other).collect()] == [(2, "a")]
    for size in (100_000, 2):
        monkeypatch.setattr(P, "COPIES_PER_ROW", size)
        left = P.set_difference(df, other, distinct=False)
        assert sorted(map(tuple, left.collect()), key=str) == sorted([(1, None)] * 5 + [(2, "a")] * 3, key=str)
        assert left.columns == ["x", "y"]


def test_stratified_sample_share(spark):
    n = P.stratified_sample(people(spark, 10_000), "y", train=0.9, seed=1).count()
    assert abs(n - 9000) < 200


def test_fence_keeps_gaps(spark):
    rows = [(float(i % 10),) for i in range(100)] + [(1000.0,), (None,)]
    out = O.iqr_filter(spark.createDataFrame(rows, "x double"), ["x"])
    assert out.count() == 101 and out.filter("x > 100").count() == 0


def planted(spark, n=4000):
    base = spark.range(n).select("id", (F.randn(3) * 1.0).alias("a"), (F.randn(4) * 1.0).alias("b"))
    far = spark.range(n, n + 12).select("id", F.lit(40.0).alias("a"), (F.col("id") % 2 * 80.0 - 40).alias("b"))
    return base.unionByName(far).repartition(6, "id")


def test_forest_flags_planted_rows_and_the_asked_share(spark):
    df = planted(spark)
    out = O.isolation_forest(df, ["a", "b"], "id", contamination=0.05, trees=50, seed=11)
    flagged = out.filter("is_outlier")
    assert flagged.filter("id >= 4000").count() == 12
    assert abs(flagged.count() - 0.05 * 4012) < 12


def test_forest_does_not_depend_on_partitions(spark):
    df = planted(spark)
    first, second = (O.IsolationForest(["a", "b"], "id", trees=10, seed=5).fit(df.repartition(n)).trees for n in (2, 7))
    assert first == second


def test_forest_draws_full_samples_without_repeats(spark):
    for rows in (3000, 300):
        df = spark.range(rows).select("id", F.col("id").cast("double").alias("a"))
        drawn = O.IsolationForest(["a"], "id", trees=20, sample=64).sampled(df)
        per_tree = drawn.groupBy("tree").agg(F.count("_x0").alias("n"), F.countDistinct("_x0").alias("d")).collect()
        assert len(per_tree) == 20 and all(r["n"] == r["d"] == 64 for r in per_tree)


def test_forest_on_fewer_rows_than_its_sample(spark):
    df = spark.range(40).select("id", F.col("id").cast("double").alias("a"))
    scored = O.isolation_forest(df, ["a"], "id", trees=10, seed=1)
    assert scored.filter("anomaly_score > 0 and anomaly_score < 1").count() == 40


def test_forest_scores_match_a_plain_walk(spark):
    df = planted(spark, 300)
    model = O.IsolationForest(["a", "b"], "id", trees=7, sample=32, seed=2).fit(df)
    for r in model.score(df).limit(50).collect():
        depth = []
        for t in model.trees:
            node = 0
            while t["left"][node] != node:
                node = t["left"][node] + int(r[["a", "b"][t["feature"][node]]] > t["threshold"][node])
            depth.append(t["path"][node])
        assert r["anomaly_score"] == pytest.approx(2 ** (-np.mean(depth) / float(O.mean_path(32))))


def test_all_equal_rows_are_scored_alike(spark):
    df = spark.range(100).select("id", F.lit(1.0).alias("a"))
    scores = {r[0] for r in O.isolation_forest(df, ["a"], "id", trees=5, seed=1).select("anomaly_score").collect()}
    assert len(scores) == 1


def test_forest_flags_the_asked_share_of_a_large_table_with_copies(spark):
    """A third of the rows are copies of one row and the table is larger than a sample for the cut-off."""
    n = 450_000
    value = F.when(F.col("i") % 3 == 0, 0.0).otherwise(F.randn(3))
    df = spark.range(n).withColumnRenamed("id", "i").select(value.alias("a")).repartition(4)
    flagged = O.isolation_forest(df, ["a"], trees=10, seed=1).filter("is_outlier").count()
    assert abs(flagged / n - 0.05) < 0.004
