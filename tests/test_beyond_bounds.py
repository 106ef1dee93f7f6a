"""Tables with more columns, bands, levels or classes than the driver should hold."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tablewright.operators import enrich, features, segments, split, statistics
from tablewright.operators.comoments import correlation_blocks
from tablewright.operators.ranks import with_rank
from tablewright.operators.segments import disjoint_segments


def plan(df):
    return df._jdf.queryExecution().toString()


def correlations(df, cols, **options):
    return {(r.a, r.b): r["corr"] for r in correlation_blocks(df, cols, **options).collect()}


@pytest.mark.parametrize("block, sums", [(64, 1 << 25), (7, 1 << 25), (5, 1)])
def test_wide_correlations_equal_pandas(spark, block, sums):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 40)) @ rng.normal(size=(40, 40)) + rng.normal(size=40) * 1e3
    base[:, ::2][rng.random((300, 20)) < 0.3] = np.nan  # half the columns have gaps
    table = pd.DataFrame(base, columns=[f"x{i}" for i in range(40)])
    df = spark.createDataFrame(table.astype(object).where(table.notna(), None).values.tolist(), ", ".join(f"{c} double" for c in table))
    expected, found = table.corr(), correlations(df.repartition(5), list(table), block=block, sums_per_scan=sums)
    assert len(found) == 40 * 39 // 2
    for (a, b), value in found.items():
        assert int(a[1:]) < int(b[1:]) and value == pytest.approx(expected.loc[a, b], abs=1e-10)


def test_correlations_that_are_undefined(spark):
    rows = [(1.0, 5.0, None, 0.1, 1.0, 1e200), (2.0, 5.0, 1.0, None, float("nan"), 2e200), (4.0, 5.0, None, 0.1, 2.0, -1e200),
            (3.0, 5.0, None, 0.1, float("inf"), 1e199)]
    df = spark.createDataFrame(rows, "a double, same double, once double, gap double, odd double, huge double")
    found = correlations(df, df.columns)
    assert found["a", "same"] is None and found["a", "once"] is None and found["a", "gap"] is None
    assert math.isnan(found["a", "odd"]) and found["once", "gap"] is None
    assert found["a", "huge"] == pytest.approx(np.corrcoef([1, 2, 4, 3], [1, 2, -1, 0.1])[0, 1])
    assert set(correlations(df.limit(0), df.columns).values()) == {None}
    assert len(statistics.correlation_pairs(df.limit(0), [*df.columns, *df.columns]).collect()) == 66


def test_a_thousand_columns_take_two_scans(spark, tmp_path):
    n, rows = 1000, 40
    values = np.random.default_rng(1).normal(size=(rows, n))
    pd.DataFrame(values, columns=[f"x{i}" for i in range(n)]).to_parquet(tmp_path / "wide.parquet")
    df = spark.read.parquet(str(tmp_path / "wide.parquet"))
    out = statistics.correlation_pairs(df, df.columns)
    assert plan(out.select("a")).split("== Physical Plan ==")[1].count("FileScan") == 1  # and one for the means
    found = out.agg(F.count("corr"), F.sum("corr")).first()
    assert found[0] == n * (n - 1) // 2
    assert found[1] == pytest.approx((np.corrcoef(values.T).sum() - n) / 2, rel=1e-6)


def test_wide_columns_are_one_expression(spark, tmp_path):
    """Thirty-two in a generated method are too many for Java to compile it."""
    from checks.profiles import WIDE, wide_items, wide_sql

    rows = [(k, float(k % 50), None if k == 9 else k * 1.37, k % 7) for k in range(-20, 40)]
    df = spark.createDataFrame(rows, "l_orderkey long, l_quantity double, l_extendedprice double, l_linenumber int")
    df.write.parquet(str(tmp_path / "lineitem.parquet"))
    found = wide_items(spark, str(tmp_path))
    expected = df.select(*[F.expr(wide_sql(i)).cast("double").alias(f"x{i}") for i in range(WIDE)])
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect())) and found.dtypes == expected.dtypes
    assert plan(found).split("== Physical Plan ==")[1].count("CASE WHEN") == 1


def brute(key, bands, half_open):
    return next((rate for lo, hi, rate in bands if lo <= key and (key < hi + 1 if half_open else key <= hi)), None)


@pytest.mark.parametrize("half_open", [False, True])
@pytest.mark.parametrize("shape", ["nested", "short", "one start", "one end"])
def test_overlapping_bands_equal_a_scan(spark, half_open, shape):
    rng = random.Random(11)
    bands = []
    for i in range(400):
        a, b = sorted((rng.randrange(300), rng.randrange(300) + rng.random()))
        lo, hi = {"nested": (a, b), "short": (a, a + rng.choice([0, 1, 2.5])), "one start": (0, b), "one end": (a, 300)}[shape]
        bands.append((float(lo), float(hi), float(i)))
    keys = [float(k) for k in range(-2, 304)] + [rng.random() * 300 for _ in range(300)]
    table = spark.createDataFrame([(i, *b) for i, b in enumerate(bands)], "idx int, lo double, hi double, rate double")
    got = {r.key: r.rate for r in enrich.first_bands(spark.createDataFrame([(k,) for k in keys], "key double"), table, half_open).collect()}
    expected = {k: brute(k, bands, half_open) for k in keys}
    assert got == {k: v for k, v in expected.items() if v is not None}
    edges = [r.edge for r in disjoint_segments(table, half_open).collect()]
    assert len(edges) == len(set(edges)) <= 2 * len(bands)


def test_slices_hold_as_many_ends_however_many_bands(spark, monkeypatch):
    sweep = segments._sweep

    def counted(*args):
        run = sweep(*args)

        def small(pieces):
            assert len(pieces) <= 2 * 50 + 3, len(pieces)
            return run(pieces)

        return small

    rng = random.Random(5)
    starts = [rng.choice([7.0, float(rng.randrange(40)), rng.random() * 40]) for _ in range(1500)]
    bands = [(lo, lo + rng.choice([0, 1, 2, 30]), float(i)) for i, lo in enumerate(starts)]
    table = spark.createDataFrame([(i, *b) for i, b in enumerate(bands)], "idx int, lo double, hi double, rate double")
    keys = [rng.random() * 75 for _ in range(200)] + [float(k) for k in range(75)]
    monkeypatch.setattr(segments, "_sweep", counted)
    cut = segments.disjoint_segments(table, slice_ends=50)
    found = segments.as_of(spark.createDataFrame([(k,) for k in keys], "key double"), cut).collect()
    expected = {k: brute(k, bands, False) for k in keys}
    assert {r.key: r.rate for r in found} == {k: v for k, v in expected.items() if v is not None}


def test_only_keys_of_gaps_are_looked_up(spark, monkeypatch):
    asked = []
    first = enrich.first_bands
    monkeypatch.setattr(enrich, "first_bands", lambda keys, *rest: asked.append(keys) or first(keys, *rest))
    rows = spark.createDataFrame([(1, 5.0, None), (2, 6.0, 0.5), (3, None, None), (4, 99.0, None)], "id int, age double, smoke double")
    bands = spark.range(300).select(F.col("id").alias("idx"), (F.col("id") % 10).alias("lo"), (F.col("id") % 10).alias("hi"), F.lit(7.0).alias("rate"))
    out = enrich.impute_by_band(rows, "smoke", "age", bands, max_bands=100)
    assert sorted((r.id, r.smoke) for r in out.collect()) == [(1, 0.07), (2, 0.5), (3, None), (4, None)]
    assert sorted(r.key for r in asked[0].dropna().collect()) == [5.0, 99.0]


def test_no_bands_and_no_keys(spark):
    none = spark.createDataFrame([], "idx int, lo double, hi double, rate double")
    some = spark.createDataFrame([(1, 2.0, 3.0, 4.0), (2, None, 3.0, 5.0), (3, float("nan"), 9.0, 6.0)], "idx int, lo double, hi double, rate double")
    keys = spark.createDataFrame([(2.5,), (8.0,)], "key double")
    assert enrich.first_bands(keys, none).count() == 0 and enrich.first_bands(keys.limit(0), some).count() == 0
    assert [tuple(r) for r in enrich.first_bands(keys, some).collect()] == [(2.5, 4.0)]


def test_a_hot_key_is_split(spark):
    """A third of all rows has one key; the join back is of plain exchanges, so Spark splits it."""
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 60_000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, 77.0).otherwise((F.col("id") % 5000).cast("double")).alias("age"),
                                                   F.lit(None).cast("double").alias("smoke"))
        bands = spark.range(3000).select(F.col("id").cast("int").alias("idx"), F.col("id").cast("double").alias("lo"),
                                         (F.col("id") + 10).cast("double").alias("hi"), (F.col("id") % 50).cast("double").alias("rate"))
        out = enrich.impute_by_band(rows, "smoke", "age", bands, max_bands=100)
        assert out.count() == 60_000
        filled = out.groupBy("age").agg(F.min("smoke").alias("low"), F.max("smoke").alias("high"), F.count("smoke").alias("n"))
        assert {r.low for r in filled.filter("age = 77").collect()} == {(77 - 10) % 50 / 100}
        assert filled.filter("low <> high").count() == 0
        out.write.format("noop").mode("overwrite").save()
        joined = enrich.impute_by_band(rows, "smoke", "age", bands, max_bands=100)
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_ranks_follow_the_order(spark):
    rng = random.Random(4)
    values = [(rng.randrange(5), f"{rng.random():.6f}") for _ in range(700)]
    df = spark.createDataFrame(values, "n int, t string")
    got = {(r.n, r.t): r["rank"] for r in with_rank(df, [F.col("n").desc(), F.col("t")]).collect()}
    assert [k for k, _ in sorted(got.items(), key=lambda kv: kv[1])] == sorted(values, key=lambda v: (-v[0], v[1]))
    assert sorted(got.values()) == list(range(700)) and with_rank(df.limit(0), [F.col("t")]).count() == 0


def levelled(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice(["hot", f"l{rng.randrange(400)}", f"é{rng.randrange(30)}"]), rng.randrange(60) * 1.5) for i in range(3000)]
    return spark.createDataFrame(rows, "id long, y string, z double")


def test_an_index_table_equals_the_index_in_memory(spark):
    df = levelled(spark)
    for col in ("y", "z"):
        few, many = (features.index_labels(df, col, "label", max_levels=n) for n in (10**6, 20))
        assert many.columns == few.columns
        assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect()))
    gap = df.unionByName(spark.createDataFrame([(-1, None, 1.0)], "id long, y string, z double"))
    with pytest.raises(Exception, match="misses a label"):
        features.index_labels(gap, "y", max_levels=20).collect()


def test_vectors_over_an_index_table_equal_those_in_memory(spark):
    df = levelled(spark).unionByName(spark.createDataFrame([(-1, None, 1.5)], "id long, y string, z double"))
    few, many = (features.one_hot_vector(df, ["y", "z"], max_levels=n) for n in (10**6, 100))
    assert many.columns == few.columns

    def rows(out):
        return {r.id: (r.y, r.z, r.a, r.b) for r in out.select("id", "y", "z", vector_to_array("y_vec").alias("a"), vector_to_array("z_vec").alias("b")).collect()}

    assert rows(many) == rows(few)


def test_two_million_levels(spark):
    df = spark.range(0, 2_000_000, 1, 8).select(F.concat(F.lit("k"), "id").alias("y")).unionByName(
        spark.range(0, 500_000, 1, 4).select(F.lit("hot").alias("y")))
    out = features.index_labels(df, "y")
    assert out.filter("label = 0").agg(F.min("y"), F.max("y"), F.count("y")).first() == ("hot", "hot", 500_000)
    assert out.agg(F.countDistinct("label"), F.max("label")).first() == (2_000_001, 2_000_000.0)


@pytest.mark.parametrize("boundary_rows", [100_000, 3])
def test_splits_of_many_classes_equal_those_in_memory(spark, boundary_rows):
    rng = random.Random(2)
    rows = [(i, i % 5, rng.choice([None, "big", "big", "big", f"c{rng.randrange(300)}"])) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, part int, y string")
    for key in ("id", ["part", "id"]):
        few, many = (split.exact_split(df, "y", key, test=0.3, boundary_rows=boundary_rows, max_classes=n) for n in (1000, 20))
        assert many.columns == few.columns
        assert sorted(few.collect(), key=lambda r: r.id) == sorted(many.collect(), key=lambda r: r.id)
    few, many = (split.stratified_split(df, "y", "id", train=0.8, max_classes=n) for n in (1000, 20))
    assert sorted(few.collect(), key=lambda r: r.id) == sorted(many.collect(), key=lambda r: r.id)


def test_a_class_per_row_and_equal_keys(spark):
    df = spark.createDataFrame([(i, f"c{i}", 1) for i in range(200)], "id long, y string, k int")
    assert split.exact_split(df, "y", "id", test=0.5, max_classes=10).filter("split = 'test'").count() == 200
    assert split.exact_split(df, "y", "id", test=0.4, max_classes=10).filter("split = 'test'").count() == 0
    same = df.withColumn("y", F.concat(F.lit("c"), F.col("id") % 20))
    assert split.exact_split(same, "y", "k", test=0.4, max_classes=10, boundary_rows=2).filter("split = 'test'").count() == 200
    drawn = split.stratified_sample(df.withColumn("y", F.concat(F.lit("c"), F.col("id") % 40)), "y", train=0.5, max_classes=10)
    assert 40 < drawn.count() < 120 and set(drawn.columns) == set(df.columns)
