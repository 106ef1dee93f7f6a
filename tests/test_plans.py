"""The physical plans keep to what scales."""

import pytest
from pyspark.sql import functions as F

from checks.inputs import flag_orders, gap_lineitem, table
from tablewright.operators import enrich, evaluate, extract, features, impute, missing, outliers, split, statistics
from tablewright.plans import RulesConfig, prepare_rules
from tablewright.sources import bind_schema, read_table, write_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning") + plan(df).count("Exchange rangepartitioning")


def narrow(spark, folder):
    items = gap_lineitem(spark, folder)
    orders = flag_orders(spark, folder)
    pages = table(spark, folder, "pages")
    return {
        "mean": impute.impute_mean(items, ["l_quantity"]),
        "mode": impute.impute_mode(items, ["l_linestatus"]),
        "median": impute.impute_median(items, ["l_tax"]),
        "range": impute.repair_range(items, "l_quantity", 5, 40),
        "domain": impute.repair_domain_mode(orders, ["flag"]),
        "z": features.standardize(items, ["l_quantity"]),
        "unit": features.min_max(items, ["l_quantity"]),
        "one-hot": features.one_hot(orders, ["o_orderstatus"]),
        "fence": outliers.iqr_filter(items, ["l_quantity"]),
        "split": split.stratified_split(orders, "flag", "o_orderkey"),
        "exact split": split.exact_split(orders, "flag", "o_orderkey"),
        "bands": enrich.impute_by_band(items, "l_tax", "l_quantity", [(1, 20, 3.0), (21, 60, 4.0)]),
        "elements": extract.extract_elements(pages, "li"),
        "rules": prepare_rules(items, RulesConfig(["l_quantity", "l_tax"], modes=["l_tax"], means=["l_quantity"])),
    }


def test_fitted_operators_do_not_shuffle(spark, folder):
    moved = {name: shuffles(df) for name, df in narrow(spark, folder).items()}
    assert not any(moved.values()), moved


def test_no_nested_loops_or_cartesian_products(spark, folder):
    for name, df in narrow(spark, folder).items():
        assert "CartesianProduct" not in plan(df) and "NestedLoopJoin" not in plan(df), name


def test_imputing_stays_in_generated_code(spark, folder):
    text = plan(impute.impute_mean(gap_lineitem(spark, folder), ["l_quantity"]))
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text and "*(1)" in text


def test_columns_are_pruned_and_filters_pushed(spark, folder):
    items = table(spark, folder, "lineitem")
    text = plan(missing.missing_profile(items, ["l_tax"]))
    assert "ReadSchema: struct<l_tax:double>" in text
    text = plan(items.filter("l_quantity < 5").select("l_orderkey"))
    assert "LessThan(l_quantity,5.0)" in text


def test_profiles_read_the_table_once(spark, folder):
    items = gap_lineitem(spark, folder)
    for df in (missing.missing_profile(items), statistics.describe_table(items, ["l_quantity", "l_tax"]),
               statistics.correlation_pairs(items, ["l_quantity", "l_tax"])):
        assert plan(df).count("FileScan") == 1


def test_mode_shuffles_counted_values_only(spark, folder):
    text = plan(statistics.column_modes(gap_lineitem(spark, folder), ["l_quantity"]))
    assert "partial_count" in text and "Window" not in text


def test_area_ranks_in_buckets(spark, folder):
    text = plan(evaluate.auc_exact(flag_orders(spark, folder), "o_totalprice", "flag"))
    windows = [line for line in text.splitlines() if "Window " in line]
    assert windows and all("bucket" in line for line in windows)


def test_csv_binds_by_name(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    write_table(spark.createDataFrame([("1", "x,\"y\"\\"), ("zz", None)], "b string, a string"), path)
    schema = spark.createDataFrame([], "a string, b double").schema
    assert sorted(map(tuple, read_table(spark, path, schema, strict=False).collect()), key=str) == sorted(
        [("x,\"y\"\\", 1.0), (None, None)], key=str)
    with pytest.raises(ValueError):
        bind_schema(spark.range(1), schema)
    with pytest.raises(Exception, match="zz"):
        read_table(spark, path, schema).collect()


def test_fitted_models_work_on_a_stream(spark, folder, tmp_path):
    """Fit on a table, apply to a stream: the fitted part is a projection."""
    items = gap_lineitem(spark, folder).select("l_orderkey", "l_quantity")
    fitted = impute.fit_mean(items, ["l_quantity"])
    path = str(tmp_path / "in")
    write_table(items, path)
    stream = spark.readStream.schema(items.schema).parquet(path)
    run = (fitted.transform(stream).writeStream.format("memory").queryName("filled")
           .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    run.awaitTermination(120)
    got = spark.table("filled")
    assert got.count() == items.count() and got.filter(F.col("l_quantity").isNull()).count() == 0
