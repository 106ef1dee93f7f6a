"""Cases that once gave wrong, endless or size-dependent results."""

import math
import os
import random
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from tablewright.functions.html import plain_text, scan_elements
from tablewright.operators import enrich, extract, features, outliers, statistics
from tablewright.operators.evaluate import auc_exact
from tablewright.operators.models import logistic, score
from tablewright.operators.quantiles import exact_quantiles
from tablewright.plans import Candidate, PageSources, prepare_statistical, select_model
from tablewright.plans.enrichment import rates_from_pages
from tablewright.sources import bind_schema


def test_elements_take_time_in_proportion_to_the_page():
    def seconds(n):
        page, began = "<ul>" + "<li>item <b>text</b> here" * n, time.process_time()
        assert len(scan_elements(page, "li")) == n
        return time.process_time() - began

    seconds(1000)
    assert seconds(64000) < 10 * max(0.05, seconds(16000))


@pytest.mark.parametrize("page, tag, inner", [
    ("<ul><li>a<li>b</ul>c", "li", ["a", "b"]),
    ("<p>one<p>two<div>x</div>", "p", ["one", "two"]),
    ("<div><p>one</div>two", "p", ["one"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "td", ["1", "2", "3"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "tr", ["<td>1<td>2", "<td>3"]),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", "li", ["a<ul><li>b</ul>", "b", "c"]),
    ("</li><li>never closed", "li", ["never closed"]),
    ("<dl><dt>a<dd>b<dt>c</dl>", "dt", ["a", "c"]), ("", "p", []),
])
def test_elements_without_end_tags(page, tag, inner):
    assert [e[1] for e in scan_elements(page, tag)] == inner


def test_all_character_references():
    assert plain_text("&rsquo;&eacute;&hellip;&times;&#128512;&#x1F600;&amp;lt;&nbsp;<b>&lt;</b>") == "’é…×😀😀&lt; <"


def test_tail_mean_counts_numbers_only(spark):
    rows = [(1, i, t) for i, t in enumerate(["12", "14", "n/a", "16", " "])]
    out = extract.tail_mean(spark.createDataFrame(rows, "page_id long, pos int, text string"), 2)
    assert [tuple(r) for r in out.collect()] == [(1, 15.0)]


@pytest.mark.parametrize("values", [
    [float("nan")] * 50 + list(range(10)), [1.0, 2.0, math.inf], [-math.inf, 1.0, 5.0, math.inf], [3.0] * 40 + [7.0], [float("nan")] * 5])
def test_quantiles_end_and_do_not_depend_on_size(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    probs = {"x": [0.0, 0.25, 0.5, 0.9, 1.0]}
    assert repr(exact_quantiles(df, probs)) == repr(exact_quantiles(df, probs, small=0, ranked=5))


def test_correlations_stay_pair_wise(spark):
    rng = random.Random(1)
    rows = [tuple(rng.random() if rng.random() < 0.7 else None for _ in range(34)) for _ in range(120)]
    names = [f"c{i}" for i in range(34)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    wide = {(r.a, r.b): r["corr"] for r in statistics.correlation_pairs(df, names).collect()}
    assert len(wide) == 34 * 33 // 2
    for a, b in (("c0", "c1"), ("c5", "c33")):
        assert wide[a, b] == pytest.approx(df.select(F.corr(a, b)).first()[0])
    assert statistics.correlation_pairs(df, ["c0"]).count() == 0


def test_labels_of_other_than_two_classes_are_refused(spark):
    def labelled(*values):
        return spark.createDataFrame([(v,) for v in values], "y string")

    for values in (("F", "O", "P"), ("F", "F"), (None, None)):
        with pytest.raises(ValueError, match="two classes"):
            features.binarize_label(labelled(*values), "y")
    got = features.binarize_label(labelled("b", "a", None), "y", out="z").collect()
    assert {(r.y, r.z) for r in got} == {("b", 1.0), ("a", 0.0), (None, None)}


def test_a_forest_refuses_gaps(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else float(i)) for i in range(300)], "k long, x double")
    with pytest.raises(ValueError, match="gaps"):
        outliers.isolation_forest(df, ["x"], "k", seed=1)


def test_later_passes_do_not_score_a_table_again(spark, folder):
    from checks.flows import clinical_orders, statistical_config

    flow = prepare_statistical(clinical_orders(spark, folder), statistical_config("forest"))
    for df in (flow.table, flow.feature_histogram):
        assert "EvalPython" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [30, 2000, 10241, 30000])
def test_trees_get_their_samples_at_any_size(spark, n):
    forest = outliers.IsolationForest(["x"], "k", trees=20, sample=64)
    df = spark.range(n).select(F.col("id").alias("k"), F.rand(3).alias("x"))
    per_tree = [r["count"] for r in forest.sampled(df).groupBy("tree").count().collect()]
    assert len(per_tree) == 20 and min(per_tree) >= 0.85 * min(64, n)


def first_match(key, bands, half_open):
    for lo, hi, rate in bands:
        if lo <= key and (key < hi + 1 if half_open else key <= hi):
            return rate
    return None


@pytest.mark.parametrize("half_open", [False, True])
def test_joined_bands_equal_a_scan(spark, half_open):
    rng = random.Random(7)
    bands = [(lo, lo + rng.choice([0, 0.25, 1, 3, 17, 300]), float(i))
             for i, lo in enumerate(rng.choice([rng.randrange(-50, 90), rng.random() * 80]) for _ in range(300))]
    bands += [(-math.inf, -40.0, -1.0), (85.0, math.inf, -2.0), (5.0, 4.0, -3.0), bands[0]]
    keys = [rng.choice([float(rng.randrange(-60, 100)), rng.random() * 100]) for _ in range(200)] + [math.inf, -math.inf, float(bands[3][0])]
    table = spark.createDataFrame([(i, float(a), float(b), r) for i, (a, b, r) in enumerate(bands)], "idx int, lo double, hi double, rate double")
    got = enrich.first_bands(spark.createDataFrame([(k,) for k in [*keys, None, float("nan")]], "key double"), table, half_open)
    found = {r.key: r.rate for r in got.collect()}
    assert found == {k: first_match(k, bands, half_open) for k in keys if first_match(k, bands, half_open) is not None}


def test_more_bands_than_the_driver_holds(spark):
    bands = spark.range(200_000).select(
        F.col("id").cast("int").alias("idx"), (F.col("id") * 2).cast("double").alias("lo"),
        (F.col("id") * 2 + 1).cast("double").alias("hi"), (F.col("id") % 100).cast("double").alias("rate"))
    people = spark.createDataFrame([(1, 10.0, 0, None), (2, 399_999.0, 1, None), (3, 1e9, 0, None), (4, None, 0, None), (5, 4.0, 1, 0.5)],
                                   "id int, age double, sex int, smoke double")
    out = enrich.impute_by_band(people, "smoke", "age", bands)
    assert out.columns == people.columns
    assert [r.smoke for r in out.orderBy("id").collect()] == [0.05, 0.99, None, None, 0.5]
    out = enrich.impute_by_band_and_group(people, "smoke", "age", bands, "sex", {0: 1.0, 1: 2.0})
    assert out.columns == people.columns
    assert [r.smoke for r in out.orderBy("id").collect()] == [0.05, 1.98, None, None, 0.5]


def test_text_that_is_no_number_is_an_error(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("x", T.DoubleType())])
    df = spark.createDataFrame([("1.5",), ("one",)], "x string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bind_schema(df, schema).collect()
    assert [r.x for r in bind_schema(df, schema, strict=False).collect()] == [1.5, None]


def test_every_row_of_a_rate_page_counts(spark):
    def row(lo, hi, rate):
        return f'<tr class="even"><th>{lo}–{hi}</th><td>{rate}</td></tr>'

    ages = "<table>" + "".join(row(10 + 5 * i, 14 + 5 * i, i + 1) for i in range(12)) + "</table>"
    groups = '<div class="row"></div>' * 7 + '<div class="row"><ul><li>men (2%)<li>women (4%)' + "".join(
        f"<li>{20 + 10 * i}–{29 + 10 * i} ({i}%)" for i in range(6)) + "</ul></div>"
    pages = spark.createDataFrame([(1, "a", ages), (2, "g", groups), (3, "y", "")], "page_id int, url string, html string")
    rates = rates_from_pages(pages, PageSources("a", "g", "y"))
    assert len(rates.first) == 12 and len(rates.second) == 6 and rates.groups == {1: 2.0, 0: 4.0}
    rates = rates_from_pages(pages, PageSources("a", "g", "y", age_rows=7, group_rows=4))
    assert len(rates.first) == 7 and len(rates.second) == 4


@pytest.mark.parametrize("scope", ["train", "each"])
def test_the_model_kept_is_the_model_scored(spark, folder, scope):
    people = spark.read.parquet(f"{folder}/customer.parquet").select(
        "c_custkey", F.col("c_acctbal").alias("balance"), F.col("c_nationkey").cast("double").alias("nation"),
        F.when(F.col("c_acctbal") + F.col("c_nationkey") * 60 > 5000, "yes").otherwise("no").alias("target"))
    chosen = select_model(people, [Candidate("lr", logistic("target", max_iter=20), {"regParam": [0.01]})], label="target",
                          key="c_custkey", folds=2, train=0.5, scale_scope=scope)
    row = chosen.leaderboard.first()
    scored = score(chosen.models["lr"], chosen.tests["lr"])
    assert row.rocauc == auc_exact(scored, "decision", "target").first().auc
    assert row.accuracy == scored.select(F.avg((F.col("prediction") == F.col("target")).cast("double"))).first()[0]


def test_queries_run_from_another_folder(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {root!r})
import __spark_entry__ as e
from tablewright.session import local_session
spark = local_session(2, **{{"spark.sql.shuffle.partitions": "2", "spark.driver.memory": "2g"}})
print("rows", e.queries()["isolation_forest"](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "rows " in done.stdout, done.stderr[-2000:]
