"""How often flows go over their tables."""

from pyspark.sql import functions as F

from checks.flows import clinical_orders, statistical_config
from tablewright.operators.models import logistic
from tablewright.plans import Candidate, PageSources, prepare_statistical, select_model
from tablewright.plans.enrichment import rates_from_pages
from tests.test_enrichment import stored_pages


def jobs(spark, name, work):
    """Spark jobs that ``work`` starts, one per action and broadcast."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.sparkContext.setJobGroup(name, name)
    try:
        out = work()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.sparkContext.setJobGroup("", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name)), out


def test_the_statistical_flow_starts_few_jobs(spark, folder):
    orders = clinical_orders(spark, folder)
    n, flow = jobs(spark, "iqr", lambda: prepare_statistical(orders, statistical_config("iqr")))
    assert n <= 8
    assert flow.table.count() > 1000
    n, _ = jobs(spark, "none", lambda: prepare_statistical(orders, statistical_config("none")))
    assert n <= 7


def test_three_candidates_scan_their_table_once(spark, tmp_path):
    rows = spark.range(0, 400, 1, 2).selectExpr("id", "double(id % 50) AS a", "double(id % 7) AS b", "double(id % 50 > 20) AS y")
    rows.write.parquet(str(tmp_path / "t"))
    spark.sparkContext.setLocalProperty("x", "y")
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(value):
        read.add(1)
        return value

    df = spark.read.parquet(str(tmp_path / "t")).withColumn("a", counted.asNondeterministic()("a"))
    candidates = [Candidate("first", logistic("y", max_iter=5), {"regParam": [0.1, 1.0]}), Candidate("second", logistic("y", max_iter=5)),
                  Candidate("third", logistic("y", max_iter=5), drop=["a"])]
    chosen = select_model(df, candidates, label="y", key="id", folds=2)
    assert read.value == 400
    assert {r.model for r in chosen.leaderboard.collect()} == {"first", "second", "third"} and chosen.best in ("first", "second")
    assert chosen.models["first"].transform(chosen.tests["first"]).count() == chosen.tests["first"].count() > 0


def test_three_rate_pages_are_one_scan(spark, tmp_path):
    stored_pages(spark).write.parquet(str(tmp_path / "pages"))
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(url):
        read.add(1)
        return url

    pages = spark.read.parquet(str(tmp_path / "pages")).withColumn("url", counted.asNondeterministic()("url"))
    assert len(rates_from_pages(pages, PageSources("a", "b", "c")).first) == 3
    assert read.value == 3
