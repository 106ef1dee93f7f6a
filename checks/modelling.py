"""Models on a planted signal, and measures over scored tables."""

from pyspark.sql import functions as F

from checks import query
from checks.features import HASHED
from checks.inputs import table
from tablewright.operators import evaluate as E
from tablewright.operators import models as M
from tablewright.operators.split import stratified_split
from tablewright.session import own, scratch_path
from tablewright.sources import load_model, save_model

FEATURES = ["balance", "nation"]


def labelled(spark, folder):
    """Customers with the label "balance above 4500", a signal the classifiers must find."""
    return table(spark, folder, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("balance"), F.col("c_nationkey").cast("double").alias("nation"),
        (F.col("c_acctbal") > 4500).cast("double").alias("target"))


def split(spark, folder):
    parts = stratified_split(labelled(spark, folder), "target", "c_custkey")
    return parts.filter("split = 'train'").drop("split"), parts.filter("split = 'test'").drop("split")


TEST_ROWS = f"""te AS (SELECT c_custkey, target FROM (
  SELECT c_custkey, target, {HASHED.replace("o_orderkey", "c_custkey")} / 4294967296.0::DOUBLE AS u,
         count(*) OVER (PARTITION BY target) AS n
  FROM (SELECT c_custkey, (c_acctbal > 4500)::INT::DOUBLE AS target FROM customer))
  WHERE u >= floor(0.9::DOUBLE * n) / n)"""


def fitted_logistic(train):
    return M.feature_pipeline(M.logistic("target", max_iter=100), FEATURES).fit(train)


# Away from the cut every prediction must be the label.
CLEAR = f"""WITH {TEST_ROWS} SELECT c_custkey, target, target AS prediction
FROM te JOIN customer USING (c_custkey) WHERE abs(c_acctbal - 4500) > 500"""


def clear_predictions(model, test):
    away = F.abs(F.col("balance") - 4500) > 500
    return M.score(model, test).filter(away).select("c_custkey", "target", "prediction")


@query(CLEAR)
def logistic(spark, folder):
    train, test = split(spark, folder)
    return clear_predictions(fitted_logistic(train), test)


@query(CLEAR)
def linear_svm(spark, folder):
    train, test = split(spark, folder)
    return clear_predictions(M.feature_pipeline(M.linear_svm("target", max_iter=100), FEATURES).fit(train), test)


@query(f"WITH {TEST_ROWS} SELECT c_custkey, true AS rescored_alike FROM te")
def save_and_load_model(spark, folder):
    train, test = split(spark, folder)
    model = fitted_logistic(train)
    path = own(spark, scratch_path(spark, "model"))
    save_model(model, path)
    before = M.score(model, test).select("c_custkey", F.col("decision").alias("before"))
    after = M.score(load_model(path), test).select("c_custkey", "decision")
    return after.join(before, "c_custkey").select(
        "c_custkey", (F.col("decision") == F.col("before")).alias("rescored_alike"))


@query(f"""WITH {TEST_ROWS} SELECT 'lr' AS model, count(*) FILTER (target = 1) AS n_pos,
           count(*) FILTER (target = 0) AS n_neg, true AS found FROM te""")
def cross_validate(spark, folder):
    train, test = split(spark, folder)
    search = M.cross_validate(M.logistic("target", max_iter=100), {"regParam": [0.01, 0.1]}, train,
                              features=FEATURES, key="c_custkey", folds=5)
    measured = E.auc_exact(M.score(search, test), "decision", "target")
    return measured.select(F.lit("lr").alias("model"), "n_pos", "n_neg", (F.col("auc") > 0.95).alias("found"))


def noisy(spark, folder):
    """Customers with a label that the balance explains in part."""
    return table(spark, folder, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("balance"), F.col("c_nationkey").cast("double").alias("nation"),
        (F.col("c_acctbal") + (F.col("c_custkey") * 7919) % 9000 + F.col("c_nationkey") * 60 > 9000).cast("double").alias("target"))


def newton_sql(cases: str, rows: str, rounds: int = 25) -> str:
    """Logistic regression by Newton steps in SQL: per case (id, reg) of ``rows`` (id, y, u, v) on standardized u and v.

    Solves for the weights (b0, b1, b2) at which the gradient of mean loss plus
    reg / 2 * (b1^2 + b2^2) vanishes.
    """
    det = "(h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02))"
    return f"""data AS MATERIALIZED ({rows}),
moments AS (SELECT id, avg(u) AS mu, stddev_samp(u) AS su, avg(v) AS mv, stddev_samp(v) AS sv, min(u) AS lu, max(u) - min(u) AS ru,
  min(v) AS lv, max(v) - min(v) AS rv FROM data GROUP BY id),
standard AS MATERIALIZED (SELECT id, reg, y, (u - mu) / su AS x1, (v - mv) / sv AS x2 FROM data JOIN moments USING (id) JOIN ({cases}) USING (id)),
newton AS (
  SELECT DISTINCT id, reg, 0 AS step, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2 FROM standard
  UNION ALL
  SELECT id, reg, step + 1,
    b0 - (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / {det},
    b1 - (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / {det},
    b2 - (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / {det}
  FROM (SELECT id, reg, step, b0, b1, b2, avg(p - y) AS g0, avg((p - y) * x1) + reg * b1 AS g1, avg((p - y) * x2) + reg * b2 AS g2,
          avg(p * (1 - p)) AS h00, avg(p * (1 - p) * x1) AS h01, avg(p * (1 - p) * x2) AS h02,
          avg(p * (1 - p) * x1 * x1) + reg AS h11, avg(p * (1 - p) * x1 * x2) AS h12, avg(p * (1 - p) * x2 * x2) + reg AS h22
        FROM (SELECT n.*, y, x1, x2, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p
              FROM newton n JOIN standard s ON s.id = n.id AND s.reg = n.reg WHERE step < {rounds})
        GROUP BY id, reg, step, b0, b1, b2)),
weights AS (SELECT * FROM newton WHERE step = {rounds})"""


NOISY = """(SELECT c_custkey, c_acctbal AS u, c_nationkey::DOUBLE AS v,
  (c_acctbal + (c_custkey * 7919) % 9000 + c_nationkey * 60 > 9000)::INT::DOUBLE AS y FROM customer)"""


@query(f"""WITH RECURSIVE {newton_sql("SELECT 1 AS id, 0.02::DOUBLE AS reg", f"SELECT 1 AS id, y, u, v FROM {NOISY}")}
SELECT 'balance' AS term, round(b1 / su * ru, 4) AS weight FROM weights JOIN moments USING (id)
UNION ALL SELECT 'nation', round(b2 / sv * rv, 4) FROM weights JOIN moments USING (id)
UNION ALL SELECT 'intercept', round(b0 - b1 * (mu - lu) / su - b2 * (mv - lv) / sv, 4) FROM weights JOIN moments USING (id)""")
def logistic_weights(spark, folder):
    """The weights of the regularised optimum, which the SQL finds by its own steps."""
    estimator = M.logistic("target", reg=0.02, max_iter=500).setTol(1e-12)
    classifier = M.feature_pipeline(estimator, FEATURES).fit(noisy(spark, folder)).stages[-1]
    found = [*zip(FEATURES, classifier.coefficients.toArray().tolist()), ("intercept", classifier.intercept)]
    return spark.createDataFrame(found, "term string, weight double").withColumn("weight", F.round("weight", 4))


FOLDS = "(('0x' || substr(md5('43|' || c_custkey), 1, 8))::BIGINT % 4)"


@query(f"""WITH RECURSIVE folded AS (SELECT *, {FOLDS} AS fold FROM {NOISY}),
{newton_sql("SELECT f AS id, r AS reg FROM range(4) AS a(f), (VALUES (0.01::DOUBLE), (1.0::DOUBLE), (30.0::DOUBLE)) AS b(r)",
            "SELECT f AS id, y, u, v FROM folded, range(4) AS a(f) WHERE fold <> f")},
ranked AS (SELECT id, reg, y, rank() OVER (PARTITION BY id, reg ORDER BY s) + (count(*) OVER (PARTITION BY id, reg, s) - 1) / 2.0::DOUBLE AS k
  FROM (SELECT w.id, w.reg, y, b0 + b1 * (u - mu) / su + b2 * (v - mv) / sv AS s FROM weights w JOIN moments USING (id) JOIN folded ON fold = id)),
areas AS (SELECT id, reg, (sum(k) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0::DOUBLE)
  / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)) AS area FROM ranked GROUP BY id, reg),
means AS (SELECT reg, avg(area) AS area FROM areas GROUP BY reg)
SELECT reg, round(area, 3) AS area, reg = (SELECT reg FROM means ORDER BY area DESC, reg LIMIT 1) AS chosen FROM means""")
def cross_validated_areas(spark, folder):
    """The mean area of each strength over the folds, and which strength the refitted model has."""
    regs = [0.01, 1.0, 30.0]
    search = M.cross_validate(M.logistic("target", max_iter=500).setTol(1e-12), {"regParam": regs}, noisy(spark, folder),
                              features=FEATURES, key="c_custkey", folds=4)
    chosen = M.classifier_of(search).getRegParam()
    found = [(reg, float(area), reg == chosen) for reg, area in zip(regs, search.avgMetrics)]
    return spark.createDataFrame(found, "reg double, area double, chosen boolean").withColumn("area", F.round("area", 3))


@query("SELECT * FROM (VALUES ('maxIter', true), ('regParam', true)) v(param, in_grid)")
def best_params(spark, folder):
    train, _ = split(spark, folder)
    grid = {"regParam": [0.01, 0.1], "maxIter": [10, 100]}
    search = M.cross_validate(M.linear_svm("target"), grid, train, features=FEATURES, key="c_custkey", folds=5)
    values = F.create_map(*[x for name, vs in grid.items() for x in (F.lit(name), F.array(*[F.lit(float(v)) for v in vs]))])
    found = M.best_params(search)
    return found.select("param", F.array_contains(values[F.col("param")], F.col("value").cast("double")).alias("in_grid"))


@query(f"WITH {TEST_ROWS} SELECT count(*) AS n, true AS near_exact FROM te")
def auc_binned(spark, folder):
    train, test = split(spark, folder)
    scored = fitted_logistic(train).transform(test)
    binned = E.auc_binned(scored, "target")
    exact = E.auc_exact(M.score(fitted_logistic(train), test), "decision", "target")
    near = (F.abs(F.col("auc") - binned) < 0.01).alias("near_exact")
    return exact.select((F.col("n_pos") + F.col("n_neg")).alias("n"), near)


@query("""WITH s AS (SELECT floor(o_totalprice / 1000) AS score, o_orderstatus = 'F' AS y FROM orders),
r AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS k FROM s),
t AS (SELECT count(*) FILTER (y) AS n_pos, count(*) FILTER (NOT y) AS n_neg, sum(k) FILTER (y) AS ranks FROM r)
SELECT n_pos, n_neg, round((ranks - n_pos * (n_pos + 1) / 2.0::DOUBLE) / (n_pos * n_neg), 12) AS auc FROM t""")
def auc_exact(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.floor(F.col("o_totalprice") / 1000).alias("score"), (F.col("o_orderstatus") == "F").cast("double").alias("y"))
    return E.auc_exact(orders, "score", "y").withColumn("auc", F.round("auc", 12))


@query("""SELECT round(avg(((o_totalprice > 250000) = (o_orderstatus = 'F'))::INT), 9) AS accuracy FROM orders""")
def accuracy(spark, folder):
    orders = table(spark, folder, "orders").select(
        (F.col("o_totalprice") > 250000).cast("double").alias("prediction"),
        (F.col("o_orderstatus") == "F").cast("double").alias("y"))
    return E.accuracy(orders, "prediction", "y").withColumn("accuracy", F.round("accuracy", 9))


@query("""WITH s AS (SELECT c_nationkey AS pos, 'nation ' || c_nationkey AS model,
  CASE WHEN c_nationkey % 7 <> 0 THEN round(avg(c_acctbal), 0) END AS rocauc FROM customer GROUP BY c_nationkey)
SELECT model, rocauc, pos = (SELECT pos FROM s WHERE rocauc IS NOT NULL ORDER BY rocauc DESC, pos LIMIT 1) AS is_best FROM s""")
def leaderboard(spark, folder):
    score = F.when(F.col("c_nationkey") % 7 != 0, F.round(F.avg("c_acctbal"), 0))
    scores = (table(spark, folder, "customer").groupBy("c_nationkey").agg(score.alias("rocauc"))
              .select(F.col("c_nationkey").alias("pos"),
                      F.concat(F.lit("nation "), F.col("c_nationkey")).alias("model"), "rocauc"))
    return E.leaderboard(scores)


@query(f"""WITH {TEST_ROWS} SELECT 'lr' AS model, count(*) FILTER (target = 1) AS n_pos,
           count(*) FILTER (target = 0) AS n_neg, true AS found, true AS accurate FROM te""")
def evaluate_best(spark, folder):
    train, test = split(spark, folder)
    path = own(spark, scratch_path(spark, "best"))
    save_model(fitted_logistic(train), path)
    noise = M.feature_pipeline(M.logistic("target", max_iter=5), ["nation"]).fit(train)
    models = {"noise": noise, "lr": path}
    scores = [(name, E.auc_exact(M.score(load_model(m) if isinstance(m, str) else m, train), "decision",
                                 "target").first()["auc"]) for name, m in models.items()]
    board = E.leaderboard(E.score_table(spark, scores))
    return (E.evaluate_best(models, board, test, "target")
            .select("model", "n_pos", "n_neg", (F.col("auc") > 0.95).alias("found"),
                    (F.col("accuracy") > 0.9).alias("accurate")))
