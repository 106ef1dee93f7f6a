"""The composed flows on driver tables."""

from pyspark.sql import functions as F

from checks import query
from checks.imputation import mode_sql
from checks.inputs import AGED_PART, aged_part, table
from checks.modelling import TEST_ROWS, labelled
from checks.profiles import histogram_sql
from tablewright.operators.models import linear_svm, logistic
from tablewright.plans import (
    Candidate,
    PageSources,
    RulesConfig,
    StatisticalConfig,
    enrich_from_pages,
    prepare_rules,
    prepare_statistical,
    select_model,
)
from tablewright.plans.enrichment import rates_from_pages

# ---------------------------------------------------------------- statistical flow


def clinical_orders(spark, folder):
    """Orders in the role of the clinical table: two numbers with gaps, a sparse one, bad codes."""
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(key % 13 != 0, F.col("o_totalprice")).alias("price"),
        F.when(key % 17 == 0, F.lit(float("nan"))).otherwise((F.col("o_custkey") % 98).cast("double")).alias("cust"),
        F.when(key % 5 != 0, F.lit(1.0)).alias("sparse"),
        F.when(key % 50 == 0, 22.0).when(key % 9 != 0, (F.col("o_orderstatus") == "F").cast("double")).alias("prop"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("priority"),
        (F.col("o_totalprice") > 250000).cast("double").alias("target"))


CLINICAL_ORDERS = """raw AS (SELECT o_orderkey,
  CASE WHEN o_orderkey % 13 <> 0 THEN o_totalprice END AS price,
  CASE WHEN o_orderkey % 17 <> 0 THEN (o_custkey % 98)::DOUBLE END AS cust,
  CASE WHEN o_orderkey % 50 = 0 THEN 22.0::DOUBLE WHEN o_orderkey % 9 <> 0 THEN (o_orderstatus = 'F')::INT::DOUBLE END AS prop,
  substr(o_orderpriority, 1, 1)::DOUBLE AS priority, (o_totalprice > 250000)::INT::DOUBLE AS target FROM orders)"""


def statistical_config(outliers: str) -> StatisticalConfig:
    return StatisticalConfig(
        numeric=["price", "cust", "sparse"], categorical=["prop", "priority", "target"], label="target",
        key=["o_orderkey"], rules={"prop": [22.0], "cust": [1.0, 26.0, 16.0]}, outliers=outliers,
        rescale=["cust"])


STATISTICAL = f"""WITH {CLINICAL_ORDERS},
filled AS (SELECT o_orderkey, coalesce(price, (SELECT median(price) FROM raw)) AS price,
  coalesce(cust, (SELECT median(cust) FROM raw)) AS cust, coalesce(prop, {mode_sql("raw", "prop")}) AS prop,
  priority, target FROM raw),
ruled AS (SELECT * FROM filled WHERE prop <> 22 AND cust NOT IN (1, 26, 16)),
z AS (SELECT o_orderkey, (price - avg(price) OVER ()) / stddev_pop(price) OVER () AS price,
  (cust - avg(cust) OVER ()) / stddev_pop(cust) OVER () AS cust, prop, priority, target FROM ruled),
fence AS (SELECT quantile_cont(price, 0.25) AS p1, quantile_cont(price, 0.75) AS p3,
  quantile_cont(cust, 0.25) AS c1, quantile_cont(cust, 0.75) AS c3 FROM z),
kept AS (SELECT z.* FROM z, fence WHERE price BETWEEN p1 - 1.5 * (p3 - p1) AND p3 + 1.5 * (p3 - p1)
  AND cust BETWEEN c1 - 1.5 * (c3 - c1) AND c3 + 1.5 * (c3 - c1)),
again AS (SELECT o_orderkey, (price - avg(price) OVER ()) / stddev_pop(price) OVER () AS price,
  (cust - avg(cust) OVER ()) / stddev_pop(cust) OVER () AS cust, target, prop, priority FROM kept)"""


@query(STATISTICAL + """
SELECT o_orderkey, round(price, 6) AS price, round(cust, 6) AS cust, target,
  (prop = 0)::INT AS prop_0, (prop = 1)::INT AS prop_1, (priority = 1)::INT AS priority_1, (priority = 2)::INT AS priority_2,
  (priority = 3)::INT AS priority_3, (priority = 4)::INT AS priority_4, (priority = 5)::INT AS priority_5 FROM again""")
def prepare_statistical_flow(spark, folder):
    out = prepare_statistical(clinical_orders(spark, folder), statistical_config("iqr")).table
    return out.withColumns({c: F.round(c, 6) for c in ("price", "cust")})


@query(f"""WITH {CLINICAL_ORDERS}, g AS (SELECT CASE WHEN o_orderkey % 1999 = 0 THEN -1e6::DOUBLE ELSE cust END AS cust, prop FROM raw),
f AS (SELECT coalesce(cust, (SELECT median(cust) FROM g)) AS cust,
  coalesce(prop, {mode_sql("raw", "prop")}) AS prop FROM g)
SELECT count(*) AS before, 0 AS planted_left, true AS share_kept FROM f WHERE prop <> 22 AND cust NOT IN (1, 26, 16)""")
def prepare_statistical_forest(spark, folder):
    """Rows planted far away go, and 95 % of the rows that pass the rules stay."""
    planted = F.col("o_orderkey") % 1999 == 0
    orders = clinical_orders(spark, folder).withColumns({
        "price": F.when(planted, 1e9).otherwise(F.col("price")), "cust": F.when(planted, -1e6).otherwise(F.col("cust"))})
    kept = prepare_statistical(orders, statistical_config("forest")).table
    before = prepare_statistical(orders, statistical_config("none")).table.count()
    return kept.agg(F.lit(before).cast("long").alias("before"), F.count_if(planted).cast("int").alias("planted_left"),
                    (F.abs(F.count(F.lit(1)) / before - 0.95) < 0.005).alias("share_kept"))


@query(f"""{STATISTICAL[:STATISTICAL.index("fence AS")].rstrip().rstrip(",")},
again AS (SELECT (price - avg(price) OVER ()) / stddev_pop(price) OVER () AS price,
  (cust - avg(cust) OVER ()) / stddev_pop(cust) OVER () AS cust, target, (prop = 0)::INT AS prop_0, (prop = 1)::INT AS prop_1,
  {", ".join(f"(priority = {i})::INT AS priority_{i}" for i in range(1, 6))} FROM z)
SELECT "column", bin, round(lo, 6) AS lo, round(hi, 6) AS hi, n, 'cleaned' AS stage
FROM ({histogram_sql("z", ["price", "cust", "prop", "priority", "target"])})
UNION ALL SELECT "column", bin, round(lo, 6), round(hi, 6), n, 'features'
FROM ({histogram_sql("again", ["price", "cust", "target", "prop_0", "prop_1", *[f"priority_{i}" for i in range(1, 6)]])})""")
def prepare_statistical_histograms(spark, folder):
    flow = prepare_statistical(clinical_orders(spark, folder), statistical_config("none"))
    both = (flow.cleaned_histogram.withColumn("stage", F.lit("cleaned"))
            .unionByName(flow.feature_histogram.withColumn("stage", F.lit("features"))))
    return both.withColumns({c: F.round(c, 6) for c in ("lo", "hi")})


# ---------------------------------------------------------------- rules flow


def clinical_lineitem(spark, folder):
    """Lineitem in the role of the clinical table, with NaN gaps and bad codes."""
    nan = F.lit(float("nan"))
    line, key = F.col("l_linenumber"), F.col("l_orderkey")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.when(line == 3, nan).otherwise(F.col("l_quantity")).alias("pressure"),
        F.when(key % 10 == 0, nan).otherwise(F.col("l_tax") * 100).alias("peak"),
        F.when(line == 2, nan).otherwise(F.col("l_extendedprice")).alias("rate"),
        F.when(key % 7 == 0, nan).when(key % 50 == 1, 22.0)
         .otherwise((F.col("l_returnflag") == "A").cast("double")).alias("prop"),
        F.when(key % 9 == 0, nan).otherwise(F.col("l_discount")).alias("slope"))


@query(f"""WITH raw AS (SELECT l_orderkey, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS pressure,
  CASE WHEN l_orderkey % 10 <> 0 THEN l_tax * 100 END AS peak, CASE WHEN l_linenumber <> 2 THEN l_extendedprice END AS rate,
  CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 50 = 1 THEN 22.0::DOUBLE ELSE (l_returnflag = 'A')::INT::DOUBLE END AS prop,
  CASE WHEN l_orderkey % 9 <> 0 THEN l_discount END AS slope FROM lineitem),
fixed AS (SELECT l_orderkey,
  CASE WHEN pressure IS NULL OR pressure < 10 THEN (SELECT avg(pressure) FROM raw WHERE pressure >= 10) ELSE pressure END AS pressure,
  CASE WHEN peak BETWEEN 0 AND 4 THEN peak ELSE (SELECT avg(peak) FROM raw WHERE peak BETWEEN 0 AND 4) END AS peak,
  coalesce(rate, (SELECT avg(rate) FROM raw)) AS rate,
  CASE WHEN prop IS NULL OR prop > 1 THEN {mode_sql("raw", "prop")} ELSE prop END AS prop,
  coalesce(slope, {mode_sql("raw", "slope")}) AS slope FROM raw)
SELECT l_orderkey, round(pressure, 6) AS pressure, round(peak, 6) AS peak, round(rate, 4) AS rate, prop, slope,
  round(pressure * rate, 2) AS "pressurexrate" FROM fixed""")
def prepare_rules_flow(spark, folder):
    cfg = RulesConfig(columns=["l_orderkey", "pressure", "peak", "rate", "prop", "slope"], modes=["slope"],
                      ranges={"pressure": (10, None), "peak": (0, 4)}, means=["rate"], domain=["prop"],
                      product=("pressure", "rate"))
    out = prepare_rules(clinical_lineitem(spark, folder), cfg)
    return out.withColumns({"pressure": F.round("pressure", 6), "peak": F.round("peak", 6),
                            "rate": F.round("rate", 4), "pressurexrate": F.round("pressurexrate", 2)})


# ---------------------------------------------------------------- enrichment flow

AGES = [(18, 24), (25, 34), (35, 44), (45, 54), (55, 64), (65, 74), (75, 200)]
SECOND = [(18, 24), (25, 44), (45, 66), (65, 200)]
DASH = "–"


def rate_pages(spark, folder):
    """Three pages whose rates are sums over the part table, as a statistics office would print them."""
    part = table(spark, folder, "part")

    def tenths(modulus: int, rest: int):
        return F.sum(F.when(F.col("p_partkey") % modulus == rest, F.col("p_size"))) % 900

    def shown(name: str):
        return F.concat(F.floor(F.col(name) / 10), F.lit("."), F.col(name) % 10)

    sums = part.agg(*[tenths(7, i).alias(f"a{i}") for i in range(7)], *[tenths(4, i).alias(f"b{i}") for i in range(4)],
                    *[tenths(2, i).alias(f"g{i}") for i in range(2)], *[tenths(5, i).alias(f"y{i}") for i in range(5)])
    band = [f"{lo}{DASH}{hi}" if hi < 200 else f"{lo}+" for lo, hi in AGES]
    first = F.concat(F.lit("<table>"), *[x for i in range(7) for x in (
        F.lit(f'<tr class="even"><th>{band[i]} years</th><td>'), shown(f"a{i}"), F.lit('</td><td>0</td></tr>'))],
        F.lit("</table>"))
    band = [f"{lo}&ndash;{hi}" if hi < 200 else f"{lo}+" for lo, hi in SECOND]
    items = [x for i, who in ((1, "men"), (0, "women")) for x in (
        F.lit(f"<li>Of {who} ("), shown(f"g{i}"), F.lit("%)</li>"))]
    items += [x for i in range(4) for x in (
        F.lit(f"<li>Aged <b>{band[i]}</b> years ("), shown(f"b{i}"), F.lit("%)</li>"))]
    second = F.concat(F.lit('<div class="row"><div>skip</div></div>' * 7 + '<div class="col row"><ul>'), *items,
                      F.lit("</ul></div>"))
    points = [x for i in range(5) for x in (
        F.lit('<span class="ds-data-point ds-2017"><span class="dp-data-estimate">'), shown(f"y{i}"),
        F.lit('</span><span class="ci">1</span></span>'))]
    third = F.concat(F.lit('<div class="ds-data-table-container">'), *points, F.lit("</div>"))
    pages = F.array(*[F.struct(F.lit(i).alias("page_id"), F.lit(url).alias("url"), html.alias("html"))
                      for i, (url, html) in enumerate((("ages", first), ("groups", second), ("youth", third)))])
    return sums.select(F.inline(pages))


def tenth_sql(modulus: int, rest: int) -> str:
    return f"(SELECT sum(p_size) % 900 FROM part WHERE p_partkey % {modulus} = {rest}) / 10.0::DOUBLE"


def band_case(rows, rates, factor: str) -> str:
    whens = " ".join(f"WHEN age BETWEEN {lo} AND {hi} THEN {rate} * {factor} / 100" for (lo, hi), rate in zip(rows, rates))
    return f"CASE {whens} END"


_YOUTH = "(" + " + ".join(tenth_sql(5, i) for i in range(1, 5)) + ") / 4"
_SECOND = ([(14, 17), *SECOND], [_YOUTH, *[tenth_sql(4, i) for i in range(4)]])


@query(f"""WITH {AGED_PART}, r AS (SELECT {tenth_sql(2, 0)} / ({tenth_sql(2, 1)}) AS ratio)
SELECT p_partkey, age, sex, smoke,
  round(coalesce(smoke, {band_case(AGES, [tenth_sql(7, i) for i in range(7)], "1")}), 9) AS smoke_source1,
  round(coalesce(smoke, CASE WHEN sex = 0 THEN {band_case(*_SECOND, "1")} WHEN sex = 1 THEN {band_case(*_SECOND, "ratio")} END), 9)
    AS smoke_source2 FROM pa, r""")
def enrich_from_pages_flow(spark, folder):
    src = PageSources("ages", "groups", "youth")
    out = enrich_from_pages(aged_part(spark, folder), rate_pages(spark, folder), src)
    return out.withColumns({c: F.round(c, 9) for c in ("smoke_source1", "smoke_source2")})


@query(f"""SELECT key, CASE key WHEN 1 THEN {tenth_sql(2, 1)} ELSE {tenth_sql(2, 0)} END AS rate FROM (VALUES (0), (1)) v(key)""")
def rates_of_a_page_stored_twice(spark, folder):
    """An older copy of a page, with other rates, does not count."""
    pages = rate_pages(spark, folder)
    older = pages.withColumns({"page_id": F.col("page_id") - 10, "html": F.regexp_replace("html", r"\([0-9.]+%", "(99%")})
    rates = rates_from_pages(older.unionByName(pages), PageSources("ages", "groups", "youth")).groups
    return spark.createDataFrame(sorted(rates.items()), "key int, rate double")


# ---------------------------------------------------------------- selection flow


@query(f"""WITH {TEST_ROWS} SELECT v.model, v.found, v.found AS accurate, v.is_best, n FROM
  (VALUES ('logistic', true, true), ('svm', true, false), ('noise', false, false)) v(model, found, is_best),
  (SELECT count(*) AS n FROM te)""")
def select_model_flow(spark, folder):
    """Two candidates that can see the signal and one that cannot; the first perfect one wins."""
    people = labelled(spark, folder)
    candidates = [
        Candidate("logistic", logistic("target", max_iter=100), {"regParam": [0.01, 0.1]}),
        Candidate("svm", linear_svm("target"), {"regParam": [0.01, 0.1], "maxIter": [10, 100]}),
        Candidate("noise", logistic("target", max_iter=100), {"regParam": [0.01, 0.1]}, drop=["balance"]),
    ]
    chosen = select_model(people, candidates, label="target", key="c_custkey", folds=5)
    n = chosen.tests["logistic"].agg(F.count(F.lit(1))).scalar()
    return chosen.leaderboard.select("model", (F.col("rocauc") > 0.95).alias("found"), (F.col("accuracy") > 0.85).alias("accurate"),
                                     "is_best", n.alias("n"))
