"""Filling gaps, repairing values and dropping outliers."""

from pyspark.sql import functions as F

from checks import query
from checks.inputs import (
    FLAG_ORDERS,
    GAP_CUSTOMER,
    GAP_LINEITEM,
    flag_orders,
    gap_customer,
    gap_lineitem,
    table,
)
from tablewright.operators import impute as I
from tablewright.operators import outliers as O


def rounded(df, *cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def mode_sql(source: str, col: str) -> str:
    return (f"(SELECT {col} FROM {source} WHERE {col} IS NOT NULL GROUP BY {col} "
            f"ORDER BY count(*) DESC, {col} LIMIT 1)")


@query(f"""WITH {GAP_LINEITEM}
SELECT l_orderkey, l_linenumber, coalesce(l_quantity, {mode_sql("li", "l_quantity")}) AS l_quantity,
       coalesce(l_linestatus, {mode_sql("li", "l_linestatus")}) AS l_linestatus FROM li""")
def impute_mode(spark, folder):
    items = gap_lineitem(spark, folder).select("l_orderkey", "l_linenumber", "l_quantity", "l_linestatus")
    return I.impute_mode(items, ["l_quantity", "l_linestatus"])


@query(f"""WITH {GAP_LINEITEM}
SELECT l_orderkey, l_linenumber, round(coalesce(l_quantity, (SELECT avg(l_quantity) FROM li)), 6) AS l_quantity,
       round(coalesce(l_tax, (SELECT avg(l_tax) FROM li)), 9) AS l_tax FROM li""")
def impute_mean(spark, folder):
    items = gap_lineitem(spark, folder).select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    return rounded(rounded(I.impute_mean(items, ["l_quantity", "l_tax"]), "l_quantity"), "l_tax", digits=9)


@query(f"""WITH {GAP_LINEITEM}
SELECT l_orderkey, l_linenumber,
       coalesce(l_extendedprice, (SELECT round(median(l_extendedprice), 4) FROM li)) AS l_extendedprice FROM li""")
def impute_median(spark, folder):
    items = gap_lineitem(spark, folder).select("l_orderkey", "l_linenumber", "l_extendedprice")
    return rounded(I.impute_median(items, ["l_extendedprice"]), "l_extendedprice", digits=4)


@query(f"""WITH {GAP_LINEITEM}
SELECT coalesce(l_quantity, (SELECT median(l_quantity) FROM li)) AS l_quantity,
       round(coalesce(l_extendedprice, (SELECT median(l_extendedprice) FROM li)), 4) AS l_extendedprice,
       coalesce(l_tax, {mode_sql("li", "l_tax")}) AS l_tax,
       coalesce(l_linestatus, {mode_sql("li", "l_linestatus")}) AS l_linestatus FROM li""")
def impute_groups(spark, folder):
    out = I.impute_groups(gap_lineitem(spark, folder), ["l_quantity", "l_extendedprice"],
                          ["l_tax", "l_linestatus"])
    return rounded(out, "l_extendedprice", digits=4)


@query(f"""WITH {GAP_CUSTOMER}
SELECT c_custkey, round(coalesce(c_acctbal, (SELECT avg(c_acctbal) FROM cu)), 6) AS c_acctbal FROM cu""")
def fit_imputer(spark, folder):
    customer = gap_customer(spark, folder).select("c_custkey", "c_acctbal")
    return rounded(I.fit_imputer(["c_acctbal"]).fit(customer).transform(customer), "c_acctbal")


@query(f"""WITH {GAP_CUSTOMER}
SELECT c_custkey, round(CASE WHEN c_acctbal IS NULL OR c_acctbal < 0
  THEN (SELECT avg(c_acctbal) FROM cu WHERE c_acctbal >= 0) ELSE c_acctbal END, 6) AS c_acctbal FROM cu""")
def repair_range_valid(spark, folder):
    customer = gap_customer(spark, folder).select("c_custkey", "c_acctbal")
    return rounded(I.repair_range(customer, "c_acctbal", lo=0, fill_missing=True), "c_acctbal")


@query("""SELECT p_partkey, round(CASE WHEN p_size < 10 OR p_size > 40
  THEN (SELECT avg(p_size) FROM part) ELSE p_size END, 6) AS p_size FROM part""")
def repair_range_observed(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"))
    return rounded(I.repair_range(part, "p_size", 10, 40, "observed"), "p_size")


@query(f"""WITH {FLAG_ORDERS}
SELECT o_orderkey, CASE WHEN flag IS NULL OR flag > 1 THEN {mode_sql("od", "flag")} ELSE flag END AS flag FROM od""")
def repair_domain_mode(spark, folder):
    return I.repair_domain_mode(flag_orders(spark, folder).select("o_orderkey", "flag"), ["flag"])


@query(f"""WITH {FLAG_ORDERS}
SELECT o_orderkey, flag, o_orderpriority FROM od
WHERE flag IS DISTINCT FROM 22 AND o_orderpriority NOT IN ('1-URGENT', '5-LOW')""")
def drop_values(spark, folder):
    orders = flag_orders(spark, folder).select("o_orderkey", "flag", "o_orderpriority")
    return O.drop_values(orders, {"flag": [22.0], "o_orderpriority": ["1-URGENT", "5-LOW"]})


@query("""WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, value FROM events, q WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""")
def iqr_filter(spark, folder):
    return O.iqr_filter(table(spark, folder, "events").select("event_id", "value"), ["value"])


@query("""SELECT event_id, true AS as_wanted FROM events WHERE event_id % 997 = 0
UNION ALL SELECT -1, true""")
def isolation_forest(spark, folder):
    """Rows planted far away are all flagged, and the share of flagged rows (as row -1) is the one asked for."""
    planted = F.col("event_id") % 997 == 0
    events = table(spark, folder, "events").select(
        "event_id", F.when(planted, 1e6).otherwise(F.col("value")).alias("value"),
        F.when(planted, -1e6).otherwise(F.col("user_id")).alias("user_id"))
    flagged = O.isolation_forest(events, ["value", "user_id"], "event_id", seed=42)
    share = flagged.agg(F.avg(F.col("is_outlier").cast("double")).alias("share"))
    return (flagged.filter(planted).select("event_id", F.col("is_outlier").alias("as_wanted"))
            .unionByName(share.select(F.lit(-1).cast("long").alias("event_id"), (F.abs(F.col("share") - 0.05) < 0.001).alias("as_wanted"))))


@query("SELECT o_orderkey, true AS above_all_others FROM orders WHERE o_orderkey % 4999 = 0")
def isolation_forest_outliers(spark, folder):
    """The few planted rows score above every other row."""
    planted = F.col("o_orderkey") % 4999 == 0
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.when(planted, -1e6).otherwise(F.col("o_custkey")).alias("o_custkey"),
        F.when(planted, 1e9).otherwise(F.col("o_totalprice")).alias("o_totalprice"))
    scored = O.isolation_forest(orders, ["o_totalprice", "o_custkey"], "o_orderkey", seed=7)
    best = scored.filter(~planted).agg(F.max("anomaly_score")).scalar()
    return scored.filter(planted).select("o_orderkey", (F.col("anomaly_score") > best).alias("above_all_others"))
