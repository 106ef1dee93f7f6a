"""Projections, predicates, filters and missing markers."""

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
from tablewright.functions import in_range, is_missing
from tablewright.operators import columns as C
from tablewright.operators import missing as M


@query("SELECT l_orderkey, l_quantity, l_discount FROM lineitem")
def keep_columns(spark, folder):
    return C.keep_columns(table(spark, folder, "lineitem"), ["l_orderkey", "l_quantity", "l_discount"])


@query("SELECT event_id, user_id, event_type, value FROM events")
def drop_columns(spark, folder):
    return C.drop_columns(table(spark, folder, "events"), ["ts", "props"])


@query("""SELECT p_partkey, p_size::DOUBLE AS p_size,
                 TRY_CAST(split_part(p_brand, '#', 2) AS DOUBLE) AS p_brand FROM part""")
def cast_columns(spark, folder):
    part = table(spark, folder, "part").select(
        "p_partkey", "p_size", F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("p_brand"))
    return C.cast_columns(part, ["p_size", "p_brand"], lenient=True)


@query("""SELECT l_orderkey, l_quantity, l_extendedprice,
                 l_quantity * l_extendedprice AS l_quantityxl_extendedprice FROM lineitem""")
def interaction(spark, folder):
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    return C.interaction(items, "l_quantity", "l_extendedprice")


@query(f"""WITH {GAP_CUSTOMER}
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0::DOUBLE ELSE c_acctbal END AS c_acctbal FROM cu""")
def replace_when(spark, folder):
    customer = gap_customer(spark, folder).select("c_custkey", "c_acctbal")
    return C.replace_when(customer, "c_acctbal", F.col("c_acctbal") < 0, 0.0)


@query(f"WITH {FLAG_ORDERS} SELECT o_orderkey, flag FROM od WHERE flag IS DISTINCT FROM 22")
def filter_ne(spark, folder):
    return C.filter_ne(flag_orders(spark, folder).select("o_orderkey", "flag"), "flag", 22.0)


@query(f"WITH {FLAG_ORDERS} SELECT o_orderkey, flag FROM od WHERE flag = 1")
def filter_eq(spark, folder):
    return C.filter_eq(flag_orders(spark, folder).select("o_orderkey", "flag"), "flag", 1.0)


@query(f"WITH {FLAG_ORDERS} SELECT o_orderkey, flag FROM od WHERE flag IS NULL OR flag NOT IN (0, 22)")
def filter_not_in(spark, folder):
    return C.filter_not_in(flag_orders(spark, folder).select("o_orderkey", "flag"), "flag", [0.0, 22.0])


@query("SELECT p_partkey, p_size, p_size BETWEEN 18 AND 24 AS young FROM part", name="in_range")
def in_range_(spark, folder):
    part = table(spark, folder, "part")
    return part.select("p_partkey", "p_size", in_range("p_size", 18, 24).alias("young"))


@query(f"WITH {GAP_LINEITEM} SELECT l_orderkey, l_linenumber, l_tax IS NULL AS gap FROM li",
       name="is_missing")
def is_missing_(spark, folder):
    return gap_lineitem(spark, folder).select("l_orderkey", "l_linenumber", is_missing("l_tax").alias("gap"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 11 > 1 THEN c_mktsegment END AS c_mktsegment
          FROM customer""")
def blank_to_null(spark, folder):
    rest = F.col("c_custkey") % 11
    text = F.when(rest == 0, "").when(rest == 1, "  ").otherwise(F.col("c_mktsegment"))
    customer = table(spark, folder, "customer").select("c_custkey", text.alias("c_mktsegment"))
    return M.blank_to_null(customer, ["c_mktsegment"])


@query(f"""WITH {GAP_LINEITEM}
SELECT l_orderkey, l_quantity, l_linestatus, l_tax FROM li
WHERE NOT (l_quantity IS NULL AND l_extendedprice IS NULL)""")
def drop_all_null(spark, folder):
    items = M.drop_all_null(gap_lineitem(spark, folder), ["l_quantity", "l_extendedprice"])
    return items.select("l_orderkey", "l_quantity", "l_linestatus", "l_tax")


@query("""SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN value END AS value,
                 CASE WHEN event_id % 5 <> 0 THEN event_type END AS event_type FROM events""")
def normalize_missing(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_id") % 13 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        F.when(F.col("event_id") % 5 == 0, " ").otherwise(F.col("event_type")).alias("event_type"))
    return M.normalize_missing(events)


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def split_xy(spark, folder):
    orders = table(spark, folder, "orders").drop("o_orderdate")
    features, _ = C.split_xy(orders, "o_orderstatus")
    return features


@query(f"""WITH {GAP_LINEITEM}, t AS (SELECT count(*) AS n FROM li)
SELECT c.column, c.n_missing, c.n_missing / t.n::DOUBLE AS fraction
FROM (SELECT 'l_quantity' AS "column", count(*) FILTER (l_quantity IS NULL) AS n_missing FROM li
      UNION ALL SELECT 'l_tax', count(*) FILTER (l_tax IS NULL) FROM li
      UNION ALL SELECT 'l_discount', count(*) FILTER (l_discount IS NULL) FROM li
      UNION ALL SELECT 'l_linestatus', count(*) FILTER (l_linestatus IS NULL) FROM li) c, t""")
def missing_profile(spark, folder):
    return M.missing_profile(gap_lineitem(spark, folder), ["l_quantity", "l_tax", "l_discount", "l_linestatus"])


@query(f"""WITH {GAP_LINEITEM}
SELECT l_orderkey, l_linenumber, l_returnflag, l_discount, l_linestatus FROM li""")
def drop_sparse(spark, folder):
    # Gaps are about one seventh per line number: above 12 %, unless protected.
    return M.drop_sparse(gap_lineitem(spark, folder), protect=["l_linestatus"])


@query(f"""WITH {FLAG_ORDERS}
SELECT count(*) AS n, count(*) FILTER (flag = 1) AS positive,
       count(*) FILTER (flag > 1) AS bad, count(*) FILTER (flag IS NULL) AS gap FROM od""")
def row_counts(spark, folder):
    flag = F.col("flag")
    return C.row_counts(flag_orders(spark, folder),
                        {"positive": flag == 1, "bad": flag > 1, "gap": flag.isNull()})
