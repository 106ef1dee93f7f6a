"""Driver tables with gaps and bad codes put in by rule, and the same rules as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def gap_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    gap = F.col("l_linenumber") == 3
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag",
        F.when(~gap, F.col("l_quantity")).alias("l_quantity"),
        F.when(~gap, F.col("l_extendedprice")).alias("l_extendedprice"),
        F.col("l_discount"),
        F.when(F.col("l_linenumber") > 2, F.col("l_tax")).alias("l_tax"),
        F.when(F.col("l_linenumber") != 5, F.col("l_linestatus")).alias("l_linestatus"),
    )


GAP_LINEITEM = """li AS (
  SELECT l_orderkey, l_linenumber, l_returnflag,
         CASE WHEN l_linenumber <> 3 THEN l_quantity END AS l_quantity,
         CASE WHEN l_linenumber <> 3 THEN l_extendedprice END AS l_extendedprice,
         l_discount,
         CASE WHEN l_linenumber > 2 THEN l_tax END AS l_tax,
         CASE WHEN l_linenumber <> 5 THEN l_linestatus END AS l_linestatus
  FROM lineitem)"""


def flag_orders(spark: SparkSession, folder: str) -> DataFrame:
    flag = (F.when(F.col("o_orderkey") % 50 == 0, 22.0)
            .when(F.col("o_orderkey") % 7 != 0, (F.col("o_orderstatus") == "F").cast("double")))
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", flag.alias("flag"))


FLAG_ORDERS = """od AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice,
         CASE WHEN o_orderkey % 50 = 0 THEN 22.0::DOUBLE
              WHEN o_orderkey % 7 <> 0 THEN (o_orderstatus = 'F')::INT::DOUBLE END AS flag
  FROM orders)"""


def gap_customer(spark: SparkSession, folder: str) -> DataFrame:
    kept = F.col("c_custkey") % 11 != 0
    return table(spark, folder, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment",
        F.when(kept, F.col("c_acctbal")).alias("c_acctbal"))


GAP_CUSTOMER = """cu AS (
  SELECT c_custkey, c_nationkey, c_mktsegment,
         CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal END AS c_acctbal
  FROM customer)"""


def aged_part(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as people: an age between 1.5 and 75, a sex, and a rate known for some."""
    return table(spark, folder, "part").select(
        "p_partkey",
        (F.col("p_size") * 1.5).alias("age"),
        (F.col("p_partkey") % 2).cast("double").alias("sex"),
        F.when(F.col("p_partkey") % 3 == 0, F.col("p_retailprice")).alias("smoke"))


AGED_PART = """pa AS (
  SELECT p_partkey, (p_size * 1.5)::DOUBLE AS age, (p_partkey % 2)::DOUBLE AS sex,
         CASE WHEN p_partkey % 3 = 0 THEN p_retailprice END AS smoke
  FROM part)"""
