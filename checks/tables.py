"""Scans, sinks, schemas and views."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import query
from checks.inputs import table
from tablewright.session import own, scratch_path
from tablewright.sources import as_view, bind_schema, head_rows, read_table, require_columns, write_table

CUSTOMER = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()),
])
ORDERS = T.StructType([
    T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()),
])


@query("SELECT c_custkey, c_acctbal, c_mktsegment FROM customer")
def read_table_parquet(spark, folder):
    return read_table(spark, f"{folder}/customer.parquet", CUSTOMER)


@query("SELECT o_totalprice, o_orderkey, o_orderstatus FROM orders")
def write_and_read_csv(spark, folder):
    path = own(spark, scratch_path(spark, "orders.csv"))
    write_table(table(spark, folder, "orders"), path, fmt="csv")
    return read_table(spark, path, ORDERS, fmt="csv")


@query("SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem")
def write_and_read_parquet(spark, folder):
    path = own(spark, scratch_path(spark, "lineitem"))
    write_table(table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag"), path)
    return read_table(spark, path)


@query("""SELECT p_size::DOUBLE AS p_size, p_partkey::DOUBLE AS p_partkey,
                 TRY_CAST(replace(p_brand, 'Brand#1', '') AS DOUBLE) AS p_brand FROM part""",
       name="bind_schema")
def bind_schema_(spark, folder):
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in ("p_size", "p_partkey", "p_brand")])
    part = table(spark, folder, "part")
    return bind_schema(part.withColumn("p_brand", F.replace("p_brand", F.lit("Brand#1"), F.lit(""))), schema, strict=False)


@query("SELECT l_returnflag, count(*) AS n, max(l_quantity) AS top FROM lineitem GROUP BY l_returnflag",
       name="as_view")
def as_view_(spark, folder):
    as_view(table(spark, folder, "lineitem"), "temp_view")
    return spark.sql("SELECT l_returnflag, count(*) AS n, max(l_quantity) AS top "
                     "FROM temp_view GROUP BY l_returnflag")


@query("""SELECT o_orderkey, o_totalprice FROM orders
          ORDER BY o_totalprice DESC, o_orderkey LIMIT 899""", name="head_rows")
def head_rows_(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return head_rows(orders, 899, [F.desc("o_totalprice"), "o_orderkey"])


@query("SELECT c_custkey, c_acctbal FROM customer", name="require_columns")
def require_columns_(spark, folder):
    return require_columns(table(spark, folder, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])
