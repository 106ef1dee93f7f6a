"""Scaling, encoding, splitting and set difference."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import query
from checks.inputs import FLAG_ORDERS, flag_orders, table
from tablewright.operators import features as X
from tablewright.operators import split as P


def rounded(df, *cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query("""SELECT l_orderkey,
  round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_pop(l_quantity) FROM lineitem), 6) AS l_quantity,
  round((l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem))
        / (SELECT stddev_pop(l_extendedprice) FROM lineitem), 6) AS l_extendedprice FROM lineitem""")
def standardize(spark, folder):
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    return rounded(X.standardize(items, ["l_quantity", "l_extendedprice"]), "l_quantity", "l_extendedprice")


@query("""SELECT l_orderkey, (l_quantity - mn) / (mx - mn) AS l_quantity, 0.0::DOUBLE AS constant
          FROM lineitem, (SELECT min(l_quantity) AS mn, max(l_quantity) AS mx FROM lineitem)""")
def min_max(spark, folder):
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", F.lit(3.0).alias("constant"))
    return X.min_max(items, ["l_quantity", "constant"])


@query("""SELECT o_orderkey, (o_orderstatus = 'F')::INT AS "o_orderstatus_F", (o_orderstatus = 'O')::INT AS "o_orderstatus_O",
  (o_orderstatus = 'P')::INT AS "o_orderstatus_P", (o_orderpriority = '1-URGENT')::INT AS "o_orderpriority_1_URGENT",
  (o_orderpriority = '2-HIGH')::INT AS "o_orderpriority_2_HIGH", (o_orderpriority = '3-MEDIUM')::INT AS "o_orderpriority_3_MEDIUM",
  (o_orderpriority = '4-NOT SPECIFIED')::INT AS "o_orderpriority_4_NOT_SPECIFIED",
  (o_orderpriority = '5-LOW')::INT AS "o_orderpriority_5_LOW" FROM orders""")
def one_hot(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return X.one_hot(orders, ["o_orderstatus", "o_orderpriority"])


NATION_PLACES = """SELECT c_custkey, k AS place, 1.0::DOUBLE AS total FROM customer JOIN (
  SELECT c_nationkey, row_number() OVER (ORDER BY count(*) DESC, c_nationkey::VARCHAR) AS k
  FROM customer GROUP BY c_nationkey) USING (c_nationkey)"""


def nation_places(spark, folder, **options):
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    hot = vector_to_array(F.col("c_nationkey_vec"))
    return X.one_hot_vector(customer, ["c_nationkey"], **options).select(
        "c_custkey", F.array_position(hot, 1.0).alias("place"),
        F.aggregate(hot, F.lit(0.0), lambda s, x: s + x).alias("total"))


@query(NATION_PLACES)
def one_hot_vector(spark, folder):
    return nation_places(spark, folder)


@query(NATION_PLACES)
def one_hot_vector_by_an_index_table(spark, folder):
    """The same vectors where the levels are more than may be held, by a bound set low."""
    return nation_places(spark, folder, max_levels=5)


@query("SELECT p_partkey, p_size::DOUBLE AS a, p_retailprice AS b FROM part")
def assemble(spark, folder):
    part = X.assemble(table(spark, folder, "part"), ["p_size", "p_retailprice"])
    v = vector_to_array("features")
    return part.select("p_partkey", v[0].alias("a"), v[1].alias("b"))


@query("""SELECT p_partkey, round((p_size - a) / (b - a)::DOUBLE, 9) AS size, 0.5::DOUBLE AS constant
          FROM part, (SELECT min(p_size) AS a, max(p_size) AS b FROM part)""")
def min_max_vector(spark, folder):
    part = X.assemble(table(spark, folder, "part").withColumn("one", F.lit(1.0)), ["p_size", "one"])
    v = vector_to_array("scaled")
    scaled = X.min_max_vector("features", "scaled").fit(part).transform(part)
    return scaled.select("p_partkey", F.round(v[0], 9).alias("size"), v[1].alias("constant"))


@query("""SELECT o_orderkey, o_orderpriority, (k - 1)::DOUBLE AS label FROM orders JOIN (
  SELECT o_orderpriority, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) AS k
  FROM orders GROUP BY o_orderpriority) USING (o_orderpriority)""")
def index_labels(spark, folder):
    return X.index_labels(table(spark, folder, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, (k - 1)::DOUBLE AS label FROM lineitem JOIN (
  SELECT l_partkey, row_number() OVER (ORDER BY count(*) DESC, l_partkey::VARCHAR) AS k
  FROM lineitem GROUP BY l_partkey) USING (l_partkey)""")
def index_labels_by_a_table(spark, folder):
    """An index of all parts, which is joined, as they are more than may be held by a bound set low."""
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return X.index_labels(items, "l_partkey", max_levels=100)


@query("SELECT doc_id, quality, (quality = 1)::INT::DOUBLE AS label FROM labels")
def binarize_label(spark, folder):
    return X.binarize_label(table(spark, folder, "labels").select("doc_id", "quality"), "quality", out="label")


HASHED = "('0x' || substr(md5('42|' || o_orderkey), 1, 8))::BIGINT"


@query("SELECT DISTINCT o_orderstatus, true AS near_share, true AS distinct_rows_of_the_table FROM orders")
def stratified_sample(spark, folder):
    """Per class: within four deviations of the share drawn, and each row drawn is one of the table's, once."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    drawn = P.stratified_sample(orders, "o_orderstatus", train=0.9, seed=42).withColumn("times", F.lit(1))
    both = orders.join(drawn.groupBy("o_orderkey", "o_orderstatus").agg(F.sum("times").alias("times")),
                       ["o_orderkey", "o_orderstatus"], "full")
    n, k = F.count(F.lit(1)), F.count("times")
    return both.groupBy("o_orderstatus").agg(
        (F.abs(k - 0.9 * n) <= 4 * F.sqrt(0.09 * n) + 1).alias("near_share"),
        (F.max(F.coalesce("times", F.lit(1))) == 1).alias("distinct_rows_of_the_table"))


@query(f"""WITH {FLAG_ORDERS}, c AS (SELECT flag, count(*) AS n FROM od GROUP BY flag)
SELECT o_orderkey, od.flag, CASE WHEN {HASHED} / 4294967296.0::DOUBLE < floor(0.9::DOUBLE * n) / n
       THEN 'train' ELSE 'test' END AS split
FROM od JOIN c ON od.flag IS NOT DISTINCT FROM c.flag""")
def stratified_split(spark, folder):
    return P.stratified_split(flag_orders(spark, folder).select("o_orderkey", "flag"), "flag", "o_orderkey")


@query(f"""SELECT o_orderkey, o_custkey, CASE WHEN {HASHED} / 4294967296.0::DOUBLE < floor(0.8::DOUBLE * n) / n THEN 'train' ELSE 'test' END AS split
FROM orders JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) USING (o_custkey)""")
def stratified_split_by_customer(spark, folder):
    """A class per customer: shares are a table that is joined, by a bound set low."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return P.stratified_split(orders, "o_custkey", "o_orderkey", train=0.8, max_classes=50)


@query(f"""SELECT o_orderkey, o_custkey, CASE WHEN k <= floor(n * 0.3::DOUBLE + 0.5) THEN 'test' ELSE 'train' END AS split
FROM (SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey) AS n,
      row_number() OVER (PARTITION BY o_custkey ORDER BY {HASHED}, o_orderkey) AS k FROM orders)""")
def exact_split_by_customer(spark, folder):
    """A class per customer, of which some are searched by hash prefixes."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return P.exact_split(orders, "o_custkey", "o_orderkey", test=0.3, boundary_rows=8, max_classes=50)


EXACT = f"""SELECT o_orderkey, o_orderstatus, CASE WHEN k <= floor(n * 0.1::DOUBLE + 0.5) THEN 'test' ELSE 'train' END AS split
FROM (SELECT o_orderkey, o_orderstatus, count(*) OVER (PARTITION BY o_orderstatus) AS n,
      row_number() OVER (PARTITION BY o_orderstatus ORDER BY {HASHED}, o_orderkey) AS k FROM orders)"""


@query(EXACT)
def exact_split(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return P.exact_split(orders, "o_orderstatus", "o_orderkey")


@query(EXACT)
def exact_split_by_prefixes(spark, folder):
    """The same split with the boundary found through hash prefixes, as for large classes."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return P.exact_split(orders, "o_orderstatus", "o_orderkey", boundary_rows=50)


@query("""SELECT l_orderkey, l_linenumber FROM lineitem
          EXCEPT SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity < 25""")
def set_difference(spark, folder):
    items = table(spark, folder, "lineitem")
    keys = items.select("l_orderkey", "l_linenumber")
    return P.set_difference(keys, items.filter("l_quantity < 25").select("l_orderkey", "l_linenumber"))


@query("""SELECT l_orderkey, l_linenumber FROM lineitem
          EXCEPT ALL SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity < 25""")
def set_difference_with_duplicates(spark, folder):
    items = table(spark, folder, "lineitem")
    keys = items.select("l_orderkey", "l_linenumber")
    taken = items.filter("l_quantity < 25").select("l_orderkey", "l_linenumber")
    return P.set_difference(keys, taken, distinct=False)
