"""Range lookups of rates."""

from pyspark.sql import functions as F

from checks import query
from checks.inputs import AGED_PART, aged_part, table
from tablewright.functions import percent_to_fraction
from tablewright.operators import enrich as E
from tablewright.sources import bands

# Fixed values: (lo, hi, rate); 65 to 66 lies in two bands, of which the first wins.
BANDS = [(14, 17, 3.2), (18, 24, 5.3), (25, 44, 12.6), (45, 66, 14.9), (65, 200, 8.3)]
GROUP_RATES = {1: 13.1, 0: 10.1}


def case_sql(key: str, rows, factor: float = 1.0, below: bool = False) -> str:
    def test(lo, hi):
        return f"{key} >= {lo} AND {key} < {hi} + 1" if below else f"{key} BETWEEN {lo} AND {hi}"

    whens = " ".join(f"WHEN {test(lo, hi)} THEN {rate * factor!r}::DOUBLE / 100" for lo, hi, rate in rows)
    return f"CASE {whens} END"


def band_rows(spark, folder):
    return bands(spark, BANDS)


@query(f"WITH {AGED_PART} SELECT p_partkey, smoke, smoke AS smoke_source1 FROM pa")
def copy_observed(spark, folder):
    return E.copy_observed(aged_part(spark, folder).select("p_partkey", "smoke"), "smoke", "smoke_source1")


@query(f"WITH {AGED_PART} SELECT p_partkey, age, coalesce(smoke, {case_sql('age', BANDS)}) AS smoke FROM pa")
def impute_by_band(spark, folder):
    return E.impute_by_band(aged_part(spark, folder).select("p_partkey", "age", "smoke"), "smoke", "age",
                            band_rows(spark, folder))


@query(f"""WITH {AGED_PART}
SELECT p_partkey, age, coalesce(smoke, {case_sql('age', BANDS, below=True)}) AS smoke FROM pa""")
def impute_by_band_half_open(spark, folder):
    return E.impute_by_band(aged_part(spark, folder).select("p_partkey", "age", "smoke"), "smoke", "age",
                            BANDS, half_open=True)


@query(f"""WITH {AGED_PART}, b AS (SELECT p_partkey AS idx, p_partkey % 70 AS lo, p_partkey % 70 + p_size % 5 AS hi,
                                      p_retailprice AS rate FROM part),
hit AS (SELECT a.age, arg_min(rate, idx) AS rate FROM (SELECT DISTINCT age FROM pa) a
        JOIN b ON a.age BETWEEN b.lo AND b.hi GROUP BY a.age)
SELECT p_partkey, pa.age, coalesce(smoke, rate / 100) AS smoke FROM pa LEFT JOIN hit ON hit.age = pa.age""")
def impute_by_many_bands(spark, folder):
    """A band per part: too many for a CASE chain, so they are searched."""
    part = table(spark, folder, "part").select(
        F.col("p_partkey").alias("idx"), (F.col("p_partkey") % 70).alias("lo"),
        (F.col("p_partkey") % 70 + F.col("p_size") % 5).alias("hi"), F.col("p_retailprice").alias("rate"))
    return E.impute_by_band(aged_part(spark, folder).select("p_partkey", "age", "smoke"), "smoke", "age", part)


@query(f"""WITH {AGED_PART}
SELECT p_partkey, age, sex, coalesce(smoke, CASE WHEN sex = 0 THEN {case_sql('age', BANDS)}
  WHEN sex = 1 THEN {case_sql('age', BANDS, GROUP_RATES[0] / GROUP_RATES[1])} END) AS smoke FROM pa""")
def impute_by_band_and_group(spark, folder):
    factors = {0: 1.0, 1: E.rate_ratio(GROUP_RATES)}
    return E.impute_by_band_and_group(aged_part(spark, folder), "smoke", "age", BANDS, "sex", factors)


def table_of_bands_sql(inside: str, factor: str = "1") -> str:
    return f"""WITH li AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS price, l_linenumber % 2 AS side,
  CASE WHEN l_linenumber <> 3 THEN l_discount END AS rate FROM lineitem),
b AS (SELECT o_orderkey AS idx, o_totalprice / 4 AS lo, o_totalprice / 4 + (o_orderkey % 40) * 25 AS hi, (o_custkey % 100)::DOUBLE AS r FROM orders),
hit AS (SELECT p.price, arg_min(r, idx) AS r FROM (SELECT DISTINCT price FROM li WHERE rate IS NULL) p
        JOIN b ON {inside} GROUP BY p.price)
SELECT l_orderkey, l_linenumber, li.price, side, coalesce(rate, r * {factor} / 100) AS rate FROM li LEFT JOIN hit ON hit.price = li.price"""


def priced_items(spark, folder):
    """Prices with gaps in the rate, and a band per order: too many to hold, by a bound set low."""
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"), (F.col("l_linenumber") % 2).alias("side"),
        F.when(F.col("l_linenumber") != 3, F.col("l_discount")).alias("rate"))
    low = F.col("o_totalprice") / 4
    bands_ = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("idx"), low.alias("lo"), (low + F.col("o_orderkey") % 40 * 25).alias("hi"),
        (F.col("o_custkey") % 100).cast("double").alias("rate"))
    return items, bands_


@query(table_of_bands_sql("p.price BETWEEN b.lo AND b.hi"))
def impute_by_a_table_of_bands(spark, folder):
    items, bands_ = priced_items(spark, folder)
    return E.impute_by_band(items, "rate", "price", bands_, max_bands=100)


@query(table_of_bands_sql("p.price >= b.lo AND p.price < b.hi + 1"))
def impute_by_a_table_of_bands_half_open(spark, folder):
    items, bands_ = priced_items(spark, folder)
    return E.impute_by_band(items, "rate", "price", bands_, half_open=True, max_bands=100)


@query(table_of_bands_sql("p.price BETWEEN b.lo AND b.hi", "CASE WHEN side = 0 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END"))
def impute_by_a_table_of_bands_and_group(spark, folder):
    items, bands_ = priced_items(spark, folder)
    return E.impute_by_band_and_group(items, "rate", "price", bands_, "side", {0: 1.0, 1: 0.5}, max_bands=100)


@query("""SELECT round((SELECT avg(p_retailprice) FROM part WHERE p_partkey % 2 = 0)
                / (SELECT avg(p_retailprice) FROM part WHERE p_partkey % 2 = 1), 9) AS ratio""")
def rate_ratio(spark, folder):
    rates = (table(spark, folder, "part").groupBy((F.col("p_partkey") % 2).alias("key"))
             .agg(F.avg("p_retailprice").alias("rate")))
    return spark.createDataFrame([(E.rate_ratio(rates),)], "ratio double").select(F.round("ratio", 9).alias("ratio"))


@query("SELECT p_partkey, p_retailprice / 100 AS rate FROM part", name="percent_to_fraction")
def percent_to_fraction_(spark, folder):
    return table(spark, folder, "part").select("p_partkey", percent_to_fraction("p_retailprice").alias("rate"))
