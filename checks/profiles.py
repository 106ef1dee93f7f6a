"""Aggregates and column profiles."""

from pyspark.sql import functions as F

from checks import query
from checks.inputs import FLAG_ORDERS, GAP_LINEITEM, flag_orders, gap_lineitem, table
from tablewright.operators import statistics as S
from tablewright.operators.quantiles import exact_quantiles
from tablewright.operators.split import stratified_split


def rounded(df, *cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query(f"""WITH {GAP_LINEITEM}
SELECT 'l_quantity' AS "column", round(avg(l_quantity), 6) AS mean FROM li
UNION ALL SELECT 'l_extendedprice', round(avg(l_extendedprice), 6) FROM li
UNION ALL SELECT 'l_tax', round(avg(l_tax), 6) FROM li""")
def column_means(spark, folder):
    means = S.column_means(gap_lineitem(spark, folder), ["l_quantity", "l_extendedprice", "l_tax"])
    return rounded(means, "mean")


MODES = """SELECT "column", value AS mode, n FROM (
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS k FROM counted) WHERE k = 1"""


@query(f"""WITH {GAP_LINEITEM}, counted AS (
  SELECT 'l_quantity' AS "column", l_quantity AS value, count(*) AS n FROM li WHERE l_quantity IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'l_extendedprice', l_extendedprice, count(*) FROM li WHERE l_extendedprice IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'l_tax', l_tax, count(*) FROM li WHERE l_tax IS NOT NULL GROUP BY 2) {MODES}""")
def column_modes(spark, folder):
    return S.column_modes(gap_lineitem(spark, folder), ["l_quantity", "l_extendedprice", "l_tax"])


@query(f"""WITH counted AS (
  SELECT 'n_regionkey' AS "column", n_regionkey AS value, count(*) AS n FROM nation GROUP BY 2
  UNION ALL SELECT 'n_nationkey', n_nationkey, count(*) FROM nation GROUP BY 2) {MODES}""")
def column_modes_with_ties(spark, folder):
    return S.column_modes(table(spark, folder, "nation"), ["n_regionkey", "n_nationkey"])


@query(f"""WITH {GAP_LINEITEM}
SELECT 'l_quantity' AS "column", median(l_quantity) AS median FROM li
UNION ALL SELECT 'l_extendedprice', round(median(l_extendedprice), 6) FROM li
UNION ALL SELECT 'l_tax', median(l_tax) FROM li""")
def column_medians(spark, folder):
    medians = S.column_medians(gap_lineitem(spark, folder), ["l_quantity", "l_extendedprice", "l_tax"])
    return rounded(medians, "median")


@query("""SELECT round(quantile_cont(l_extendedprice, 0.1), 4) AS p10, round(median(l_extendedprice), 4) AS p50,
                 round(quantile_cont(l_extendedprice, 0.99), 4) AS p99 FROM lineitem""")
def quantiles_by_narrowing(spark, folder):
    """The bracket search that serves columns too long for a single percentile buffer."""
    items = table(spark, folder, "lineitem")
    found = exact_quantiles(items, {"l_extendedprice": [0.1, 0.5, 0.99]}, small=0, ranked=500)
    return rounded(spark.createDataFrame([tuple(found["l_extendedprice"])], "p10 double, p50 double, p99 double"),
                   "p10", "p50", "p99", digits=4)


@query("SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def label_counts(spark, folder):
    return S.label_counts(table(spark, folder, "lineitem"), "l_returnflag")


@query("""SELECT o_orderstatus, count(*) AS n, count(*) / (SELECT count(*) FROM orders)::DOUBLE AS proportion
          FROM orders GROUP BY o_orderstatus""")
def class_balance(spark, folder):
    return S.class_balance(table(spark, folder, "orders"), "o_orderstatus")


@query(f"""WITH {FLAG_ORDERS}, c AS (SELECT flag, count(*) AS n FROM od GROUP BY flag),
h AS (SELECT od.*, ('0x' || substr(md5('42|' || o_orderkey), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM od),
s AS (SELECT CASE WHEN u < floor(0.9::DOUBLE * n) / n THEN 'train' ELSE 'test' END AS split, h.flag
      FROM h JOIN c ON h.flag IS NOT DISTINCT FROM c.flag)
SELECT split, flag, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY split)::DOUBLE AS proportion
FROM s GROUP BY split, flag""")
def class_balance_by_split(spark, folder):
    parts = stratified_split(flag_orders(spark, folder), "flag", "o_orderkey")
    return S.class_balance(parts, "flag", split="split")


def histogram_sql(source: str, cols: list[str]) -> str:
    parts = [f"""SELECT '{c}' AS "column", g.bin::INT AS bin,
        lo + (hi - lo) * g.bin / 20 AS lo, lo + (hi - lo) * (g.bin + 1) / 20 AS hi, coalesce(k.n, 0) AS n
      FROM (SELECT min({c})::DOUBLE + 0.0 AS lo, max({c})::DOUBLE AS hi FROM {source}) r
      CROSS JOIN range(20) g(bin)
      LEFT JOIN (SELECT least(floor(({c} - lo) / (hi - lo) * 20), 19)::INT AS bin, count(*) AS n
                 FROM {source}, (SELECT min({c})::DOUBLE + 0.0 AS lo, max({c})::DOUBLE AS hi FROM {source})
                 WHERE {c} IS NOT NULL GROUP BY 1) k ON k.bin = g.bin""" for c in cols]
    return " UNION ALL ".join(parts)


@query(f"WITH {GAP_LINEITEM} " + "SELECT \"column\", bin, round(lo, 6) AS lo, round(hi, 6) AS hi, n FROM ("
       + histogram_sql("li", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
       + " UNION ALL " + histogram_sql("events", ["value"]) + ")")
def histogram(spark, folder):
    items = S.histogram(gap_lineitem(spark, folder), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    events = S.histogram(table(spark, folder, "events"), ["value"])
    return rounded(items.unionByName(events), "lo", "hi")


@query(f"""WITH {GAP_LINEITEM}
{" UNION ALL ".join(f'''SELECT '{c}' AS "column", round(avg({c}), {5 if c == 'l_extendedprice' else 9}) AS mean, round(stddev_samp({c}), 6) AS std,
min({c}) + 0.0 AS min, max({c}) AS max, round(skewness({c}), 6) AS skew FROM li'''
for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))}""")
def describe_table(spark, folder):
    out = S.describe_table(gap_lineitem(spark, folder), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    price = F.col("column") == "l_extendedprice"
    mean = F.when(price, F.round("mean", 5)).otherwise(F.round("mean", 9))
    out = rounded(out, "std", "skew").withColumn("mean", mean)
    return out.withColumn("min", F.col("min") + 0.0)


@query(f"""WITH {GAP_LINEITEM}
SELECT 'l_returnflag' AS "column", l_returnflag AS value, count(*) AS n FROM li GROUP BY 2
UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM li WHERE l_linestatus IS NOT NULL GROUP BY 2""")
def value_counts(spark, folder):
    return S.value_counts(gap_lineitem(spark, folder), ["l_returnflag", "l_linestatus"])


@query("""SELECT 'l_orderkey' AS "column", count(DISTINCT l_orderkey) AS n_distinct FROM lineitem
UNION ALL SELECT 'l_quantity', count(DISTINCT l_quantity) FROM lineitem
UNION ALL SELECT 'l_linenumber', count(DISTINCT l_linenumber) FROM lineitem""")
def distinct_counts(spark, folder):
    return S.distinct_counts(table(spark, folder, "lineitem"), ["l_orderkey", "l_quantity", "l_linenumber"])


@query(f"""WITH {GAP_LINEITEM}
{" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS corr FROM li"
for a, b in (("l_quantity", "l_extendedprice"), ("l_quantity", "l_tax"), ("l_extendedprice", "l_tax")))}""")
def correlation_pairs(spark, folder):
    out = S.correlation_pairs(gap_lineitem(spark, folder), ["l_quantity", "l_extendedprice", "l_tax"])
    return rounded(out, "corr").withColumn("corr", F.col("corr") + 0.0)


WIDE = 32


def wide_sql(i: int) -> str:
    return f"CASE WHEN (l_orderkey + {i}) % 7 <> 0 THEN l_quantity * {i % 5 - 2} + l_extendedprice / {1000 * (i + 1)} + l_linenumber * {i % 3} END"


def wide_items(spark, folder):
    """The columns of `wide_sql` by one expression over their numbers.

    An expression for each makes a generated method of more than 8,000 bytes, which Java does not compile.
    """
    cell = """CASE WHEN (l_orderkey + i) % 7 <> 0
        THEN l_quantity * (i % 5 - 2) + l_extendedprice / (1000 * (i + 1)) + l_linenumber * (i % 3) END"""
    cells = table(spark, folder, "lineitem").select(F.expr(f"transform(sequence(0, {WIDE - 1}), i -> {cell})").alias("x"))
    return cells.select(*[F.get("x", F.lit(i)).cast("double").alias(f"x{i}") for i in range(WIDE)])


_WIDE_PAIRS = [(i, j) for i in range(WIDE) for j in range(i + 1, WIDE)]


@query(f"""WITH w AS (SELECT {", ".join(f"({wide_sql(i)})::DOUBLE AS x{i}" for i in range(WIDE))} FROM lineitem),
r AS (SELECT {", ".join(f"round(corr(x{i}, x{j}), 6) + 0.0 AS c{i}_{j}" for i, j in _WIDE_PAIRS)} FROM w)
{" UNION ALL ".join(f"SELECT 'x{i}' AS a, 'x{j}' AS b, c{i}_{j} AS corr FROM r" for i, j in _WIDE_PAIRS)}""")
def correlation_pairs_of_many_columns(spark, folder):
    """Gaps fall on other rows in every column, and stay pair-wise however many columns there are."""
    wide = wide_items(spark, folder)
    out = S.correlation_pairs(wide, wide.columns)
    return rounded(out, "corr").withColumn("corr", F.col("corr") + 0.0)


@query("""SELECT "column", min + 0.0 AS min, round(q1, 6) AS q1, round(median, 6) AS median,
       round(q3, 6) AS q3, max FROM (
  SELECT 'value' AS "column", min(value) AS min, quantile_cont(value, 0.25) AS q1, median(value) AS median,
         quantile_cont(value, 0.75) AS q3, max(value) AS max FROM events
  UNION ALL SELECT 'user_id', min(user_id)::DOUBLE, quantile_cont(user_id::DOUBLE, 0.25), median(user_id::DOUBLE),
         quantile_cont(user_id::DOUBLE, 0.75), max(user_id)::DOUBLE FROM events)""")
def box_summary(spark, folder):
    out = S.box_summary(table(spark, folder, "events"), ["value", "user_id"])
    return rounded(out, "q1", "median", "q3").withColumn("min", F.col("min") + 0.0)
