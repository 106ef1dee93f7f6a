"""Connected components of a graph given as links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.durable import durable


def _lowest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("low"))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): every node that has a link, with the smallest node it can reach.

    Each round points a node's larger neighbours at its smallest neighbour, then
    joins its smaller neighbours there. Minima are combined before the shuffle, so a
    hub costs one row per task; a component of any size takes a logarithmic number
    of rounds. Links with a null end are ignored.
    """
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
    state, seen = durable(links.distinct()), None
    while True:
        mark = state.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = mark
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_lowest(both), "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "low").alias("v")).distinct())
        low = _lowest(large)
        small = large.join(low, "u").filter("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        state = durable(small.unionByName(low.withColumnRenamed("low", "v")).distinct())
