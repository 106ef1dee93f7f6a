"""Intermediate tables that outlive the executors that made them, and ranks over a whole table."""

from __future__ import annotations

import atexit
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.session import scratch_path


def durable(df: DataFrame) -> DataFrame:
    """The same rows read from a checkpoint in the shared folder; for narrow tables."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(scratch_path(df.sparkSession, "checkpoints"))
    return df.checkpoint()


_paths: list[tuple[SparkSession, str]] = []


def stored(df: DataFrame, stem: str, codec: str = "snappy") -> DataFrame:
    """The same rows read from a Parquet table in the shared folder; for wide tables.

    The table stays until ``discard`` or the end of the driver, as lazy results read it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, stem)
    df.write.option("compression", codec).parquet(path)
    _paths.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def discard() -> None:
    """Delete all stored tables. Results that still read them can then not be computed again."""
    while _paths:
        spark, path = _paths.pop()
        try:
            jvm = spark._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # noqa: BLE001  the session may have ended; then nothing can be done
            continue


def numbered(df: DataFrame, row_id: str) -> DataFrame:
    """The table, stored, with a distinct number per row in ``row_id``.

    The numbers are part of the stored rows, so no later scan can number them otherwise.
    """
    return stored(df.withColumn(row_id, F.monotonically_increasing_id()), "numbered")


def unused(df: DataFrame, stem: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def shuffle_partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def rank_of_keys(keys: DataFrame, order: Sequence[str], weight: Column, out: str) -> DataFrame:
    """Adds ``out``: the total weight of the rows before each row, ordered by ``order`` (null last).

    With distinct rows and weight 1 that is a rank from 0. Rows are dealt by
    range, so no task holds more than its share, and one total per partition
    meets in one place.
    """
    by = [F.col(c).asc_nulls_last() for c in order]
    dealt = durable(keys.repartitionByRange(shuffle_partitions(keys), *by).select(
        F.struct(*keys.columns).alias("row"), weight.alias("weight"), F.spark_partition_id().alias("part")))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("part").agg(F.sum("weight").alias("total")).select(
        "part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    local = (Window.partitionBy("part").orderBy(*[F.col(f"row.{c}").asc_nulls_last() for c in order])
             .rowsBetween(Window.unboundedPreceding, -1))
    return (dealt.withColumn("own", F.coalesce(F.sum("weight").over(local), F.lit(0)))
            .join(F.broadcast(totals), "part")  # one row per partition
            .select("row.*", (F.col("base") + F.col("own")).alias(out)))
