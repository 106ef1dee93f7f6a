"""Ranks over a whole table, and intermediate tables that outlive the executors that made them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.session import checkpoint_folder

_ROW_BITS = 33  # of monotonically_increasing_id


def checkpointed(df: DataFrame) -> DataFrame:
    """The same rows read from a checkpoint in the shared folder.

    A join with it meets a plain exchange, of which Spark can split a hot key's part.
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def unused(df: DataFrame, stem: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = f"_{stem}"
    return stem


def with_rank(df: DataFrame, order: Sequence[Column], out: str = "rank") -> DataFrame:
    """Adds each row's rank from 0 in the given order, which should leave no ties.

    Rows are dealt by range and sorted where they are; the driver sees one count per partition.
    """
    dealt = checkpointed(df.repartitionByRange(partitions(df), *order).sortWithinPartitions(*order)
                         .withColumn(out, F.monotonically_increasing_id()))
    part = F.shiftrightunsigned(out, _ROW_BITS)
    counts = sorted((r["part"], r["n"]) for r in dealt.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    bases, total = [], 0
    for at, n in counts:
        bases += [F.lit(at), F.lit(total)]
        total += n
    base = F.create_map(*bases)[part] if bases else F.lit(0)
    row = F.col(out).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return dealt.withColumn(out, (base + row).cast("long"))
