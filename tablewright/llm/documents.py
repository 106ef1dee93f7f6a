"""What the operators share about tables of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but space, tab, line feed, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def whole_text(column: str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def document_key(id_col: str, text: Column) -> Column:
    """A number that orders documents by their whole-number id (null last), then by a hash of the text.

    It names a document: rows equal in id and text are one document listed twice.
    Being of fixed length, it can be a minimum in a hash aggregate.
    """
    number = F.coalesce(F.col(id_col).cast("decimal(38,0)"), F.lit(str(2**63)).cast("decimal(38,0)"))
    tail = F.shiftrightunsigned(F.xxhash64(text), 4)
    return (number * F.lit(2**60).cast("decimal(19,0)") + tail.cast("decimal(38,0)")).cast("decimal(38,0)")
