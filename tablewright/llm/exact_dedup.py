"""Exact deduplication by 128-bit content hash."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import query
from tablewright.llm.documents import documents, whole_text
from tablewright.llm.durable import durable


def content_hash(text: Column) -> Column:
    """128 bits of the UTF-8 text."""
    return F.unhex(F.md5(text))


def exact_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
    digest: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256), one row per row of ``df``.

    Texts are equal when their bytes are. Rows are grouped by ``digest`` and, inside
    a hash, by the text itself, so a collision never joins two texts. Copies shrink
    to one row per task before the shuffle, and the verdicts travel back as narrow
    rows by hash; only hashes that two texts share are resolved by text.

    Null text counts as empty, and empty texts are copies of each other. A null id is
    never kept before another id; if all ids of a group are null, ``keep_id`` is null and
    all its rows stay. Rows that repeat id and text are one document listed
    twice: they share the verdict and count in ``group_size``. An empty table gives an
    empty result. Other columns are not read.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be 'smallest' or 'largest'")
    best = F.min if keep == "smallest" else F.max
    rows = df.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text")).withColumn("hash", digest(F.col("text")))

    def by_text(of: DataFrame) -> DataFrame:
        return of.groupBy("hash", "text").agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))

    by_hash = durable(by_text(rows).groupBy("hash").agg(
        F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")))
    shared = by_hash.filter("texts > 1").select("hash")
    narrow = rows.select("id", "hash", F.sha2("text", 256).alias("text_sha256"))
    found = narrow.join(by_hash.filter("texts = 1").drop("texts"), "hash")
    if not shared.isEmpty():
        some = rows.join(shared, "hash", "left_semi")
        found = found.select("id", "keep_id", "group_size", "text_sha256").unionByName(
            some.join(by_text(some), ["hash", "text"])
            .select("id", "keep_id", "group_size", F.sha2("text", 256).alias("text_sha256")))
    return found.select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


@query("""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""")
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(documents(spark, folder), keep="largest")
