"""SimHash near-deduplication over a multi-index of fingerprint segments."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import query
from tablewright.llm.components import components
from tablewright.llm.documents import documents
from tablewright.llm.durable import durable, numbered, unused

BITS = 64
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_AT_ONCE = 1 << 15


def fingerprint(text: bytes, words: int = 4) -> int:
    """Each bit is set if it is set in over half the hashes of the text's word shingles."""
    parts = text.translate(_LOWER).split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) < words:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[: len(parts) - words] + 1))
    starts, ends = starts.tolist(), ends[words - 1:].tolist()
    digest, set_in = xxhash.xxh64_digest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _AT_ONCE):
        hashes = b"".join([digest(joined[a:b], 42) for a, b in zip(starts[at:at + _AT_ONCE], ends[at:at + _AT_ONCE])])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, BITS)
        set_in += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_in > len(starts)).tobytes(), "big")


def _fingerprint_batches(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t or b"", words) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            signed = pa.array(np.array(prints, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), signed], ["id", "fp"])

    return run


def fingerprints(df: DataFrame, id_col: str, text_col: str, words: int = 4) -> DataFrame:
    """(id, fp): the 64-bit fingerprint as a signed number; null and wordless texts have 0."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_fingerprint_batches(words), f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def _ball(width: int, radius: int, parity: int) -> list[int]:
    """Differences of at most ``radius`` bits, an even or an odd number of them."""
    return [sum(1 << i for i in bits) for r in range(parity, radius + 1, 2) for bits in combinations(range(width), r)]


def close_pairs(prints: DataFrame, distance: int = 4, segments: int | None = None) -> DataFrame:
    """(a, b): distinct fingerprints (column ``fp``) that differ in at most ``distance`` bits.

    With m segments, close fingerprints differ in at most distance // m bits of one
    segment. Each fingerprint is stored under its exact segments and looked up under
    every value of that small Hamming ball; what the tables return is verified over
    all 64 bits. Two segments at an odd distance have unlike parities, so only
    odd ones look up the odd part of the ball. A pair may come out once per segment that
    finds it. ``segments`` changes the cost, never the pairs: few long segments make large
    balls and selective tables, so three suit up to 2**28 fingerprints and two more.
    """
    if segments is None:
        segments = 3 if prints.count() <= 2**28 else 2
    if not 1 <= segments <= 8 or distance < 0:
        raise ValueError("segments must be 1 to 8 and distance not negative")
    exact, probes, low = [], [], 0
    for s in range(segments):
        width = BITS // segments + (s < BITS % segments)
        part = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1)) if width < BITS else F.col("fp")
        low += width

        def entry(value: Column, odd: bool, s: int = s) -> Column:
            return F.struct(F.lit(s).alias("segment"), value.alias("value"), F.lit(odd).alias("odd"))

        exact.append(entry(part, False))
        probes.append(F.array(*[entry(part.bitwiseXOR(F.lit(m)), False) for m in _ball(width, distance // segments, 0)]))
        odd = _ball(width, distance // segments, 1)
        if odd:
            probes.append(F.when(F.bit_count(part) % 2 == 1, F.array(*[entry(part.bitwiseXOR(F.lit(m)), True) for m in odd]))
                          .otherwise(F.array().cast("array<struct<segment:int,value:bigint,odd:boolean>>")))
    table = prints.select(F.col("fp").alias("b"), F.explode(F.array(*exact)).alias("at")).select("b", "at.segment", "at.value")
    asked = prints.select(F.col("fp").alias("a"), F.explode(F.concat(*probes)).alias("at")).select("a", "at.*")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return (asked.join(table, (asked["segment"] == table["segment"]) & (asked["value"] == table["value"])
                       & near & (F.col("odd") | (F.col("a") < F.col("b")))).select("a", "b"))


def near_duplicate_classes(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, distance: int = 4,
    segments: int | None = None,
) -> DataFrame:
    """(id, fp, component_id): one row per row; classes are linked by close fingerprints.

    Documents with one fingerprint shrink to one entry before any search, so large
    groups of copies cost nothing, and links are only made between different
    fingerprints. ``component_id`` is the smallest id in the class (null only if all its
    ids are null). Null and wordless texts have fingerprint 0 and form a class like any
    other. Repeated rows are members of their class. Other columns are not read; an
    empty table gives an empty result.
    """
    prints = durable(fingerprints(df, id_col, text_col, words))
    firsts = prints.groupBy("fp").agg(F.min("id").alias("first"))
    linked = components(close_pairs(firsts.select("fp"), distance, segments), "a", "b")
    roots = linked.join(firsts, linked["node"] == firsts["fp"]).groupBy("root").agg(F.min("first").alias("component"))
    members = linked.join(roots, "root").select(F.col("node").alias("fp"), "component")
    # A class whose smallest member has no id still has the others' smallest.
    # Stored, so that the join below meets two plain exchanges, of which Spark splits a hot fingerprint's side.
    classes = durable(firsts.join(members, "fp", "left").select("fp", F.coalesce("component", "first").alias("component_id")))
    return prints.join(classes, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df``, one of each class of near-duplicates: that with the smallest id.

    Among rows that share that id (or have none) one stays.
    """
    row_id = unused(df, "row")
    rows = numbered(df, row_id)
    classes = near_duplicate_classes(rows.select(F.struct(F.col(id_col).isNull(), F.col(id_col), F.col(row_id)).alias("id"),
                                                 F.col(text_col).alias("text")), "id", "text", **options)
    stay = classes.filter(F.col("id") == F.col("component_id")).select(F.col(f"id.{row_id}").alias(row_id))
    return rows.join(stay, row_id, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])


@query()
def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    classes = near_duplicate_classes(documents(spark, folder))
    return classes.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
