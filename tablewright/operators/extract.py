"""Reading rates out of stored web pages.

A pages table has an id column and an html column; element tables have the id,
a position in document order, and the element's inner html.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import html as H


def extract_elements(pages: DataFrame, tag: str, class_: str | None = None, *,
                     id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, pos, inner) of all elements of a tag and class, nested ones included."""
    clean = pages.select(id_col, H.without_scripts(html_col).alias("_html"))
    return _listed(clean, tag, class_)


def _listed(fragments: DataFrame, tag: str, class_: str | None) -> DataFrame:
    """The columns but the last, which holds html, with (pos, inner) of each element in it.

    A few pages at a time are read and their elements given out, so a task's memory does not grow with its pages.
    """
    H.check_tag(tag)
    *kept, _ = fragments.schema.fields
    schema = T.StructType([*kept, T.StructField("pos", T.IntegerType(), False), T.StructField("inner", T.StringType())])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *others, html = batch.columns
            for first, end in H.parts_of(html):
                rows, pos, inner = [], [], []
                for row, page in enumerate(html[first:end].to_pylist(), first):
                    for k, found in enumerate([] if page is None else H.scan_elements(page, tag, class_)):
                        rows.append(row)
                        pos.append(k)
                        inner.append(found[1])
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[c.take(at) for c in others], pa.array(pos, pa.int32()), pa.array(inner, pa.string())], schema.names)

    return fragments.mapInArrow(listed, schema)


def nested_elements(elements: DataFrame, tag: str, class_: str | None = None, *,
                    id_col: str = "page_id", html_col: str = "inner") -> DataFrame:
    """Elements inside elements: (id, outer_pos, pos, inner)."""
    return _listed(elements.select(id_col, F.col("pos").alias("outer_pos"), html_col), tag, class_)


def child_text(elements: DataFrame, tag: str, n: int = 0, out: str = "text") -> DataFrame:
    """Add the text of the n-th (from 0) nested element; null when there is none."""
    return elements.withColumn(out, H.nth_text("inner", tag, n))


def own_text(elements: DataFrame, out: str = "text") -> DataFrame:
    """Add the element's whole text."""
    return elements.withColumn(out, H.text_of("inner"))


def parse_band(df: DataFrame, text: str = "text", top: float = 200.0) -> DataFrame:
    """Add lo and hi read from an age band's text, with ``top`` closing an open last band."""
    return df.withColumns({"lo": H.parse_band(text, "lo", top), "hi": H.parse_band(text, "hi", top)})


def parse_percent(df: DataFrame, text: str = "text", out: str = "rate") -> DataFrame:
    return df.withColumn(out, H.parse_percent(text))


def open_ended_band(bands: DataFrame, top: float = 200.0, text: str = "text") -> DataFrame:
    """Set hi where the band's text has no upper bound, such as "75+"."""
    return bands.withColumn("hi", F.when(H.has_open_end(text), float(top)).otherwise(F.col("hi")))


def category_rates(elements: DataFrame, text: str = "text") -> DataFrame:
    """(key, rate) from the first two elements: position 0 is key 1, position 1 is key 0."""
    return (elements.filter(F.col("pos") < 2)
            .withColumn("key", 1 - F.col("pos")).withColumn("rate", H.parse_percent(text))
            .drop("pos", "inner", text))


def tail_mean(elements: DataFrame, n: int = 4, *, id_col: str = "page_id", text: str = "text",
              order: Sequence[str] = ("pos",)) -> DataFrame:
    """(id, mean) of the last n texts per page that are numbers.

    The rank limit is applied before the shuffle, so at most n rows per page and
    task move.
    """
    ranked = Window.partitionBy(id_col).orderBy(*[F.col(c).desc() for c in order])
    numbers = elements.withColumn("_number", F.trim(text).try_cast("double")).filter(
        F.col("_number").isNotNull() & ~F.isnan("_number"))
    last = numbers.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") <= n)
    return last.groupBy(id_col).agg(F.avg("_number").alias("mean"))


def prepend_band(bands: DataFrame, row: DataFrame | Sequence[float]) -> DataFrame:
    """Put a band in front of the others, where it wins over later ones."""
    if not isinstance(row, DataFrame):
        lo, hi, rate = (float(v) for v in row)
        row = bands.sparkSession.createDataFrame([(lo, hi, rate)], "lo double, hi double, rate double")
    first = row.select(F.lit(0).alias("idx"), "lo", "hi", "rate")
    rest = bands.select((F.col("idx") + 1).cast("int").alias("idx"), "lo", "hi", "rate")
    return first.unionByName(rest)
