"""Rates from stored web pages into a table's gaps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions import html as H
from tablewright.operators.enrich import (
    Band,
    band_list,
    copy_observed,
    impute_by_band,
    impute_by_band_and_group,
    rate_ratio,
)
from tablewright.operators.extract import (
    category_rates,
    child_text,
    extract_elements,
    nested_elements,
    own_text,
    parse_band,
    parse_percent,
    prepend_band,
    tail_mean,
)
from tablewright.operators.ranks import checkpointed

# The markup of the three pages.
AGE_ROW_CLASS = "even"
GROUP_CLASS = "row"
YOUTH_TABLE_CLASS = "ds-data-table-container"
YOUTH_POINT_CLASS = "ds-data-point ds-2017"
YOUTH_ESTIMATE_CLASS = "dp-data-estimate"


@dataclass(frozen=True)
class PageSources:
    """Which stored pages hold which rates, by url; ``age_rows`` and ``group_rows`` stop after so many bands."""

    age_url: str
    group_url: str
    youth_url: str
    id_col: str = "page_id"
    group_container: int = 7
    age_rows: int | None = None
    group_rows: int | None = None
    youth_span: tuple[float, float] = (14, 17)
    top: float = 200.0


@dataclass(frozen=True)
class PageRates:
    """Bands of the first source, bands of the second, and the second's rate per group."""

    first: Sequence[Band]
    second: Sequence[Band]
    groups: Mapping[int, float]


def age_bands(pages: DataFrame, *, rows: int | None = None, id_col: str = "page_id",
              top: float = 200.0) -> DataFrame:
    """(id, idx, lo, hi, rate) from the table rows of class "even", all or the first ``rows``.

    The band is in the head cell, its rate in the first other cell.
    """
    found = extract_elements(pages, "tr", AGE_ROW_CLASS, id_col=id_col)
    if rows is not None:
        found = found.filter(F.col("pos") < rows)
    rows = child_text(found, "th", 0, "band")
    rows = child_text(rows, "td", 0, "value")
    return (parse_band(rows, "band", top)
            .select(id_col, F.col("pos").alias("idx"), "lo", "hi",
                    F.trim("value").try_cast("double").alias("rate"))
            .filter(F.col("lo").isNotNull() & F.col("rate").isNotNull()))


def group_bands(pages: DataFrame, *, container: int = 7, bands: int | None = None, id_col: str = "page_id",
                top: float = 200.0) -> tuple[DataFrame, DataFrame]:
    """Group rates (id, key, rate) and bands (id, idx, lo, hi, rate) from one list.

    The list sits in the n-th (from 0) division of class "row": two groups come first,
    then the age bands, all or the first ``bands``.
    """
    rows = extract_elements(pages, "div", GROUP_CLASS, id_col=id_col).filter(F.col("pos") == container)
    items = own_text(nested_elements(rows, "li", id_col=id_col)).select(id_col, "pos", "inner", "text")
    listed = F.col("pos") >= 2 if bands is None else F.col("pos").between(2, bands + 1)
    ages = parse_percent(parse_band(items.filter(listed), top=top))
    ages = ages.filter(F.col("lo").isNotNull() & F.col("rate").isNotNull())
    return (category_rates(items),
            ages.select(id_col, (F.col("pos") - 2).alias("idx"), "lo", "hi", "rate"))


def youth_band(pages: DataFrame, *, span: tuple[float, float] = (14, 17), n: int = 4,
               id_col: str = "page_id") -> DataFrame:
    """(id, lo, hi, rate): the mean of the last n estimates in the first data table."""
    tables = extract_elements(pages, "div", YOUTH_TABLE_CLASS, id_col=id_col)
    points = nested_elements(tables.filter(F.col("pos") == 0), "span", YOUTH_POINT_CLASS,
                             id_col=id_col)
    points = points.select(id_col, "pos", "inner")
    values = nested_elements(points, "span", YOUTH_ESTIMATE_CLASS, id_col=id_col)
    values = values.withColumn("text", H.text_of("inner"))
    mean = tail_mean(values, n, id_col=id_col, order=("outer_pos", "pos"))
    return mean.select(id_col, F.lit(float(span[0])).alias("lo"), F.lit(float(span[1])).alias("hi"),
                       F.col("mean").alias("rate"))


def rates_from_pages(pages: DataFrame, src: PageSources) -> PageRates:
    """Read all rates; what reaches the driver is one row per band and group.

    Of a url stored several times, the page with the largest id counts. The pages are
    found in one scan and stored, three at most, before elements are read.
    """
    urls = [src.age_url, src.group_url, src.youth_url]
    order = F.struct(F.col(src.id_col).isNotNull(), F.col(src.id_col))
    latest = checkpointed(pages.filter(F.col("url").isin(urls)).groupBy("url")
                          .agg(F.max_by(F.struct(src.id_col, "html"), order).alias("page")).select("url", "page.*"))

    def of(url: str) -> DataFrame:
        return latest.filter(F.col("url") == url).drop("url")

    first = age_bands(of(src.age_url), rows=src.age_rows, id_col=src.id_col, top=src.top)
    groups, second = group_bands(of(src.group_url), container=src.group_container, bands=src.group_rows,
                                 id_col=src.id_col, top=src.top)
    youth = youth_band(of(src.youth_url), span=src.youth_span, id_col=src.id_col)
    rates = {r["key"]: r["rate"] for r in groups.collect()}  # two positions of one page
    return PageRates(band_list(first), band_list(prepend_band(second, youth)), rates)


def enrich(df: DataFrame, rates: PageRates, *, col: str = "smoke", key: str = "age",
           group: str = "sex", out: tuple[str, str] = ("smoke_source1", "smoke_source2")) -> DataFrame:
    """Two filled copies of a column: by age band, and by age band and group.

    Group 0 takes the band's rate, group 1 the rate times (rate of 0 / rate of 1).
    """
    df = copy_observed(copy_observed(df, col, out[0]), col, out[1])
    df = impute_by_band(df, out[0], key, rates.first)
    factors = {0: 1.0, 1: rate_ratio(rates.groups, 0, 1)}
    return impute_by_band_and_group(df, out[1], key, rates.second, group, factors)


def enrich_from_pages(df: DataFrame, pages: DataFrame, src: PageSources, **columns) -> DataFrame:
    return enrich(df, rates_from_pages(pages, src), **columns)
