"""Filling a column from external rates by range lookup."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.ranks import checkpointed, unused
from tablewright.operators.segments import as_of, disjoint_segments

CASE_BANDS = 100
MAX_BANDS = 100_000

Band = tuple[float, float, float]


def band_list(bands: DataFrame | Iterable[Sequence[float]]) -> list[Band]:
    """Bands as (lo, hi, rate) in first-match order; a table must hold at most MAX_BANDS."""
    rows = _few_bands(bands)
    if rows is None:
        raise ValueError(f"more than {MAX_BANDS} bands; impute_by_band takes them as a table")
    return rows


def _few_bands(bands: DataFrame | Iterable[Sequence[float]], most: int = MAX_BANDS) -> list[Band] | None:
    """The bands as a list, or None where a table holds too many for the driver."""
    if not isinstance(bands, DataFrame):
        return [tuple(b) for b in bands]
    rows = bands.select("idx", "lo", "hi", "rate").limit(most + 1).collect()
    if len(rows) > most:
        return None
    return [(r["lo"], r["hi"], r["rate"]) for r in sorted(rows, key=lambda r: r["idx"])]


def copy_observed(df: DataFrame, col: str, out: str) -> DataFrame:
    """A new column holding the observed value, null where there is none."""
    return df.withColumn(out, F.col(col))


def rate_ratio(rates: DataFrame | Mapping, num=0, den=1) -> float:
    """Rate of one group over the rate of another; a table has columns key and rate."""
    if isinstance(rates, DataFrame):
        pick = [F.max(F.when(F.col("key") == k, F.col("rate"))).alias(name)
                for k, name in ((num, "num"), (den, "den"))]
        row = rates.agg(*pick).first()
        return row["num"] / row["den"]
    return rates[num] / rates[den]


def band_value(key: Column | str, bands: Sequence[Band], factor: float = 1.0, scale: float = 0.01,
               half_open: bool = False) -> Column:
    """Scaled rate of the first band with lo <= key <= hi, else null.

    ``half_open`` lets whole-number bands cover the fractions up to the next one
    (lo <= key < hi + 1). Up to CASE_BANDS bands are a CASE chain inside the
    generated code, more are a binary search over two bounded arrays; neither
    joins or shuffles.
    """
    key = F.col(key) if isinstance(key, str) else key
    divisor = 1 / scale
    whole = abs(divisor - round(divisor)) < 1e-9
    priced = [(lo, hi, rate * factor / round(divisor) if whole else rate * factor * scale)
              for lo, hi, rate in bands]
    if len(priced) > CASE_BANDS:
        return _searched(key, priced, half_open)
    chain = F.lit(None).cast("double")
    for lo, hi, value in reversed(priced):
        inside = (key >= lo) & (key < hi + 1) if half_open else key.between(lo, hi)
        chain = F.when(inside, F.lit(float(value))).otherwise(chain)
    return chain


def _searched(key: Column, bands: Sequence[Band], half_open: bool) -> Column:
    """Look up many bands by bisection over the points where the winning band changes."""
    edges, values, points = _segments(bands, half_open)

    @F.pandas_udf("double")
    def lookup(keys: pd.Series) -> pd.Series:
        k = keys.to_numpy(dtype=float)
        at = np.searchsorted(edges, k, side="right") - 1
        inside = np.where(at >= 0, values[np.maximum(at, 0)], np.nan)
        on = np.minimum(np.searchsorted(edges, k), len(edges) - 1)
        found = np.where(edges[on] == k, points[on], inside)
        return pd.Series(found, dtype="Float64").mask(np.isnan(found) | np.isnan(k))

    return lookup(key.cast("double"))


def _segments(bands: Sequence[Band], half_open: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted edges, the value between each edge and the next, and the value on each edge.

    Earlier bands win, so bands are painted from last to first.
    """
    lo = np.array([b[0] for b in bands], dtype=float)
    hi = np.array([b[1] + 1 if half_open else b[1] for b in bands], dtype=float)
    edges = np.unique(np.concatenate([lo, hi]))
    between = np.full(len(edges), np.nan)
    points = np.full(len(edges), np.nan)
    first = np.searchsorted(edges, lo)
    last = np.searchsorted(edges, hi)
    for i in range(len(bands) - 1, -1, -1):
        between[first[i]:last[i]] = bands[i][2]
        points[first[i]:last[i] + (0 if half_open else 1)] = bands[i][2]
    return edges, between, points


def first_bands(keys: DataFrame, bands: DataFrame, half_open: bool = False) -> DataFrame:
    """(key, rate) for the distinct keys (key) that some band (idx, lo, hi, rate) holds, without a table on the driver.

    Bands become disjoint segments, each with the rate of its first band, and meet the
    keys in sorted order. Missing keys and bands without a beginning or an end are left out.
    Segments are stored, as dealing them by range reads them twice.
    """
    asked = keys.select(F.col("key").cast("double").alias("key")).filter(F.col("key").isNotNull() & ~F.isnan("key")).distinct()
    return as_of(asked, checkpointed(disjoint_segments(bands, half_open)))


def _joined(df: DataFrame, col: str, key: str, bands: DataFrame, half_open: bool) -> tuple[DataFrame, str]:
    """The table with the rate of each row's first band in a new column, for rows with a gap in ``col``.

    Distinct keys of these are looked up; what is found is stored, so the join back meets two plain
    exchanges and Spark splits the rows of a hot key.
    """
    rate = unused(df, "_rate")
    found = checkpointed(first_bands(df.filter(F.col(col).isNull()).select(F.col(key).alias("key")), bands, half_open))
    found = found.select(F.col("key").alias(f"{rate}key"), F.col("rate").alias(rate))
    return df.join(found, F.col(key).cast("double") == F.col(f"{rate}key"), "left").drop(f"{rate}key"), rate


def _scaled(rate: Column, factor: float, scale: float) -> Column:
    divisor = 1 / scale
    return rate * factor / round(divisor) if abs(divisor - round(divisor)) < 1e-9 else rate * factor * scale


def impute_by_band(df: DataFrame, col: str, key: str, bands: DataFrame | Iterable[Sequence[float]],
                   scale: float = 0.01, *, half_open: bool = False, max_bands: int = MAX_BANDS) -> DataFrame:
    """Fill gaps with the scaled rate of the first band holding the key; no band leaves a gap.

    A table of more than ``max_bands`` bands is joined instead of brought to the driver.
    """
    few = _few_bands(bands, max_bands)
    if few is None:
        joined, rate = _joined(df, col, key, bands, half_open)
        filled = F.coalesce(F.col(col), _scaled(F.col(rate), 1.0, scale))
        return joined.select(*[filled.alias(c) if c == col else F.col(c) for c in df.columns])
    value = band_value(key, few, scale=scale, half_open=half_open)
    return df.withColumn(col, F.coalesce(F.col(col), value))


def impute_by_band_and_group(df: DataFrame, col: str, key: str,
                             bands: DataFrame | Iterable[Sequence[float]], group_col: str,
                             factors: Mapping[object, float], scale: float = 0.01, *,
                             half_open: bool = False, max_bands: int = MAX_BANDS) -> DataFrame:
    """As `impute_by_band`, with the rate multiplied by the row's group factor.

    Rows of a group without a factor keep their gap.
    """
    few = _few_bands(bands, max_bands)
    columns = df.columns
    if few is None:
        df, joined = _joined(df, col, key, bands, half_open)
    value = F.lit(None).cast("double")
    for group, factor in factors.items():
        rate = (_scaled(F.col(joined), factor, scale) if few is None
                else band_value(key, few, factor, scale, half_open))
        value = F.when(F.col(group_col) == group, rate).otherwise(value)
    return df.withColumn(col, F.coalesce(F.col(col), value)).select(*columns)
