"""Aggregates and column profiles.

Results in long form have one row per column (or per column and value).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.comoments import correlation_blocks
from tablewright.operators.quantiles import exact_quantiles

PAIRS_PER_PASS = 60

_SIMPLE = {
    "n": F.count,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "std": F.stddev,
    "std_pop": F.stddev_pop,
}


def statistics(df: DataFrame, spec: Mapping[str, Sequence[str]]) -> dict[str, dict]:
    """Literals per column: ``{"a": ["mean", "min"]}`` gives ``{"a": {"mean": .., "min": ..}}``.

    All means, extremes and deviations come from one aggregate over the table,
    all modes from one grouped job, all medians from one quantile search.
    """
    out: dict[str, dict] = {c: {} for c in spec}
    simple = [(c, s) for c, names in spec.items() for s in names if s in _SIMPLE]
    if simple:
        row = df.agg(*[_SIMPLE[s](c).alias(f"{s}:{c}") for c, s in simple]).first()
        for c, s in simple:
            out[c][s] = row[f"{s}:{c}"]
    mode_cols = [c for c, names in spec.items() if "mode" in names]
    if mode_cols:
        for c, value in modes(df, mode_cols).items():
            out[c]["mode"] = value
    median_cols = [c for c, names in spec.items() if "median" in names]
    if median_cols:
        for c, values in exact_quantiles(df, {c: [0.5] for c in median_cols}).items():
            out[c]["median"] = values[0]
    return out


def column_means(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, mean)"""
    wide = df.agg(*[F.avg(c).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column", "mean")


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value) over all given columns, in a type that holds them all."""
    types = {df.schema[c].dataType for c in cols}
    if len(types) == 1:
        shared = next(iter(types))
    elif all(isinstance(t, T.NumericType) for t in types):
        shared = T.DoubleType()
    else:
        shared = T.StringType()
    cast = df.select(*[F.col(c).cast(shared).alias(c) for c in cols])
    return cast.unpivot([], list(cols), "column", "value")


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n), missing values left out; the shuffle carries distinct values only."""
    counted = _long(df, cols).filter(F.col("value").isNotNull()).groupBy("column", "value")
    return counted.agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(df: DataFrame, cols: Sequence[str], *, exact: bool = True) -> DataFrame:
    """(column, n_distinct), missing values left out; sketched when not exact."""
    if exact:
        return value_counts(df, cols).groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
    wide = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column", "n_distinct")


def column_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, mode, n): the most frequent value, the lowest one on a tie.

    Values are counted with pre-aggregation, so no task holds a column. The
    highest counts, one per column, then filter the counted values; both steps
    hash and stream, where a minimum over (count, value) pairs would sort.
    """
    counted = value_counts(df, cols)
    highest = counted.groupBy("column").agg(F.max("n").alias("n"))
    return (counted.join(F.broadcast(highest), ["column", "n"])
            .groupBy("column").agg(F.min("value").alias("mode"), F.first("n").alias("n")))


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, object]:
    """Modes as literals, in each column's own type; None for a column without values."""
    found: dict[str, object] = dict.fromkeys(cols)
    by_type: dict[T.DataType, list[str]] = {}
    for c in cols:
        by_type.setdefault(df.schema[c].dataType, []).append(c)
    for group in by_type.values():
        found.update({r["column"]: r["mode"] for r in column_modes(df, group).collect()})
    return found


def column_medians(df: DataFrame, cols: Sequence[str], *, exact: bool = True) -> DataFrame:
    """(column, median); approximate medians come from one sketching aggregate."""
    if not exact:
        wide = df.agg(*[F.percentile_approx(c, 0.5).cast("double").alias(c) for c in cols])
        return wide.unpivot([], list(cols), "column", "median")
    found = exact_quantiles(df, {c: [0.5] for c in cols})
    return df.sparkSession.createDataFrame([(c, found[c][0]) for c in cols],
                                           "column string, median double")


def label_counts(df: DataFrame, label: str) -> DataFrame:
    """(label column, n)"""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_balance(df: DataFrame, label: str, split: str | None = None) -> DataFrame:
    """(label, n, proportion); with a split column, proportions within each split."""
    if split is None:
        counts = label_counts(df, label)
        total = counts.agg(F.sum("n")).scalar()
        return counts.withColumn("proportion", F.col("n") / total)
    counts = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(split).agg(F.sum("n").alias("_total"))
    # Both sides hold one row per class, not per input row.
    return (counts.join(totals, counts[split].eqNullSafe(totals[split])).drop(totals[split])
            .select(split, label, "n", (F.col("n") / F.col("_total")).alias("proportion")))


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 20,
              extremes: Mapping[str, tuple] | None = None) -> DataFrame:
    """(column, bin, lo, hi, n): equal-width bins, empty ones included.

    The last bin is closed; a constant column gets a unit range around its value.
    ``extremes`` are the columns' (min, max) where they are already known.
    """
    if extremes is None:
        found = statistics(df, {c: ["min", "max"] for c in cols})
        extremes = {c: (found[c]["min"], found[c]["max"]) for c in cols}
    ranges: dict[str, tuple[float, float]] = {}
    for c in cols:
        lo, hi = extremes[c]
        if lo is not None:
            ranges[c] = (lo - 0.5, hi + 0.5) if lo == hi else (float(lo), float(hi))
    spark = df.sparkSession
    grid = spark.createDataFrame(
        [(c, b, lo + (hi - lo) * b / bins, lo + (hi - lo) * (b + 1) / bins)
         for c, (lo, hi) in ranges.items() for b in range(bins)],
        "column string, bin int, lo double, hi double")
    if not ranges:
        return grid.withColumn("n", F.lit(0).cast("long"))

    def bin_of(c: str) -> Column:
        lo, hi = ranges[c]
        at = F.floor((F.col(c).cast("double") - lo) / (hi - lo) * bins)
        # least() skips nulls, so a missing value needs its own test.
        return F.when(at.isNotNull(), F.least(at, F.lit(bins - 1))).cast("int").alias(c)

    binned = df.select(*[bin_of(c) for c in ranges]).unpivot([], list(ranges), "column", "bin")
    counts = (binned.filter(F.col("bin").isNotNull())
              .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n")))
    # At most one row per column and bin on either side.
    return (grid.join(F.broadcast(counts), ["column", "bin"], "left")
            .select("column", "bin", "lo", "hi", F.coalesce("n", F.lit(0)).alias("n")))


def describe_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, mean, std, min, max, skew); std and skew are sample estimates."""
    parts = []
    for c in cols:
        n = F.count(c).cast("double")
        skew = F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2)
        parts.append(F.struct(
            F.lit(c).alias("column"),
            F.avg(c).alias("mean"),
            F.stddev(c).alias("std"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
            F.when(n > 2, skew).alias("skew"),
        ))
    return df.agg(F.array(*parts).alias("rows")).select(F.inline("rows"))


def correlation_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, corr) for every pair, over rows where both are present, however many columns there are.

    Up to PAIRS_PER_PASS pairs are one aggregate; more are added up by blocks of columns
    in two scans.
    """
    pairs = list(combinations(cols, 2))
    if not pairs:
        return df.sparkSession.createDataFrame([], "a string, b string, corr double")
    if len(pairs) > PAIRS_PER_PASS:
        return correlation_blocks(df, cols)
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(a, b).alias("corr")) for a, b in pairs])
    return df.agg(rows.alias("rows")).select(F.inline("rows"))


def box_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, min, q1, median, q3, max)"""
    found = exact_quantiles(df, {c: [0.0, 0.25, 0.5, 0.75, 1.0] for c in cols})
    return df.sparkSession.createDataFrame(
        [(c, *found[c]) for c in cols],
        "column string, min double, q1 double, median double, q3 double, max double")
