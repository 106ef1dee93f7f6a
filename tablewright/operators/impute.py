"""Filling gaps and repairing values with statistics of the table.

Every ``fit_*`` runs its statistics once and returns a small model of literals;
its ``transform`` is a narrow projection, so a model fitted on one table can be
applied to another.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import Imputer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.values import in_range
from tablewright.operators.statistics import modes, statistics


@dataclass(frozen=True)
class Surrogates:
    """Fill values per column; a column without a fill value is left as it is."""

    values: Mapping[str, object]
    order: Sequence[str] = field(default=())

    def transform(self, df: DataFrame) -> DataFrame:
        filled = df.withColumns({c: F.coalesce(F.col(c), F.lit(v))
                                 for c, v in self.values.items() if v is not None})
        return filled.select(*self.order) if self.order else filled


def _fit(df: DataFrame, cols: Sequence[str], statistic: str) -> Surrogates:
    found = statistics(df, {c: [statistic] for c in cols})
    return Surrogates({c: found[c][statistic] for c in cols})


def fit_mean(df: DataFrame, cols: Sequence[str]) -> Surrogates:
    return _fit(df, cols, "mean")


def fit_median(df: DataFrame, cols: Sequence[str]) -> Surrogates:
    return _fit(df, cols, "median")


def fit_mode(df: DataFrame, cols: Sequence[str]) -> Surrogates:
    return _fit(df, cols, "mode")


def fit_groups(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> Surrogates:
    """Median for numeric and mode for categorical columns, in that column order."""
    found = statistics(df, {**{c: ["median"] for c in numeric}, **{c: ["mode"] for c in categorical}})
    values = {c: next(iter(s.values())) for c, s in found.items()}
    return Surrogates(values, [*numeric, *categorical])


def impute_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return fit_mean(df, cols).transform(df)


def impute_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return fit_median(df, cols).transform(df)


def impute_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return fit_mode(df, cols).transform(df)


def impute_groups(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    return fit_groups(df, numeric, categorical).transform(df)


def fit_imputer(cols: Sequence[str], strategy: str = "mean") -> Imputer:
    """Spark ML's imputer as a pipeline stage, writing back to its input columns."""
    return Imputer(inputCols=list(cols), outputCols=list(cols), strategy=strategy)


@dataclass(frozen=True)
class RangeRepair:
    """Replaces out-of-range values, and missing ones if asked, by a mean per column."""

    ranges: Mapping[str, tuple]
    means: Mapping[str, float | None]
    fill_missing: bool = False

    def transform(self, df: DataFrame) -> DataFrame:
        def repaired(c: str) -> Column:
            wrong = ~in_range(c, *self.ranges[c])
            if self.fill_missing:
                wrong = F.col(c).isNull() | wrong
            return F.when(wrong, F.lit(self.means[c])).otherwise(F.col(c))

        return df.withColumns({c: repaired(c) for c in self.ranges})


def fit_range_repair(df: DataFrame, ranges: Mapping[str, tuple], surrogate: str = "valid", *,
                     fill_missing: bool = False) -> RangeRepair:
    """``ranges`` maps a column to (lo, hi), inclusive, None for an open side.

    The surrogate is the mean of the in-range values ("valid") or of all
    observed ones ("observed"); one aggregate serves all columns.
    """
    if surrogate not in ("valid", "observed"):
        raise ValueError(f"unknown surrogate {surrogate!r}")

    def source(c: str) -> Column:
        return F.when(in_range(c, *ranges[c]), F.col(c)) if surrogate == "valid" else F.col(c)

    row = df.agg(*[F.avg(source(c)).alias(c) for c in ranges]).first()
    return RangeRepair(dict(ranges), row.asDict(), fill_missing)


def repair_range(df: DataFrame, col: str, lo=None, hi=None, surrogate: str = "valid", *,
                 fill_missing: bool = False) -> DataFrame:
    fitted = fit_range_repair(df, {col: (lo, hi)}, surrogate, fill_missing=fill_missing)
    return fitted.transform(df)


@dataclass(frozen=True)
class DomainRepair:
    """Replaces missing values and codes above the domain by the column's mode."""

    modes: Mapping[str, object]
    max_valid: float

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            c: F.when(F.col(c).isNull() | (F.col(c) > self.max_valid), F.lit(mode)).otherwise(F.col(c))
            for c, mode in self.modes.items()
        })


def fit_domain_repair(df: DataFrame, cols: Sequence[str], max_valid: float = 1) -> DomainRepair:
    """The mode is taken over all present values, before anything is repaired."""
    return DomainRepair(modes(df, cols), max_valid)


def repair_domain_mode(df: DataFrame, cols: Sequence[str], max_valid: float = 1) -> DataFrame:
    return fit_domain_repair(df, cols, max_valid).transform(df)
