"""Projections, predicates and row filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.values import differs, none_of
from tablewright.sources.tables import require_columns


def keep_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return require_columns(df, cols).select(*cols)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def cast_columns(df: DataFrame, cols: Sequence[str], type_: str = "double", *,
                 lenient: bool = False) -> DataFrame:
    """Cast many columns in one projection; lenient turns unreadable text into null."""
    cast = {c: F.col(c).try_cast(type_) if lenient else F.col(c).cast(type_) for c in cols}
    return require_columns(df, cols).withColumns(cast)


def interaction(df: DataFrame, a: str, b: str, out: str | None = None) -> DataFrame:
    """Add the product of two columns, named "<a>x<b>" unless given."""
    return df.withColumn(out or f"{a}x{b}", F.col(a) * F.col(b))


def replace_when(df: DataFrame, col: str, predicate: Column, value) -> DataFrame:
    """Overwrite a column where the predicate holds; where it is false or null, keep it."""
    return df.withColumn(col, F.when(predicate, value).otherwise(F.col(col)))


def filter_ne(df: DataFrame, col: str, value) -> DataFrame:
    """Drop rows equal to a value; rows missing the value stay."""
    return df.filter(differs(col, value))


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == value)


def filter_not_in(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """Drop rows in a value set; rows missing the value stay."""
    return df.filter(none_of(col, values))


def split_xy(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Feature table (all columns but the label) and label table."""
    require_columns(df, [label])
    return df.select(*feature_names(df, label)), df.select(label)


def feature_names(df: DataFrame, label: str, exclude: Iterable[str] = ()) -> list[str]:
    left_out = {label, *exclude}
    return [c for c in df.columns if c not in left_out]


def row_counts(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """Total (column ``n``) and conditional row counts in one aggregate."""
    counts = [F.count_if(p).alias(name) for name, p in predicates.items()]
    return df.agg(F.count(F.lit(1)).alias("n"), *counts)
