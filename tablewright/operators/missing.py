"""Missing values: one marker at ingest, then profiling and dropping."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import values as V


def normalize_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NaN in float columns and blank text become null, the only marker afterwards; in all columns or ``cols``."""
    def clean(field: T.StructField):
        if cols is not None and field.name not in cols:
            return F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return V.nan_to_null(field.name).alias(field.name)
        if isinstance(field.dataType, T.StringType):
            return V.blank_to_null(field.name).alias(field.name)
        return F.col(field.name)

    return df.select(*[clean(field) for field in df.schema])


def blank_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Blank text becomes null; to be applied before a column is cast."""
    return df.withColumns({c: V.blank_to_null(c) for c in cols})


def drop_all_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with every column missing.

    Apply it before columns are computed: over many computed columns the
    predicate is pushed through their expressions and takes long to plan.
    """
    return df.na.drop("all", subset=list(cols) if cols else None)


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, n_missing, fraction) from one pass over the table."""
    cols = list(cols or df.columns)
    total = F.count(F.lit(1)).alias("_rows")
    wide = df.agg(total, *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    rows = F.array(*[F.struct(
        F.lit(c).alias("column"),
        F.col(c).alias("n_missing"),
        F.try_divide(F.col(c).cast("double"), F.col("_rows")).alias("fraction"),
    ) for c in cols])
    return wide.select(F.inline(rows))


def sparse_columns(df: DataFrame, threshold: float = 0.12, protect: Iterable[str] = ()) -> list[str]:
    protected = set(protect)
    profile = missing_profile(df, [c for c in df.columns if c not in protected])
    return [r["column"] for r in profile.filter(F.col("fraction") > threshold).collect()]


def drop_sparse(df: DataFrame, threshold: float = 0.12, protect: Iterable[str] = ()) -> DataFrame:
    """Drop columns whose missing share exceeds the threshold; the label can be protected."""
    return df.drop(*sparse_columns(df, threshold, protect))
