"""Table scans, schema binding, views and sinks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.sources.schemas import BANDS


def _format_of(path: str, fmt: str | None) -> str:
    return fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str | None = None, *, strict: bool = True, **options) -> DataFrame:
    """Scan a headed CSV or a parquet table and bind it to a schema by name.

    CSV columns are read as text under their header names, so a file whose
    columns are in another order binds right; the casts fuse into the scan's
    projection and unread columns are pruned.
    """
    fmt = _format_of(path, fmt)
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    df = reader.format(fmt).options(**options).load(path)
    return df if schema is None else bind_schema(df, schema, strict=strict)


def bind_schema(df: DataFrame, schema: T.StructType, *, strict: bool = True) -> DataFrame:
    """Select and cast the schema's columns by name.

    Text that is no value of the type fails, or becomes null when not ``strict``.
    """
    require_columns(df, schema.names)

    def bound(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if df.schema[field.name].dataType != field.dataType:
            c = c.cast(field.dataType) if strict else c.try_cast(field.dataType)
        return c.alias(field.name)

    return df.select(*[bound(field) for field in schema])


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a temporary view and return it as read through SQL."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def write_table(df: DataFrame, path: str, fmt: str | None = None, mode: str = "overwrite") -> None:
    """Write one file per partition, with a header for CSV; rows never pass through the driver."""
    writer = df.write.mode(mode)
    fmt = _format_of(path, fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(fmt).save(path)


def head_rows(df: DataFrame, n: int, order_by: str | Column | Sequence[str | Column]) -> DataFrame:
    """The first n rows under an explicit order, as a distributed top-n."""
    order = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    return df.orderBy(*order).limit(n)


def bands(spark: SparkSession, rows: Iterable[Sequence[float]]) -> DataFrame:
    """A band table (idx, lo, hi, rate); idx keeps the list order, where the first match wins."""
    data = [(i, float(lo), float(hi), float(rate)) for i, (lo, hi, rate) in enumerate(rows)]
    return spark.createDataFrame(data, BANDS)


def require_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Fail while planning, without a job, when a column is absent."""
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df
