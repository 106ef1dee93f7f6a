"""Operators from table to table."""

from tablewright.operators import (
    columns,
    enrich,
    evaluate,
    extract,
    features,
    impute,
    missing,
    models,
    outliers,
    quantiles,
    split,
    statistics,
)

__all__ = [
    "columns", "enrich", "evaluate", "extract", "features", "impute", "missing", "models",
    "outliers", "quantiles", "split", "statistics",
]
