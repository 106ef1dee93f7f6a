"""Reading, binding and writing tables and models."""

from tablewright.sources.models import load_model, save_model
from tablewright.sources.schemas import (
    BANDS,
    CLEANED,
    FEATURES,
    MERGED,
    RAW,
    STATISTICAL_CATEGORICAL,
    STATISTICAL_NUMERICAL,
)
from tablewright.sources.tables import (
    as_view,
    bands,
    bind_schema,
    head_rows,
    read_table,
    require_columns,
    write_table,
)

__all__ = [
    "BANDS", "CLEANED", "FEATURES", "MERGED", "RAW", "STATISTICAL_CATEGORICAL",
    "STATISTICAL_NUMERICAL", "as_view", "bands", "bind_schema", "head_rows", "load_model",
    "read_table", "require_columns", "save_model", "write_table",
]
