"""Column expressions shared by the operators."""

from tablewright.functions.html import (
    elements,
    has_open_end,
    nth_text,
    parse_band,
    parse_percent,
    text_of,
    without_scripts,
)
from tablewright.functions.values import (
    blank_to_null,
    differs,
    fold_of,
    hash32,
    hash_hex,
    hash_unit,
    in_range,
    is_missing,
    nan_to_null,
    none_of,
    percent_to_fraction,
)

__all__ = [
    "blank_to_null", "differs", "elements", "fold_of", "has_open_end", "hash32", "hash_hex",
    "hash_unit", "in_range", "is_missing", "nan_to_null", "none_of", "nth_text", "parse_band", "parse_percent",
    "percent_to_fraction", "text_of", "without_scripts",
]
