"""Operators for preparing language-model training data, and the queries that run them.

Nothing else in the library imports this subpackage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL where there is one."""
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def load_all() -> None:
    from tablewright.llm import (  # noqa: F401
        exact_dedup,
        host_rules,
        line_runs,
        mixing_tree,
        packing,
        phrases,
        pu_quality,
        simhash_index,
        spelling_variants,
        surrogates,
        text_density,
        toxicity,
        unit_dedup,
    )
