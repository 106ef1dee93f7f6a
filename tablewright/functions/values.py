"""Expressions over plain values: missing markers, predicates and hashes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c: Column | str) -> Column:
    """True where the value is null, the only missing marker after ingest."""
    return as_column(c).isNull()


def nan_to_null(c: Column | str) -> Column:
    return F.nanvl(as_column(c), F.lit(None))


def blank_to_null(c: Column | str) -> Column:
    """Empty or whitespace-only text becomes null; other text is kept as it is."""
    c = as_column(c)
    return F.when(F.trim(c) != "", c)


def in_range(c: Column | str, lo, hi) -> Column:
    """Inclusive on both ends; either bound may be None for an open side."""
    c = as_column(c)
    if lo is not None and hi is not None:
        return c.between(lo, hi)
    if lo is None and hi is None:
        return c.isNotNull()
    return c >= lo if hi is None else c <= hi


def differs(c: Column | str, value) -> Column:
    """Not equal, where a missing value counts as different and is kept."""
    return ~as_column(c).eqNullSafe(value)


def none_of(c: Column | str, values: Iterable) -> Column:
    """Outside a value set, keeping missing values."""
    c = as_column(c)
    return c.isNull() | ~c.isin(list(values))


def percent_to_fraction(c: Column | str) -> Column:
    return as_column(c) / 100


def hash_hex(key: Sequence[str] | str, seed: int) -> Column:
    """The first 32 bits of md5("seed|key|...") as eight hexadecimal digits.

    It depends on the row's key alone, so it survives repartitioning, retries
    and other engines, unlike a seeded random column. The digits sort as the
    number does, which spares comparisons the conversion. Of several columns each part
    has its length in front, and a missing one is marked, so different keys have
    different texts.
    """
    key = [key] if isinstance(key, str) else list(key)
    parts = [F.col(k).cast("string") for k in key]
    if len(parts) > 1:
        parts = [F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)), 1, 8)


def hash32(key: Sequence[str] | str, seed: int) -> Column:
    """`hash_hex` as a non-negative long."""
    return F.conv(hash_hex(key, seed), 16, 10).cast("long")


def hash_unit(key: Sequence[str] | str, seed: int) -> Column:
    """`hash32` scaled to [0, 1)."""
    return hash32(key, seed) / F.lit(4294967296.0)


def fold_of(key: Sequence[str] | str, folds: int, seed: int) -> Column:
    """A fold number in [0, folds) fixed by the row's key."""
    return (hash32(key, seed) % folds).cast("int")
