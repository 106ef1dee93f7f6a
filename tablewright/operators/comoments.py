"""Correlations of all pairs of many columns from one scan.

Columns are cut into blocks. Each task adds up the masked products of every pair of blocks,
and the sums of the tasks meet by pair of blocks, so no place holds more than a block's.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns per block.
BLOCK = 64
#: Numbers that a task may add up in one scan (8 bytes each): 3,000 columns; more columns take further scans.
SUMS_PER_SCAN = 1 << 25
_SUMS = 7
_CELLS = 1 << 20
#: A variance below this share of the mean square is rounding: the column is constant there.
_ROUNDING = 64 * np.finfo(float).eps


class _Block:
    """Some rows of a block of columns: values (0 where missing), their squares, what is there, what is no finite number."""

    def __init__(self, columns: list[pa.Array], center: np.ndarray, scale: np.ndarray):
        self.there = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in columns]).astype(float)
        raw = np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns])
        good = np.isfinite(raw)
        self.value = np.where(good, (np.where(good, raw, 0.0) - center) / scale, 0.0)
        self.square = self.value * self.value
        self.odd = np.where(good, 0.0, self.there)
        self.full, self.any_odd = bool(self.there.all()), bool(self.odd.any())


def _product(left: np.ndarray, right: np.ndarray, right_full: bool) -> np.ndarray:
    """left' right, where right may be known to be all ones."""
    return np.repeat(left.sum(0)[:, None], right.shape[1], 1) if right_full else left.T @ right


def _sums(a: _Block, b: _Block) -> np.ndarray:
    """Per pair of columns, over rows that have both: count, sums, sums of squares, product, odd values."""
    return np.stack([
        _product(a.there, b.there, b.full), _product(a.value, b.there, b.full), _product(b.value, a.there, a.full).T,
        _product(a.square, b.there, b.full), _product(b.square, a.there, a.full).T, a.value.T @ b.value,
        _product(a.odd, b.there, b.full) + _product(b.odd, a.there, a.full).T if a.any_odd or b.any_odd
        else np.zeros((a.value.shape[1], b.value.shape[1])),
    ])


def _range_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per column: how many finite numbers, their sum and the largest size."""
    n = total = most = None
    for batch in batches:
        if n is None:
            n, total, most = (np.zeros(batch.num_columns) for _ in range(3))
        for k, column in enumerate(batch.columns):
            raw = column.to_numpy(zero_copy_only=False)
            good = raw[np.isfinite(raw)]
            if len(good):
                n[k] += len(good)
                total[k] += good.sum()
                most[k] = max(most[k], np.abs(good).max())
    if n is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n))), pa.array(n), pa.array(total), pa.array(most)], ["k", "n", "total", "most"])


def _sum_batches(pairs: Sequence[tuple[int, int]], spans: dict[int, slice], center: np.ndarray, scale: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for whole in batches:
            step = max(1, _CELLS // whole.num_columns)
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                blocks = {i: _Block(batch.columns[s], center[s], scale[s]) for i, s in spans.items()}
                for i, j in pairs:
                    found = _sums(blocks[i], blocks[j])
                    totals[i, j] = totals[i, j] + found if (i, j) in totals else found
        for (i, j), sums in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([sums.ravel()], pa.list_(pa.float64()))],
                ["i", "j", "sums"])

    return run


def correlations(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Correlation per pair of columns of two blocks, and where it is defined."""
    n, a, b, aa, bb, ab, odd = sums
    n = np.round(n)
    with np.errstate(all="ignore"):
        spread_a, spread_b = n * aa - a * a, n * bb - b * b
        flat = (spread_a <= _ROUNDING * n * aa) | (spread_b <= _ROUNDING * n * bb)
        corr = np.clip((n * ab - a * b) / np.sqrt(spread_a * spread_b), -1.0, 1.0)
    strange = odd > 0.5
    return np.where(strange, np.nan, corr), (n > 1) & (strange | ~flat)


def _pair_batches(names: Sequence[str], block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, sums in zip(*[c.to_pylist() for c in batch.columns]):
                first, second = names[i * block:(i + 1) * block], names[j * block:(j + 1) * block]
                corr, defined = correlations(np.array(sums).reshape(_SUMS, len(first), len(second)))
                x, y = np.triu_indices(len(first), 1) if i == j else (v.ravel() for v in np.indices(corr.shape))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([first[k] for k in x]), pa.array([second[k] for k in y]), pa.array(corr[x, y], mask=~defined[x, y])],
                    ["a", "b", "corr"])

    return run


def correlation_blocks(df: DataFrame, cols: Sequence[str], block: int = BLOCK, sums_per_scan: int = SUMS_PER_SCAN) -> DataFrame:
    """(a, b, corr) for every pair of columns, over the rows that have both.

    A first scan finds means and the largest sizes, about and in terms of which a second one
    adds up; both are of fixed number up to thousands of columns. As with ``corr``, a pair is null where fewer than
    two rows have both or one column does not vary there, and NaN where a value is NaN
    or infinite.
    """
    cols = list(cols)
    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(cols)])
    ranges = (numbers.mapInArrow(_range_batches, "k long, n double, total double, most double")
              .groupBy("k").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("most").alias("most")).collect())
    center, scale = np.zeros(len(cols)), np.ones(len(cols))
    for r in ranges:
        if r["n"] and r["most"]:
            center[r["k"]], scale[r["k"]] = r["total"] / r["n"], r["most"]

    pairs = list(combinations_with_replacement(range(-(-len(cols) // block)), 2))
    at_once = max(1, sums_per_scan // (_SUMS * block * block))
    sums = None
    for start in range(0, len(pairs), at_once):
        some = pairs[start:start + at_once]
        used = sorted({i for pair in some for i in pair})
        wanted, spans = [], {}
        for i in used:
            at = range(i * block, min((i + 1) * block, len(cols)))
            spans[i] = slice(len(wanted), len(wanted) + len(at))
            wanted += at
        part = numbers.select(*[f"c{k}" for k in wanted]).mapInArrow(
            _sum_batches(some, spans, center[wanted], scale[wanted]), "i int, j int, sums array<double>")
        sums = part if sums is None else sums.unionByName(part)
    # A pair of blocks of which no row was seen has sums of nothing.
    width = {i: min(block, len(cols) - i * block) for i in range(-(-len(cols) // block))}
    none = df.sparkSession.createDataFrame([(i, j, _SUMS * width[i] * width[j]) for i, j in pairs], "i int, j int, size int")
    sums = sums.unionByName(none.select("i", "j", F.array_repeat(F.lit(0.0), F.col("size")).alias("sums")))
    merged = (sums.groupBy("i", "j").agg(Summarizer.sum(array_to_vector("sums")).alias("sums"))
              .select("i", "j", vector_to_array("sums").alias("sums")))
    return merged.mapInArrow(_pair_batches(cols, block), "a string, b string, corr double")
