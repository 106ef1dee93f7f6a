"""Exact order statistics without gathering a column in one place.

Spark's exact percentile keeps every distinct value of a column in one buffer.
Here a sketch proposes a narrow bracket around each wanted rank, a counting
pass proves which side of the bracket the rank lies on, and the bracket shrinks
by orders of magnitude per pass until the few rows left can be ranked. The
counts, not the sketch, decide, so a poor sketch costs passes and not accuracy.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

SKETCH_ACCURACY = 10_000
SMALL_COLUMN = 200_000
RANKED_ROWS = 200_000


@dataclass
class _Slot:
    """One wanted rank, the bracket known to hold it and how many rows lie below."""

    id: int
    col: str
    rank: int
    below: int
    inside: int
    lo: float | None = None
    hi: float | None = None
    lo_open: bool = False
    hi_open: bool = False
    value: float | None = None
    cuts: tuple[float, float] | None = None
    stuck: bool = False

    def holds(self) -> Column:
        c = F.col(self.col)
        test = c.isNotNull()
        if self.lo is not None:
            test = test & ((c > self.lo) if self.lo_open else (c >= self.lo))
        if self.hi is not None:
            test = test & ((c < self.hi) if self.hi_open else (c <= self.hi))
        return test

    def settle(self, under: int, upto: int) -> None:
        """Keep the part of the bracket that holds the rank."""
        a, b = self.cuts
        k, before = self.rank - self.below, self.inside
        if k < under:
            self.inside, self.hi, self.hi_open = under, a, True
        elif k < upto:
            self.below, self.inside = self.below + under, upto - under
            self.lo, self.lo_open, self.hi, self.hi_open = a, False, b, False
            if a == b:
                self.value = a
        else:
            self.below, self.inside = self.below + upto, self.inside - upto
            self.lo, self.lo_open = b, True
        # Both cuts on the bracket's ends: the next round cuts at one value, which always gains.
        self.stuck = self.value is None and self.inside == before


def _number(c: str) -> Column:
    return F.nanvl(F.col(c).cast("double"), F.lit(None))


def quantile_head(probs: Mapping[str, Sequence[float]]) -> list[Column]:
    """Aggregates of the search's first pass: the count of each column and the first brackets.

    They can be part of a wider aggregate, whose row `exact_quantiles` then takes as ``head``.
    """
    return [e for c, shares in probs.items() for e in (
        F.count(_number(c)).alias(f"n:{c}"),
        F.percentile_approx(_number(c), _literals([x for p in shares for x in _around(p)]), SKETCH_ACCURACY).alias(f"cuts:{c}"))]


def exact_quantiles(df: DataFrame, probs: Mapping[str, Sequence[float]], *,
                    small: int = SMALL_COLUMN, ranked: int = RANKED_ROWS, head: Row | None = None,
                    ) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation, as ``{column: [value per probability]}``.

    Missing values, null or NaN, are ignored; a column without values gives None.
    ``small`` is the row count up to which Spark's own percentile is used, ``ranked`` the
    number of bracket rows that may be ranked directly; neither changes a result.
    """
    cols = list(probs)
    if not cols:
        return {}
    head = df.agg(*quantile_head(probs)).first() if head is None else head
    df = df.select(*[_number(c).alias(c) for c in cols])
    counts = {c: head[f"n:{c}"] for c in cols}
    if max(counts.values()) <= small:
        row = df.agg(*[F.percentile(c, _literals(probs[c])).alias(c) for c in cols]).first()
        return {c: list(row[c]) if row[c] is not None else [None] * len(probs[c]) for c in cols}

    slots: dict[tuple[str, int], _Slot] = {}
    for c in cols:
        for i, p in enumerate(probs[c]):
            for rank in _ranks(p, counts[c]):
                cuts = tuple(head[f"cuts:{c}"][2 * i:2 * i + 2])
                slots.setdefault((c, rank), _Slot(len(slots), c, rank, 0, counts[c], cuts=cuts))
    slots = list(slots.values())
    pending = [s for s in slots if s.inside > ranked]
    while pending:
        _count(df, pending)
        pending = [s for s in pending if s.value is None and s.inside > ranked]
        if pending:
            _propose(df, pending)
    _rank(df, [s for s in slots if s.value is None])
    found = {(s.col, s.rank): s.value for s in slots}

    def interpolated(c: str, p: float) -> float | None:
        if not counts[c]:
            return None
        lower, upper = _ranks(p, counts[c])
        if found[c, lower] == found[c, upper]:
            return found[c, lower]  # also where both are infinite
        part = p * (counts[c] - 1) - lower
        return found[c, lower] * (1 - part) + found[c, upper] * part

    return {c: [interpolated(c, p) for p in probs[c]] for c in cols}


def _literals(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _around(p: float) -> list[float]:
    """Shares a little below and above p, wider than the sketch's error."""
    margin = 2 / SKETCH_ACCURACY
    return [max(0.0, p - margin), min(1.0, p + margin)]


def _ranks(p: float, n: int) -> tuple[int, ...]:
    if not n:
        return ()
    at = p * (n - 1)
    return math.floor(at), math.ceil(at)


def _propose(df: DataFrame, slots: list[_Slot]) -> None:
    def cut(s: _Slot) -> Column:
        shares = _around((s.rank - s.below + 0.5) / s.inside)
        return F.percentile_approx(F.when(s.holds(), F.col(s.col)), _literals(shares),
                                   SKETCH_ACCURACY).alias(str(s.id))

    row = df.agg(*[cut(s) for s in slots]).first()
    for s in slots:
        a, b = row[str(s.id)]
        s.cuts = (a, a) if s.stuck else (a, b)


def _count(df: DataFrame, slots: list[_Slot]) -> None:
    sums = []
    for s in slots:
        a, b = s.cuts
        sums.append(F.count_if(s.holds() & (F.col(s.col) < a)).alias(f"u{s.id}"))
        sums.append(F.count_if(s.holds() & (F.col(s.col) <= b)).alias(f"v{s.id}"))
    row = df.agg(*sums).first()
    for s in slots:
        s.settle(row[f"u{s.id}"], row[f"v{s.id}"])


def _rank(df: DataFrame, slots: list[_Slot]) -> None:
    """Rank the rows of every remaining bracket; each holds at most ``ranked`` rows."""
    if not slots:
        return
    hits = F.array(*[F.when(s.holds(), F.struct(
        F.lit(s.id).alias("slot"), F.col(s.col).alias("value"))) for s in slots])
    counted = (df.select(F.inline(F.filter(hits, lambda h: h.isNotNull())))
               .groupBy("slot", "value").count())
    order = Window.partitionBy("slot").orderBy("value")
    running = F.sum("count").over(order.rowsBetween(Window.unboundedPreceding, 0))
    target = F.create_map(*[F.lit(x) for s in slots for x in (s.id, s.rank - s.below)])
    rows = (counted.withColumn("upto", running)
            .filter(F.col("upto") > target[F.col("slot")])
            .groupBy("slot").agg(F.min("value").alias("value")).collect())
    values = {r["slot"]: r["value"] for r in rows}
    for s in slots:
        s.value = values[s.id]
