"""Scaling, encoding and assembling features."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import (
    MinMaxScaler,
    OneHotEncoder,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.ranks import checkpointed, unused, with_rank
from tablewright.operators.statistics import statistics, value_counts

#: Levels of an index that the driver holds and ships to every task; beyond, the index is a table that is joined.
MAX_INDEXED = 1_000_000


@dataclass(frozen=True)
class LinearScale:
    """(value - shift) / scale per column; a constant column becomes 0."""

    parameters: Mapping[str, tuple[float | None, float | None]]

    def transform(self, df: DataFrame) -> DataFrame:
        def scaled(c: str) -> Column:
            shift, scale = self.parameters[c]
            if not scale:
                return F.when(F.col(c).isNotNull(), F.lit(0.0))
            return (F.col(c) - F.lit(shift)) / F.lit(scale)

        return df.withColumns({c: scaled(c) for c in self.parameters})


    def applied(self, c: str, value: float | None) -> float | None:
        """One value through a column's scale, as transform computes it."""
        shift, scale = self.parameters.get(c, (0.0, None))
        if value is None or c not in self.parameters:
            return value
        return (value - shift) / scale if scale else 0.0


def fit_standardize(df: DataFrame, cols: Sequence[str]) -> LinearScale:
    found = statistics(df, {c: ["mean", "std_pop"] for c in cols})
    return LinearScale({c: (found[c]["mean"], found[c]["std_pop"]) for c in cols})


def fit_min_max(df: DataFrame, cols: Sequence[str]) -> LinearScale:
    found = statistics(df, {c: ["min", "max"] for c in cols})

    def span(s: Mapping) -> tuple[float | None, float | None]:
        return s["min"], None if s["min"] is None else float(s["max"] - s["min"])

    return LinearScale({c: span(found[c]) for c in cols})


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """z-scores with the population standard deviation."""
    return fit_standardize(df, cols).transform(df)


def min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Scale to [0, 1] per column."""
    return fit_min_max(df, cols).transform(df)


def level_name(col: str, value) -> str:
    """Name of a dummy column: "<column>_<value>", whole numbers without a fraction."""
    if isinstance(value, float) and value.is_integer():
        value = int(value)
    return f"{col}_{re.sub(r'[^0-9A-Za-z]+', '_', str(value)).strip('_')}"


@dataclass(frozen=True)
class OneHot:
    """One 0/1 column per level seen when fitted; missing values give zeros only."""

    levels: Mapping[str, Sequence]

    def transform(self, df: DataFrame) -> DataFrame:
        dummies = [F.when(F.col(c) == F.lit(v), 1).otherwise(0).alias(level_name(c, v))
                   for c, levels in self.levels.items() for v in levels]
        return df.select(*[c for c in df.columns if c not in self.levels], *dummies)


def fit_one_hot(df: DataFrame, cols: Sequence[str], max_levels: int = 100) -> OneHot:
    """Levels per column, sorted; more than ``max_levels`` in a column is an error.

    One result column per level only makes sense for few levels. A column with
    many levels belongs in `one_hot_vector`, whose rows stay one value wide.
    """
    return one_hot_of({c: list(counts) for c, counts in level_counts(df, cols, max_levels).items()})


def level_counts(df: DataFrame, cols: Sequence[str], max_levels: int = 100) -> dict[str, dict]:
    """Rows per level of each column; more than ``max_levels`` in a column is an error."""
    found: dict[str, dict] = {c: {} for c in cols}
    groups: dict[object, list[str]] = {}
    for c in cols:
        groups.setdefault(df.schema[c].dataType, []).append(c)
    for group in groups.values():
        # One row that holds at most so many: a limited collect may start a job per few partitions.
        some = value_counts(df, group).limit(max_levels * len(group) + 1)
        for r in some.agg(F.collect_list(F.struct("column", "value", "n")).alias("rows")).first()["rows"]:
            found[r["column"]][r["value"]] = r["n"]
    wide = [c for c in cols if len(found[c]) > max_levels]
    if wide:
        raise ValueError(f"more than {max_levels} levels in: {', '.join(wide)}; use one_hot_vector")
    return found


def one_hot_of(levels: Mapping[str, Sequence]) -> OneHot:
    fitted = {c: sorted(values) for c, values in levels.items()}
    names = [level_name(c, v) for c, values in fitted.items() for v in values]
    if len(set(names)) < len(names):
        raise ValueError("two levels give the same column name")
    return OneHot(fitted)


def one_hot(df: DataFrame, cols: Sequence[str], max_levels: int = 100) -> DataFrame:
    """Replace columns by one 0/1 column per observed value, none dropped."""
    return fit_one_hot(df, cols, max_levels).transform(df)


def one_hot_vector(df: DataFrame, cols: Sequence[str], suffix: str = "_vec",
                   max_levels: int = MAX_INDEXED) -> DataFrame:
    """Sparse vectors instead of columns, with a place per level by falling frequency and one for missing values.

    The index of a column of at most ``max_levels`` levels is held in memory, that of a
    column with more is a table.
    """
    many = _over(df, cols, max_levels)
    few = [c for c in cols if c not in many]
    indexed = df
    if few:
        index = StringIndexer(inputCols=few, outputCols=[f"{c}_index" for c in few], handleInvalid="keep")
        indexed = index.fit(df).transform(df)
    for c in many:
        ranks = level_ranks(df, c)
        n = ranks.count()
        # What the encoder reads the length of its vectors from.
        size = {"ml_attr": {"type": "nominal", "name": f"{c}_index", "num_vals": n + 1}}
        indexed = _with_index(indexed, c, ranks, f"{c}_index", F.lit(float(n)), size)
    encode = OneHotEncoder(inputCols=[f"{c}_index" for c in cols],
                           outputCols=[f"{c}{suffix}" for c in cols], dropLast=False)
    return encode.fit(indexed).transform(indexed).drop(*[f"{c}_index" for c in cols])


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Columns into one vector; a missing value is an error, so impute first."""
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


def min_max_vector(input_col: str, output_col: str) -> MinMaxScaler:
    """Vector scaler as a pipeline stage; a constant feature becomes 0.5."""
    return MinMaxScaler(inputCol=input_col, outputCol=output_col)


def _over(df: DataFrame, cols: Sequence[str], most: int) -> list[str]:
    """Columns with more than ``most`` levels; a sketch counts first, exactly where it is near."""
    about = df.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in cols]).first()
    return [c for c in cols
            if (about[c] if abs(about[c] - most) > 0.1 * most else df.filter(F.col(c).isNotNull()).select(c).distinct().count()) > most]


def level_ranks(df: DataFrame, col: str) -> DataFrame:
    """(level, n, rank): the texts of a column's values by falling frequency, ties in the order of the text.

    The table of an index of any size: counts are combined before the shuffle, and ranks
    come from range partitions.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("level")).agg(F.count(F.lit(1)).alias("n"))
    return with_rank(counts, [F.col("n").desc(), F.col("level")])


def _with_index(df: DataFrame, col: str, ranks: DataFrame, out: str, missing: Column, metadata: Mapping | None = None) -> DataFrame:
    """The index by joining its table, which is stored: of two plain exchanges Spark splits a hot level's rows."""
    level, rank = unused(df, "_level"), unused(df, "_rank")
    table = checkpointed(ranks.select(F.col("level").alias(level), F.col("rank").cast("double").alias(rank)))
    joined = df.join(table, df[col].cast("string") == table[level], "left")
    index = F.coalesce(F.col(rank), missing)
    fields = [F.col(f"`{c}`") for c in df.columns if c != out]
    return joined.select(*fields, index.alias(out, metadata=dict(metadata)) if metadata else index.alias(out))


def index_labels(df: DataFrame, col: str, out: str = "label", max_levels: int = MAX_INDEXED) -> DataFrame:
    """Label index by falling frequency, ties in the order of the label's text; a missing label is an error.

    More than ``max_levels`` labels are not brought to the driver: their index is a table
    that is joined.
    """
    if _over(df, [col], max_levels):
        return _with_index(df, col, level_ranks(df, col), out, F.raise_error(F.lit(f"{col} misses a label")).cast("double"))
    indexer = StringIndexer(inputCol=col, outputCol=out, stringOrderType="frequencyDesc")
    return indexer.fit(df).transform(df)


def binarize_label(df: DataFrame, col: str, classes: Sequence | None = None,
                   out: str | None = None) -> DataFrame:
    """1.0 for the second of two classes, else 0.0; by default the classes in sorted order."""
    if classes is None:
        seen = df.filter(F.col(col).isNotNull()).select(col).distinct().limit(3).collect()
        classes = sorted(r[0] for r in seen)
    if len(classes) != 2:
        raise ValueError(f"{col!r} needs two classes, not {'three or more' if len(classes) > 2 else len(classes)}")
    return df.withColumn(out or col, (F.col(col) == F.lit(classes[1])).cast("double"))
