"""Cleaning, imputing and feature flows: one statistical, one by rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tablewright.operators.columns import interaction, keep_columns
from tablewright.operators.features import LinearScale, level_counts, level_name, one_hot_of
from tablewright.operators.impute import (
    DomainRepair,
    Surrogates,
    fit_range_repair,
)
from tablewright.operators.missing import drop_all_null, normalize_missing
from tablewright.operators.outliers import drop_isolated, drop_values, fences, within
from tablewright.operators.quantiles import exact_quantiles, quantile_head
from tablewright.operators.statistics import histogram, modes, statistics
from tablewright.session import stored_table
from tablewright.sources.schemas import CLEANED, STATISTICAL_CATEGORICAL, STATISTICAL_NUMERICAL


@dataclass(frozen=True)
class StatisticalConfig:
    """Columns and options of the statistical flow.

    ``key`` columns identify a row; they are carried along untouched. ``outliers``
    is "forest", "iqr" or "none"; ``exact`` takes the forest's cut-off from all rows. ``rescale`` names numeric columns scaled to
    [0, 1] before the last standardisation.
    """

    numeric: Sequence[str]
    categorical: Sequence[str]
    label: str
    key: Sequence[str] = ()
    threshold: float = 0.12
    rules: Mapping[str, Sequence] = field(default_factory=dict)
    outliers: str = "forest"
    contamination: float = 0.05
    trees: int = 100
    sample: int = 256
    seed: int = 42
    exact: bool = True
    iqr: float = 1.5
    rescale: Sequence[str] = ()
    standardize_first: bool = True
    standardize_last: bool = True
    encode: bool = True
    bins: int = 20


@dataclass(frozen=True)
class Prepared:
    table: DataFrame
    cleaned_histogram: DataFrame
    feature_histogram: DataFrame


def prepare_statistical(df: DataFrame, cfg: StatisticalConfig) -> Prepared:
    """Drop sparse columns, impute, apply rules, scale, drop outliers, encode, scale again.

    Each state of the table (as read, filled, without outliers) is profiled by one
    aggregate, which all fits of that state read; beyond it only exact quantiles, modes and
    levels need a pass of their own. What scaling does to a statistic is computed, not measured.
    """
    df = keep_columns(df, [*cfg.key, *cfg.numeric, *cfg.categorical])
    watched = [c for c in df.columns if c not in cfg.key]
    df = normalize_missing(df, watched)

    medians = {c: [0.5] for c in cfg.numeric}
    raw = _profile(df, watched, (), medians)
    sparse = {c for c in watched if c != cfg.label and raw["rows"] and (raw["rows"] - raw[f"present:{c}"]) / raw["rows"] > cfg.threshold}
    numeric = [c for c in cfg.numeric if c not in sparse]
    categorical = [c for c in cfg.categorical if c not in sparse]
    fills = {c: v[0] for c, v in exact_quantiles(df, {c: medians[c] for c in numeric}, head=raw).items()} | modes(df, categorical)
    df = Surrogates(fills, [*cfg.key, *numeric, *categorical]).transform(df)
    rules = {c: values for c, values in cfg.rules.items() if c in df.columns}
    if rules:
        df = drop_values(df, rules)

    quartiles = {c: [0.25, 0.75] for c in numeric} if cfg.outliers == "iqr" else {}
    shown = [*numeric, *_numeric_only(df, categorical)]
    filled = _profile(df, shown, numeric if cfg.standardize_first else (), quartiles)
    scale = _standard(filled, numeric) if cfg.standardize_first else LinearScale({})
    scaled = scale.transform(df)
    cleaned = histogram(scaled, shown, cfg.bins, _ends(filled, shown, scale))
    if cfg.outliers == "forest":
        df = drop_isolated(scaled, numeric, cfg.key, contamination=cfg.contamination, trees=cfg.trees,
                           sample=cfg.sample, seed=cfg.seed, exact=cfg.exact)
        df = df if cfg.exact else stored_table(df, "kept")  # exact, the scores are stored
    elif cfg.outliers == "iqr":
        # Scaling keeps order, so rows are outside before it that are outside after it.
        df = scale.transform(within(df, fences(exact_quantiles(df, quartiles, head=filled), cfg.iqr)))
    elif cfg.outliers == "none":
        df = scaled
    else:
        raise ValueError(f"unknown outlier treatment {cfg.outliers!r}")

    encoded = [c for c in categorical if c != cfg.label] if cfg.encode else []
    plain = [c for c in df.columns if c not in (*cfg.key, *encoded)]
    kept = _profile(df, _numeric_only(df, plain), numeric if cfg.standardize_last else ())
    rescale = LinearScale({c: (kept[f"min:{c}"], _span(kept, c)) for c in cfg.rescale if c in numeric})
    df = rescale.transform(df)
    ends = _ends(kept, _numeric_only(df, plain), rescale)
    if encoded:
        levels = level_counts(df, encoded)
        df = one_hot_of(levels).transform(df)
        ends |= {level_name(c, v): (int(n == kept["rows"]), 1) for c, counts in levels.items() for v, n in counts.items()}
    last = _standard(kept, numeric, rescale) if cfg.standardize_last else LinearScale({})
    df = last.transform(df)
    ends = {c: tuple(last.applied(c, end) for end in ends[c]) for c in df.columns if c in ends}
    return Prepared(df, cleaned, histogram(df, list(ends), cfg.bins, ends))


def _profile(df: DataFrame, cols: Sequence[str], moments: Sequence[str], quantiles: Mapping[str, Sequence[float]] | None = None) -> Row:
    """One aggregate: rows, values and extremes of columns, moments of some, the beginning of quantile searches."""
    numbers = _numeric_only(df, cols)
    return df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"present:{c}") for c in cols],
        *[f(c).alias(f"{name}:{c}") for c in numbers for name, f in (("min", F.min), ("max", F.max))],
        *[f(c).alias(f"{name}:{c}") for c in moments for name, f in (("mean", F.avg), ("std_pop", F.stddev_pop))],
        *quantile_head(quantiles or {})).first()


def _span(profile: Row, c: str) -> float | None:
    return None if profile[f"min:{c}"] is None else float(profile[f"max:{c}"] - profile[f"min:{c}"])


def _standard(profile: Row, cols: Sequence[str], before: LinearScale = LinearScale({})) -> LinearScale:
    """The standardisation of columns that ``before`` has scaled since they were profiled."""
    def parameters(c: str) -> tuple[float | None, float | None]:
        mean, deviation = before.applied(c, profile[f"mean:{c}"]), profile[f"std_pop:{c}"]
        if deviation is not None and c in before.parameters:
            span = before.parameters[c][1]
            deviation = deviation / span if span else 0.0
        return mean, deviation

    return LinearScale({c: parameters(c) for c in cols})


def _ends(profile: Row, cols: Sequence[str], scale: LinearScale) -> dict[str, tuple]:
    """The extremes of columns after scaling, which keeps their order."""
    return {c: tuple(scale.applied(c, profile[f"{end}:{c}"]) for end in ("min", "max")) for c in cols}


def _numeric_only(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if df.schema[c].dataType.typeName() not in ("string", "boolean")]


@dataclass(frozen=True)
class RulesConfig:
    """Columns and rules of the rule-based flow.

    ``ranges`` maps a column to its valid (lo, hi); invalid and missing values
    take the mean. ``domain`` columns are codes up to ``max_valid``; others take
    the mode.
    """

    columns: Sequence[str]
    modes: Sequence[str] = ()
    ranges: Mapping[str, tuple] = field(default_factory=dict)
    means: Sequence[str] = ()
    domain: Sequence[str] = ()
    max_valid: float = 1
    surrogate: str = "valid"
    product: tuple[str, str] | None = None
    product_name: str | None = None


def prepare_rules(df: DataFrame, cfg: RulesConfig) -> DataFrame:
    """Select, repair and impute by rules, then add a product feature.

    The rules touch different columns, so all means come from one aggregate over
    the input, all modes from one grouped job, and everything after that is one
    projection. The mean of repaired columns equals the mean of their valid
    values, so no second imputing pass is needed.
    """
    df = normalize_missing(keep_columns(df, cfg.columns))
    found = statistics(df, {c: ["mode"] for c in (*cfg.modes, *cfg.domain)})
    mode = {c: s["mode"] for c, s in found.items()}
    ranges = {**cfg.ranges, **{c: (None, None) for c in cfg.means}}
    repair = fit_range_repair(df, ranges, cfg.surrogate, fill_missing=True) if ranges else None
    fills = [*mode.values(), *(repair.means.values() if repair else ())]
    if all(value is None for value in fills):
        # With any fill value no row is empty afterwards. The test is left out then, because a
        # predicate over all computed columns is very expensive to plan.
        df = drop_all_null(df)
    if repair:
        df = repair.transform(df)
    df = DomainRepair({c: mode[c] for c in cfg.domain}, cfg.max_valid).transform(df)
    df = Surrogates({c: mode[c] for c in cfg.modes}).transform(df)
    return interaction(df, *cfg.product, out=cfg.product_name) if cfg.product else df


# The clinical table's columns, valid ranges, codes and rules.
CLINICAL_RULES = RulesConfig(
    columns=CLEANED.names,
    modes=["painloc", "painexer", "exang", "slope"],
    ranges={"trestbps": (100, None), "oldpeak": (0, 4)},
    means=["thaldur", "thalach"],
    domain=["fbs", "prop", "nitr", "pro", "diuretic"],
    product=("trestbps", "thalach"),
)
CLINICAL_STATISTICAL = StatisticalConfig(
    numeric=STATISTICAL_NUMERICAL,
    categorical=STATISTICAL_CATEGORICAL,
    label="target",
    rules={"prop": [22], "cyr": [1, 26, 16], "dummy": [0], "trestbps": [0], "tpeakbpd": [11],
           "trestbpd": [0]},
    rescale=["thaldur", "thalrest", "oldpeak"],
)
