"""Quality classifier from positive and unlabelled documents.

The risk is the non-negative unbiased one: with class prior p, loss l, positives P and
unlabelled U it is  p E_P[l(f)] + max(0, E_U[l(-f)] - p E_P[l(-f)]).
"""

from __future__ import annotations

import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import query
from tablewright.llm.documents import documents
from tablewright.llm.durable import stored
from tablewright.llm.host_rules import repeated_words

_SYMBOLS, _DIGITS, _MARKS = b"#*$%&|<>", b"0123456789", b"!"
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_STOP = re.compile(rb"[.!?](?=\s|$)")

FEATURES = (
    "log_chars", "log_words", "symbols", "upper", "digits", "exclamations", "bars", "punctuation", "odd_ends",
    "adjacent_repeats", "distinct_words", "repeated_windows", "repeated_lines", "word_length", "long_words",
    "capital_words", "stops", "line_length", "wordless",
)


def features(text: bytes) -> list[float]:
    """What a text looks like, whatever its language: shares of kinds of characters, words and repeats."""
    def count(characters: bytes) -> int:
        return len(text) - len(text.translate(None, characters))

    words = text.split()
    n, size = max(1, len(words)), max(1, len(text))
    lines = [line for line in text.split(b"\n") if line.strip()]
    upper, lower = count(_UPPER), count(_LOWER)
    return [
        np.log1p(len(text)), np.log1p(len(words)), count(_SYMBOLS) / n, upper / max(1, upper + lower),
        count(_DIGITS) / size, count(_MARKS) / n, words.count(b"|") / n, count(_PUNCTUATION) / size,
        sum(w[-1] in _SYMBOLS for w in words) / n,
        sum(map(operator.eq, words, words[1:])) / n, len(set(words)) / n, repeated_words(words) / n,
        1.0 - len(set(lines)) / max(1, len(lines)), np.log1p(sum(map(len, words)) / n),
        sum(len(w) > 20 for w in words) / n, sum(map(bytes.isupper, words)) / n, len(_STOP.findall(text)) / n,
        np.log1p(len(words) / max(1, len(lines))), float(not words),
    ]


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.float32())
    for batch in batches:
        table = [features(t or b"") for t in batch.column(1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(table, kind)], ["id", "features"])


def feature_table(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, features array<float>), one row per row, over whole texts; null counts as empty."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_feature_batches, f"id {rows.schema['id'].dataType.simpleString()}, features array<float>")


@dataclass(frozen=True)
class Model:
    """A linear score over standardized features, each held to a few deviations."""

    mean: np.ndarray
    deviation: np.ndarray
    weights: np.ndarray  # the last is the intercept
    prior: float

    REACH = 4.0

    def inputs(self, table: np.ndarray) -> np.ndarray:
        x = np.clip((table - self.mean) / self.deviation, -self.REACH, self.REACH)
        return np.hstack([x, np.ones((len(x), 1))])

    def scores(self, table: np.ndarray) -> np.ndarray:
        """The estimated probability of quality."""
        return 1.0 / (1.0 + np.exp(-np.clip(self.inputs(table) @ self.weights, -40.0, 40.0)))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _summed(table: DataFrame, partial) -> dict[int, float]:
    """Sums of the vectors that ``partial`` makes of each batch's features.

    Each task adds up its own; the sums meet by position in the vector, not on the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                vector = partial(_matrix(batch.column(0)))
                total = vector if total is None else total + vector
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "part"])

    sums = table.select("features").mapInArrow(run, "at long, part double").groupBy("at").agg(F.sum("part").alias("part"))
    return {r["at"]: r["part"] for r in sums.collect()}


def _vector(sums: dict[int, float], size: int) -> np.ndarray:
    return np.array([sums.get(i, 0.0) for i in range(size)])


def _standard(table: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    d = len(FEATURES)
    sums = _vector(_summed(table, lambda x: np.concatenate(([len(x)], x.sum(0), (x * x).sum(0)))), 2 * d + 1)
    n = max(1.0, sums[0])
    mean = sums[1:d + 1] / n
    deviation = np.sqrt(np.maximum(sums[d + 1:] / n - mean * mean, 0.0))
    return int(sums[0]), mean, np.where(deviation > 1e-9, deviation, 1.0)


def _risk_parts(table: DataFrame, model: Model) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Means over the table: l(-f), x, sigma(f) x, and sigma(f) (1 - sigma(f)) x x'."""
    d = len(FEATURES) + 1

    def partial(features: np.ndarray) -> np.ndarray:
        x = model.inputs(features)
        f = x @ model.weights
        s = 1.0 / (1.0 + np.exp(-np.clip(f, -40.0, 40.0)))
        return np.concatenate(([len(x), np.logaddexp(0.0, f).sum()], x.sum(0), s @ x, ((x.T * (s * (1.0 - s))) @ x).ravel()))

    sums = _vector(_summed(table, partial), 2 + 2 * d + d * d)
    n = max(1.0, sums[0])
    return sums[1] / n, sums[2:2 + d] / n, sums[2 + d:2 + 2 * d] / n, (sums[2 + 2 * d:] / n).reshape(d, d)


def fit(positive: DataFrame, unlabelled: DataFrame, model: Model, ridge: float = 1e-3, rounds: int = 25) -> Model:
    """Newton steps on the non-negative risk; each round is one pass over either table.

    With the logistic loss l(f) - l(-f) = -f, so positives enter the plain risk by their
    mean alone. Where the negative part of the risk is below zero, the step goes against its
    gradient, as the correction demands, and does not follow the plain risk.
    """
    weights, keep = model.weights, np.append(np.full(len(FEATURES), ridge), 1e-6)
    for _ in range(rounds):
        now = Model(model.mean, model.deviation, weights, model.prior)
        loss_u, _, slope_u, curve = _risk_parts(unlabelled, now)
        loss_p, mean_p, slope_p, _ = _risk_parts(positive, now)
        if loss_u - model.prior * loss_p < 0.0:
            step = 0.5 * (model.prior * slope_p - slope_u)
        else:
            slope = slope_u - model.prior * mean_p + keep * weights
            step = np.linalg.solve(curve + np.diag(keep + 1e-6), slope)
        step *= min(1.0, 3.0 / max(1e-12, float(np.abs(step).max())))
        weights = weights - step
        if np.abs(step).max() < 1e-3:
            break
    return Model(model.mean, model.deviation, weights, model.prior)


def estimate_prior(positive: DataFrame, unlabelled: DataFrame, model: Model, bins: int = 400) -> float:
    """The share of quality among the unlabelled: the best-bin estimate.

    A classifier of positives against unlabelled ranks documents. In its top bins only
    positives remain, so the share of the unlabelled there over the share of the positives
    there is the prior; the bin with the lowest upper confidence bound of that ratio is taken.
    """
    against = _positive_against_unlabelled(positive, unlabelled, model)

    def shares(table: DataFrame) -> tuple[float, np.ndarray]:
        def partial(features: np.ndarray) -> np.ndarray:
            at = np.minimum((against.scores(features) * bins).astype(int), bins - 1)
            return np.bincount(at, minlength=bins).astype(float)

        counts = _vector(_summed(table, partial), bins)
        return max(1.0, counts.sum()), counts[::-1].cumsum() / max(1.0, counts.sum())

    (n_p, top_p), (n_u, top_u) = shares(positive), shares(unlabelled)
    slack = np.sqrt(np.log(20.0) / (2.0 * n_u)) + np.sqrt(np.log(20.0) / (2.0 * n_p))
    enough = top_p > 0.01
    if not enough.any():
        return 0.5
    best = int(np.argmin(np.where(enough, (top_u + slack) / np.maximum(top_p, 1e-12), np.inf)))
    return float(np.clip(top_u[best] / top_p[best], 0.05, 0.98))


def _positive_against_unlabelled(positive: DataFrame, unlabelled: DataFrame, model: Model, rounds: int = 6) -> Model:
    """Logistic regression of positives (1) against unlabelled (0), both of weight one half."""
    weights, keep = np.zeros(len(FEATURES) + 1), np.append(np.full(len(FEATURES), 1e-3), 1e-6)
    for _ in range(rounds):
        now = Model(model.mean, model.deviation, weights, 0.5)
        _, _, slope_u, curve_u = _risk_parts(unlabelled, now)
        _, mean_p, slope_p, curve_p = _risk_parts(positive, now)
        step = np.linalg.solve((curve_u + curve_p) / 2 + np.diag(keep), (slope_u + slope_p - mean_p) / 2 + keep * weights)
        step *= min(1.0, 3.0 / max(1e-12, float(np.abs(step).max())))
        weights = weights - step
    return Model(model.mean, model.deviation, weights, 0.5)


def train(table: DataFrame, trusted: DataFrame, prior: float | None = None) -> Model:
    """Learn from a table (id, features): all its rows are the unlabelled, those in ``trusted`` (id) the positives.

    Every pass covers all rows; the driver holds sums of fixed length. Without trusted
    rows every text scores one half. A prior may be given instead of estimated.
    """
    n, mean, deviation = _standard(table)
    model = Model(mean, deviation, np.zeros(len(FEATURES) + 1), 0.5 if prior is None else prior)
    positive = stored(table.join(trusted.filter("id IS NOT NULL").distinct(), "id", "left_semi").select("features"), "positives")
    n_positive = positive.count()
    if not n or not n_positive:
        return model
    if prior is None:
        prior = estimate_prior(positive, table, model)
    # The positives' mean is all that the plain risk knows of them: few need more restraint.
    return fit(positive, table, Model(mean, deviation, model.weights, prior), ridge=1e-3 + 3.0 / n_positive)


def scored(table: DataFrame, model: Model) -> DataFrame:
    """(id, score) of a table (id, features)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(_matrix(batch.column(1))))], ["id", "score"])

    return table.select("id", "features").mapInArrow(run, f"id {table.schema['id'].dataType.simpleString()}, score double")


def text_score(model: Model, text_col: str = "text") -> Column:
    """The score of each text, for filtering documents where they are."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        table = np.array([features((t or "").encode()) for t in texts], np.float32).reshape(-1, len(FEATURES))
        return pd.Series(model.scores(table.astype(np.float64)))

    return score(F.col(text_col).cast("string"))


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learnt from; a null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """(id): labelled with quality and with nothing else, outside the held-out fold."""
    return (labels.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").alias("id"))
            .agg(F.min("quality").alias("low")).filter("low = 1").select("id"))


def learn_quality(spark: SparkSession, docs: DataFrame, folder: str) -> tuple[DataFrame, Model]:
    """The stored features of ``docs`` and a model learnt from them and the folder's labels."""
    table = stored(feature_table(docs, "doc_id", "text"), "features")
    return table, train(table, trusted_ids(spark.read.parquet(f"{folder}/labels.parquet")))


def quality_scores(spark: SparkSession, docs: DataFrame, folder: str, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``.

    Scores depend on the text alone. Null and empty texts are scored by the features of an
    empty text; null ids cannot be labelled; repeated rows are scored each; ids labelled both
    ways are not trusted. Other columns are not read; an empty table gives an empty result.
    """
    table, model = learn_quality(spark, docs, folder)
    return scored(table, model).select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


@query()
def op6_pu_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(spark, documents(spark, folder), folder)
