"""Toxicity: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

What a text says is which character n-grams it holds at least once, twice, four times. Each
such fact has the logarithm of the ratio of its shares among toxic and other labelled
texts; a feature is that number where the fact holds, else 0. A logistic regression over
these features gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import query
from tablewright.llm.documents import documents
from tablewright.llm.durable import shuffle_partitions, stored

#: n-grams are of 3 to 6 code points, in 2**20 hash buckets.
LENGTHS = (3, 4, 5, 6)
BUCKETS = 1 << 20
#: A bucket's facts: it occurs at least that often.
TIMES = (1, 2, 4)
#: The classifier is fitted on about this many labelled texts at most, drawn by the hash of their id.
MAX_LABELLED = 20_000
#: Facts that the classifier looks at: those that tell most about the label.
MAX_FEATURES = 1024
_AT_ONCE = 1 << 16
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def buckets(text: str, lengths: Sequence[int] = LENGTHS, n_buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """The buckets of a text's n-grams, in parts, each of which may hold a bucket repeatedly.

    Letters count in lower case and white space as one space, which also stands at either end.
    """
    points = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    for at in range(0, len(points), _AT_ONCE):
        part = points[at:at + _AT_ONCE + max(lengths) - 1].astype(np.uint64)
        own = min(_AT_ONCE, len(points) - at)
        hashes = np.zeros(len(part), np.uint64)
        for n in range(1, max(lengths) + 1):
            if len(part) < n:
                break
            # The hash of n code points from that of the n - 1 before the last.
            hashes = (hashes[: len(part) - n + 1] ^ part[n - 1:]) * _FACTOR
            hashes ^= hashes >> np.uint64(32)
            if n in lengths:
                yield ((hashes[:own] + np.uint64(n)) % np.uint64(n_buckets)).astype(np.int64)


def _facts(found: list[np.ndarray]) -> np.ndarray:
    at, n = np.unique(np.concatenate([*found, np.empty(0, np.int64)]), return_counts=True)
    return np.concatenate([at[n >= times] + k * BUCKETS for k, times in enumerate(TIMES)])


def facts(text: str) -> np.ndarray:
    """The numbers bucket + k * BUCKETS of the buckets that the text holds TIMES[k] times or more, ascending."""
    return _facts(list(buckets(text)))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int) -> DataFrame:
    """(text, toxic) of about ``most`` labelled rows at most; ids labelled both ways are left out.

    Ids are drawn by a hash, all of them if there are fewer, so the ids are broadcast.
    """
    marked = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id"))
              .agg(F.min(label_col).alias("low"), F.max(label_col).alias("toxic")).filter("low = toxic"))
    n = marked.count()
    if n > most:
        marked = marked.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * most / n))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.join(F.broadcast(marked.select("id", "toxic")), "id").select("text", F.col("toxic").cast("int").alias("toxic"))


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, rows = np.zeros((2, BUCKETS * len(TIMES)), np.int64), np.zeros(2, np.int64)
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[toxic, facts(text)] += 1
            rows[toxic] += 1
    at = np.flatnonzero(counts.any(0))
    if rows.any():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(counts[1, at], rows[1])), pa.array(np.append(counts[0, at], rows[0]))],
            ["fact", "toxic", "other"])


@dataclass(frozen=True)
class Ratios:
    """Per chosen fact the log-count ratio."""

    fact: np.ndarray  # ascending
    ratio: np.ndarray


def log_count_ratios(sample: DataFrame, most: int = MAX_FEATURES, smoothing: float = 1.0) -> Ratios:
    """The ``most`` facts by their likelihood ratio with the label, and log((p / |p|) / (q / |q|)) of each.

    p and q are the numbers of toxic and other texts that have the fact, plus ``smoothing``;
    |p| and |q| their sums over all facts.
    """
    sums = stored(sample.mapInArrow(_count_batches, "fact long, toxic long, other long")
                  .groupBy("fact").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")), "ratios")
    total = sums.agg(*[F.sum(F.when(F.col("fact") < 0, F.col(c))).alias(f"texts_{c}") for c in ("toxic", "other")],
                     *[F.sum(F.when(F.col("fact") >= 0, F.col(c))).alias(c) for c in ("toxic", "other")]).first()
    if not total["texts_toxic"] or not total["texts_other"]:
        return Ratios(np.empty(0, np.int64), np.empty(0))
    p, q = total["texts_toxic"], total["texts_other"]
    with_it, without = F.col("toxic") + F.col("other"), F.lit(p + q) - F.col("toxic") - F.col("other")

    def part(seen: Column, of: Column, share: float) -> Column:
        return F.when(seen > 0, seen * F.log(seen / (of * share))).otherwise(0.0)

    evidence = (part(F.col("toxic"), with_it, p / (p + q)) + part(F.col("other"), with_it, q / (p + q))
                + part(p - F.col("toxic"), without, p / (p + q)) + part(q - F.col("other"), without, q / (p + q)))
    best = sums.filter("fact >= 0").withColumn("evidence", evidence).orderBy(F.desc("evidence"), "fact").limit(most).collect()
    best = sorted(best, key=lambda r: r["fact"])
    norm = np.log((total["toxic"] + smoothing * BUCKETS * len(TIMES)) / (total["other"] + smoothing * BUCKETS * len(TIMES)))
    ratio = np.log([(r["toxic"] + smoothing) / (r["other"] + smoothing) for r in best]) - norm
    return Ratios(np.array([r["fact"] for r in best], np.int64), ratio)


@dataclass(frozen=True)
class Toxicity:
    """The weight of each chosen fact, and the intercept."""

    fact: np.ndarray
    weight: np.ndarray
    intercept: float

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        table = np.zeros(BUCKETS * len(TIMES))
        table[self.fact] = self.weight
        known = np.zeros(BUCKETS, bool)
        known[self.fact % BUCKETS] = True
        out = np.full(len(texts), self.intercept)
        for i, text in enumerate(texts):
            # Few n-grams are in chosen buckets; only these are counted.
            out[i] += table[_facts([at[known[at]] for at in buckets(text)])].sum()
        return 1.0 / (1.0 + np.exp(-np.clip(out, -40.0, 40.0)))


def _chosen_batches(chosen: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[str(b) for b in np.intersect1d(facts(t), chosen, assume_unique=True)] for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.string()))], ["toxic", "found"])

    return run


def train(sample: DataFrame, most: int = MAX_FEATURES, ridge: float = 1e-3, rounds: int = 60) -> Toxicity:
    """Learn from a table (text, toxic); without texts of both kinds every score is the share of toxic ones.

    Spark's logistic regression sees the facts found in a text, each scaled by its
    ratio and by nothing else.
    """
    ratios = log_count_ratios(sample, most)
    if not len(ratios.fact):
        n, share = sample.agg(F.count(F.lit(1)), F.avg("toxic")).first()
        share = share if n else 0.0
        return Toxicity(ratios.fact, ratios.ratio, float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    found = stored(sample.mapInArrow(_chosen_batches(ratios.fact), "toxic int, found array<string>"), "found")
    words = [str(b) for b in ratios.fact.tolist()]
    presence = CountVectorizerModel.from_vocabulary(words, "found", "presence", binary=True)
    scale = ElementwiseProduct(scalingVec=Vectors.dense(ratios.ratio), inputCol="presence", outputCol="features")
    regression = LogisticRegression(labelCol="toxic", regParam=ridge, maxIter=rounds, standardization=False)
    fitted = regression.fit(scale.transform(presence.transform(found)).select("features", "toxic"))
    return Toxicity(ratios.fact, fitted.coefficients.toArray() * ratios.ratio, float(fitted.intercept))


def _score_batches(model: Toxicity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["id", "score"])

    return run


def scored(df: DataFrame, model: Toxicity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score), one row per row; null counts as empty."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_score_batches(model), f"id {rows.schema['id'].dataType.simpleString()}, score double")


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learnt from; a null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", most_labelled: int = MAX_LABELLED, most_features: int = MAX_FEATURES) -> Toxicity:
    """Learn from the labelled rows outside the held-out fold, at most about ``most_labelled`` of them."""
    drawn = labelled_sample(docs, labels.filter(~held_out(F.col(id_col))), id_col, text_col, label_col, most_labelled)
    # Few rows, however many tasks found them.
    sample = stored(drawn.repartition(min(shuffle_partitions(docs), 64)), "labelled")
    return train(sample, most_features)


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``.

    Scores depend on the text alone. Null and empty texts are scored by the intercept; null
    ids cannot be labelled; repeated rows are scored each; ids labelled both ways or with
    neither 0 nor 1 are not learnt from. Other columns are not read; an empty table gives an
    empty result.
    """
    return scored(docs, learn_toxicity(docs, labels, **options)).select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


@query()
def op12_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_scores(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))
